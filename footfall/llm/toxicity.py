"""Toxic passages as maximum-scoring segments of token log-odds.

Training counts words of toxic and clean labelled documents; each word's
log-odds are smoothed by a Dirichlet prior in proportion to its frequency in the
whole corpus (Monroe and others). A word counts once per document. Words that
stand out by their likelihood ratio keep their own log-odds, the rest share one
small negative value. A linear scan finds all maximal
segments of a document's words (Ruzzo and Tompa). Segment scores in clean text
follow an extreme-value law (Karlin and Altschul), whose scale and size are
fitted on clean documents; a document's significant segments are summed as bits
over chance, and a logistic curve turns the sum into a score.

A null or empty text has no words and gets the score of a text without any
segment. Rows with null or equal ids are scored one by one. Documents without an
id or a label, and labels without a document, do not train; an id labelled more
than once is toxic if any label says so. With no usable labels every score is
about 0. Only the text is scored. An empty table gives no rows; other columns are
ignored by ``toxicity`` and kept by ``scored``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from footfall.llm.columns import fresh
from footfall.llm.words import Remembered, texts_of
from footfall.settings import materialize

# Labelled rows that the model is fitted on, at most; drawn by a digest of doc_id.
FIT_ROWS = 30_000
# Words with log-odds of their own, at most: those that stand out most.
MODEL_WORDS = 50_000
# Twice the log-likelihood ratio from which a word stands out; as chi-square, a chance of 1 in 100,000.
STANDS_OUT = 20.0
# Strength of the prior, in words per class.
PRIOR = 2_000.0
# Segments below this score are not looked at when the law is fitted.
FIT_SCORE = 2.0
# Expected segments by chance per document up to which a segment is significant.
SIGNIFICANT = 0.05
THRESHOLD = 0.7
_WORD = regex.compile(r"[^\W\d_]+")
_COUNTED = 300_000


def tokens(text: bytes) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.decode("utf-8", "replace").lower())


@dataclass
class Model:
    odds: dict[str, float]
    rest: float = 0.0
    scale: float = 1.0
    size: float = 1.0
    slope: float = 0.0
    offset: float = -50.0

    def segments(self, words: list[str]) -> list[tuple[float, int, int]]:
        """Maximal scoring segments (score, start, end), in time linear in the words.

        Only words with positive log-odds can start or end a segment, so the scan
        goes from one of these to the next and sums what lies between.
        """
        # Start, end, total before, total with it, and the last one that began at a smaller total.
        found: list[list[float]] = []
        total = 0.0
        odds, rest = self.odds.get, self.rest
        for i, word in enumerate(words):
            value = odds(word, rest)
            if value <= 0:
                total += value
                continue
            now = [i, i + 1, total, total + value, -1]
            total += value
            while True:
                k = len(found) - 1
                while k >= 0 and found[k][2] >= now[2]:
                    k = found[k][4]
                if k < 0 or found[k][3] >= now[3]:
                    now[4] = k
                    found.append(now)
                    break
                now = [found[k][0], i + 1, found[k][2], now[3], -1]
                del found[k:]
        return [(after - before, a, b) for a, b, before, after, _ in found]

    def expected(self, score: float, words: int) -> float:
        """Segments of that score that chance brings into so many words."""
        return self.size * max(1, words) * math.exp(-self.scale * min(score, 500.0))

    def evidence(self, words: list[str]) -> tuple[float, list[tuple[float, int, int]]]:
        """Nats over chance of the significant segments, and these."""
        passages = [s for s in self.segments(words) if self.expected(s[0], len(words)) <= SIGNIFICANT]
        return sum(-math.log(max(self.expected(s[0], len(words)), 1e-300)) for s in passages), passages

    def score(self, evidence: float) -> float:
        z = self.slope * math.log1p(evidence) + self.offset
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _counts(docs: DataFrame) -> DataFrame:
    """(word, corpus, toxic, clean): how many of all and of the labelled documents hold a word.

    The column ``toxic`` of ``docs`` is null, 0 or 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = Counter(), Counter(), Counter()

        def emitted() -> pa.RecordBatch:
            words = list(counters[0])
            columns = [pa.array([c[w] for w in words], pa.int64()) for c in counters]
            return pa.record_batch([pa.array(words, pa.string()), *columns], names=["word", "corpus", "toxic", "clean"])

        for batch in batches:
            labels = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
            for text, label in zip(texts_of(batch, "text"), labels, strict=True):
                words = set(tokens(text))
                counters[0].update(words)
                if label is not None:
                    counters[1 if label else 2].update(words)
                if len(counters[0]) >= _COUNTED:
                    yield emitted()
                    for c in counters:
                        c.clear()
        yield emitted()

    return (
        docs.select(F.col("text").cast("binary").alias("text"), "toxic")
        .mapInArrow(run, "word string, corpus long, toxic long, clean long")
        .groupBy("word")
        .agg(F.sum("corpus").alias("corpus"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def held_out(doc_id):
    """Rows that never train: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, model_words: int = MODEL_WORDS) -> Model:
    usable = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    # At most fit_rows rows of two numbers: small enough for every task.
    chosen = F.broadcast(materialize(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "labels"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = materialize(_counts(texts.join(chosen, "doc_id", "left")), "counts")
    total = counts.agg(*[F.sum(c).alias(c) for c in ("corpus", "toxic", "clean")]).first()
    if not total.toxic or not total.clean:
        return Model({})
    prior = F.col("corpus") * (PRIOR / total.corpus)

    def log_odds(count: str, n: int):
        return F.log((F.col(count) + prior) / (n + PRIOR - F.col(count) - prior))

    delta = log_odds("toxic", total.toxic) - log_odds("clean", total.clean)

    def part(count: str, n: int):
        """A class's share of the likelihood ratio."""
        chance = (F.col("toxic") + F.col("clean")) * (n / (total.toxic + total.clean))
        return F.when(F.col(count) > 0, F.col(count) * F.log(F.col(count) / chance)).otherwise(0.0)

    ratio = 2 * (part("toxic", total.toxic) + part("clean", total.clean))
    stand_out = (
        counts.where("toxic > 0")
        .select("word", "toxic", "clean", delta.alias("delta"), ratio.alias("ratio"))
        .where((F.col("ratio") >= STANDS_OUT) & (F.col("delta") > 0))
        .orderBy(F.desc("ratio"), "word")
        .limit(model_words)
        .collect()
    )
    model = Model({r.word: float(r.delta) for r in stand_out})
    # The words without log-odds of their own: how much rarer they are in toxic text.
    in_toxic = sum(r.toxic for r in stand_out)
    in_clean = sum(r.clean for r in stand_out)
    model.rest = min(-0.01, math.log((1 - in_toxic / (total.toxic + 1)) / (1 - in_clean / (total.clean + 1))))
    _fit_law(model, [(r.delta, r.clean) for r in stand_out], total.clean)
    _calibrate(model, texts.join(chosen, "doc_id"))
    return model


def _fit_law(model: Model, words: list[tuple[float, int]], n: int) -> None:
    """The scale at which the mean of exp(scale * score) over clean words is 1."""
    smooth = 0.5 / max(1, len(words))
    shares = [(d, (c + smooth) / (n + 1)) for d, c in words]
    left = 1 - sum(p for _, p in shares)

    def mean(scale: float) -> float:
        return left * math.exp(scale * model.rest) + sum(p * math.exp(min(700.0, scale * d)) for d, p in shares)

    low, high = 1e-3, 1.0
    while mean(high) < 1 and high < 16:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    model.scale = max(low, 0.05)


def _calibrate(model: Model, labelled: DataFrame) -> None:
    """Fits the law's size on clean rows, then the logistic curve on all of the bounded rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
            n, scores = [], []
            for text in texts_of(batch, "text"):
                words = tokens(text)
                n.append(len(words))
                scores.append(sorted((s[0] for s in model.segments(words)), reverse=True))
            yield pa.record_batch(
                [pa.array(labels, pa.int32()), pa.array(n, pa.int64()), pa.array(scores, pa.list_(pa.float64()))],
                names=["toxic", "n", "scores"],
            )

    rows = materialize(
        labelled.select("toxic", F.col("text").cast("binary").alias("text"))
        .mapInArrow(run, "toxic int, n long, scores array<double>")
        .select("toxic", "n", "scores", F.size(F.filter("scores", lambda s: s >= FIT_SCORE)).alias("many")),
        "segments",
    )
    law = rows.where("toxic = 0").agg(F.sum("many").alias("many"), F.sum("n").alias("n")).first()
    model.size = ((law.many or 0) + 0.5) * math.exp(model.scale * FIT_SCORE) / max(1, law.n or 0)
    chance = F.lit(model.size) * F.greatest("n", F.lit(1))

    def nats(s):
        return F.lit(model.scale) * F.least(s, F.lit(500.0)) - F.log(chance)

    significant = F.filter("scores", lambda s: nats(s) >= -math.log(SIGNIFICANT))
    evidence = F.aggregate(significant, F.lit(0.0), lambda a, s: a + nats(s))
    # Rounded evidence has few values; they are counted.
    bins = (
        rows.select("toxic", F.round(F.log1p(evidence), 2).alias("x"))
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
        .collect()
    )
    x = np.array([float(b.x) for b in bins])
    n = np.array([float(b.n) for b in bins])
    y = np.array([float(b.toxic) for b in bins])
    slope, offset = 0.0, 0.0
    for _ in range(100):  # Newton steps with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -40, 40)))
        g = np.array([((y - n * p) * x).sum() - 0.1 * slope, (y - n * p).sum()])
        w = n * p * (1 - p) + 1e-9
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-9:
            break
    model.slope, model.offset = max(0.0, float(slope)), float(offset)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns, and toxic_score, toxic_passages (start, end in words, score) as the last two.

    Where docs has a column of such a name, the new one has an underscore in front.
    """
    added = [fresh(name, docs.columns) for name in ("toxic_score", "toxic_passages")]
    passages_type = ArrayType(StructType().add("start", "integer").add("end", "integer").add("score", "double"))
    names = [*docs.columns, *added]
    # By place while they are in the tasks, for a name may hold anything.
    places = [f"c{k}" for k in range(len(names))]
    fields = [StructField(at, f.dataType) for at, f in zip(places, docs.schema.fields, strict=False)]
    schema = StructType(fields).add(places[-2], "double").add(places[-1], passages_type)
    text_at = places[docs.columns.index(text)]
    passage = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, passages = [], []
            for t in texts_of(batch, text_at):
                nats, found = model.evidence(tokens(t))
                scores.append(model.score(nats))
                passages.append([{"start": a, "end": b, "score": s} for s, a, b in found])
            yield pa.record_batch(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(passages, passage)], names=places
            )

    return docs.toDF(*places[:-2]).mapInArrow(run, schema).toDF(*names)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, passages of every row."""
    model = fit(docs, labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scored(texts, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("toxic_passages").alias("passages"),
    )
