"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is predicted from the tokens on both sides of it. The network knows
the most frequent words of the whole corpus, and buckets for the rest; an id's
probability is that of its class times that within the class. A word of a bucket
has, besides, its share of the bucket's tokens, from the counts of all words of
the corpus, which stay a table; words that the corpus does not have count as one
more token of their bucket. The network is
trained in numpy on all documents: each task trains a copy on its own documents,
and the copies are averaged by Spark, weighted by their tokens; training takes
two such rounds, which share the tokens between them. A document's score is the
sum of its tokens' conditional log-probabilities.

Nulls and texts without words have no tokens, a sum of 0 and a null mean. Rows
with null or equal ids are scored one by one; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.words import LOWER, Remembered, texts_of
from footfall.settings import materialize

CLASSES = 32
VOCABULARY = CLASSES * CLASSES
# Ids of the most frequent words; the others share the ids above.
FREQUENT = 768
SIDE = 2
WIDTH = 16
BLOCK = 16_384
# Documents encoded as one row.
BLOCK_TEXTS = 2_000
RATE = 0.1
ROUNDS = 2
SEED = 7
PAD = VOCABULARY
_COUNTED = 300_000

SHAPES = {
    "context": (2 * SIDE, VOCABULARY + 1, WIDTH),
    "hidden": (WIDTH,),
    "class": (CLASSES, WIDTH),
    "class_bias": (CLASSES,),
    "member": (CLASSES, CLASSES, WIDTH),
    "member_bias": (CLASSES, CLASSES),
}
SIZES = {k: int(np.prod(s)) for k, s in SHAPES.items()}

Net = dict[str, np.ndarray]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


class Vocabulary(NamedTuple):
    """The keys of words with an id of their own, by rank; key and count of every other word; the tokens of each bucket."""

    frequent: list[int]
    rest: DataFrame
    tokens: dict[int, int]


def bucket_key(word: bytes) -> int:
    """A long that stands for a word: its bucket's id in the last ten bits, a hash above."""
    key = (xxhash.xxh64_intdigest(word) * VOCABULARY + FREQUENT + zlib.crc32(word) % (VOCABULARY - FREQUENT)) % 2**64
    return key - 2**64 if key >= 2**63 else key


def vocabulary(docs: DataFrame, most: int = FREQUENT) -> Vocabulary:
    """All words of all documents, by their keys; the most frequent ones with ties by the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()

        def emitted() -> pa.RecordBatch:
            keys = pa.array(map(bucket_key, counter), pa.int64())
            return pa.record_batch([keys, pa.array(list(counter.values()), pa.int64())], names=["key", "n"])

        for batch in batches:
            for text in texts_of(batch, "text"):
                counter.update(words_of(text))
                if len(counter) >= _COUNTED:
                    yield emitted()
                    counter.clear()
        yield emitted()

    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "key long, n long")
    counts = materialize(counts.groupBy("key").agg(F.sum("n").alias("n")), "words")
    top = [r.key for r in counts.orderBy(F.desc("n"), "key").limit(most).collect()]
    rest = counts.where(~F.col("key").isin(top))
    bucket = F.col("key").bitwiseAND(F.lit(VOCABULARY - 1)).alias("bucket")
    tokens = rest.groupBy(bucket).agg(F.sum("n").alias("n")).collect()
    return Vocabulary(top, rest, {r.bucket: r.n for r in tokens})


def initial() -> Net:
    draw = np.random.default_rng(SEED)
    net = {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
    for k in ("context", "class", "member"):
        net[k] = draw.normal(0, 0.1, SHAPES[k]).astype(np.float32)
    return net


class Ids:
    """Numbers of words: the rank of the frequent ones, the others' keys. A number's last ten bits are the id."""

    def __init__(self, frequent: list[int]):
        rank = {key: i for i, key in enumerate(frequent)}

        def number(word: bytes) -> int:
            key = bucket_key(word)
            return rank.get(key, key)

        self.memory = Remembered(number)

    def keyed(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all texts' words with padding around each text, the places of the tokens, and each token's text."""
        ids, places, owners = [np.full(SIDE, PAD, np.int64)], [], []
        at = SIDE
        for k, text in enumerate(texts):
            words = words_of(text)
            if not words:
                continue
            ids.append(np.fromiter(map(self.memory.__getitem__, words), np.int64, len(words)))
            ids.append(ids[0])
            places.append(np.arange(at, at + len(words)))
            owners.append(np.full(len(words), k))
            at += len(words) + SIDE
        empty = [np.empty(0, np.int64)]
        return np.concatenate(ids), np.concatenate(places or empty), np.concatenate(owners or empty)


OFFSETS = [d for d in range(-SIDE, SIDE + 1) if d]


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


def _hidden(net: Net, around: list[np.ndarray]) -> np.ndarray:
    h = net["hidden"] + net["context"][0][around[0]]
    for table, ids in zip(net["context"][1:], around[1:], strict=True):
        h += table[ids]
    return np.tanh(h, out=h)


def log_probabilities(net: Net, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """log p(token | tokens around it) for every place."""
    out = np.empty(len(places), np.float32)
    for start in range(0, len(places), BLOCK):
        at = places[start : start + BLOCK]
        target = ids[at]
        order = np.argsort(target // CLASSES, kind="stable")
        at, target = at[order], target[order]
        h = _hidden(net, [ids[at + d] for d in OFFSETS])
        kind = target // CLASSES
        value = _log_softmax(h @ net["class"].T + net["class_bias"])[np.arange(len(at)), kind]
        edges = np.searchsorted(kind, np.arange(CLASSES + 1))
        for c in range(CLASSES):
            s = slice(edges[c], edges[c + 1])
            if s.start < s.stop:
                inner = _log_softmax(h[s] @ net["member"][c].T + net["member_bias"][c])
                value[s] += inner[np.arange(s.stop - s.start), target[s] % CLASSES]
        out[start + order] = value
    return out


class Trainer:
    """Adagrad over blocks of tokens."""

    def __init__(self, net: Net):
        self.net = {k: v.copy() for k, v in net.items()}
        self.seen = {k: np.full(v.shape, 1e-6, np.float32) for k, v in net.items()}

    def _step(self, name: str, gradient: np.ndarray, index=...) -> None:
        seen = self.seen[name]
        seen[index] += gradient * gradient
        self.net[name][index] -= RATE * gradient / np.sqrt(seen[index])

    def block(self, ids: np.ndarray, at: np.ndarray) -> None:
        net, n = self.net, len(at)
        target = ids[at]
        order = np.argsort(target // CLASSES, kind="stable")
        at, target = at[order], target[order]
        around = [ids[at + d] for d in OFFSETS]
        h = _hidden(net, around)
        kind, member = target // CLASSES, target % CLASSES
        p = np.exp(_log_softmax(h @ net["class"].T + net["class_bias"]))
        p[np.arange(n), kind] -= 1
        back = p @ net["class"]
        steps = [("class", p.T @ h / n, ...), ("class_bias", p.mean(axis=0), ...)]
        edges = np.searchsorted(kind, np.arange(CLASSES + 1))
        for c in range(CLASSES):
            s = slice(edges[c], edges[c + 1])
            if s.start < s.stop:
                q = np.exp(_log_softmax(h[s] @ net["member"][c].T + net["member_bias"][c]))
                q[np.arange(s.stop - s.start), member[s]] -= 1
                back[s] += q @ net["member"][c]
                steps.append(("member", q.T @ h[s] / n, c))
                steps.append(("member_bias", q.sum(axis=0) / n, c))
        back *= (1 - h * h) / n
        steps.append(("hidden", back.sum(axis=0), ...))
        for k, ids_around in enumerate(around):
            columns = [np.bincount(ids_around, back[:, j], VOCABULARY + 1) for j in range(WIDTH)]
            steps.append(("context", np.stack(columns, axis=1).astype(np.float32), k))
        for name, gradient, index in steps:
            self._step(name, gradient, index)


def _flat(net: Net) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in SHAPES])


def _shaped(values: np.ndarray) -> Net:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        out[k] = values[at : at + SIZES[k]].reshape(shape).astype(np.float32)
        at += SIZES[k]
    return out


ENCODED = (
    "rows array<long>, doc_ids array<long>, tokens array<int>, ids binary, rare array<int>, words binary, times binary, "
    "keys array<long>"
)


def encoded(docs: DataFrame, frequent: list[int]) -> DataFrame:
    """The documents as numbers, one row for each batch of them, with its ``block``.

    ``ids`` holds the ids of all tokens, with padding around each document of
    ``tokens`` tokens. ``keys`` are the block's words without an id of their own;
    ``words`` and ``times`` say for each document in turn which of them it has,
    ``rare`` many, and how often.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = Ids(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_TEXTS):
                part = batch.slice(at, BLOCK_TEXTS)
                n = part.num_rows
                keys, places, owners = keys_of.keyed(texts_of(part, "text"))
                ids = np.full(len(keys), PAD, np.uint16)
                ids[places] = keys[places] & (VOCABULARY - 1)
                rare = ids[places] >= FREQUENT
                known, word = np.unique(keys[places][rare], return_inverse=True)
                pair, times = np.unique(owners[rare] * max(1, len(known)) + word, return_counts=True)
                owner, word = np.divmod(pair, max(1, len(known)))
                one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                columns = [
                    one(part.column(0)),
                    one(part.column(1)),
                    one(pa.array(np.bincount(owners, minlength=n), pa.int32())),
                    pa.array([ids.astype("<u2").tobytes()], pa.binary()),
                    one(pa.array(np.bincount(owner, minlength=n), pa.int32())),
                    pa.array([word.astype("<i4").tobytes()], pa.binary()),
                    pa.array([times.astype("<i4").tobytes()], pa.binary()),
                    one(pa.array(known, pa.int64())),
                ]
                yield pa.record_batch(columns, names=[c.split()[0] for c in ENCODED.split(", ")])

    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")
    )
    # Written once, so that texts are read and rows are numbered once.
    return materialize(texts.mapInArrow(run, ENCODED).withColumn("block", F.monotonically_increasing_id()), "encoded")


def _places(ids: np.ndarray) -> np.ndarray:
    return np.flatnonzero(ids != PAD)


def _round(blocks: DataFrame, net: Net, number: int, rounds: int) -> Net:
    """One round: every task trains on its share of blocks, and the copies are averaged."""
    sent = blocks.sparkSession.sparkContext.broadcast(_flat(net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, tokens, seen = Trainer(_shaped(sent.value)), 0, 0
        for batch in batches:
            for stored in batch.column(0):
                ids = np.frombuffer(stored.as_py(), "<u2").astype(np.int64)
                places = _places(ids)
                for start in range(0, len(places), BLOCK):
                    seen += 1
                    if seen % rounds == number:
                        trainer.block(ids, places[start : start + BLOCK])
                        tokens += len(places[start : start + BLOCK])
        if tokens:
            flat = _flat(trainer.net).astype(np.float64) * tokens
            yield pa.record_batch(
                [pa.array([tokens], pa.int64()), pa.array([flat], pa.list_(pa.float64()))], names=["tokens", "sums"]
            )

    copies = blocks.select("ids").mapInArrow(run, "tokens long, sums array<double>")
    # Summed place by place before and after the shuffle; a copy has a fixed size.
    summed = (
        copies.select("tokens", F.posexplode("sums").alias("place", "value"))
        .groupBy("place")
        .agg((F.sum("value") / F.sum("tokens")).alias("value"))
    )
    rows = materialize(summed, "network").collect()
    if not rows:
        return net
    values = np.empty(sum(SIZES.values()))
    for r in rows:
        values[r.place] = r.value
    return _shaped(values)


def _trained(blocks: DataFrame, rounds: int = ROUNDS) -> Net:
    net = initial()
    for number in range(rounds):
        net = _round(blocks, net, number, rounds)
    return net


def train(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Net, Vocabulary]:
    known = vocabulary(docs)
    return _trained(encoded(docs, known.frequent), rounds), known


def scored(docs: DataFrame, net: Net, known: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, log_likelihood, mean_log_likelihood of every row."""
    return _scored(encoded(docs, known.frequent), net, known)


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    known = vocabulary(docs)
    blocks = encoded(docs, known.frequent)
    return _scored(blocks, _trained(blocks), known)


def _scored(blocks: DataFrame, net: Net, known: Vocabulary) -> DataFrame:
    totals = np.zeros(VOCABULARY, np.int64)
    for bucket, n in known.tokens.items():
        totals[bucket] = n
    # Every bucket has one token more, for the words that the corpus does not have.
    sent = blocks.sparkSession.sparkContext.broadcast((_flat(net), np.log(totals + 1)))
    # A block's words meet their counts once, however many documents have them; a word that is there once adds nothing.
    counts = known.rest.where("n > 1").select("key", F.log("n").alias("log_n"))
    shares = (
        blocks.select("block", F.explode("keys").alias("key"))
        .join(counts, "key")
        .groupBy("block")
        .agg(F.collect_list(F.struct("key", "log_n")).alias("shares"))
        .select("block", F.col("shares.key").alias("found"), F.col("shares.log_n").alias("log_n"))
    )

    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def in_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, buckets = sent.value
        own = _shaped(values)
        for batch in batches:
            for row in range(batch.num_rows):
                block, doc_ids, tokens, stored = (batch.column(k)[row] for k in range(4))
                ids = np.frombuffer(stored.as_py(), "<u2").astype(np.int64)
                places = _places(ids)
                value = log_probabilities(own, ids, places).astype(np.float64)
                in_bucket = ids[places] >= FREQUENT
                value[in_bucket] -= buckets[ids[places][in_bucket]]
                tokens = tokens.values
                total = np.bincount(np.repeat(np.arange(len(tokens)), tokens.to_numpy()), value, len(tokens))
                yield pa.record_batch(
                    [pa.array([block.as_py()], pa.int64()), one(doc_ids.values), one(tokens), one(pa.array(total))],
                    names=["block", "doc_ids", "tokens", "totals"],
                )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                stored = {name: batch.column(k)[row] for k, name in enumerate(batch.schema.names)}
                lists = ("doc_ids", "tokens", "totals", "rare", "keys", "found", "log_n")
                doc_ids, tokens, total, rare, keys, found, log_n = (stored[k].values for k in lists)
                tokens, rare, keys = tokens.to_numpy(), rare.to_numpy(), keys.to_numpy()
                n = len(tokens)
                share = np.zeros(len(keys))
                if found is not None:
                    share[np.searchsorted(keys, found.to_numpy())] = log_n.to_numpy()
                word, times = (np.frombuffer(stored[k].as_py(), "<i4") for k in ("words", "times"))
                total = total.to_numpy() + np.bincount(np.repeat(np.arange(n), rare), share[word] * times, n)
                mean = [float(t) / int(m) if m else None for t, m in zip(total, tokens, strict=True)]
                yield pa.record_batch(
                    [doc_ids, pa.array(tokens, pa.int64()), pa.array(total), pa.array(mean, pa.float64())],
                    names=["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"],
                )

    # The tokens are scored where they lie; what meets the shares are the documents' sums and words.
    totals = blocks.select("block", "doc_ids", "tokens", "ids").mapInArrow(
        in_context, "block long, doc_ids array<long>, tokens array<int>, totals array<double>"
    )
    own_words = blocks.select("block", "rare", "words", "times", "keys")
    columns = ["doc_ids", "tokens", "totals", "rare", "words", "times", "keys", "found", "log_n"]
    return own_words.join(totals, "block").join(shares, "block", "left").select(*columns).mapInArrow(
        shared, "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double"
    )
