"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct five-word shingles. A few small collections
of minhashes are computed, and the keys of the tables are all pairs of
collections: with m collections of k minhashes there are m(m-1)/2 tables for
m*k minhashes, about the square root of what independent tables need. Two
documents meet in a table when at least two of their collections agree. Only
collections that agree with some other document's give keys.

Documents with equal sets are one class, represented by its smallest doc_id.
Representatives that share a table key are candidates. First each is held
against the smallest and the largest one of the key. What that leaves in
different components is held against each other where a third collection agrees
as well, once, for the first three that do. One-bit minhashes of the candidates (Li and Koenig) drop pairs that are
far from similar enough, and every link is confirmed on the full sets.

Texts that are null or have no word have an empty set and are linked with
nothing. A row without doc_id is linked with nothing; its component is null and
it is kept. Rows that share a doc_id share its component. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.llm.words import LOWER, array_of, gram_hashes, hash_memory, mixed, texts_of, word_hashes
from footfall.settings import materialize

SHINGLE = 5
# Two documents are linked from this many hundredths of common shingles.
PERCENT = 85
# Minhashes in a collection.
ROWS = 3
# Chance that a pair just at the limit is missed: one half that it meets in no table, one that its sketches differ too much.
MISS = 1e-4
# One-bit minhashes of a candidate.
BITS = 1024
# Collections are bits of a long, tables the last bits of a key.
MOST_COLLECTIONS = 62
TABLE_BITS = 16
SEED = 20240117

# Texts a Python worker turns into sets at once.
BATCH_TEXTS = 1_000

SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, minhashes array<int>"


def collections_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """The least number of collections of which three agree with the wanted chance."""
    p = (percent / 100) ** rows
    m = 3
    while sum(math.comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(3)) > miss:
        m += 1
    return m


def _few(batches: Iterator[pa.RecordBatch], rows: int = BATCH_TEXTS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of fewer texts, which bounds what is made of them at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shingles(text: bytes, memory, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles, ascending; all words as one when there are fewer."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words, memory)
    return np.unique(gram_hashes(hashes, min(k, len(hashes))) + np.uint64(min(k, len(hashes))))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, size and digest of the set, and ``size`` minhashes."""
    draw = np.random.default_rng(SEED)
    salts = draw.integers(0, 2**63, size, np.uint64)[:, None]
    factors = (draw.integers(0, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
    step = 4096

    def minhashes(grams: np.ndarray) -> np.ndarray:
        least = None
        for at in range(0, len(grams), step):
            part = (((grams[at : at + step] ^ salts) * factors) >> np.uint64(32)).min(axis=1)
            least = part if least is None else np.minimum(least, part)
        return least.astype(np.uint32).view(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = hash_memory()
        for batch in _few(batches):
            n = batch.num_rows
            sizes, a, b = (np.zeros(n, np.int64) for _ in range(3))
            offsets, found = np.zeros(n + 1, np.int32), []
            for i, text in enumerate(texts_of(batch, "text")):
                grams = shingles(text, memory)
                sizes[i] = len(grams)
                offsets[i + 1] = offsets[i]
                if len(grams):
                    a[i] = np.add.reduce(mixed(grams)).view(np.int64)
                    b[i] = np.bitwise_xor.reduce(mixed(grams + np.uint64(SEED)) * factors[0]).view(np.int64)
                    found.append(minhashes(grams))
                    offsets[i + 1] += size
            values = pa.array(np.concatenate(found) if found else np.empty(0, np.int32), pa.int32())
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes), pa.array(a), pa.array(b), array_of(pa.int32(), offsets, values)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "minhashes"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, SIGNED)


def _sketch(grams: np.ndarray, salts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The lowest bit of every minhash, packed into longs."""
    least = np.full(len(salts), np.iinfo(np.uint64).max)
    step = 512
    for at in range(0, len(grams), step):
        part = ((grams[at : at + step] ^ salts[:, None]) * factors[:, None]).min(axis=1)
        np.minimum(least, part, out=least)
    return np.packbits((mixed(least) >> np.uint64(40)).astype(np.uint8) & 1).view(np.int64)


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, grams, sketch) of the documents in ``ids`` (rep)."""
    draw = np.random.default_rng(SEED + 1)
    salts = draw.integers(0, 2**63, BITS, np.uint64)
    factors = draw.integers(0, 2**63, BITS, np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = hash_memory()
        for batch in _few(batches):
            grams = [shingles(t, memory) for t in texts_of(batch, "text")]
            offsets = np.concatenate(([0], np.cumsum([len(g) for g in grams]))).astype(np.int32)
            values = np.concatenate(grams).view(np.int64) if grams else np.empty(0, np.int64)
            bits = [_sketch(g, salts, factors) for g in grams]
            bits = np.concatenate(bits) if bits else np.empty(0, np.int64)
            yield pa.record_batch(
                [
                    batch.column(0),
                    array_of(pa.int64(), offsets, pa.array(values)),
                    array_of(pa.int64(), np.arange(len(grams) + 1) * (BITS // 64), pa.array(bits)),
                ],
                names=["rep", "grams", "sketch"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("binary").alias("text"))
    return texts.join(ids, "rep", "left_semi").mapInArrow(run, "rep long, grams array<long>, sketch array<long>")


def _tables(m: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(m) for j in range(i + 1, m)]


def _collections(m: int, rows: int):
    """One number for each collection of minhashes."""
    return F.array(*[F.hash(*[F.col("minhashes")[i * rows + r] for r in range(rows)]) for i in range(m)])


def _agreeing(reps: DataFrame) -> DataFrame:
    """(rep, agreeing): the collections of a document that another one agrees with, if there are two of them.

    Two documents that meet in a table agree in both of its collections, so no
    meeting is lost, and a document unlike all others has no keys at all.
    """
    each = reps.select("rep", F.posexplode("parts").alias("collection", "value"))
    value = ["collection", "value"]
    shared = each.groupBy(*value).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*value)
    return (
        each.join(shared, value, "left_semi")
        .groupBy("rep")
        .agg(F.sort_array(F.collect_list(F.struct(*value))).alias("agreeing"))
        .where(F.size("agreeing") > 1)
    )


def _table_keys(agreeing: DataFrame, m: int) -> DataFrame:
    """A row for every table: the key of two collections, with the table's number as its last two bytes."""

    def key(x: Column, y: Column) -> Column:
        i, j = x["collection"], y["collection"]
        number = (i * m - F.call_function("div", i * (i + 1), F.lit(2)) + j - i - 1).cast("long")
        return F.shiftleft(F.xxhash64(number, x["value"], y["value"]), TABLE_BITS).bitwiseOR(number)

    def with_later(x: Column, at: Column) -> Column:
        later = F.slice("agreeing", at + 2, F.size("agreeing"))
        return F.transform(F.filter(later, lambda y: y["collection"] > x["collection"]), lambda y: key(x, y))

    return agreeing.select("rep", F.explode(F.flatten(F.transform("agreeing", with_later))).alias("key"))


def _most_differing(percent: int, miss: float) -> int:
    """The bits in which the sketches of a pair just at the limit differ at most, but for the given chance."""
    p = (1 - percent / 100) / 2
    chance, k = 0.0, BITS
    while k > 0:
        log = math.lgamma(BITS + 1) - math.lgamma(k + 1) - math.lgamma(BITS - k + 1)
        chance += math.exp(log + k * math.log(p) + (BITS - k) * math.log1p(-p)) if p else 0.0
        if chance > miss:
            break
        k -= 1
    return k


def _alike(a: str, b: str, most: int) -> Column:
    """Whether the sketches leave a fair chance that the pair is linked."""
    differing = sum(F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64))
    return differing <= most


def _first_shared(a: str, b: str, m: int):
    """Whether the row's three collections are the first in which both documents agree.

    The columns ``low`` and ``first`` are the bits of the collections under the
    third one, and the bits of the other two.
    """
    bit = lambda i: F.lit(1 << i).cast("long")
    equal = sum(F.when(F.col(f"{a}.parts")[i] == F.col(f"{b}.parts")[i], bit(i)).otherwise(F.lit(0)) for i in range(m))
    return equal.bitwiseAND(F.col(f"{a}.low")) == F.col(f"{a}.first")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("grams").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("grams").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b")).alias("both"))
        .where(F.col("common") * 100 >= percent * (F.col("both") - F.col("common")))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, rows: int = ROWS, miss: float = MISS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    m = collections_for(percent, rows, miss / 2)
    if m > MOST_COLLECTIONS:
        raise ValueError(f"{m} collections are more than {MOST_COLLECTIONS}; take fewer rows, or a larger chance of a miss")
    most = _most_differing(percent, miss / 2)
    signed = materialize(signatures(docs, m * rows), "signatures")
    classes = materialize(
        signed.where("doc_id is not null and n_shingles > 0")
        .groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.first("minhashes").alias("minhashes")),
        "classes",
    )
    # A doc_id with several texts may stand for several classes; each keeps its minhashes.
    reps = classes.select("rep", _collections(m, rows).alias("parts"))
    keys = _table_keys(materialize(_agreeing(reps), "agreeing"), m)
    shared = keys.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    met = materialize(keys.join(shared, "key"), "met")
    members = met.select("rep").distinct()
    sets = materialize(_sets(docs, members), "sets")
    sketches = sets.select("rep", "sketch")

    ends = F.explode(F.array("least", "most"))
    stars = met.select("rep", ends.alias("end")).where("rep <> end")
    stars = stars.select(F.greatest("rep", "end").alias("a"), F.least("rep", "end").alias("b")).distinct()
    likely = (
        stars.join(sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("of_a")), "a")
        .join(sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("of_b")), "b")
        .where(_alike("of_a", "of_b", most))
        .select("a", "b")
    )
    links = materialize(_confirmed(likely, sets, percent), "links")
    known = materialize(components(links), "known")
    # Keys whose documents are still in different components.
    placed = met.join(known.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    apart = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    tables = _tables(m)
    table = F.col("key").bitwiseAND(F.lit((1 << TABLE_BITS) - 1)).cast("int")
    thirds = F.array(*[F.array(*[F.lit(k) for k in range(j + 1, m)]).cast("array<int>") for _, j in tables])
    finer = materialize(
        placed.join(apart.select("key"), "key", "left_semi")
        .join(reps, "rep")
        .withColumn("third", F.explode(thirds[table]))
        .select(
            F.xxhash64("key", "third", F.col("parts")[F.col("third")]).alias("key"),
            "rep",
            "component",
            F.array(*[F.lit((1 << i) + (1 << j)).cast("long") for i, j in tables])[table].alias("first"),
            F.array(*[F.lit((1 << k) - 1).cast("long") for k in range(m)])[F.col("third")].alias("low"),
        ),
        "finer",
    )
    apart = finer.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    left = materialize(
        finer.join(apart.select("key"), "key", "left_semi").join(sketches, "rep").join(reps, "rep"), "apart"
    )
    one, two = left.alias("one"), left.alias("two")
    across = one.join(
        two,
        (F.col("one.key") == F.col("two.key"))
        & (F.col("one.rep") > F.col("two.rep"))
        & (F.col("one.component") != F.col("two.component"))
        & _first_shared("one", "two", m)
        & _alike("one.sketch", "two.sketch", most),
    ).select(F.col("one.rep").alias("a"), F.col("two.rep").alias("b"))
    more = materialize(_confirmed(across, sets, percent), "more")
    # Classes that share a representative and documents of one class are linked as well.
    member = signed.where("doc_id is not null and n_shingles > 0").join(
        classes.select("set_a", "set_b", "n_shingles", "rep"), ["set_a", "set_b", "n_shingles"]
    )
    same = member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(more).unionByName(same))
    return (
        signed.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
