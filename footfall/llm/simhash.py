"""Near-duplicate documents by SimHash, found by a self-join of a binary trie.

A document's fingerprint has a bit for every bit of its shingles' hashes: 1 if
more than half of the shingles have it set. The distinct fingerprints are the
leaves of a binary trie. The join starts with the root paired with itself and
goes down both sides together: a pair of nodes has the pairs of their children,
every differing bit on the way is added up, and a pair beyond the error budget
is left with all that is below it.

The upper levels are tables: subtrees that hold too many fingerprints for one
task are split, and their pairs with them, until every pair left is one of two
small subtrees. These go to tasks of their own, where the same walk runs over
sorted arrays, with branches of a single fingerprint compared at once. A task
returns what it linked as a forest, so a dense group of m fingerprints is at most m
rows of it and not m squared.

A document with fewer words than a shingle has them all as its one shingle.
Texts that are null or have no word have fingerprint 0 and are linked like any
other. Rows with equal or null ids are rows of their own; a component is named
by the smallest id in it, null if it has none. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.llm.words import LOWER, texts_of
from footfall.settings import materialize

SHINGLE = 3
SEED = 42
# Linked fingerprints differ in this many bits at most.
BUDGET = 3
WIDTH = 64
# Fingerprints of a subtree that one task joins with another one.
SUBTREE = 1 << 15
# Levels by which a subtree that is too large is split.
STEP = 4
# Pairs of nodes that a task goes down with at once.
FRONT = 1 << 19


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """The 64 bits as an unsigned number."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    k = min(k, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    places = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in places], np.uint64)
    ones = np.zeros(WIDTH, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, WIDTH // 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, bits) of every row; ``bits`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t) for t in texts_of(batch, "text")], np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(run, "doc_id long, bits long")


class Trie:
    """The nodes of a subtree, level by level, over its sorted fingerprints."""

    def __init__(self, values: np.ndarray, depth: int):
        self.values, self.depth = values, depth
        self.starts = {depth: np.zeros(1, np.int64)}
        self.below: dict[int, np.ndarray] = {}

    def single(self, level: int) -> np.ndarray:
        """Whether a node holds one fingerprint only."""
        return np.diff(self.starts[level], append=len(self.values)) == 1

    def children(self, level: int) -> np.ndarray:
        """Each node's child for bit 0 and for bit 1, -1 where there is none."""
        if level not in self.below:
            shift = np.uint64(WIDTH - 1 - level)
            cut = np.flatnonzero(np.diff(self.values >> shift)) + 1
            lower = np.concatenate((np.zeros(1, np.int64), cut))
            first = np.searchsorted(lower, self.starts[level])
            bit = (self.values[lower[first]] >> shift) & np.uint64(1) == 1
            forked = np.diff(first, append=len(lower)) == 2
            self.below[level] = np.stack(
                (np.where(bit, -1, first), np.where(bit, first, np.where(forked, first + 1, -1)))
            ).astype(np.int32)
            self.starts[level + 1] = lower
        return self.below[level]


def linked(one: Trie, two: Trie, errors: int, same: bool, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the fingerprints, in ``one`` and ``two``, that differ in at most ``budget`` bits.

    ``errors`` bits differ above the subtrees; with ``same`` both are the same one.
    """
    root = np.zeros(1, np.int32)
    stack = [(one.depth, root, root, np.full(1, errors, np.int8))]
    while stack:
        level, i, j, wrong = stack.pop()
        ends = one.single(level)[i] & two.single(level)[j]
        if ends.any():
            x, y = one.starts[level][i[ends]], two.starts[level][j[ends]]
            near = np.bitwise_count(one.values[x] ^ two.values[y]) <= budget
            if same:
                near &= x < y
            yield x[near], y[near]
            i, j, wrong = i[~ends], j[~ends], wrong[~ends]
        if not len(i):
            continue
        left, right = one.children(level), two.children(level)
        down = []
        for a in (0, 1):
            for b in (0, 1):
                u, v, w = left[a][i], right[b][j], wrong + np.int8(a != b)
                keep = (u >= 0) & (v >= 0) & (w <= budget)
                if same:
                    keep &= u <= v
                down.append((u[keep], v[keep], w[keep]))
        i, j, wrong = (np.concatenate(parts) for parts in zip(*down, strict=True))
        stack += [(level + 1, i[k : k + FRONT], j[k : k + FRONT], wrong[k : k + FRONT]) for k in range(0, len(i), FRONT)]


def merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``label`` (the smallest place linked with each one so far) after further links."""
    while len(x):
        a, b = label[x], label[y]
        apart = a != b
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label = up
    return label


def _forests(pairs: DataFrame, budget: int) -> DataFrame:
    """(a, b): what is linked within and between the two subtrees of each row, as a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                depth, errors, same = (batch.column(k)[row].as_py() for k in range(3))
                one, two = (
                    np.sort(batch.column(k)[row].values.to_numpy(zero_copy_only=False).view(np.uint64)) for k in (3, 4)
                )
                values = one if same else np.concatenate((one, two))
                label = np.arange(len(values))
                for x, y in linked(Trie(one, depth), Trie(two, depth), errors, same, budget):
                    label = merge(label, x, y if same else y + len(one))
                hung = np.flatnonzero(label != np.arange(len(label)))
                yield pa.record_batch(
                    [pa.array(values[hung].view(np.int64)), pa.array(values[label[hung]].view(np.int64))], names=["a", "b"]
                )

    return pairs.select("depth", "errors", "same", "of_p", "of_q").mapInArrow(run, "a long, b long")


def _mask(depth: int) -> int:
    """The first ``depth`` of 64 bits, as a signed long."""
    mask = ((1 << depth) - 1) << (WIDTH - depth)
    return mask - (1 << WIDTH) if mask >> (WIDTH - 1) else mask


def _node(bits: Column, depth: int) -> Column:
    return bits.bitwiseAND(F.lit(_mask(depth)))


def _subtrees(bits: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """The fingerprints as (node, bits) of their small subtree, and the children (parent, node) of split ones by level.

    Two small subtrees never have the same ``node``: the bits before one's depth tell them apart.
    """
    rest, depth, small, split = bits, 0, [], []
    while True:
        sizes = rest.groupBy(_node(F.col("bits"), depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))
        sizes = materialize(sizes, "subtrees")
        if depth:
            split.append(sizes.select(_node(F.col("node"), depth - STEP).alias("parent"), "node"))
        placed = rest.withColumn("node", _node(F.col("bits"), depth)).join(sizes, "node")
        small.append(placed.where(F.col("n") <= most).select("node", "bits"))
        if depth == WIDTH or not sizes.where(F.col("n") > most).take(1):
            break
        rest = materialize(placed.where(F.col("n") > most).select("bits"), "split")
        depth += STEP
    whole = small[0]
    for part in small[1:]:
        whole = whole.unionByName(part)
    return whole, split


def _differing(depth: Column) -> Column:
    """Bits in which the nodes of a pair differ, in the levels that both have."""
    masks = F.array(*[F.lit(_mask(d)) for d in range(0, WIDTH + 1, STEP)])
    shared = masks[(depth / F.lit(STEP)).cast("int")]
    return F.bit_count(F.col("p.node").bitwiseXOR(F.col("q.node")).bitwiseAND(shared))


def _subtree_pairs(spark: SparkSession, split: list[DataFrame], budget: int) -> DataFrame:
    """Pairs of small subtrees (p, q: node, depth) within the budget, with the levels both have and the errors there."""
    pairs = spark.range(1).select(F.struct(F.col("id").alias("node"), F.lit(0).alias("depth")).alias("p"))
    pairs = pairs.withColumn("q", F.col("p"))
    common = F.least("p.depth", "q.depth")
    for number, children in enumerate(split, 1):
        for side in ("p", "q"):
            # Nodes that are not split have no children and stay.
            below = children.withColumnRenamed("node", "child")
            down = F.struct(F.col("child").alias("node"), F.lit(number * STEP).alias("depth"))
            pairs = pairs.join(below, F.col(f"{side}.node") == F.col("parent"), "left").withColumn(
                side, F.when(F.col("child").isNull(), F.col(side)).otherwise(down)
            )
            pairs = pairs.select("p", "q")
        # The children of a node paired with itself meet twice.
        near = pairs.where(_differing(common) <= budget)
        pairs = materialize(near.select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct(), "pairs")
    return pairs.select("p", "q", common.alias("depth"), _differing(common).alias("errors"))


def links(bits: DataFrame, budget: int = BUDGET, most: int = SUBTREE) -> DataFrame:
    """(a, b): links that connect all distinct ``bits`` within the budget, and only those.

    Two linked fingerprints are connected through rows of the result, not always by one of their own.
    """
    spark = bits.sparkSession
    subtrees, split = _subtrees(bits, most)
    stored = materialize(subtrees.groupBy("node").agg(F.collect_list("bits").alias("bits")), "subtree")
    pairs = _subtree_pairs(spark, split, budget).select("p.node", F.col("q.node").alias("other"), "depth", "errors")
    joined = (
        pairs.join(stored.withColumnRenamed("bits", "of_p"), "node")
        .join(stored.select(F.col("node").alias("other"), F.col("bits").alias("of_q")), "other")
        .withColumn("same", F.expr("node = other"))
    )
    # A row is work for a task, however few bytes it has.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _forests(joined.repartition(tasks, "node", "other"), budget)


def near_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """doc_id, bits, component_id of every row."""
    marked = materialize(fingerprints(docs), "fingerprints")
    # Equal fingerprints are one from here on.
    classes = materialize(marked.groupBy("bits").agg(F.min("doc_id").alias("rep")), "classes")
    found = materialize(components(links(classes.select("bits"), budget)), "connected")
    placed = classes.join(found.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "rep", F.coalesce("component", "bits").alias("component")
    )
    named = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    return marked.join(placed.join(named, "component").select("bits", "component_id"), "bits").select(
        "doc_id", "bits", "component_id"
    )
