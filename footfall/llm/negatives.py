"""Hard negatives of anchors, mined with Kronecker-packed products.

A block of candidates is packed component by component: the candidates' biased
components are separate fields of one wide integer. An anchor's products with
all candidates of the block are then the sum of its components times these
integers, one multiplication a component; a second bias keeps every field from
borrowing of the next one, and unpacking the fields gives the exact scores.

The first pass multiplies anchors only with blocks that hold their label and
finds every anchor's positives. The second one finds, for each of them, the
rows of other labels whose score lies in a band under the positive's. Anchors
and candidates meet in blocks, in a grid of cells: an anchor block is sent to
every cell of its row, a candidate block to every cell of its column. A cell
keeps the best so far of each anchor; the best of all cells are ranked by Spark.

Rows with a null id, label or vector, or with a null component, take no part.
A shorter vector counts as having zeros behind; an empty one has score 0 with
all. Repeated rows, also of one id, are rows of their own; a row is never its
own positive. Ties go by id. An empty table gives no rows; other columns are
ignored. Products that might not fit into a long are an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.words import array_of
from footfall.operators.ranking import top_n
from footfall.settings import materialize

POSITIVES = 5
NEGATIVES = 3
# A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
# Candidates packed into one integer a component, and anchors sent together.
BLOCK = 4096
ANCHORS = 512
# Cells of the grid for each shuffle partition.
CELLS = 4
# Anchors and positives whose best a task keeps before it hands them on.
KEPT = 100_000

ROWS = "uid long, id long, label long, vector array<long>"
BLOCKS = "uids array<long>, ids array<long>, labels array<long>, least long, most long, width int, vectors binary"
TARGETS = "numbers array<int>, targets array<long>, ends array<int>"


def quantized(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of the components; null if the vector, or a component, is null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _longs(lists: list[np.ndarray], type_: pa.DataType = pa.int64()) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    return array_of(type_, offsets, pa.array(np.concatenate(lists), type_))


def _blocks(rows: DataFrame, size: int, targets: bool = False) -> DataFrame:
    """Rows in blocks: a block's vectors are stored component by component."""

    def packed(part: pa.Table) -> pa.RecordBatch:
        uids, ids, labels = (part.column(k).to_numpy() for k in range(3))
        vectors = part.column(3).combine_chunks()
        lengths = vectors.value_lengths().to_numpy()
        width = int(lengths.max())
        full = np.zeros((len(ids), width), np.int64)
        full[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy()
        columns = [
            *(_longs([x]) for x in (uids, ids, labels)),
            pa.array([labels.min()], pa.int64()),
            pa.array([labels.max()], pa.int64()),
            pa.array([width], pa.int32()),
            pa.array([np.ascontiguousarray(full.T).tobytes()], pa.binary()),
        ]
        names = ["uids", "ids", "labels", "least", "most", "width", "vectors"]
        if targets:
            numbers, scores = (part.column(k).combine_chunks() for k in (4, 5))
            columns += [
                _longs([numbers.flatten().to_numpy()], pa.int32()),
                _longs([scores.flatten().to_numpy()]),
                _longs([np.cumsum(scores.value_lengths().to_numpy())], pa.int32()),
            ]
            names += ["numbers", "targets", "ends"]
        return pa.record_batch(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while n + batch.num_rows >= size:
                yield packed(pa.Table.from_batches([*waiting, batch.slice(0, size - n)]))
                batch = batch.slice(size - n)
                waiting, n = [], 0
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
        if n:
            yield packed(pa.Table.from_batches(waiting))

    schema = f"{BLOCKS}, {TARGETS}" if targets else BLOCKS
    return materialize(rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "blocks")


class Packed:
    """Candidates as one wide integer a component."""

    def __init__(self, vectors: np.ndarray, reach: int):
        """``vectors`` has a row for every component; anchors' absolute components sum up to ``reach`` at most."""
        self.n = vectors.shape[1]
        self.bias = int(vectors.min(initial=0))
        self.most = reach * (int(vectors.max(initial=0)) - self.bias)
        if max(self.most, reach * -self.bias) >= 1 << 62:
            raise ValueError("products do not fit into a long")
        self.field = np.dtype("<u4") if 2 * self.most < 1 << 32 else np.dtype("<u8")
        biased = (vectors - self.bias).astype(self.field)
        self.parts = [int.from_bytes(row.tobytes(), "little") for row in biased]
        self.ones = int.from_bytes(np.ones(self.n, self.field).tobytes(), "little") * self.most

    def products(self, anchor: list[int]) -> np.ndarray:
        """The anchor's product with every candidate."""
        fields = sum(map(mul, anchor, self.parts), self.ones)
        unpacked = np.frombuffer(fields.to_bytes(self.n * self.field.itemsize, "little"), self.field)
        return unpacked.astype(np.int64) + (self.bias * sum(anchor[: len(self.parts)]) - self.most)


def _best(scores: np.ndarray, places: np.ndarray, ids: np.ndarray, uids: np.ndarray, n: int) -> list[tuple]:
    """(-score, id, uid) of the first ``n`` of the places."""
    found = scores[places]
    if len(places) > n:
        places = places[found >= np.partition(found, -n)[-n]]
    rows = zip((-scores[places]).tolist(), ids[places].tolist(), uids[places].tolist(), strict=True)
    return sorted(rows)[:n]


def _cells(anchors: DataFrame, candidates: DataFrame, wanted: Column) -> DataFrame:
    """Every anchor block beside every candidate block that ``wanted`` holds for."""
    spark = anchors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, columns = (max(1, df.count()) for df in (anchors, candidates))
    # With cells in plenty, rows and columns are chosen so that least is sent.
    across = min(rows, max(1, round(math.sqrt(CELLS * tasks * rows * ANCHORS / (columns * BLOCK)))))
    down = min(columns, max(1, CELLS * tasks // across))
    across = min(rows, max(1, CELLS * tasks // down))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    a = anchors.select(
        F.pmod(F.xxhash64("block"), F.lit(across).cast("long")).alias("row"),
        numbers(down).alias("column"),
        F.struct(*anchors.columns).alias("a"),
    )
    c = candidates.select(
        numbers(across).alias("row"),
        F.pmod(F.xxhash64("block"), F.lit(down).cast("long")).alias("column"),
        F.struct(*candidates.columns).alias("c"),
    )
    cell = ["row", "column"]
    return a.repartition(tasks, *cell).join(c.repartition(tasks, *cell), cell).where(wanted).select("a", "c")


def _searched(cells: DataFrame, search: Callable, n: int) -> DataFrame:
    """The first ``n`` found in a task for each anchor and number: (uid, anchor_id, number, target, other_id, other_uid, score).

    ``search`` gets an anchor's place in its block, the block's rows and the
    candidates' and yields (number, target, places), after its ``scores``.
    """
    schema = "uid long, anchor_id long, number int, target long, other_id long, other_uid long, score long"
    names = ["uid", "anchor_id", "number", "target", "other_id", "other_uid", "score"]

    def vectors(block) -> np.ndarray:
        shape = block["width"].as_py(), len(block["ids"].values)
        return np.frombuffer(block["vectors"].as_py(), np.int64).reshape(shape)

    def rows(block) -> dict[str, np.ndarray]:
        kinds = ("uids", "ids", "labels", "numbers", "targets", "ends")
        return {k: block[k].values.to_numpy() for k in kinds if k in block}

    def handed(kept: dict) -> pa.RecordBatch:
        found = [(*key, o, u, -s) for key, best in kept.items() for s, o, u in best]
        columns = zip(*found, strict=True) if found else [[]] * 7
        kinds = [pa.int32() if k == "number" else pa.int64() for k in names]
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, list] = {}
        for batch in batches:
            for pair in range(batch.num_rows):
                a, c = batch.column(0)[pair], batch.column(1)[pair]
                anchors, others = rows(a), rows(c)
                of_a = vectors(a).T.tolist()
                packed = Packed(vectors(c), max(sum(map(abs, v)) for v in of_a))
                there = np.unique(others["labels"])
                for at, anchor in enumerate(of_a):
                    found = search(at, anchors, others, there)
                    if found is None:
                        continue
                    scores = packed.products(anchor)
                    for number, target, places in found(scores):
                        if len(places):
                            key = (int(anchors["uids"][at]), int(anchors["ids"][at]), number, target)
                            best = _best(scores, places, others["ids"], others["uids"], n)
                            kept[key] = sorted(kept[key] + best)[:n] if key in kept else best
                if len(kept) >= KEPT:
                    yield handed(kept)
                    kept = {}
        yield handed(kept)

    return cells.mapInArrow(run, schema)


def _same_label(at: int, anchors: dict, others: dict, there: np.ndarray):
    label = anchors["labels"][at]
    if label not in there:
        return None
    places = np.flatnonzero((others["labels"] == label) & (others["uids"] != anchors["uids"][at]))
    return lambda scores: [(0, 0, places)]


def _in_band(low: int, high: int):
    def search(at: int, anchors: dict, others: dict, there: np.ndarray):
        label = anchors["labels"][at]
        if len(there) == 1 and there[0] == label:
            return None
        places = np.flatnonzero(others["labels"] != label)
        start, end = (anchors["ends"][at - 1] if at else 0), anchors["ends"][at]

        def bands(scores: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
            found = scores[places]
            for number, target in zip(anchors["numbers"][start:end].tolist(), anchors["targets"][start:end].tolist(), strict=True):
                inside = (found >= -(-low * target // 100)) & (found <= high * target // 100)
                yield number, target, places[inside]

        return bands

    return search


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has id, label and vector, whole numbers all; ``anchor`` says of a
    row whether it is an anchor. An anchor's positives are the first
    ``positives`` other rows of its label; of each, the first ``negatives`` rows
    of other labels are returned whose score, times 100, is not below ``low``
    and not above ``high`` times the positive's.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taking_part = rows.select(
        F.col("id").cast("long"),
        F.col("label").cast("long"),
        F.col("vector").cast("array<long>"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where("id is not null and label is not null and vector is not null and not exists(vector, x -> x is null)")
    # Blocks of few labels each, so that the first pass skips most of them; a large label is cut by its ids.
    numbered = materialize(
        taking_part.repartitionByRange(tasks, "label", "id")
        .sortWithinPartitions("label", "id")
        .withColumn("uid", F.monotonically_increasing_id()),
        "numbered",
    )
    columns = ["uid", "id", "label", "vector"]
    candidates = _blocks(numbered.select(*columns), BLOCK)
    anchors = numbered.where("anchor").select(*columns)
    meeting = (F.col("a.least") <= F.col("c.most")) & (F.col("c.least") <= F.col("a.most"))
    found = _searched(_cells(_blocks(anchors, ANCHORS), candidates, meeting), _same_label, positives)
    order = [F.desc("score"), "other_id", "other_uid"]
    positive = materialize(
        top_n(found, ["uid"], order, positives, "number").select("uid", "number", F.col("other_id").alias("positive_id"), "score"),
        "positives",
    )
    wanted = positive.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("number", "score"))).alias("of"))
    aimed = anchors.join(wanted, "uid").select(*columns, F.col("of.number").alias("numbers"), F.col("of.score").alias("targets"))
    other = ~((F.col("a.least") == F.col("a.most")) & (F.col("c.least") == F.col("c.most")) & (F.col("a.least") == F.col("c.least")))
    found = _searched(_cells(_blocks(aimed, ANCHORS, targets=True), candidates, other), _in_band(low, high), negatives)
    ranked = top_n(found, ["uid", "number"], order, negatives, "rank")
    return ranked.join(positive.select("uid", "number", "positive_id"), ["uid", "number"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("other_id").alias("negative_id"),
        F.col("target").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
