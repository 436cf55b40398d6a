"""Shards of nearly equal bytes by multiway differencing (Karmarkar and Karp).

Groups of equal texts stay together. A group is a partial partition with one
loaded shard; again and again the two partial partitions with the largest
spread are combined, the heaviest shards of one with the lightest of the other.
Each task differences a bounded number of groups into one partial partition,
and the partial partitions of the tasks are differenced in the same way, level
by level, until one is left.

A null text has no bytes and is grouped with the empty ones. Rows with null or
equal ids are rows of their own; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.settings import materialize

SHARDS = 40
ROW_BYTES = 16
# Partial partitions combined by one task.
PER_TASK = 30_000
# Rows of a shard numbered by one task, about.
RUN_ROWS = 100_000


def differenced(loads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows of ``loads``) into one.

    Returns where each row's shards went, and the loads of the result.
    """
    n, shards = loads.shape
    order = np.argsort(loads, axis=1, kind="stable")[:, ::-1]
    sums = np.take_along_axis(loads, order, axis=1)
    # A node holds its own loads, heaviest first, and how its two parts' places map to its own.
    made: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    current = list(sums)
    heap = [(-int(s[0] - s[-1]), i) for i, s in enumerate(current)]
    heapq.heapify(heap)
    backwards = np.arange(shards - 1, -1, -1)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = current[a] + current[b][::-1]
        by_load = np.argsort(-total, kind="stable")
        place = np.empty(shards, np.int64)
        place[by_load] = np.arange(shards)
        made.append((a, b, place, place[backwards]))
        node = len(current)
        current.append(total[by_load])
        current[a] = current[b] = None
        heapq.heappush(heap, (-int(current[node][0] - current[node][-1]), node))
    root = len(current) - 1
    where: dict[int, np.ndarray] = {root: np.arange(shards)}
    for k in range(len(made) - 1, -1, -1):
        a, b, of_a, of_b = made[k]
        up = where.pop(n + k)
        where[a], where[b] = up[of_a], up[of_b]
    result = np.empty((n, shards), np.int64)
    for i in range(n):
        result[i][order[i]] = where[i]
    return result, current[root]


def _level(parts: DataFrame, n: int, shards: int, per_task: int, level: int) -> tuple[DataFrame, int]:
    """One level: (id, loads) -> (id, up, moved, loads of up on one of its rows)."""
    tasks = max(1, -(-n // per_task))

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        moved, total = differenced(np.array(group["loads"].to_list(), np.int64))
        loads = [total.tolist()] + [None] * (len(group) - 1)
        return pd.DataFrame({"id": group["id"], "up": int(key[0]), "moved": moved.tolist(), "loads": loads})

    out = (
        parts.withColumn("up", F.pmod(F.xxhash64("id", F.lit(level)), F.lit(tasks)))
        .groupBy("up")
        .applyInPandas(run, "id long, up long, moved array<int>, loads array<long>")
    )
    return materialize(out, f"level{level}"), tasks


def _first_level(groups: DataFrame, n: int, shards: int, per_task: int) -> tuple[DataFrame, int]:
    tasks = max(1, -(-n // per_task))

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("text_key")
        loads = np.zeros((len(group), shards), np.int64)
        loads[:, 0] = group["bytes"]
        moved, total = differenced(loads)
        sums = [total.tolist()] + [None] * (len(group) - 1)
        return pd.DataFrame({"text_key": group["text_key"], "up": int(key[0]), "place": moved[:, 0], "loads": sums})

    out = (
        groups.withColumn("up", F.pmod(F.xxhash64("text_key"), F.lit(tasks)))
        .groupBy("up")
        .applyInPandas(run, "text_key binary, up long, place int, loads array<long>")
    )
    return materialize(out, "level0"), tasks


def group_shards(groups: DataFrame, shards: int = SHARDS, per_task: int = PER_TASK) -> DataFrame:
    """(text_key, bytes) -> (text_key, shard)."""
    groups = materialize(groups.select("text_key", "bytes"), "groups")
    placed, parts = _first_level(groups, groups.count(), shards, per_task)
    sums = placed.where("loads is not null").select(F.col("up").alias("id"), "loads")
    placed = placed.drop("loads")
    level = 1
    while parts > 1:
        moves, parts = _level(sums, parts, shards, per_task, level)
        step = moves.select(F.col("id").alias("up"), F.col("up").alias("above"), "moved")
        placed = placed.join(step, "up").select(
            "text_key", F.col("above").alias("up"), F.col("moved")[F.col("place")].alias("place")
        )
        sums = moves.where("loads is not null").select(F.col("up").alias("id"), "loads")
        level += 1
    return placed.select("text_key", F.col("place").cast("int").alias("shard"))


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, per_task: int = PER_TASK, run_rows: int = RUN_ROWS
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialize(
        docs.select(
            F.col("doc_id").cast("long"),
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("text_key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("bytes"))
    # Joined from two shuffles, so Spark can split a text with very many copies.
    placed = rows.join(group_shards(groups, shards, per_task), "text_key").drop("text_key")
    # Slots: rows of a shard are dealt into runs, runs are counted, and each row is numbered in its run.
    runs = max(1, -(-rows.count() // run_rows))
    placed = materialize(placed.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs))), "placed")
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "run")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    in_run = Window.partitionBy("shard", "run").orderBy("row")
    return (
        placed.withColumn("slot", F.row_number().over(in_run) - 1)
        .join(starts, ["shard", "run"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("slot") + F.col("first")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
