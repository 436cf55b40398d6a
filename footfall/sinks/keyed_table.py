"""Keyed tables that micro-batches bring up to date part by part.

A table lies in one folder per bucket of its keys and, where one is named, per
day. A batch reads the parts that its keys fall in, merges its changes into them
by the table's rule and replaces these parts; all other files stay as they are.

A batch may end at any moment and run again. The merged parts are first written
beside the table, then the batch's number, and only then they take the place of
the old ones. A batch that finds its own number puts the same parts in place
once more; one that does not finds the table as the batch before left it.
A table belongs to the checkpoint of one query, whose batch numbers it holds.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

BATCH = "batch_id"
BUCKET = "bucket"
BUCKETS = 8


def merge_increment(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sum of all changes per key."""
    return rows.groupBy(*keys).agg(
        *[F.sum(v).alias(v) for v in values], F.max(BATCH).alias(BATCH)
    )


def merge_replace(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The values a key got in its latest batch."""
    return rows.groupBy(*keys).agg(
        *[F.max_by(v, BATCH).alias(v) for v in values], F.max(BATCH).alias(BATCH)
    )


def merge_replace_group(rows: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """All rows a group got in its latest batch."""
    latest = rows.groupBy(*group).agg(F.max(BATCH).alias(BATCH))
    return rows.join(latest, [*group, BATCH], "left_semi").select(*group, *values, BATCH)


def merge_new_keys(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Each key once, as the batch that brought it wrote it."""
    return rows.groupBy(*keys).agg(
        *[F.min_by(v, BATCH).alias(v) for v in values], F.min(BATCH).alias(BATCH)
    )


RULES = {
    "increment": merge_increment,
    "replace": merge_replace,
    "replace_group": merge_replace_group,
    "new_keys": merge_new_keys,
}


@dataclass(frozen=True)
class KeyedTable:
    """One table: its folder, columns, rule and the rule's keys.

    ``split_by`` is a key column, never null, that gets a folder per value.
    Buckets go by the other keys, or by the keys ``bucket_by`` alone; choose
    ``buckets`` so that a batch leaves most of them untouched.
    """

    path: str
    schema: StructType
    rule: str
    keys: list[str]
    split_by: str | None = None
    bucket_by: list[str] | None = None
    buckets: int = BUCKETS

    @property
    def values(self) -> list[str]:
        return [name for name in self.schema.names if name not in self.keys]

    @property
    def _bucket_keys(self) -> list[str]:
        return self.bucket_by or [key for key in self.keys if key != self.split_by]

    @property
    def _parts(self) -> list[str]:
        return [*([self.split_by] if self.split_by else []), BUCKET]

    @property
    def _stored_schema(self) -> StructType:
        own = [StructField(BATCH, LongType(), True), StructField(BUCKET, IntegerType(), True)]
        return StructType([*self.schema.fields, *own])

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self._bucket_keys), F.lit(self.buckets)).cast("int")

    def _stored(self, spark: SparkSession, name: str, schema: StructType | str) -> DataFrame:
        """Rows of one of the table's folders, none if it is not there yet."""
        try:
            return spark.read.schema(schema).parquet(self._at(name))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _store(self, rows: DataFrame, name: str, mode: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(*self._parts).parquet(self._at(name))

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The table's rows; with ``before``, without those last changed by that batch or a later one."""
        rows = self._stored(spark, "rows", self._stored_schema)
        if before is not None:
            rows = rows.where(F.col(BATCH) < before)
        return rows.select(*self.schema.names)

    def _touched(self, spark: SparkSession, rows: DataFrame) -> DataFrame:
        """The parts that ``rows`` fall in. Their names, a bucket's number and its
        day, are all that the driver gets to see."""
        stored = self._stored(spark, "rows", self._stored_schema)
        parts = rows.select(*self._parts).distinct().collect()
        if not self.split_by:
            return stored.where(F.col(BUCKET).isin([p[BUCKET] for p in parts]))
        days: dict = {}
        for part in parts:
            days.setdefault(part[self.split_by], []).append(part[BUCKET])
        within = [(F.col(self.split_by) == F.lit(day)) & F.col(BUCKET).isin(found) for day, found in days.items()]
        return stored.where(reduce(Column.__or__, within, F.lit(False)))

    def read_touching(self, spark: SparkSession, rows: DataFrame, on: list[str]) -> DataFrame:
        """The table's rows whose ``on`` values occur in ``rows``, from the parts that can hold them."""
        if not set(self._parts[:-1] + self._bucket_keys) <= set(on) <= set(self.keys):
            raise ValueError("rows are looked up by key columns that name their part")
        wanted = rows.select(*on).distinct()
        parts = self._touched(spark, wanted.withColumn(BUCKET, self._bucket()))
        return parts.join(wanted, on, "left_semi").select(*self.schema.names)

    def _prepared(self, spark: SparkSession) -> int | None:
        """The last batch whose merged parts were written in full."""
        return max((row[BATCH] for row in self._stored(spark, "commit", "batch_id long").collect()), default=None)

    def upsert(self, batch_id: int, changes: DataFrame) -> None:
        """Merge a batch's changes into the table; running it again changes nothing."""
        spark = changes.sparkSession
        if self._prepared(spark) != batch_id:
            numbered = changes.select(
                *self.schema.names, F.lit(batch_id).cast("bigint").alias(BATCH), self._bucket().alias(BUCKET)
            )
            rows = self._touched(spark, numbered).unionByName(numbered)
            merged = RULES[self.rule](rows, self.keys, self.values).withColumn(BUCKET, self._bucket())
            # Few files per part, while a part with very many rows is still written by many tasks.
            self._store(merged.hint("rebalance", *[F.col(p) for p in self._parts]), "pending", "static")
            spark.range(1).select(F.lit(batch_id).cast("bigint").alias(BATCH)).write.mode("overwrite").parquet(
                self._at("commit")
            )
        self._store(self._stored(spark, "pending", self._stored_schema), "rows", "dynamic")
