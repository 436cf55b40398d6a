"""Batch scans: the action fact table, dimensions and the task table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import columns as C
from footfall.params import JobParams
from footfall.schemas import USER_VISIT_ACTION


def read_table(
    spark: SparkSession,
    path: str | None = None,
    source: str = "parquet",
    options: dict[str, str] | None = None,
    schema=None,
) -> DataFrame:
    """A table from files or from JDBC (``source="jdbc"`` and its options).

    A large JDBC table should be given Spark's ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``, or it is read by one task.
    """
    reader = spark.read.format(source).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def in_date_range(actions: DataFrame, params: JobParams) -> DataFrame:
    """Actions from the first to the last day, both included.

    The condition stays on the stored column, so it prunes partitions when the
    table is laid out by date and row groups when it is not.
    """
    if params.start_date is not None:
        actions = actions.where(F.col("date") >= params.start_date)
    if params.end_date is not None:
        actions = actions.where(F.col("date") <= params.end_date)
    return actions


def typed_actions(actions: DataFrame) -> DataFrame:
    """Stored text forms of date, time and city turned into their types.

    Extra columns (such as an event number that orders equal times) are kept.
    """
    types = dict(actions.dtypes)
    changed = {}
    if types["date"] == "string":
        changed["date"] = F.to_date("date", C.DATE_FORMAT)
    if types["action_time"] == "string":
        changed["action_time"] = C.parse_time(F.col("action_time"))
    elif types["action_time"] == "timestamp_ntz":
        changed["action_time"] = F.col("action_time").cast("timestamp")
    if types["city_id"] == "string":
        changed["city_id"] = F.col("city_id").try_cast("bigint")
    return actions.withColumns(changed) if changed else actions


def scan_actions(actions: DataFrame, params: JobParams) -> DataFrame:
    """The fact table as the jobs want it: filtered first, then typed."""
    return typed_actions(in_date_range(actions, params))


def detail_columns(actions: DataFrame) -> DataFrame:
    """The stored columns of an action without date and city."""
    names = [f.name for f in USER_VISIT_ACTION.fields if f.name not in ("date", "city_id")]
    return actions.select(*names)


def click_scan(actions: DataFrame) -> DataFrame:
    """City and product of every product click."""
    return actions.where(F.col("click_product_id").isNotNull()).select(
        "city_id", F.col("click_product_id").alias("product_id")
    )


def click_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with the name and area of their city.

    No broadcast is forced: Spark takes one when the measured size of the city
    table allows, and otherwise splits a city that holds too many clicks (both
    sides come straight from a shuffle, so the runtime skew rule applies).
    """
    return clicks.join(cities, "city_id").select("city_id", "city_name", "area", "product_id")
