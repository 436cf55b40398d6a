"""The ad-click log: ``epoch-millis province city user ad`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import columns as C


def kafka_lines(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """Stream of log lines from a comma list of topics.

    Needs Spark's own Kafka package on the cluster's class path.
    """
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .options(**options)
        .load()
    )
    return stream.select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of log lines from text files landing in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _parsed(lines: DataFrame) -> DataFrame:
    part = F.split("value", " ", -1)
    return lines.select(
        "value",
        C.from_epoch_millis(F.get(part, F.lit(0))).alias("ts"),
        F.get(part, F.lit(1)).alias("province"),
        F.get(part, F.lit(2)).alias("city"),
        F.get(part, F.lit(3)).try_cast("bigint").alias("user_id"),
        F.get(part, F.lit(4)).try_cast("bigint").alias("ad_id"),
    )


def _well_formed() -> Column:
    return (
        F.col("ts").isNotNull()
        & F.col("city").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("ad_id").isNotNull()
    )


def parse_ad_log(lines: DataFrame, metric: str | None = None) -> DataFrame:
    """Typed clicks of the well-formed lines.

    With ``metric``, counts of all and of malformed lines are reported as the
    observed metric of that name, per run or per micro-batch.
    """
    parsed = _parsed(lines)
    if metric:
        parsed = parsed.observe(
            metric,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(~_well_formed()).alias("malformed"),
        )
    return parsed.where(_well_formed()).select(
        "ts", F.to_date("ts").alias("date"), "province", "city", "user_id", "ad_id"
    )


def malformed_lines(lines: DataFrame) -> DataFrame:
    return _parsed(lines).where(~_well_formed()).select("value")
