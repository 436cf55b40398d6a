"""Where job results go."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.schemas import RESULT_TABLES

RUNS = "task_id long, run string, finished_at long"


def append_result(df: DataFrame, root: str, name: str, task_id: int) -> str:
    """Add a task's rows to the result table ``name``.

    A run of a task writes its rows to a folder of its own and, when all are
    there, one line to the table's list of finished runs. Readers take each
    task's last finished run: a run that fails leaves the rows before it in
    place, and one that repeats a task replaces that task's rows, also by none.
    """
    path = f"{root.rstrip('/')}/{name}"
    run = uuid.uuid4().hex
    df.write.parquet(f"{path}/rows/task_id={task_id}/run={run}")
    # One row is one file, which is there in full or not at all.
    line = df.sparkSession.createDataFrame([(task_id, run, time.time_ns())], RUNS).coalesce(1)
    line.write.mode("append").parquet(f"{path}/runs")
    return path


def _finished(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(RUNS).parquet(f"{path}/runs")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUNS)


def read_result(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None, task_id: int | None = None
) -> DataFrame:
    """A stored result table; it may be without rows. With ``task_id``, that task's rows only."""
    schema = schema or RESULT_TABLES[name]
    path = f"{root.rstrip('/')}/{name}"
    runs = _finished(spark, path)
    if task_id is not None:
        runs = runs.where(F.col("task_id") == task_id)
    last = runs.groupBy("task_id").agg(F.max_by("run", "finished_at").alias("run"))
    stored = StructType(list(schema.fields))
    if "task_id" not in schema.names:
        stored.add("task_id", "long")
    try:
        rows = spark.read.schema(StructType(list(stored.fields)).add("run", "string")).parquet(f"{path}/rows")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stored)
    if task_id is not None:
        rows = rows.where(F.col("task_id") == task_id)
    return rows.join(last, ["task_id", "run"], "left_semi").select(*stored.names)


def replaced_runs(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(task_id, run) of finished runs that a later one replaced; nobody reads their folders any more."""
    runs = _finished(spark, f"{root.rstrip('/')}/{name}")
    last = runs.groupBy("task_id").agg(F.max_by("run", "finished_at").alias("run"))
    return runs.join(last, ["task_id", "run"], "left_anti").select("task_id", "run")


def append_jdbc(df: DataFrame, table: str, options: dict[str, str], task_id: int | None = None) -> None:
    """Append to a database table through Spark's JDBC writer."""
    if task_id is not None:
        df = df.withColumn("task_id", F.lit(task_id).cast("bigint"))
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
