"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings for large runs; every one can be changed on a live session.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Gathering sets per session sorts its input once a task has seen this many
    # sessions; the default of 128 is far below what fits in memory.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Settings that only a session builder can give.
RECOMMENDED_AT_START = {
    # Tracing the caller of every column expression is a debugging aid that
    # makes building a plan several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_recommended(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared location the cluster names.

    Only a local master may fall back on a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="footfall-")
    return f"{root.rstrip('/')}/footfall/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    For results that several outputs start from: the work is done once, a lost
    executor does not bring it back, and later joins know the real size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
