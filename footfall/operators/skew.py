"""Answers to skewed keys: find them, salt them, join around them.

Salts are computed from the row and the partition that holds it, never drawn.
A task that runs again after an executor is lost gives every row the salt it
had before, and identical copies in different partitions get different salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from footfall.settings import materialize

SALTS = 64
# Keys that a task's sketch of frequent keys holds.
TRACKED = 1 << 16


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, MapType)


def salt(df: DataFrame, n: int, by: list[str] | None = None) -> Column:
    """A number below ``n`` that spreads the rows of any one key.

    ``by`` names the columns it is made from, by default all that have a hash;
    columns that the plan does not need otherwise are better left out.
    """
    columns = [f.name for f in df.schema.fields if _hashable(f.dataType)] if by is None else by
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(n)).cast("int")


def key_sketch(df: DataFrame, key: str, tracked: int = TRACKED) -> DataFrame:
    """Frequent keys of ``df`` and about how many rows they have, as (key, about_rows), in one pass.

    Every task keeps a heavy-hitter sketch of at most ``tracked`` keys, which
    are merged. Keys that hold more than 7 / ``tracked`` of all rows are always
    found, and all keys with their exact counts where there are no more than
    three quarters of ``tracked``.
    """
    found = df.where(F.col(key).isNotNull()).agg(F.call_function("approx_top_k", key, F.lit(tracked), F.lit(tracked)).alias("top"))
    return found.select(F.explode("top").alias("top")).select(F.col("top.item").alias(key), F.col("top.count").alias("about_rows"))


def hot_keys(
    df: DataFrame,
    key: str,
    n: int = 1,
    fraction: float = 1.0,
    seed: int = 7,
    min_rows: int = 1,
    tracked: int = TRACKED,
) -> DataFrame:
    """The ``n`` most frequent keys of a sample, as (key, sampled_rows).

    ``min_rows`` refers to the whole table; it is scaled to the sample. A first
    pass finds candidates by ``key_sketch``, so a group by every key is never
    made; a second one counts the candidates exactly.
    """
    keys = df.select(key).where(F.col(key).isNotNull())
    if fraction < 1.0:
        keys = keys.sample(fraction=fraction, seed=seed)
    return (
        keys.join(key_sketch(keys, key, tracked).select(key), key, "left_semi")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("sampled_rows"))
        .where(F.col("sampled_rows") >= max(1, int(min_rows * fraction)))
        .orderBy(F.desc("sampled_rows"), F.asc(key))
        .limit(n)
    )


def salted_count(df: DataFrame, keys: list[str], n: int = SALTS, name: str = "count") -> DataFrame:
    """Rows per key in two steps: per key and salt, then per key.

    Spark's own partial aggregation already does this within a task; the extra
    step helps when one key's partial results alone would swamp a task.
    """
    df = df.select(*keys)
    partial = df.groupBy(*keys, salt(df, n).alias("_salt")).agg(F.count(F.lit(1)).alias("_part"))
    return partial.groupBy(*keys).agg(F.sum("_part").alias(name))


def _marked(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The rows with ``_hot``: whether their key is in the table of hot keys; false for null."""
    marks = hot.select(key).distinct().withColumn("_hot", F.lit(True))
    return df.join(marks, key, "left").select(*df.columns, F.coalesce("_hot", F.lit(False)).alias("_hot"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    n: int = SALTS,
    hot: DataFrame | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Equi join with the left rows of a key spread over ``n`` tasks.

    Each right row is repeated once per salt, so every left row meets exactly
    the rows it would meet in a plain join: ``inner``, ``left``, ``left_semi``
    and ``left_anti`` are all exact. With ``hot``, a table of any number of keys,
    only those are salted and repeated. ``hot`` is asked on both sides, so it has
    to be the same each time it is read: a stored table, or a plan without chance.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how!r}")
    left_salt = salt(left, n, by)
    right_salts = F.sequence(F.lit(0), F.lit(n - 1))
    if hot is not None:
        left, right = _marked(left, hot, key), _marked(right, hot, key).withColumnRenamed("_hot", "_hot_too")
        left_salt = F.when(F.col("_hot"), left_salt).otherwise(F.lit(0))
        right_salts = F.when(F.col("_hot_too"), right_salts).otherwise(F.array(F.lit(0)))
    return (
        left.withColumn("_salt", left_salt)
        .join(right.withColumn("_salt", F.explode(right_salts)), [key, "_salt"], how)
        .drop("_salt", "_hot", "_hot_too")
    )


def skew_split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    n: int = SALTS,
    fraction: float = 0.1,
    seed: int = 7,
    top: int = 1,
    tracked: int = TRACKED,
) -> DataFrame:
    """Join the ``top`` hottest keys of a sample with salts, all others plainly.

    The hot keys are found in one pass over the sample and stored; both kinds of
    rows then go through one join, so the left side is read twice in all. Which
    keys are hot changes nothing in the result, so the sketch's counts will do.
    """
    sample = left.select(key).sample(fraction=fraction, seed=seed) if fraction < 1.0 else left.select(key)
    order = [F.desc("about_rows"), F.asc(key)]
    hot = materialize(key_sketch(sample, key, tracked).orderBy(*order).limit(top).select(key), "hot-keys")
    return salted_join(left, right, key, how, n, hot)
