"""The first rows of every group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.skew import SALTS, salt

# Up to this many rows per group Spark cuts a rank filter short inside the map tasks by itself.
CUT_BY_SPARK = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_n(
    df: DataFrame, group: list[str], order: list[Column | str], n: int, rank: str = "_rank"
) -> DataFrame:
    """The first ``n`` rows of each group, with their rank.

    However large a group is, no task receives all of it: for a small ``n`` each
    map task sends its own first ``n``; for a large one the group is ranked in
    ``SALTS`` parts first, whose first ``n`` hold the group's first ``n``.
    """

    def first(rows: DataFrame, keys: list[str]) -> DataFrame:
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn(rank, ranked).where(F.col(rank) <= n)

    if n > int(df.sparkSession.conf.get(CUT_BY_SPARK, "-1")):
        spread = df.withColumn("_salt", salt(df, SALTS))
        df = first(spread, [*group, "_salt"]).drop("_salt", rank)
    return first(df, group)
