"""Stratified sampling of sessions by start hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.sessions import session_lists

SAMPLE_SIZE = 100
# Hexadecimal digits of a digest by which an hour's sessions are counted.
DIGITS = 3


def _with_hour(sessions: DataFrame) -> DataFrame:
    return sessions.withColumns(
        {"date": F.to_date("start_time"), "hour": F.date_format("start_time", "HH")}
    )


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions per start date and hour."""
    return (
        _with_hour(sessions)
        .groupBy("date", "hour")
        .agg(F.count(F.lit(1)).alias("hour_count"))
    )


def sample_quota(per_hour: DataFrame, n: int = SAMPLE_SIZE) -> DataFrame:
    """How many sessions each hour gives to a sample of ``n`` over all days.

    Every day gets ``n`` divided by the number of days; an hour gets its share
    of its day's sessions. Both are rounded down. The windows run over one row
    per calendar hour, whatever the size of the data.
    """
    day = Window.partitionBy("date")
    everything = Window.partitionBy(F.lit(0))
    first_of_day = F.row_number().over(day.orderBy("hour")) == 1
    counted = per_hour.withColumns(
        {"day_count": F.sum("hour_count").over(day), "_first": first_of_day.cast("int")}
    )
    per_day = F.call_function("div", F.lit(n), F.sum("_first").over(everything))
    quota = F.call_function("div", F.col("hour_count") * F.col("per_day"), F.col("day_count"))
    return counted.withColumn("per_day", per_day).select(
        "date", "hour", "hour_count", "day_count",
        F.least(quota, F.col("hour_count")).alias("quota"),
    )


def sample_sessions(sessions: DataFrame, n: int = SAMPLE_SIZE, seed: int = 0) -> DataFrame:
    """At most ``n`` sessions, spread over days and hours by ``sample_quota``.

    The order within an hour is the digest of seed and session id: random to
    the eye, the same on every run. One pass counts an hour's sessions by the
    beginning of their digest, which gives the quotas and, for each hour, the
    beginning up to which its share reaches; a second one ranks the sessions up
    to there. ``sessions`` is read twice and never shuffled as a whole.
    """
    digest = F.md5(F.concat(F.lit(str(seed)), F.col("session_id")))
    drawn = _with_hour(sessions).withColumn("_order", digest).withColumn("_start", F.substring("_order", 1, DIGITS))
    hour = ["date", "hour"]
    counted = drawn.groupBy(*hour, "_start").agg(F.count(F.lit(1)).alias("_count"))
    quotas = sample_quota(counted.groupBy(*hour).agg(F.sum("_count").alias("hour_count")), n)
    before = Window.partitionBy(*hour).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    reached = (
        counted.withColumn("_before", F.coalesce(F.sum("_count").over(before), F.lit(0)))
        .join(quotas.select(*hour, "quota"), hour)
        .where(F.col("_before") < F.col("quota"))
        .groupBy(*hour, "quota")
        .agg(F.max("_start").alias("_last"))
    )
    near = drawn.join(reached, hour).where(F.col("_start") <= F.col("_last"))
    rank = F.row_number().over(Window.partitionBy(*hour).orderBy("_order", "session_id"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= F.col("quota")).select(*sessions.columns)


def sampled_session_records(sampled: DataFrame, actions: DataFrame) -> DataFrame:
    """Start time, keywords and clicked categories of the sampled sessions.

    The lists are gathered for the sampled sessions alone, after removing
    repeats.
    """
    few = sampled.select("session_id")
    lists = session_lists(actions.join(few, "session_id", "left_semi"))

    def text(name: str) -> Column:
        joined = F.array_join(F.col(name).cast("array<string>"), ",")
        return F.coalesce(joined, F.lit("")).alias(name)

    return (
        sampled.select("session_id", "start_time")
        .join(lists, "session_id", "left")
        .select("session_id", "start_time", text("search_keywords"), text("click_category_ids"))
    )
