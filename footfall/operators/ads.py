"""Ad-click statistics as plain DataFrame functions, for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.ranking import top_n

BLACKLIST_THRESHOLD = 100
TOP_ADS = 3
TREND_MINUTES = 60


def without_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users that are not on the blacklist.

    An anti join; Spark splits a user with very many clicks at run time.
    """
    users = blacklist.select("user_id").distinct()
    return clicks.join(users, "user_id", "left_anti").select(*clicks.columns)


def user_daily_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    return clicks.groupBy("date", "user_id", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def blacklisted_users(user_clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users who clicked one ad ``threshold`` times or more on one day."""
    return user_clicks.where(F.col("click_count") >= threshold).select("user_id").distinct()


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return clicks.groupBy("date", "province", "city", "ad_id").agg(
        F.count(F.lit(1)).alias("click_count")
    )


def province_clicks(stat: DataFrame) -> DataFrame:
    """Clicks per day, province and ad, over all cities."""
    return stat.groupBy("date", "province", "ad_id").agg(
        F.sum("click_count").alias("click_count")
    )


def province_top_ads(stat: DataFrame, n: int = TOP_ADS, per_day: bool = True) -> DataFrame:
    """The ``n`` most clicked ads per day and province, or per province."""
    group = ["date", "province"] if per_day else ["province"]
    order = [F.desc("click_count"), "ad_id", "date"]
    return top_n(province_clicks(stat), group, order, n).drop("_rank")


def trend_columns(minute: Column) -> list[Column]:
    """Date, hour and minute of a minute's start."""
    return [
        F.to_date(minute).alias("date"),
        F.date_format(minute, "HH").alias("hour"),
        F.date_format(minute, "mm").alias("minute"),
    ]


def click_trend(clicks: DataFrame, as_of=None, minutes: int = TREND_MINUTES) -> DataFrame:
    """Clicks per minute and ad; with ``as_of``, of the last ``minutes`` minutes.

    ``as_of`` is a timestamp column or literal. Minutes count whole, from the
    one that holds the start of the trailing window.
    """
    if as_of is not None:
        end = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
        start = F.date_trunc("minute", end - F.make_dt_interval(mins=F.lit(minutes)))
        clicks = clicks.where((F.col("ts") >= start) & (F.col("ts") <= end))
    counted = clicks.groupBy(
        F.date_trunc("minute", "ts").alias("at"), "ad_id"
    ).agg(F.count(F.lit(1)).alias("click_count"))
    return counted.select(*trend_columns(F.col("at")), "ad_id", "click_count")


def sliding_clicks(clicks: DataFrame, size_minutes: int = 60, slide_minutes: int = 10) -> DataFrame:
    """``sliding_clicks_seconds`` with whole minutes."""
    return sliding_clicks_seconds(clicks, size_minutes * 60, slide_minutes * 60)


def sliding_clicks_seconds(clicks: DataFrame, size_seconds: int = 3600, slide_seconds: int = 10) -> DataFrame:
    """Clicks per ad in windows of ``size_seconds`` starting every ``slide_seconds``.

    The size is a multiple of the slide. Clicks are first counted per slide, so
    what is repeated for the overlapping windows are counts, not clicks.
    """
    if slide_seconds <= 0 or size_seconds <= 0 or size_seconds % slide_seconds:
        raise ValueError("the window size must be a multiple of the slide")
    per_slide = clicks.groupBy(
        F.window("ts", f"{slide_seconds} seconds").alias("slot"), "ad_id"
    ).agg(F.count(F.lit(1)).alias("clicks"))
    back = F.explode(F.sequence(F.lit(0), F.lit(size_seconds // slide_seconds - 1)))
    shifted = per_slide.select("slot", "ad_id", "clicks", back.alias("k"))
    start = F.col("slot.start") - F.make_dt_interval(secs=F.col("k") * slide_seconds)
    return shifted.groupBy(start.alias("window_start"), "ad_id").agg(
        F.sum("clicks").alias("click_count")
    )
