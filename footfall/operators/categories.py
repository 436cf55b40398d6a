"""Category popularity over clicks, orders and payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.ranking import top_n

TOP_CATEGORIES = 10
TOP_SESSIONS = 3


def _touches(detail: DataFrame) -> DataFrame:
    """One row per category an action clicks, orders or pays, with which it was.

    An id list may name a category twice, which counts twice. Only generators
    and plain expressions, so all of it is compiled code.
    """
    click, order, pay = "click_category_id", "order_category_ids", "pay_category_ids"
    return (
        detail.select(
            "session_id",
            F.stack(
                F.lit(3),
                F.lit("click"), F.col(click).cast("string"),
                F.lit("order"), F.col(order),
                F.lit("pay"), F.col(pay),
            ).alias("kind", "ids"),
        )
        .where(F.col("ids").isNotNull())
        .select("session_id", "kind", F.explode(F.split("ids", ",")).alias("id"))
        .select("session_id", "kind", F.trim("id").try_cast("bigint").alias("category_id"))
        .where(F.col("category_id").isNotNull())
    )


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("click_count", "order_count", "pay_count")]


def category_activity(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per session and category.

    One pass over the actions, and the base of both top lists: a session of any
    size shrinks to one row per category before it meets another table.
    """
    return (
        _touches(actions.where(F.col("session_id").isNotNull()))
        .groupBy("session_id", "category_id")
        .agg(
            *[
                F.count_if(F.col("kind") == kind).alias(f"{kind}_count")
                for kind in ("click", "order", "pay")
            ]
        )
    )


def activity_of(activity: DataFrame, sessions: DataFrame) -> DataFrame:
    """The activity of the given sessions."""
    return activity.join(sessions.select("session_id"), "session_id", "left_semi")


def category_ids(detail: DataFrame) -> DataFrame:
    """Every category clicked, ordered or paid, once."""
    return _touches(detail).select("category_id").distinct()


def category_click_counts(detail: DataFrame) -> DataFrame:
    return (
        detail.where(F.col("click_category_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"))
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def _listed_counts(detail: DataFrame, column: str, name: str) -> DataFrame:
    return (
        detail.where(F.col(column).isNotNull())
        .select(F.explode(F.split(column, ",")).alias("id"))
        .select(F.trim("id").try_cast("bigint").alias("category_id"))
        .where(F.col("category_id").isNotNull())
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias(name))
    )


def category_order_counts(detail: DataFrame) -> DataFrame:
    return _listed_counts(detail, "order_category_ids", "order_count")


def category_pay_counts(detail: DataFrame) -> DataFrame:
    return _listed_counts(detail, "pay_category_ids", "pay_count")


def top_categories(activity: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The ``n`` categories with most clicks, then orders, then payments."""
    return (
        activity.groupBy("category_id")
        .agg(*_sums())
        .orderBy(
            F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"
        )
        .limit(n)
    )


def session_category_clicks(activity: DataFrame) -> DataFrame:
    """Clicks per category and session, where there are any."""
    return activity.where(F.col("click_count") > 0).select(
        "category_id", "session_id", "click_count"
    )


def top_sessions_per_category(
    activity: DataFrame, categories: DataFrame | None = None, n: int = TOP_SESSIONS
) -> DataFrame:
    """The ``n`` sessions with most clicks in each category.

    ``categories`` restricts the result to a top list; without it every category
    counts.
    """
    clicks = session_category_clicks(activity)
    if categories is not None:
        clicks = clicks.join(categories.select("category_id"), "category_id", "left_semi")
    order = [F.desc("click_count"), "session_id"]
    return top_n(clicks, ["category_id"], order, n).drop("_rank")
