"""Session profiles, filters, length statistics and detail."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import columns as C
from footfall.params import JobParams
from footfall.schemas import STEP_BUCKETS, STEP_RATIOS, VISIT_BUCKETS, VISIT_RATIOS
from footfall.sources.tables import detail_columns


def session_features(
    actions: DataFrame, keywords: list[str] = (), category_ids: list[int] = ()
) -> DataFrame:
    """One narrow row per session: user, start, length and filter marks.

    Only fixed-size aggregates, so a session of any size is reduced inside the
    map tasks to one row each. Whether a session searched one of ``keywords`` or
    clicked one of ``category_ids`` is a boolean here, which spares the filters
    the session's full lists. A row without a session id belongs to no session.
    """
    marks = {}
    if keywords:
        marks["searched_keyword"] = F.col("search_keyword").isin(list(keywords))
    if category_ids:
        marks["clicked_category"] = F.col("click_category_id").isin(list(category_ids))
    start, end = F.min("action_time"), F.max("action_time")
    return actions.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        start.alias("start_time"),
        C.whole_seconds_between(start, end).alias("visit_length"),
        F.count(F.lit(1)).alias("step_length"),
        *[F.coalesce(F.max(mark), F.lit(False)).alias(name) for name, mark in marks.items()],
    )


def session_terms(actions: DataFrame) -> DataFrame:
    """Each session's distinct keywords and clicked categories, one per row.

    The other of the two columns is null. The shuffle is on all three columns,
    so the terms of a huge session are spread over many tasks.
    """
    keyword = F.nullif(F.col("search_keyword"), F.lit(""))
    no_keyword, no_category = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    return (
        actions.select(
            "session_id",
            F.stack(
                F.lit(2), keyword, no_category, no_keyword, F.col("click_category_id").cast("bigint")
            ).alias("search_keyword", "click_category_id"),
        )
        .where(F.col("session_id").isNotNull())
        .where(F.col("search_keyword").isNotNull() | F.col("click_category_id").isNotNull())
        .distinct()
    )


def session_lists(actions: DataFrame) -> DataFrame:
    """Distinct keywords and clicked categories of every session that has any.

    Repeats are gone before the gathering, so what one task holds for a session
    is no more than the session's row has to show. (Lists, not sets: in front of
    a set Spark would drop the step that removes repeats.)
    """
    return (
        session_terms(actions)
        .groupBy("session_id")
        .agg(
            F.array_sort(F.collect_list("search_keyword")).alias("search_keywords"),
            F.array_sort(F.collect_list("click_category_id")).alias("click_category_ids"),
        )
    )


def session_rollup(actions: DataFrame) -> DataFrame:
    """One full row per session: the narrow features and the two lists.

    Features and lists come out spread by session already, so putting them
    together moves no data.
    """
    return (
        session_features(actions)
        .join(session_lists(actions), "session_id", "left")
        .select(
            "session_id",
            "user_id",
            F.coalesce("search_keywords", F.array().cast("array<string>")).alias("search_keywords"),
            F.coalesce("click_category_ids", F.array().cast("array<bigint>")).alias(
                "click_category_ids"
            ),
            "start_time",
            "visit_length",
            "step_length",
        )
    )


def session_profile(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with age, profession, city and sex of their user.

    Sessions of unknown users drop out. Filters on user columns reach the user
    scan. The join is left to Spark: broadcast when the filtered users measure
    small, else a shuffle join that splits a user with too many sessions.
    """
    traits = users.select("user_id", "age", "professional", "city", "sex")
    return sessions.join(traits, "user_id")


def age_between(low: int, high: int) -> Column:
    return F.col("age").between(low, high)


def professional_in(values: list[str]) -> Column:
    return F.col("professional").isin(list(values))


def city_in(values: list[str]) -> Column:
    return F.col("city").isin(list(values))


def sex_is(value: str) -> Column:
    return F.col("sex") == value


def filter_sessions(profile: DataFrame, params: JobParams) -> DataFrame:
    """Sessions meeting every given condition; an absent one lets all pass.

    Age counts only when both ends are given. Keyword and category conditions
    need a profile built from ``session_features`` with the same parameters.
    """
    conditions = []
    if params.start_age is not None and params.end_age is not None:
        conditions.append(age_between(params.start_age, params.end_age))
    if params.professionals:
        conditions.append(professional_in(params.professionals))
    if params.cities:
        conditions.append(city_in(params.cities))
    if params.sex is not None:
        conditions.append(sex_is(params.sex))
    if params.keywords:
        conditions.append(F.col("searched_keyword"))
    if params.category_ids:
        conditions.append(F.col("clicked_category"))
    return profile.where(reduce(and_, conditions)) if conditions else profile


def selected_sessions(actions: DataFrame, users: DataFrame, params: JobParams) -> DataFrame:
    """From actions to the sessions a task asks for."""
    features = session_features(actions, params.keywords, params.category_ids)
    return filter_sessions(session_profile(features, users), params)


def _bucket_counts(column: str, buckets) -> list[Column]:
    return [
        F.count_if(C.in_bucket(F.col(column), low, high)).alias(label)
        for label, low, high in buckets
    ]


def _histogram(sessions: DataFrame, column: str, buckets) -> DataFrame:
    wide = sessions.agg(*_bucket_counts(column, buckets))
    labels = [label for label, _, _ in buckets]
    return wide.unpivot([], labels, "bucket", "session_count")


def visit_length_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per visit-length bucket; a visit of 0 seconds is in none."""
    return _histogram(sessions, "visit_length", VISIT_BUCKETS)


def step_length_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per step-length bucket."""
    return _histogram(sessions, "step_length", STEP_BUCKETS)


def session_length_stats(sessions: DataFrame) -> DataFrame:
    """One row: session count and the share of every length bucket."""
    visits = [
        F.count_if(C.in_bucket(F.col("visit_length"), low, high)).alias(name)
        for name, (_, low, high) in zip(VISIT_RATIOS, VISIT_BUCKETS)
    ]
    steps = [
        F.count_if(C.in_bucket(F.col("step_length"), low, high)).alias(name)
        for name, (_, low, high) in zip(STEP_RATIOS, STEP_BUCKETS)
    ]
    counted = sessions.agg(F.count(F.lit(1)).alias("session_count"), *visits, *steps)
    return counted.select(
        "session_count",
        *[
            C.ratio(F.col(name), F.col("session_count")).alias(name)
            for name in VISIT_RATIOS + STEP_RATIOS
        ],
    )


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """All action rows of the given sessions.

    A semi join from two shuffles, or with the sessions sent to all executors
    where Spark measures them small; a session with very many rows is split by
    Spark at run time.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi").select(*actions.columns)


def detail_of_few(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The detail columns of the given sessions' action rows, each row once."""
    return detail_columns(session_detail(actions, sessions))
