"""The session analysis job: five result tables from one pass of the rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.operators import categories, sampling, sessions
from footfall.params import JobParams
from footfall.settings import materialize
from footfall.sinks.results import append_result
from footfall.sources.tables import scan_actions

SESSION_RESULTS = [
    "session_aggr_stat",
    "session_random_extract",
    "session_detail",
    "top10_category",
    "top10_session",
    "top10_session_detail",
]


def session_results(
    actions: DataFrame, users: DataFrame, params: JobParams, sample_size: int = sampling.SAMPLE_SIZE
) -> dict[str, DataFrame]:
    """Result table name -> rows.

    The selected sessions, their activity, the sample, the top sessions and the
    actions of both are written to the shared folder once, since several results
    start from them. The actions are read three times, for the sessions, their
    activity and the actions of the few.
    """
    actions = scan_actions(actions, params)
    selected = materialize(sessions.selected_sessions(actions, users, params), "sessions")
    activity = materialize(
        categories.activity_of(categories.category_activity(actions), selected), "activity"
    )
    sampled = materialize(sampling.sample_sessions(selected, sample_size), "sample")
    top_categories = materialize(categories.top_categories(activity), "top-categories")
    top_sessions = materialize(
        categories.top_sessions_per_category(activity, top_categories), "top-sessions"
    )
    few = sampled.select("session_id").unionByName(top_sessions.select("session_id"))
    few_actions = materialize(sessions.session_detail(actions, few), "few-actions")
    return {
        "session_aggr_stat": sessions.session_length_stats(selected),
        "session_random_extract": sampling.sampled_session_records(sampled, few_actions),
        "session_detail": sessions.detail_of_few(few_actions, sampled),
        "top10_category": top_categories,
        "top10_session": top_sessions,
        "top10_session_detail": sessions.detail_of_few(few_actions, top_sessions),
    }


def run_session_job(
    actions: DataFrame,
    users: DataFrame,
    params: JobParams,
    root: str,
    sample_size: int = sampling.SAMPLE_SIZE,
) -> dict[str, str]:
    """Compute and store all results of one task."""
    results = session_results(actions, users, params, sample_size)
    return {
        name: append_result(results[name], root, name, params.task_id)
        for name in SESSION_RESULTS
    }
