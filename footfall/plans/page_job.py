"""The page conversion job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.operators import funnel
from footfall.params import JobParams
from footfall.sinks.results import append_result
from footfall.sources.tables import scan_actions


def page_results(actions: DataFrame, params: JobParams, sequence: list[str] = ()) -> DataFrame:
    """Steps of the task's target flow with their rates."""
    return funnel.page_conversion(
        scan_actions(actions, params), params.target_page_flow, sequence=sequence
    )


def run_page_job(
    actions: DataFrame, params: JobParams, root: str, sequence: list[str] = ()
) -> dict[str, str]:
    """Compute and store the flow's packed rates."""
    packed = funnel.packed_conversion(page_results(actions, params, sequence))
    name = "page_split_convert_rate"
    return {name: append_result(packed, root, name, params.task_id)}
