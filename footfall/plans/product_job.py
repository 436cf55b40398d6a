"""The job for top products per area."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footfall.operators import products as P
from footfall.params import JobParams
from footfall.sinks.results import append_result
from footfall.sources.tables import scan_actions


def product_results(
    actions: DataFrame, cities: DataFrame, products: DataFrame, params: JobParams
) -> DataFrame:
    return P.area_top_products(scan_actions(actions, params), cities, products)


def run_product_job(
    actions: DataFrame, cities: DataFrame, products: DataFrame, params: JobParams, root: str
) -> dict[str, str]:
    """Compute and store the top products of one task."""
    name = "area_top3_product"
    rows = product_results(actions, cities, products, params)
    return {name: append_result(rows, root, name, params.task_id)}
