"""Most clicked products per area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import columns as C
from footfall.operators.ranking import top_n
from footfall.sources.tables import click_scan

TOP_PRODUCTS = 3

# Area -> level; areas not listed are OTHER_LEVEL. Fixed values.
AREA_LEVELS = {
    "China North": "A level",
    "China East": "A level",
    "China South": "B level",
    "China Middle": "B level",
    "West North": "C level",
    "West South": "C level",
}
OTHER_LEVEL = "D level"


def area_level(area: Column, levels: dict[str, str] = AREA_LEVELS) -> Column:
    by_level: dict[str, list[str]] = {}
    for name, level in levels.items():
        by_level.setdefault(level, []).append(name)
    label = F.lit(OTHER_LEVEL)
    for level, names in by_level.items():
        label = F.when(area.isin(names), F.lit(level)).otherwise(label)
    return label


def product_status(extend_info: Column) -> Column:
    own = C.json_field(extend_info, "product_status") == "0"
    return F.when(own, "self").otherwise("Third Party")


def area_product_clicks(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and cities per area and product.

    Clicks are summed per city and product before they meet the city table: a
    city or product with a third of all clicks is one row per pair by then. The
    city list of a group is no longer than the area has cities.
    """
    per_city = (
        click_scan(actions).groupBy("city_id", "product_id").agg(F.count(F.lit(1)).alias("clicks"))
    )
    label = C.concat_long_string(F.col("city_id"), F.col("city_name"), ":")
    return (
        per_city.join(cities, "city_id")
        .groupBy("area", "product_id")
        .agg(
            F.sum("clicks").alias("click_count"),
            C.distinct_text(label).alias("city_infos"),
        )
    )


def area_products_named(area_clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Adds name and status; products missing from the product table drop out."""
    described = products.select(
        "product_id", "product_name", product_status(F.col("extend_info")).alias("product_status")
    )
    return area_clicks.join(described, "product_id").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status"
    )


def area_top_products(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    n: int = TOP_PRODUCTS,
    levels: dict[str, str] = AREA_LEVELS,
) -> DataFrame:
    """The ``n`` most clicked products of each area.

    There are few areas and many products; the rank filter makes each map task
    send its best ``n`` per area instead of all products.
    """
    named = area_products_named(area_product_clicks(actions, cities), products)
    order = [F.desc("click_count"), "product_id"]
    return top_n(named, ["area"], order, n).select(
        "area",
        area_level(F.col("area"), levels).alias("area_level"),
        "product_id",
        "city_infos",
        "click_count",
        "product_name",
        "product_status",
    )
