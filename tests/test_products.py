import pytest
from fixtures import action, actions, rows
from pyspark.sql import functions as F

from footfall import schemas
from footfall.operators import products as P
from footfall.sources import tables as T


def cities(spark):
    return spark.createDataFrame(
        [(1, "Rome", "China East"), (2, "Oslo", "China East"), (12, "Bern", "West South")],
        schemas.CITY_INFO,
    )


def infos(spark):
    return spark.createDataFrame(
        [(1, "one", '{"product_status": 0}'), (2, "two", '{"product_status": 1}'), (3, "three", "{bad"), (4, "four", None)],
        schemas.PRODUCT_INFO,
    )


def clicks(spark, pairs):
    return actions(
        spark, [action("s", i, click_product_id=p, city_id=c) for i, (c, p) in enumerate(pairs)]
    )


PAIRS = [(1, 1), (2, 1), (2, 1), (1, 2), (1, 3), (2, 3), (1, 4), (1, 99), (1, 99), (1, 99), (12, 2), (77, 1), (1, None)]


def test_click_city_scan(spark):
    got = T.click_city(T.click_scan(clicks(spark, PAIRS)), cities(spark))
    assert got.columns == ["city_id", "city_name", "area", "product_id"]
    assert got.count() == 11  # no unknown city, no action without product


def test_clicks_and_cities_per_area(spark):
    got = rows(P.area_product_clicks(clicks(spark, PAIRS), cities(spark)))
    assert ("China East", 1, 3, "1:Rome,2:Oslo") in got
    assert ("West South", 2, 1, "12:Bern") in got
    assert len(got) == 6


def test_top_products(spark):
    got = P.area_top_products(clicks(spark, PAIRS), cities(spark), infos(spark)).collect()
    assert sorted(tuple(r) for r in got) == [
        # 99 has most clicks but no product row; 2 and 4 tie, the lower id stays.
        ("China East", "A level", 1, "1:Rome,2:Oslo", 3, "one", "self"),
        ("China East", "A level", 2, "1:Rome", 1, "two", "Third Party"),
        ("China East", "A level", 3, "1:Rome,2:Oslo", 2, "three", "Third Party"),
        ("West South", "C level", 2, "12:Bern", 1, "two", "Third Party"),
    ]


@pytest.mark.parametrize(
    "area, level",
    [
        ("China North", "A level"), ("China East", "A level"), ("China South", "B level"),
        ("China Middle", "B level"), ("West North", "C level"), ("West South", "C level"),
        ("Elsewhere", "D level"), (None, "D level"),
    ],
)
def test_levels(spark, area, level):
    df = spark.createDataFrame([(area,)], "area string")
    assert df.select(P.area_level(F.col("area"))).first()[0] == level
