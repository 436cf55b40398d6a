from datetime import datetime

import pytest
from pyspark.sql import functions as F

from footfall.functions import columns as C
from footfall.functions import sql_names


def one(spark, expression, **values):
    literals = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*literals).select(expression.alias("r")).first()["r"]


def test_label_leaves_out_nulls(spark):
    assert one(spark, C.concat_long_string(F.col("a"), F.col("b"), ":"), a=3, b="Oslo") == "3:Oslo"
    assert one(spark, C.concat_long_string(F.lit(None), F.col("b"), ":"), b="Oslo") == "Oslo"


@pytest.mark.parametrize(
    "text, expected",
    [('{"product_status": 0}', "0"), ('{"product_status":"1"}', "1"), ("{}", None), ("{bad", None), (None, None)],
)
def test_json_field(spark, text, expected):
    assert one(spark, C.json_field(F.lit(text), "product_status")) == expected


def test_prefix_goes_on_and_off(spark):
    df = spark.range(200).select(F.concat(F.lit("7_a_"), "id").alias("s"))
    salted = df.select("s", C.random_prefix(F.col("s"), 5, seed=1).alias("p"))
    seen = salted.select(F.split("p", "_")[0].alias("n"), "s", C.remove_random_prefix(F.col("p")).alias("back"))
    got = seen.collect()
    assert all(r["s"] == r["back"] for r in got)
    assert {r["n"] for r in got} == {"0", "1", "2", "3", "4"}


@pytest.mark.parametrize(
    "text, expected",
    [("3,3,4", [3, 3, 4]), ("12", [12]), (" 5 , x,6", [5, 6]), ("", []), (None, None)],
)
def test_split_ids(spark, text, expected):
    assert one(spark, C.split_ids(F.lit(text))) == expected


@pytest.mark.parametrize(
    "part, whole, expected",
    [(57, 200, 0.29), (1, 3, 0.33), (2, 3, 0.67), (0, 5, 0.0), (5, 5, 1.0), (7, 2, 3.5), (1, 0, None)],
)
def test_ratio_is_half_up(spark, part, whole, expected):
    assert one(spark, C.ratio(F.lit(part), F.lit(whole))) == expected


def test_distinct_text_is_exact(spark):
    df = spark.createDataFrame([("12",), ("1",), ("2",), ("12",), (None,)], "v string")
    assert df.agg(C.distinct_text(F.col("v"))).first()[0] == "1,12,2"


def test_times(spark):
    at = datetime(2024, 3, 1, 9, 5, 7)
    assert one(spark, C.parse_time(F.lit("2024-03-01 9:05:07"))) == at
    assert one(spark, C.parse_time(F.lit("2024-03-01 09:05:07"))) == at
    assert one(spark, C.parse_time(F.lit("soon"))) is None
    assert one(spark, C.format_time(F.lit(at))) == "2024-03-01 09:05:07"
    assert one(spark, C.format_date(F.lit(at))) == "2024-03-01"
    assert one(spark, C.date_key(F.lit(at))) == "20240301"
    assert one(spark, C.minute_key(F.lit(at))) == "202403010905"
    assert one(spark, C.date_hour(F.lit(at))) == "2024-03-01_09"
    assert one(spark, C.parse_date_key(F.lit("20240301"))) == at.date()


@pytest.mark.parametrize("text", ["x", "", "9" * 18, "9" * 30, None])
def test_epoch_text_that_is_no_time(spark, text):
    assert one(spark, C.from_epoch_millis(F.lit(text))) is None


def test_epoch_text(spark):
    assert one(spark, C.from_epoch_millis(F.lit("1700000000123"))) == datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_epoch_text_before_1970_and_after_9999(spark):
    micros = [one(spark, F.unix_micros(C.from_epoch_millis(F.lit(t)))) for t in ("-5", "253402300800000")]
    assert micros == [-5_000, 253402300800000_000]


def test_sql_names(spark):
    sql_names.register(spark)
    row = spark.sql(
        "SELECT concat_long_string(3, 'Oslo', ':') a, remove_random_prefix(random_prefix('9_x', 4)) b"
    ).first()
    assert tuple(row) == ("3:Oslo", "9_x")
