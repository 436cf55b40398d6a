from datetime import date, datetime

import pytest
from fixtures import action, actions, rows, users
from pyspark.sql import functions as F

from footfall.operators import sessions as S
from footfall.params import JobParams
from footfall.schemas import STEP_BUCKETS, VISIT_BUCKETS
from footfall.sources import tables as T


def sample(spark):
    return actions(
        spark,
        [
            action("a", 0, search_keyword="food"),
            action("a", 10, click_category_id=12),
            action("a", 65, click_category_id=1),
            action("a", 70, click_category_id=2),
            action("a", 71, click_category_id=12),
            action("a", 72, search_keyword="seafood"),
            action("a", 73, search_keyword=""),
            action("b", 5, user=2),
            action("c", 5, user=9, search_keyword="mall"),
        ],
    )


def people(spark):
    return users(spark, [(1, 30, "cook", "Oslo", "male"), (2, None, "cook", "Rome", "female")])


def test_rollup_keeps_values_that_contain_each_other(spark):
    got = {r["session_id"]: r for r in S.session_rollup(sample(spark)).collect()}
    a = got["a"]
    assert a["search_keywords"] == ["food", "seafood"]
    assert a["click_category_ids"] == [1, 2, 12]
    assert (a["user_id"], a["visit_length"], a["step_length"]) == (1, 73, 7)
    assert a["start_time"] == datetime(2024, 3, 1, 9, 0, 0)
    b = got["b"]
    assert (b["visit_length"], b["step_length"]) == (0, 1)
    assert b["search_keywords"] == [] and b["click_category_ids"] == []


def test_features_agree_with_rollup(spark):
    names = ["session_id", "user_id", "start_time", "visit_length", "step_length"]
    assert rows(S.session_features(sample(spark)).select(names)) == rows(
        S.session_rollup(sample(spark)).select(names)
    )


def test_terms(spark):
    assert rows(S.session_terms(sample(spark)).fillna({"search_keyword": "-", "click_category_id": -1})) == [
        ("a", "-", 1), ("a", "-", 2), ("a", "-", 12), ("a", "food", -1), ("a", "seafood", -1), ("c", "mall", -1),
    ]


@pytest.mark.parametrize(
    "params, expected",
    [
        ({}, ["a", "b"]),  # c has no user row
        ({"start_age": 40}, ["a", "b"]),  # one bound alone does nothing
        ({"end_age": 10}, ["a", "b"]),
        ({"start_age": 30, "end_age": 30}, ["a"]),
        ({"start_age": 0, "end_age": 29}, []),  # an unknown age is no match
        ({"professionals": ["cook", "smith"]}, ["a", "b"]),
        ({"professionals": ["smith"]}, []),
        ({"cities": ["Rome"]}, ["b"]),
        ({"sex": "male"}, ["a"]),
        ({"keywords": ["food"]}, ["a"]),
        ({"keywords": ["oo"]}, []),
        ({"category_ids": [1]}, ["a"]),
        ({"category_ids": [3]}, []),
        ({"sex": "male", "category_ids": [2], "keywords": ["x", "seafood"]}, ["a"]),
        ({"sex": "female", "category_ids": [2]}, []),
    ],
)
def test_filters(spark, params, expected):
    got = S.selected_sessions(sample(spark), people(spark), JobParams(**params))
    assert sorted(r["session_id"] for r in got.collect()) == expected


def lengths(spark, name, values):
    other = "step_length" if name == "visit_length" else "visit_length"
    return spark.createDataFrame([(v, 0) for v in values], f"{name} bigint, {other} bigint")


@pytest.mark.parametrize(
    "name, build, buckets, edges",
    [
        (
            "visit_length", S.visit_length_histogram, VISIT_BUCKETS,
            [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801],
        ),
        ("step_length", S.step_length_histogram, STEP_BUCKETS, [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]),
    ],
)
def test_bucket_edges(spark, name, build, buckets, edges):
    got = {r["bucket"]: r["session_count"] for r in build(lengths(spark, name, edges)).collect()}
    last = buckets[-1][0]
    assert got == {label: 1 if label == last else 2 for label, _, _ in buckets}


def test_shares(spark):
    df = spark.createDataFrame([(0, 1), (2, 5), (2, 70)], "visit_length bigint, step_length bigint")
    row = S.session_length_stats(df).first().asDict()
    assert row["session_count"] == 3
    assert row["visit_length_1s_3s_ratio"] == 0.67
    assert sum(v for k, v in row.items() if k.startswith("visit")) == 0.67
    assert (row["step_length_1_3_ratio"], row["step_length_4_6_ratio"], row["step_length_60_ratio"]) == (0.33,) * 3


def test_shares_of_nothing(spark):
    df = spark.createDataFrame([], "visit_length bigint, step_length bigint")
    row = S.session_length_stats(df).first().asDict()
    assert row.pop("session_count") == 0
    assert set(row.values()) == {None}


def test_detail_with_a_hot_session(spark):
    # One session holds most rows, many of them identical.
    base = actions(
        spark,
        [action("hot", i % 7) for i in range(300)] + [action("cold", i) for i in range(5)]
        + [action("out", 1) for _ in range(5)],
    ).repartition(4)
    wanted = S.session_features(base).where("session_id <> 'out'")
    plain = rows(base.where("session_id <> 'out'").select("session_id", "action_time"))
    got = S.session_detail(base, wanted)
    assert got.columns == base.columns
    assert rows(got.select("session_id", "action_time")) == plain


def test_rows_without_session_belong_to_no_session(spark):
    base = actions(
        spark,
        [action("a", 1, search_keyword="k"), action(None, 1, search_keyword="x"), action(None, 2, click_category_id=3)],
    )
    got = S.session_rollup(base).collect()
    assert [(r.session_id, r.search_keywords, r.step_length) for r in got] == [("a", ["k"], 1)]
    assert S.session_detail(base, S.session_features(base)).count() == 1


def test_detail_of_few_lists_a_session_once(spark):
    base = sample(spark)
    twice = spark.createDataFrame([("a",), ("a",), ("b",)], "session_id string")
    assert S.detail_of_few(base, twice).count() == 8


def test_scan_accepts_stored_text(spark):
    base = actions(spark, [action("a", 1), action("b", 1, day=1), action("c", 1, day=2)])
    stored = base.withColumns(
        {
            "date": F.col("date").cast("string"),
            "action_time": F.lit("2024-03-02 9:00:01"),
            "city_id": F.col("city_id").cast("string"),
        }
    )
    params = JobParams(start_date="2024-03-02", end_date="2024-03-03")
    got = T.scan_actions(stored, params)
    assert sorted(r["session_id"] for r in got.collect()) == ["b", "c"]
    row = got.first()
    assert row["date"] in (date(2024, 3, 2), date(2024, 3, 3))
    assert (row["action_time"], row["city_id"]) == (datetime(2024, 3, 2, 9, 0, 1), 1)
