from datetime import date, datetime

import pytest
from fixtures import clicks, rows

from footfall.catalog import views as V
from footfall.operators import ads as A
from footfall.sources import ad_log as L

D = date(2024, 3, 1)


def table(spark):
    return clicks(
        spark,
        [
            (0, "p", "c1", 1, 1), (1, "p", "c1", 1, 1), (2, "p", "c2", 1, 1),
            (2, "p", "c2", 2, 2), (65, "q", "c3", 2, 2), (65, "q", "c3", 3, 3),
            (1441, "p", "c1", 1, 1),
        ],
    )


def test_daily_clicks_and_blacklist(spark):
    daily = A.user_daily_clicks(table(spark))
    assert rows(daily) == [(D, 1, 1, 3), (D, 2, 2, 2), (D, 3, 3, 1), (date(2024, 3, 2), 1, 1, 1)]
    assert rows(A.blacklisted_users(daily, 2)) == [(1,), (2,)]
    assert rows(A.blacklisted_users(daily, 3)) == [(1,)]
    assert rows(A.blacklisted_users(daily, 4)) == []


def test_blacklist_filter(spark):
    black = spark.createDataFrame([(1,), (1,), (7,)], "user_id bigint")
    got = A.without_blacklisted(table(spark), black)
    assert sorted(r["user_id"] for r in got.collect()) == [2, 2, 3]
    assert got.columns == table(spark).columns


def test_stat(spark):
    assert rows(A.ad_stat(table(spark))) == [
        (D, "p", "c1", 1, 2), (D, "p", "c2", 1, 1), (D, "p", "c2", 2, 1),
        (D, "q", "c3", 2, 1), (D, "q", "c3", 3, 1), (date(2024, 3, 2), "p", "c1", 1, 1),
    ]


def test_province_top(spark):
    stat = A.ad_stat(table(spark))
    assert rows(A.province_top_ads(stat, 1)) == [
        (D, "p", 1, 3), (D, "q", 2, 1), (date(2024, 3, 2), "p", 1, 1),
    ]
    assert rows(A.province_top_ads(stat, 1, per_day=False)) == [(D, "p", 1, 3), (D, "q", 2, 1)]


def test_trend(spark):
    got = rows(A.click_trend(table(spark)))
    assert (D, "00", "02", 1, 1) in got and (D, "01", "05", 2, 1) in got and len(got) == 7
    late = rows(A.click_trend(table(spark), as_of="2024-03-01 01:05:30"))
    assert late == [(D, "01", "05", 2, 1), (D, "01", "05", 3, 1)]
    # The minute the trailing window starts in counts whole.
    early = rows(A.click_trend(table(spark), as_of="2024-03-01 01:02:30"))
    assert early == [(D, "00", "02", 1, 1), (D, "00", "02", 2, 1)]


def test_sliding(spark):
    few = clicks(spark, [(0, "p", "c", 1, 1), (12, "p", "c", 1, 1), (30, "p", "c", 1, 1)])
    got = rows(A.sliding_clicks(few, 20, 10))
    start = lambda h, m, d=1: datetime(2024, 3, d, h, m)
    assert got == [
        (datetime(2024, 2, 29, 23, 50), 1, 1), (start(0, 0), 1, 2), (start(0, 10), 1, 1),
        (start(0, 20), 1, 1), (start(0, 30), 1, 1),
    ]
    with pytest.raises(ValueError):
        A.sliding_clicks(few, 25, 10)


def test_sliding_seconds(spark):
    few = clicks(spark, [(0, "p", "c", 1, 1), (1, "p", "c", 1, 1)])
    got = rows(A.sliding_clicks_seconds(few, 90, 30))
    at = lambda m, s, d=1, h=0: datetime(2024, 3, d, h, m, s)
    assert got == [
        (datetime(2024, 2, 29, 23, 59), 1, 1), (datetime(2024, 2, 29, 23, 59, 30), 1, 1),
        (at(0, 0), 1, 2), (at(0, 30), 1, 1), (at(1, 0), 1, 1),
    ]
    with pytest.raises(ValueError):
        A.sliding_clicks_seconds(few, 95, 30)


LINES = [
    ("1700000000123 Jiangsu Nanjing 17 3",),
    ("1700000000123 Jiangsu Nanjing 17 3 more",),
    ("x Jiangsu Nanjing 17 3",), ("1700000000123 Jiangsu Nanjing u 3",),
    ("1700000000123 Jiangsu Nanjing 17",), ("",), (None,), ("99999999999999999999 a b 1 2",),
]


def test_log_lines(spark):
    lines = spark.createDataFrame(LINES, "value string")
    got = L.parse_ad_log(lines)
    at = datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert rows(got) == [(at, at.date(), "Jiangsu", "Nanjing", 17, 3)] * 2
    assert L.malformed_lines(lines).count() == 6
    assert rows(V.to_log_lines(got)) == [LINES[0]] * 2
