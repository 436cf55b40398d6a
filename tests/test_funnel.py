import random
from collections import Counter

import pytest
from fixtures import action, actions, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from footfall.operators import funnel as N

FLOW = [1, 2, 3, 1, 1]


def brute(rows_in, flow):
    """Pairs by sorting each session in plain Python."""
    wanted = set(N.flow_splits(flow))
    by_session = {}
    for session, second, page in rows_in:
        by_session.setdefault(session, []).append((second, page))
    counts = Counter()
    for views in by_session.values():
        pages = [p for _, p in sorted(views)]
        counts.update(f"{a}_{b}" for a, b in zip(pages, pages[1:]))
    return sorted((k, v) for k, v in counts.items() if k in wanted)


def table(spark, views):
    return actions(spark, [action(s, t, page=p) for s, t, p in views])


def random_views(seed, n, sessions, seconds, pages=3):
    r = random.Random(seed)
    return [
        (f"s{min(r.randrange(sessions), r.randrange(sessions))}", r.randrange(seconds), r.randrange(1, pages + 1))
        for _ in range(n)
    ]


@pytest.mark.parametrize("cell_seconds", [1, 2, 600, N.CELL_SECONDS])
@pytest.mark.parametrize("seconds", [1, 5, 5000])
def test_pairs_match_brute_force(spark, cell_seconds, seconds):
    views = random_views(seconds, 400, 6, seconds)
    df = table(spark, views).repartition(5)
    got = N.page_pair_counts(df, FLOW, cell_seconds=cell_seconds)
    assert rows(got) == brute(views, FLOW)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 6), st.integers(1, 3)), min_size=1, max_size=40
    )
)
def test_all_cells_agree(spark, views):
    df = table(spark, views)
    for cell_seconds in (1, 3, N.CELL_SECONDS):
        got = N.page_pair_counts(df, FLOW, cell_seconds=cell_seconds)
        assert rows(got) == brute(views, FLOW)


def test_equal_views_are_folded(spark):
    views = [("bot", 0, 1)] * 500 + [("bot", 1, 2)] * 500 + [("bot", 1, 3)]
    got = N.page_pair_counts(table(spark, views), [1, 1, 2, 2, 3], cell_seconds=1)
    assert rows(got) == [("1_1", 499), ("1_2", 1), ("2_2", 499), ("2_3", 1)]


def test_rates(spark):
    views = [("a", 0, 1), ("a", 1, 2), ("a", 2, 3), ("b", 0, 1), ("b", 1, 2), ("c", 0, 1)]
    got = [tuple(r) for r in N.page_conversion(table(spark, views), [1, 2, 3, 4, 5]).orderBy("step").collect()]
    assert got == [
        (1, "1_2", 2, 3, 0.67), (2, "2_3", 1, 2, 0.5), (3, "3_4", 0, 1, 0.0), (4, "4_5", 0, 0, None),
    ]


def test_no_start_views(spark):
    got = N.page_conversion(table(spark, [("a", 0, 9)]), [1, 2]).collect()
    assert [tuple(r) for r in got] == [(1, "1_2", 0, 0, None)]


def test_repeated_split_has_a_row_per_step(spark):
    views = [("a", i, 1 + i % 2) for i in range(5)]  # 1 2 1 2 1
    got = N.page_conversion(table(spark, views), [1, 2, 1, 2]).orderBy("step").collect()
    assert [(r["page_split"], r["pv"]) for r in got] == [("1_2", 2), ("2_1", 2), ("1_2", 2)]


def test_flow_of_one_page_has_no_steps(spark):
    assert N.page_conversion(table(spark, [("a", 0, 1)]), [1]).collect() == []


def test_packed(spark):
    views = [("a", 0, 1), ("a", 1, 2), ("b", 0, 1), ("c", 0, 1), ("a", 2, 3)]
    got = N.packed_conversion(N.page_conversion(table(spark, views), [1, 2, 3]))
    assert got.first()[0] == "1_2=0.33|2_3=1.0"


def test_sequence_orders_equal_times(spark):
    df = table(spark, [("a", 0, 2), ("a", 0, 1)]).selectExpr("*", "if(page_id = 2, 1, 2) AS nr")
    assert rows(N.page_pair_counts(df, [2, 1], ["nr"])) == [("2_1", 1)]
    assert rows(N.page_pair_counts(df, [2, 1])) == []
    assert rows(N.page_pair_counts(df, [2, 1], ["nr"])) == [("2_1", 1)]


def test_a_huge_session_is_spread_over_cells(spark):
    views = [("bot", t, 1 + t % 3) for t in range(2000)]
    df = table(spark, views).select("session_id", "action_time", "page_id")
    cut = N.in_cells(df, ["action_time", "page_id"], 100)
    sizes = [r["count"] for r in cut.groupBy("cell").count().collect()]
    assert len(sizes) == 20 and max(sizes) == 100
    assert rows(N.page_pair_counts(df, [1, 2, 3, 1], cell_seconds=100)) == [("1_2", 667), ("2_3", 666), ("3_1", 666)]


def test_pages_and_times_that_are_null(spark):
    some = table(spark, [("a", 0, 1), ("a", 1, 2), ("a", 2, None), ("a", 3, 2), ("a", 4, 1)])
    timeless = some.where("page_id = 2").selectExpr(*[c if c != "action_time" else "cast(null as timestamp) action_time" for c in some.columns])
    got = N.page_pair_counts(some.unionByName(timeless), [1, 2, 2, 1], cell_seconds=2)
    assert rows(got) == [("1_2", 1), ("2_1", 2), ("2_2", 1)]


def test_rows_without_session_are_in_no_session(spark):
    views = [("a", 0, 1), ("a", 1, 2), (None, 0, 1), (None, 1, 2), (None, 2, 1)]
    assert rows(N.page_pair_counts(table(spark, views), [1, 2, 1])) == [("1_2", 1)]
