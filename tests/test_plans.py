"""What the physical plans look like."""

import re

import pytest
from fixtures import action, actions

from footfall.catalog import queries as Q
from footfall.operators import sampling, sessions
from footfall.params import JobParams
from footfall.sources import tables as T

SF = "/root/testdata/sf0.001"
LAZY = [n for n in Q.all_queries() if not n.startswith(("stream_", "sink_", "session_job"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(Q.all_queries()[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "InArrow", "ObjectConsumer"):
        assert word not in text


def test_date_range_reaches_the_scan(spark):
    text = plan(Q.all_queries()["action_range_scan"](spark, SF))
    pushed = max(re.findall(r"PushedFilters: \[(.*?)\]", text), key=len)
    assert "GreaterThanOrEqual(ts,2024-01-03" in pushed and "LessThan(ts,2024-01-28" in pushed


def test_date_range_prunes_partitions(spark, tmp_path):
    stored = actions(spark, [action(f"s{d}", day=d) for d in range(5)])
    stored.write.partitionBy("date").parquet(str(tmp_path / "t"))
    table = T.read_table(spark, str(tmp_path / "t"))
    got = T.scan_actions(table, JobParams(start_date="2024-03-02", end_date="2024-03-03"))
    assert got.count() == 2
    assert re.search(r"PartitionFilters: \[.*date.*2024-03-02.*2024-03-03", plan(got))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("session_length_stats", {"ts", "user_id"}),
        ("click_city_scan", {"ts", "user_id", "event_id", "event_type"}),
        ("ad_stat", {"ts", "user_id", "event_type", "props"}),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    text = plan(Q.all_queries()[name](spark, SF))
    read = next(r for r in re.findall(r"ReadSchema: struct<(.*?)>", text) if "ts:" in r)
    assert {c.split(":")[0] for c in read.split(",")} == columns


@pytest.mark.parametrize(
    "name", ["area_top_products", "ad_province_top", "top_sessions_per_category", "top_sessions_all_categories"]
)
def test_ranks_are_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(Q.all_queries()[name](spark, SF)))


def test_sample_reads_the_sessions_twice(spark, tmp_path):
    Q._selected(spark, SF).write.parquet(str(tmp_path / "s"))
    text = plan(sampling.sample_sessions(spark.read.parquet(str(tmp_path / "s"))))
    scans = re.findall(r"FileScan parquet \[(.*?)\]", text)
    # Counting needs two columns; Spark reuses the counts where the plan shows them again.
    whole = [s for s in scans if "user_id" in s]
    assert len(whole) == 1 and all(s.count("#") == 2 for s in scans if s not in whole)


@pytest.mark.parametrize("name", ["sample_sessions", "sampled_session_detail", "top_session_detail"])
def test_the_fact_is_read_once_more_for_the_few(spark, name):
    """After the sessions or the activity were stored, one scan of the events gives the result."""
    assert len(re.findall(r"FileScan parquet .*?/events\.parquet", plan(Q.all_queries()[name](spark, SF)))) == 1


def test_top_list_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(Q.all_queries()["top_categories"](spark, SF))


def test_filters_on_users_reach_the_user_table(spark, tmp_path):
    from fixtures import users

    users(spark, [(1, 30, "cook", "Oslo", "male")]).write.parquet(str(tmp_path / "u"))
    params = JobParams(start_age=20, end_age=40, sex="male")
    picked = sessions.selected_sessions(
        actions(spark, [action("a")]), spark.read.parquet(str(tmp_path / "u")), params
    )
    text = plan(picked)
    assert "GreaterThanOrEqual(age,20)" in text and "EqualTo(sex,male)" in text


def test_rollup_has_one_shuffle(spark):
    features = sessions.session_features(Q._task_actions(spark, SF))
    assert plan(features).count("Exchange hashpartitioning") == 1


def test_plain_detail_when_no_session_is_hot(spark):
    assert "_salt" not in plan(Q._detail(spark, SF))


def test_full_rollup_joins_without_another_shuffle(spark):
    # One shuffle for the features, one to drop repeats, one for the lists.
    text = plan(sessions.session_rollup(Q._task_actions(spark, SF)))
    assert text.count("Exchange hashpartitioning") == 3


def test_funnel_moves_views_twice_and_cells_once(spark):
    text = plan(Q.all_queries()["page_pair_counts"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 3 and "rangepartitioning" not in text
