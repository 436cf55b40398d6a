"""The four applications from stored inputs to stored results."""

import pytest
from fixtures import action, actions, rows, users

from footfall import schemas
from footfall.params import load_params
from footfall.plans import session_job
from footfall.plans.page_job import run_page_job
from footfall.plans.product_job import run_product_job
from footfall.plans.session_job import SESSION_RESULTS, run_session_job
from footfall.settings import materialize
from footfall.sinks.results import read_result

PARAM = '{"startDate":["2024-03-01"],"endDate":["2024-03-01"],"sex":["male"],"targetPageFlow":["1,2"]}'


def inputs(spark):
    acts = actions(
        spark,
        [
            action("a", 0, page=1, click_category_id=1, click_product_id=10),
            action("a", 2, page=2, click_category_id=1, click_product_id=10),
            action("a", 3, page=2, order_category_ids="1,2"),
            action("b", 0, user=2, page=1, click_category_id=2, click_product_id=11),
            action("c", 0, user=3, page=1, search_keyword="food", pay_category_ids="2"),
            action("a", 0, page=1, day=1, click_category_id=9, click_product_id=10),
        ],
    )
    people = users(spark, [(1, 30, "x", "y", "male"), (2, 30, "x", "y", "female"), (3, 30, "x", "y", "male")])
    tasks = spark.createDataFrame([(5, "t", "", "", "", "", "", PARAM)], schemas.TASK)
    return acts, people, load_params(tasks, 5)


def test_session_job(spark, tmp_path):
    acts, people, params = inputs(spark)
    root = str(tmp_path)
    for _ in range(2):  # running the task again replaces its rows
        assert list(run_session_job(acts, people, params, root)) == SESSION_RESULTS
    get = {name: read_result(spark, root, name) for name in SESSION_RESULTS}
    stat = get["session_aggr_stat"].collect()
    assert len(stat) == 1 and (stat[0]["task_id"], stat[0]["session_count"]) == (5, 2)
    assert (stat[0]["visit_length_1s_3s_ratio"], stat[0]["step_length_1_3_ratio"]) == (0.5, 1.0)
    extract = get["session_random_extract"]
    assert rows(extract.select("session_id", "search_keywords", "click_category_ids")) == [
        ("a", "", "1"), ("c", "food", ""),
    ]
    assert get["session_detail"].count() == 4
    assert rows(get["top10_category"]) == [(5, 1, 2, 1, 0), (5, 2, 0, 1, 1)]
    assert rows(get["top10_session"]) == [(5, 1, "a", 2)]
    assert get["top10_session_detail"].count() == 3


def test_page_job(spark, tmp_path):
    acts, _, params = inputs(spark)
    run_page_job(acts, params, str(tmp_path))
    assert rows(read_result(spark, str(tmp_path), "page_split_convert_rate")) == [(5, "1_2=0.33")]


def test_product_job(spark, tmp_path):
    acts, _, params = inputs(spark)
    cities = spark.createDataFrame([(1, "Rome", "West North")], schemas.CITY_INFO)
    infos = spark.createDataFrame(
        [(10, "ten", '{"product_status": 0}'), (11, "eleven", '{"product_status": 1}')], schemas.PRODUCT_INFO
    )
    run_product_job(acts, cities, infos, params, str(tmp_path))
    got = read_result(spark, str(tmp_path), "area_top3_product").orderBy("product_id").collect()
    assert [tuple(r) for r in got] == [
        (5, "West North", "C level", 10, "1:Rome", 2, "ten", "self"),
        (5, "West North", "C level", 11, "1:Rome", 1, "eleven", "Third Party"),
    ]


def test_results_of_the_session_job_start_from_stored_tables(spark, tmp_path):
    acts, people, params = inputs(spark)
    acts.write.parquet(str(tmp_path / "actions"))
    reads = []

    def counted(df, name):
        reads.append(df._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/actions"))
        return materialize(df, name)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(session_job, "materialize", counted)
        results = session_job.session_results(spark.read.parquet(str(tmp_path / "actions")), people, params)
    assert sum(reads) == 3
    for df in results.values():
        assert f"{tmp_path}/actions" not in df._jdf.queryExecution().executedPlan().toString()
