"""Every registered query: name -> function of session and table folder.

Times, dates and lists leave as text, in the forms the result tables use.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, TimestampType

from footfall import schemas
from footfall.catalog import views as V
from footfall.functions import columns as C
from footfall.functions import sql_names
from footfall.operators import ads, categories, funnel, products, sampling, sessions, skew
from footfall.params import JobParams, load_params
from footfall.plans.page_job import page_results, run_page_job
from footfall.plans.product_job import product_results, run_product_job
from footfall.plans.session_job import SESSION_RESULTS, run_session_job
from footfall.settings import materialize, scratch_path
from footfall.sinks.keyed_table import KeyedTable
from footfall.sinks.results import append_result, read_result
from footfall.sources import ad_log, tables
from footfall.streaming import ad_stream

Query = Callable[[SparkSession, str], DataFrame]

TASK_TEXT = (
    '{"startDate":["2024-01-03"],"endDate":["2024-01-27"],'
    '"startAge":["20"],"endAge":["60"],"sex":["male"]}'
)
FILTER_TEXT = (
    '{"startAge":["20"],"endAge":["55"],"professsionals":["BUILDING,MACHINERY,HOUSEHOLD"],'
    '"keywords":["kw1,kw2,kw3,kw4"],"categoryIds":[]}'
)
FLOW_TEXT = '{"targetPageFlow":["1,2,3,4"]}'
# Stored tasks: id -> parameters.
TASKS = {2: TASK_TEXT, 3: FLOW_TEXT, 4: "{}"}
KEYWORDS = ["kw1", "kw2"]
CATEGORY_IDS = [3, 5, 8, 13, 21]
PROFESSIONALS = ["BUILDING", "MACHINERY"]
CITIES = ["NATION_1", "NATION_2", "NATION_3"]
FLOW = [1, 2, 3, 4]
SAMPLE = 3000
THRESHOLD = 2
HALF = "2024-01-15 12:00:00"
TREND_END = "2024-01-15 12:00:30"
SLICES = [(None, "2024-01-11 06:00:00"), ("2024-01-11 06:00:00", "2024-01-21 18:00:00"), ("2024-01-21 18:00:00", None)]
# Regions under names that have a level by default; the others keep theirs.
NAMED_AREAS = {"AFRICA": "China North", "AMERICA": "China South", "ASIA": "West South"}
AREA_LEVELS = {"ASIA": "A level", "EUROPE": "A level", "AMERICA": "B level", "AFRICA": "C level"}

_QUERIES: dict[str, Query] = {}


def _as_text(df: DataFrame) -> DataFrame:
    def shown(field):
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            return C.format_time(column).alias(field.name)
        if isinstance(field.dataType, DateType):
            return C.format_date(column).alias(field.name)
        if isinstance(field.dataType, ArrayType):
            return F.array_join(column.cast("array<string>"), ",").alias(field.name)
        return column

    return df.select(*[shown(field) for field in df.schema.fields])


def query(name: str):
    def register(build: Query) -> Query:
        _QUERIES[name] = lambda spark, sf_dir: _as_text(build(spark, sf_dir))
        return build

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _params() -> JobParams:
    return JobParams.from_json(TASK_TEXT, task_id=2)


def _task_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = _params()
    actions = V.user_visit_action(spark, sf_dir, params.start_date, params.end_date)
    return tables.scan_actions(actions, params)


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.selected_sessions(
        _task_actions(spark, sf_dir), V.user_info(spark, sf_dir), _params()
    )


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_detail(_task_actions(spark, sf_dir), _selected(spark, sf_dir))


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.activity_of(
        categories.category_activity(_task_actions(spark, sf_dir)), _selected(spark, sf_dir)
    )


def _profile(spark: SparkSession, sf_dir: str, **marks) -> DataFrame:
    features = sessions.session_features(V.user_visit_action(spark, sf_dir), **marks)
    return sessions.session_profile(features, V.user_info(spark, sf_dir))


# Scans


@query("action_range_scan")
def action_range_scan(spark, sf_dir):
    return _task_actions(spark, sf_dir)


@query("click_city_scan")
def click_city_scan(spark, sf_dir):
    clicks = tables.click_scan(_task_actions(spark, sf_dir))
    return tables.click_city(clicks, V.city_info(spark, sf_dir))


# Sessions


@query("session_rollup")
def session_rollup(spark, sf_dir):
    return sessions.session_rollup(V.user_visit_action(spark, sf_dir))


@query("session_terms")
def session_terms(spark, sf_dir):
    return sessions.session_terms(V.user_visit_action(spark, sf_dir))


@query("session_profile")
def session_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@query("filter_age_between")
def filter_age_between(spark, sf_dir):
    return _profile(spark, sf_dir).where(sessions.age_between(25, 40))


@query("filter_professional_in")
def filter_professional_in(spark, sf_dir):
    return _profile(spark, sf_dir).where(sessions.professional_in(PROFESSIONALS))


@query("filter_city_in")
def filter_city_in(spark, sf_dir):
    return _profile(spark, sf_dir).where(sessions.city_in(CITIES))


@query("filter_sex_eq")
def filter_sex_eq(spark, sf_dir):
    return _profile(spark, sf_dir).where(sessions.sex_is("female"))


@query("filter_keywords_any")
def filter_keywords_any(spark, sf_dir):
    params = JobParams(keywords=KEYWORDS)
    return sessions.filter_sessions(_profile(spark, sf_dir, keywords=KEYWORDS), params).drop(
        "searched_keyword"
    )


@query("filter_categories_any")
def filter_categories_any(spark, sf_dir):
    params = JobParams(category_ids=CATEGORY_IDS)
    return sessions.filter_sessions(
        _profile(spark, sf_dir, category_ids=CATEGORY_IDS), params
    ).drop("clicked_category")


@query("filter_sessions_all")
def filter_sessions_all(spark, sf_dir):
    params = JobParams.from_json(FILTER_TEXT)
    return sessions.selected_sessions(
        V.user_visit_action(spark, sf_dir), V.user_info(spark, sf_dir), params
    ).drop("searched_keyword")


@query("visit_length_histogram")
def visit_length_histogram(spark, sf_dir):
    return sessions.visit_length_histogram(_selected(spark, sf_dir))


@query("step_length_histogram")
def step_length_histogram(spark, sf_dir):
    return sessions.step_length_histogram(_selected(spark, sf_dir))


@query("session_length_stats")
def session_length_stats(spark, sf_dir):
    return sessions.session_length_stats(_selected(spark, sf_dir))


@query("session_detail")
def session_detail(spark, sf_dir):
    return tables.detail_columns(_detail(spark, sf_dir))


# Sampling


@query("sessions_per_hour")
def sessions_per_hour(spark, sf_dir):
    return sampling.sessions_per_hour(_selected(spark, sf_dir))


@query("sample_quota")
def sample_quota(spark, sf_dir):
    return sampling.sample_quota(sampling.sessions_per_hour(_selected(spark, sf_dir)), SAMPLE)


def _sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample, from stored sessions, and stored itself."""
    selected = materialize(_selected(spark, sf_dir), "sessions")
    return materialize(sampling.sample_sessions(selected, SAMPLE), "sample")


@query("sample_sessions")
def sample_sessions(spark, sf_dir):
    return sampling.sampled_session_records(_sampled(spark, sf_dir), _task_actions(spark, sf_dir))


@query("sampled_session_detail")
def sampled_session_detail(spark, sf_dir):
    return sessions.detail_of_few(_task_actions(spark, sf_dir), _sampled(spark, sf_dir))


# Categories


@query("category_ids_distinct")
def category_ids_distinct(spark, sf_dir):
    return categories.category_ids(_detail(spark, sf_dir))


@query("category_click_counts")
def category_click_counts(spark, sf_dir):
    return categories.category_click_counts(_detail(spark, sf_dir))


@query("category_order_counts")
def category_order_counts(spark, sf_dir):
    return categories.category_order_counts(_detail(spark, sf_dir))


@query("category_pay_counts")
def category_pay_counts(spark, sf_dir):
    return categories.category_pay_counts(_detail(spark, sf_dir))


@query("top_categories")
def top_categories(spark, sf_dir):
    return categories.top_categories(_activity(spark, sf_dir))


@query("session_category_clicks")
def session_category_clicks(spark, sf_dir):
    return categories.session_category_clicks(_activity(spark, sf_dir))


@query("top_sessions_per_category")
def top_sessions_per_category(spark, sf_dir):
    activity = materialize(_activity(spark, sf_dir), "activity")
    return categories.top_sessions_per_category(activity, categories.top_categories(activity))


@query("top_sessions_all_categories")
def top_sessions_all_categories(spark, sf_dir):
    return categories.top_sessions_per_category(_activity(spark, sf_dir))


@query("top_session_detail")
def top_session_detail(spark, sf_dir):
    top = materialize(top_sessions_per_category(spark, sf_dir), "top-sessions")
    return sessions.detail_of_few(_task_actions(spark, sf_dir), top)


# Funnel


@query("page_pair_counts")
def page_pair_counts(spark, sf_dir):
    return funnel.page_pair_counts(
        V.user_visit_action(spark, sf_dir), FLOW, sequence=["action_id"]
    )


@query("page_pair_counts_by_range")
def page_pair_counts_by_range(spark, sf_dir):
    """Sessions cut into cells of ten minutes."""
    return funnel.page_pair_counts(
        V.user_visit_action(spark, sf_dir), FLOW, sequence=["action_id"], cell_seconds=600
    )


@query("page_conversion")
def page_conversion(spark, sf_dir):
    params = JobParams(target_page_flow=FLOW)
    return page_results(V.user_visit_action(spark, sf_dir), params, sequence=["action_id"])


@query("page_conversion_packed")
def page_conversion_packed(spark, sf_dir):
    return funnel.packed_conversion(page_conversion(spark, sf_dir))


# Products


@query("area_product_clicks")
def area_product_clicks(spark, sf_dir):
    return products.area_product_clicks(
        V.user_visit_action(spark, sf_dir), V.city_info(spark, sf_dir)
    )


@query("area_product_named")
def area_product_named(spark, sf_dir):
    return products.area_products_named(
        area_product_clicks(spark, sf_dir), V.product_info(spark, sf_dir)
    )


@query("area_top_products")
def area_top_products(spark, sf_dir):
    return product_results(
        V.user_visit_action(spark, sf_dir),
        V.city_info(spark, sf_dir),
        V.product_info(spark, sf_dir),
        JobParams(),
    )


@query("area_top_products_levels")
def area_top_products_levels(spark, sf_dir):
    return products.area_top_products(
        V.user_visit_action(spark, sf_dir),
        V.city_info(spark, sf_dir),
        V.product_info(spark, sf_dir),
        n=5,
        levels=AREA_LEVELS,
    )


@query("sql_functions")
def sql_functions(spark, sf_dir):
    """The same labels through SQL: named, salted and unsalted again."""
    sql_names.register(spark)
    clicks = tables.click_city(
        tables.click_scan(V.user_visit_action(spark, sf_dir)), V.city_info(spark, sf_dir)
    )
    clicks.createOrReplaceTempView("click_city")
    return spark.sql(
        """
        SELECT remove_random_prefix(salted) AS city_label, sum(clicks) AS click_count
        FROM (
            SELECT salted, count(*) AS clicks
            FROM (
                SELECT random_prefix(concat_long_string(city_id, city_name, ':'), 10) AS salted
                FROM click_city
            )
            GROUP BY salted
        )
        GROUP BY remove_random_prefix(salted)
        """
    )


# Ads, batch


@query("ad_log_parse")
def ad_log_parse(spark, sf_dir):
    clicks = ad_log.parse_ad_log(V.to_log_lines(V.ad_clicks(spark, sf_dir)))
    return clicks.select(
        F.unix_millis("ts").alias("millis"),
        C.date_key(F.col("ts")).alias("date_key"),
        C.format_date(C.parse_date_key(C.date_key(F.col("ts")))).alias("date"),
        C.date_hour(F.col("ts")).alias("date_hour"),
        C.minute_key(F.col("ts")).alias("minute_key"),
        C.format_time(C.parse_time(C.format_time(F.col("ts")))).alias("time"),
        "province",
        "city",
        "user_id",
        "ad_id",
    )


def _blacklist(spark, sf_dir):
    daily = ads.user_daily_clicks(V.ad_clicks(spark, sf_dir))
    return ads.blacklisted_users(daily, THRESHOLD)


@query("ad_filter_blacklisted")
def ad_filter_blacklisted(spark, sf_dir):
    return ads.without_blacklisted(V.ad_clicks(spark, sf_dir), _blacklist(spark, sf_dir))


@query("ad_user_daily_clicks")
def ad_user_daily_clicks(spark, sf_dir):
    return ads.user_daily_clicks(V.ad_clicks(spark, sf_dir))


@query("ad_blacklist")
def ad_blacklist(spark, sf_dir):
    return _blacklist(spark, sf_dir)


@query("ad_stat")
def ad_stat(spark, sf_dir):
    return ads.ad_stat(V.ad_clicks(spark, sf_dir))


@query("ad_province_clicks")
def ad_province_clicks(spark, sf_dir):
    return ads.province_clicks(ads.ad_stat(V.ad_clicks(spark, sf_dir)))


@query("ad_province_top")
def ad_province_top(spark, sf_dir):
    return ads.province_top_ads(ads.ad_stat(V.ad_clicks(spark, sf_dir)))


@query("ad_province_top_all_days")
def ad_province_top_all_days(spark, sf_dir):
    return ads.province_top_ads(ads.ad_stat(V.ad_clicks(spark, sf_dir)), per_day=False)


@query("ad_click_trend")
def ad_click_trend(spark, sf_dir):
    return ads.click_trend(V.ad_clicks(spark, sf_dir))


@query("ad_click_trend_trailing")
def ad_click_trend_trailing(spark, sf_dir):
    return ads.click_trend(V.ad_clicks(spark, sf_dir), as_of=TREND_END, minutes=24 * 60)


@query("ad_click_sliding")
def ad_click_sliding(spark, sf_dir):
    return ads.sliding_clicks(V.ad_clicks(spark, sf_dir), 60, 10)


@query("ad_click_sliding_seconds")
def ad_click_sliding_seconds(spark, sf_dir):
    """An hour every ten seconds, as the ad application sets it."""
    return ads.sliding_clicks_seconds(V.ad_clicks(spark, sf_dir), 3600, 10)


# Skew helpers


@query("hot_keys")
def hot_keys(spark, sf_dir):
    return skew.hot_keys(V.user_visit_action(spark, sf_dir), "user_id", n=10)


@query("salted_count")
def salted_count(spark, sf_dir):
    actions = V.user_visit_action(spark, sf_dir)
    return skew.salted_count(actions, ["city_id", "page_id"], name="action_count")


def _who(spark, sf_dir):
    return V.user_info(spark, sf_dir).select("user_id", "professional", "city")


@query("salted_join")
def salted_join(spark, sf_dir):
    actions = V.user_visit_action(spark, sf_dir).select("action_id", "user_id", "page_id")
    return skew.salted_join(actions, _who(spark, sf_dir), "user_id", n=10)


@query("salted_join_hot")
def salted_join_hot(spark, sf_dir):
    actions = V.user_visit_action(spark, sf_dir).select("action_id", "user_id", "page_id")
    hot = skew.hot_keys(actions, "user_id", n=20)
    return skew.salted_join(actions, _who(spark, sf_dir), "user_id", "left", 10, hot)


@query("skew_split_join")
def skew_split_join(spark, sf_dir):
    actions = V.user_visit_action(spark, sf_dir).select("action_id", "user_id", "page_id")
    return skew.skew_split_join(actions, _who(spark, sf_dir), "user_id", n=10)


# Sinks


@query("sink_append")
def sink_append(spark, sf_dir):
    """Two tasks' results, the second stored twice."""
    root = scratch_path(spark, "append")
    clicks = area_product_clicks(spark, sf_dir)
    named = area_product_named(spark, sf_dir)
    append_result(clicks, root, "area_product", 1)
    for _ in range(2):
        append_result(named.select(*clicks.columns), root, "area_product", 2)
    return read_result(spark, root, "area_product", clicks.schema)


def _stored_params(spark, root: str, task_id: int) -> JobParams:
    """A task's parameters from the stored task table."""
    path = f"{root}/task"
    stored = [(key, "task", "", "", "", "", "", text) for key, text in TASKS.items()]
    spark.createDataFrame(stored, schemas.TASK).write.mode("overwrite").parquet(path)
    return load_params(tables.read_table(spark, path, schema=schemas.TASK), task_id)


def _run_session_job(spark, sf_dir) -> dict[str, DataFrame]:
    """All tables the session job stores for the task."""
    root = scratch_path(spark, "session-job")
    params = _stored_params(spark, root, 2)
    actions = V.user_visit_action(spark, sf_dir, params.start_date, params.end_date)
    run_session_job(actions, V.user_info(spark, sf_dir), params, root, SAMPLE)
    return {
        name: read_result(spark, root, name, task_id=params.task_id) for name in SESSION_RESULTS
    }


@query("session_job")
def session_job(spark, sf_dir):
    """Row counts of all tables the session job stores."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in _run_session_job(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _stored_by_session_job(name: str) -> Query:
    return lambda spark, sf_dir: _run_session_job(spark, sf_dir)[name]


for _name in SESSION_RESULTS:
    query(f"session_job_{_name}")(_stored_by_session_job(_name))


@query("page_job")
def page_job(spark, sf_dir):
    root = scratch_path(spark, "page-job")
    params = _stored_params(spark, root, 3)
    run_page_job(V.user_visit_action(spark, sf_dir), params, root, ["action_id"])
    return read_result(spark, root, "page_split_convert_rate")


@query("product_job")
def product_job(spark, sf_dir):
    """Top products of areas whose levels are the default ones."""
    root = scratch_path(spark, "product-job")
    params = _stored_params(spark, root, 4)
    cities = V.city_info(spark, sf_dir).replace(NAMED_AREAS, subset=["area"])
    run_product_job(V.user_visit_action(spark, sf_dir), cities, V.product_info(spark, sf_dir), params, root)
    return read_result(spark, root, "area_top3_product")


def _halves(spark, sf_dir):
    clicks = V.ad_clicks(spark, sf_dir)
    middle = F.lit(HALF).cast("timestamp")
    return clicks, clicks.where(F.col("ts") < middle), clicks.where(F.col("ts") >= middle)


@query("sink_append_new_keys")
def sink_append_new_keys(spark, sf_dir):
    whole, first, _ = _halves(spark, sf_dir)
    table = KeyedTable(scratch_path(spark, "new-keys"), schemas.AD_BLACKLIST, "new_keys", ["user_id"])
    for batch_id, clicks in enumerate([first, whole]):
        table.upsert(batch_id, ads.blacklisted_users(ads.user_daily_clicks(clicks), THRESHOLD))
    return table.read(spark)


@query("sink_upsert_increment")
def sink_upsert_increment(spark, sf_dir):
    """Both halves of the log, the second one twice."""
    _, first, second = _halves(spark, sf_dir)
    keys = ["date", "user_id", "ad_id"]
    table = KeyedTable(
        scratch_path(spark, "increment"), schemas.AD_USER_CLICK_COUNT, "increment", keys, split_by="date"
    )
    for batch_id, clicks in [(0, first), (1, second), (1, second)]:
        table.upsert(batch_id, ads.user_daily_clicks(clicks))
    return table.read(spark)


@query("sink_upsert_replace")
def sink_upsert_replace(spark, sf_dir):
    whole, first, second = _halves(spark, sf_dir)
    keys = ["date", "province", "city", "ad_id"]
    table = KeyedTable(scratch_path(spark, "replace"), schemas.AD_STAT, "replace", keys, split_by="date")
    table.upsert(0, ads.ad_stat(first))
    changed = ads.ad_stat(second).select(*keys)
    table.upsert(1, ads.ad_stat(whole).join(changed, keys, "left_semi"))
    return table.read(spark)


@query("sink_replace_group")
def sink_replace_group(spark, sf_dir):
    whole, first, second = _halves(spark, sf_dir)
    group = ["date", "province"]
    table = KeyedTable(scratch_path(spark, "group"), schemas.AD_PROVINCE_TOP3, "replace_group", group, "date")
    table.upsert(0, ads.province_top_ads(ads.ad_stat(first)))
    changed = second.select(*group).distinct()
    table.upsert(1, ads.province_top_ads(ads.ad_stat(whole)).join(changed, group, "left_semi"))
    return table.read(spark)


# Streams: the click log lands slice by slice, and after each landing the query
# is started anew from its checkpoint to take in what has come.

ONCE = {"availableNow": True}


def _between(low: str | None, high: str | None):
    """Whether a click lies in the slice."""
    at = F.col("ts")
    after = F.lit(True) if low is None else at >= F.lit(low).cast("timestamp")
    return after if high is None else after & (at < F.lit(high).cast("timestamp"))


def _replay(spark, sf_dir, run, slices=None, tables=ad_stream.AdTables) -> ad_stream.AdTables:
    """The tables after ``run`` has taken in one slice of the log after the other."""
    root = scratch_path(spark, "ad-stream")
    landing = f"{root}/log"
    clicks = V.ad_clicks(spark, sf_dir)
    out = tables(f"{root}/tables")
    for piece in slices or [_between(*bounds) for bounds in SLICES]:
        V.to_log_lines(clicks.where(piece)).write.mode("append").text(landing)
        running = run(ad_log.file_lines(spark, landing), out, f"{root}/checkpoint")
        if running is not None:
            running.awaitTermination()
    return out


def _replay_statistics(spark, sf_dir, threshold):
    return _replay(
        spark,
        sf_dir,
        lambda lines, out, checkpoint: ad_stream.start_statistics(
            lines, out, checkpoint, threshold, forget_hours=None, trigger=ONCE
        ),
    )


@query("stream_ad_stat")
def stream_ad_stat(spark, sf_dir):
    return _replay_statistics(spark, sf_dir, None).stat.read(spark)


@query("stream_ad_user_clicks")
def stream_ad_user_clicks(spark, sf_dir):
    return _replay_statistics(spark, sf_dir, None).user_clicks.read(spark)


@query("stream_ad_province_top")
def stream_ad_province_top(spark, sf_dir):
    return _replay_statistics(spark, sf_dir, None).province_top.read(spark)


@query("stream_ad_blacklist")
def stream_ad_blacklist(spark, sf_dir):
    return _replay_statistics(spark, sf_dir, THRESHOLD).blacklist.read(spark)


@query("stream_ad_filtered")
def stream_ad_filtered(spark, sf_dir):
    return _replay_statistics(spark, sf_dir, THRESHOLD).user_clicks.read(spark)


@query("stream_ad_stat_filtered")
def stream_ad_stat_filtered(spark, sf_dir):
    return _replay_statistics(spark, sf_dir, THRESHOLD).stat.read(spark)


@query("stream_ad_province_top_filtered")
def stream_ad_province_top_filtered(spark, sf_dir):
    return _replay_statistics(spark, sf_dir, THRESHOLD).province_top.read(spark)


@query("stream_ad_trend")
def stream_ad_trend(spark, sf_dir):
    return _replay(
        spark,
        sf_dir,
        lambda lines, out, checkpoint: ad_stream.start_trend(lines, out, checkpoint, trigger=ONCE),
    ).trend.read(spark)


@query("stream_ad_late")
def stream_ad_late(spark, sf_dir):
    """The trend's landings: their clicks, those it counted and those that came too late.

    The days around the middle of the month land first, so the earlier days are late.
    """
    middle = _between(SLICES[1][0], TREND_END)

    def run(lines, out, checkpoint):
        trend = ad_stream.start_trend(lines, out, checkpoint, trigger=ONCE)
        trend.awaitTermination()
        ad_stream.record_seen(spark, trend, out)

    out = _replay(spark, sf_dir, run, [middle, ~middle])
    return ad_stream.late_clicks(spark, out).where("clicks > 0").select("clicks", "counted", "late")


class _BrokenOff(ad_stream.AdTables):
    """Tables of an application whose queries both fail once, in the middle of a batch."""

    failures: ClassVar[dict[str, set[str]]] = {}

    def _failing(self, name: str, table: KeyedTable) -> KeyedTable:
        failed = self.failures.setdefault(self.root, set())
        if name not in failed:
            failed.add(name)
            raise RuntimeError(f"{name} is out of reach")
        return table

    @property
    def province_clicks(self) -> KeyedTable:
        return self._failing("province_clicks", super().province_clicks)

    @property
    def trend(self) -> KeyedTable:
        return self._failing("trend", super().trend)


@query("stream_ad_application")
def stream_ad_application(spark, sf_dir):
    """Statistics and trend of the whole application, whose queries were started again after a failure."""

    def run(lines, out, checkpoint):
        ad_stream.serve_ad_stream(lines, out, checkpoint, trigger=ONCE, threshold=THRESHOLD, forget_hours=None)

    out = _replay(spark, sf_dir, run, tables=_BrokenOff)
    columns = ["table_name", "date", "province", "city", "hour", "minute", "ad_id", "click_count"]
    stat = out.stat.read(spark).withColumn("table_name", F.lit("ad_stat"))
    trend = out.trend.read(spark).withColumn("table_name", F.lit("ad_click_trend"))
    return stat.unionByName(trend, allowMissingColumns=True).select(*columns)


@query("stream_ad_running_stat")
def stream_ad_running_stat(spark, sf_dir):
    def start(lines, out, checkpoint):
        counts = ad_stream.running_stat(ad_log.parse_ad_log(lines))
        return ad_stream.start_update(counts, out.running_stat.upsert, checkpoint, trigger=ONCE)

    return _replay(spark, sf_dir, start).running_stat.read(spark)


_SLIDING = schemas.StructType(
    [
        schemas.StructField("window_start", TimestampType(), True),
        schemas.StructField("ad_id", schemas.LongType(), True),
        schemas.StructField("click_count", schemas.LongType(), True),
    ]
)


def _sliding_counts(counted, write, mode: str):
    def start(lines, out, checkpoint):
        return ad_stream.start_update(counted(ad_log.parse_ad_log(lines)), write, checkpoint, mode, trigger=ONCE)

    return start


@query("stream_ad_sliding")
def stream_ad_sliding(spark, sf_dir):
    table = KeyedTable(scratch_path(spark, "sliding"), _SLIDING, "replace", ["window_start", "ad_id"])
    _replay(spark, sf_dir, _sliding_counts(ad_stream.hopping_counts, table.upsert, "update"))
    return table.read(spark)


@query("stream_ad_sliding_seconds")
def stream_ad_sliding_seconds(spark, sf_dir):
    """An hour every ten seconds: the closed windows of each ad and day, and their clicks."""
    path = scratch_path(spark, "sliding")

    def write(batch_id: int, batch: DataFrame) -> None:
        # Every window comes once, so a batch is a folder of its own.
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    _replay(spark, sf_dir, _sliding_counts(ad_stream.sliding_counts, write, "append"))
    windows = spark.read.schema(_SLIDING).parquet(path)
    return windows.groupBy(F.to_date("window_start").alias("date"), "ad_id").agg(
        F.count(F.lit(1)).alias("window_count"),
        F.sum("click_count").alias("click_count"),
        F.max("click_count").alias("most_clicks"),
    )
