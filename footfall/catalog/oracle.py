"""The registered queries once more, as SQL over the raw test tables.

Written independently of the DataFrame code: plain text built from the raw
tables, with joins, lists and ranks spelled out.
"""

from __future__ import annotations

# Label, first and last length of every bucket. Fixed values.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
    ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None),
]
STEP_BUCKETS = [
    ("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None),
]
VISIT_RATIOS = [f"visit_length_{label}_ratio" for label, _, _ in VISIT_BUCKETS]
STEP_RATIOS = [f"step_length_{label}_ratio" for label, _, _ in STEP_BUCKETS]

_TIME = "'%Y-%m-%d %H:%M:%S'"
_DAY = "'%Y-%m-%d'"

_BASE = f"""
WITH ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_id % (SELECT count(*) FROM part) AS product
  FROM events
),
uva AS (
  SELECT CAST(ts AS DATE) AS date, user_id,
         user_id || '_' || strftime(ts, {_DAY}) AS session_id,
         k % 10 AS page_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP)
           + to_hours(CAST(user_id % 24 AS INTEGER))
           + to_seconds((date_part('hour', ts) * 3600 + date_part('minute', ts) * 60
                         + CAST(floor(date_part('second', ts)) AS BIGINT)) // 40) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN product END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN k || ',' || ((k + 7) % 100) END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(product AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN k || ',' || ((k + 7) % 100) END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(product AS VARCHAR) END AS pay_product_ids,
         user_id % 25 AS city_id,
         event_id AS action_id
  FROM ev
),
ui AS (
  SELECT c_custkey AS user_id, CAST(18 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
ci AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
pin AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{{"product_status": ' || (p_size % 2) || '}}' AS extend_info
  FROM part
),
task_act AS (
  SELECT * FROM uva WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'
)
"""


def _sessions(source: str) -> str:
    return f"""
  SELECT session_id, min(user_id) AS user_id,
         min(action_time) AS start_time,
         CAST(date_diff('second', min(action_time), max(action_time)) AS BIGINT) AS visit_length,
         count(*) AS step_length,
         list(DISTINCT search_keyword) FILTER (WHERE search_keyword <> '') AS kws,
         list(DISTINCT click_category_id) FILTER (WHERE click_category_id IS NOT NULL) AS cats
  FROM {source} GROUP BY session_id"""


_PROFILES = f""",
all_sess AS ({_sessions('uva')}),
profile AS (SELECT s.*, u.age, u.professional, u.city, u.sex FROM all_sess s JOIN ui u USING (user_id))
"""

_SELECTED = f""",
sel AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex
  FROM ({_sessions('task_act')}) s JOIN ui u USING (user_id)
  WHERE u.age BETWEEN 20 AND 60 AND u.sex = 'male'
)
"""

_DETAIL = f"""{_SELECTED},
detail AS (SELECT * FROM task_act WHERE session_id IN (SELECT session_id FROM sel)),
click_c AS (
  SELECT click_category_id AS category_id, count(*) AS click_count
  FROM detail WHERE click_category_id IS NOT NULL GROUP BY 1
),
order_c AS (
  SELECT CAST(x AS BIGINT) AS category_id, count(*) AS order_count
  FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x FROM detail) GROUP BY 1
),
pay_c AS (
  SELECT CAST(x AS BIGINT) AS category_id, count(*) AS pay_count
  FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x FROM detail) GROUP BY 1
),
cat_ids AS (
  SELECT category_id FROM click_c UNION SELECT category_id FROM order_c
  UNION SELECT category_id FROM pay_c
),
top_cat AS (
  SELECT i.category_id, coalesce(click_count, 0) AS click_count,
         coalesce(order_count, 0) AS order_count, coalesce(pay_count, 0) AS pay_count
  FROM cat_ids i LEFT JOIN click_c USING (category_id)
  LEFT JOIN order_c USING (category_id) LEFT JOIN pay_c USING (category_id)
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
),
sess_cat AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM detail WHERE click_category_id IS NOT NULL GROUP BY 1, 2
),
ranked_sess AS (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
  FROM sess_cat
),
top_sess AS (
  SELECT category_id, session_id, click_count FROM ranked_sess
  WHERE rn <= 3 AND category_id IN (SELECT category_id FROM top_cat)
)
"""

_SAMPLE = """,
sel_h AS (
  SELECT *, CAST(start_time AS DATE) AS date, strftime(start_time, '%H') AS hour FROM sel
),
per_hour AS (SELECT date, hour, count(*) AS hour_count FROM sel_h GROUP BY 1, 2),
per_day AS (SELECT date, CAST(sum(hour_count) AS BIGINT) AS day_count FROM per_hour GROUP BY 1),
quotas AS (
  SELECT date, hour, hour_count, day_count,
         least(hour_count * ({n} // (SELECT count(*) FROM per_day)) // day_count, hour_count) AS quota
  FROM per_hour JOIN per_day USING (date)
),
sampled AS (
  SELECT session_id, start_time, kws, cats FROM (
    SELECT *, row_number() OVER (PARTITION BY date, hour
                                 ORDER BY md5('0' || session_id), session_id) AS rn
    FROM sel_h
  ) JOIN quotas USING (date, hour) WHERE rn <= quota
)
"""

_PAIRS = """,
steps AS (
  SELECT page_id, lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id, page_id) AS prev
  FROM uva
),
pairs AS (
  SELECT prev || '_' || page_id AS page_split, count(*) AS pv FROM steps
  WHERE prev IS NOT NULL GROUP BY 1
),
flow AS (
  SELECT * FROM (VALUES (CAST(1 AS BIGINT), '1_2'), (2, '2_3'), (3, '3_4')) AS t(step, page_split)
),
conv AS (
  SELECT step, page_split, pv,
         CASE WHEN step = 1 THEN (SELECT count(*) FROM uva WHERE page_id = 1)
              ELSE lag(pv) OVER (ORDER BY step) END AS previous_pv
  FROM (SELECT step, f.page_split, coalesce(pv, 0) AS pv FROM flow f LEFT JOIN pairs USING (page_split))
),
rates AS (
  SELECT step, page_split, pv, previous_pv,
         ((200 * pv + previous_pv) // (2 * nullif(previous_pv, 0))) / 100.0::DOUBLE AS convert_rate
  FROM conv
)
"""

_AREA = """,
area_clicks AS (
  SELECT area, click_product_id AS product_id, count(*) AS click_count,
         string_agg(DISTINCT c.city_id || ':' || city_name, ',' ORDER BY c.city_id || ':' || city_name) AS city_infos
  FROM uva JOIN ci c ON uva.city_id = c.city_id
  WHERE click_product_id IS NOT NULL GROUP BY 1, 2
),
named AS (
  SELECT area, product_id, click_count, city_infos, product_name,
         CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'self'
              ELSE 'Third Party' END AS product_status
  FROM area_clicks JOIN pin USING (product_id)
),
ranked_area AS (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rn FROM named
)
"""

_ADS = """,
clicks AS (
  SELECT ts, CAST(ts AS DATE) AS date, replace(area, ' ', '_') AS province, city_name AS city,
         user_id, k % 10 AS ad_id
  FROM ev JOIN ci ON ci.city_id = ev.user_id % 25
  WHERE event_type IN ('click', 'view')
),
daily AS (SELECT date, user_id, ad_id, count(*) AS click_count FROM clicks GROUP BY 1, 2, 3),
black AS (SELECT DISTINCT user_id FROM daily WHERE click_count >= 2),
stat AS (
  SELECT date, province, city, ad_id, count(*) AS click_count FROM clicks GROUP BY 1, 2, 3, 4
),
prov AS (
  SELECT date, province, ad_id, count(*) AS click_count FROM clicks GROUP BY 1, 2, 3
),
trend AS (
  SELECT date_trunc('minute', ts) AS slot, ad_id, count(*) AS click_count FROM clicks GROUP BY 1, 2
)
"""

# The three slices of the replayed log, each filtered by what went before.
_SLICES = """,
s1 AS (SELECT * FROM clicks WHERE ts < TIMESTAMP '2024-01-11 06:00:00'),
s2 AS (SELECT * FROM clicks WHERE ts >= TIMESTAMP '2024-01-11 06:00:00'
                              AND ts < TIMESTAMP '2024-01-21 18:00:00'),
s3 AS (SELECT * FROM clicks WHERE ts >= TIMESTAMP '2024-01-21 18:00:00'),
d1 AS (SELECT date, user_id, ad_id FROM s1),
b1 AS (SELECT DISTINCT user_id FROM (SELECT user_id FROM d1 GROUP BY date, user_id, ad_id HAVING count(*) >= 2)),
d2 AS (SELECT * FROM d1 UNION ALL
       SELECT date, user_id, ad_id FROM s2 WHERE user_id NOT IN (SELECT user_id FROM b1)),
b2 AS (SELECT DISTINCT user_id FROM (SELECT user_id FROM d2 GROUP BY date, user_id, ad_id HAVING count(*) >= 2)),
d3 AS (SELECT * FROM d2 UNION ALL
       SELECT date, user_id, ad_id FROM s3 WHERE user_id NOT IN (SELECT user_id FROM b2)),
kept AS (SELECT date, user_id, ad_id, count(*) AS click_count FROM d3 GROUP BY 1, 2, 3),
kept_clicks AS (SELECT * FROM s1
                UNION ALL SELECT * FROM s2 WHERE user_id NOT IN (SELECT user_id FROM b1)
                UNION ALL SELECT * FROM s3 WHERE user_id NOT IN (SELECT user_id FROM b2)),
kept_prov AS (SELECT date, province, ad_id, count(*) AS click_count FROM kept_clicks GROUP BY 1, 2, 3)
"""

_PROFILE_COLUMNS = (
    f"session_id, user_id, strftime(start_time, {_TIME}) AS start_time, "
    "visit_length, step_length, age, professional, city, sex"
)
_DETAIL_COLUMNS = (
    f"user_id, session_id, page_id, strftime(action_time, {_TIME}) AS action_time, "
    "search_keyword, click_category_id, click_product_id, order_category_ids, "
    "order_product_ids, pay_category_ids, pay_product_ids"
)
_SAMPLED_COLUMNS = (
    f"session_id, strftime(start_time, {_TIME}) AS start_time, "
    "coalesce(array_to_string(list_sort(kws), ','), '') AS search_keywords, "
    "coalesce(array_to_string(list_sort(cats), ','), '') AS click_category_ids"
)
_STAT_COLUMNS = f"strftime(date, {_DAY}) AS date, province, city, ad_id, click_count"
_DAILY_COLUMNS = f"strftime(date, {_DAY}) AS date, user_id, ad_id, click_count"
_TREND_COLUMNS = (
    f"strftime(slot, {_DAY}) AS date, strftime(slot, '%H') AS hour, strftime(slot, '%M') AS minute, "
    "ad_id, click_count"
)


def _condition(column: str, low: int, high: int | None) -> str:
    return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"


def _histogram(column: str, buckets) -> str:
    rows = [
        f"SELECT '{label}' AS bucket, count(*) AS session_count FROM sel "
        f"WHERE {_condition(column, low, high)}"
        for label, low, high in buckets
    ]
    return _BASE + _SELECTED + " UNION ALL ".join(rows)


def _shares() -> str:
    parts = []
    for names, column, buckets in (
        (VISIT_RATIOS, "visit_length", VISIT_BUCKETS),
        (STEP_RATIOS, "step_length", STEP_BUCKETS),
    ):
        for name, (_, low, high) in zip(names, buckets):
            n = f"count(*) FILTER (WHERE {_condition(column, low, high)})"
            parts.append(
                f"((200 * {n} + count(*)) // (2 * nullif(count(*), 0))) / 100.0::DOUBLE AS {name}"
            )
    return _BASE + _SELECTED + f"SELECT count(*) AS session_count, {', '.join(parts)} FROM sel"


def _filtered(condition: str) -> str:
    return _BASE + _PROFILES + f"SELECT {_PROFILE_COLUMNS} FROM profile WHERE {condition}"


def _province_top(partition: str) -> str:
    return _BASE + _ADS + f"""
SELECT strftime(date, {_DAY}) AS date, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY click_count DESC, ad_id, date) AS rn FROM prov
) WHERE rn <= 3"""


def _area_top(n: int, level: str, area: str = "area", more: str = "") -> str:
    return _BASE + _AREA + f"""
SELECT {more}{area} AS area, {level} AS area_level, product_id, city_infos, click_count, product_name, product_status
FROM ranked_area WHERE rn <= {n}"""


def _joined_actions(kind: str) -> str:
    return _BASE + f"""
SELECT user_id, action_id, page_id, professional, city FROM uva {kind} ui USING (user_id)"""


def _sliding(slide: str, back: str, condition: str) -> str:
    return _BASE + _ADS + f"""
SELECT strftime(window_start, {_TIME}) AS window_start, ad_id, count(*) AS click_count FROM (
  SELECT ad_id, unnest(generate_series(
           time_bucket(INTERVAL {slide}, ts) - INTERVAL {back},
           time_bucket(INTERVAL {slide}, ts), INTERVAL {slide})) AS window_start
  FROM clicks WHERE {condition}
) GROUP BY window_start, ad_id"""


def _session_job() -> dict[str, str]:
    """The rows of each table that the session job stores."""
    task = "CAST(2 AS BIGINT) AS task_id"
    sampled = _BASE + _SELECTED + _SAMPLE.format(n=3000)
    detail = f"SELECT {task}, {_DETAIL_COLUMNS} FROM task_act WHERE session_id IN"
    return {
        "session_job_session_aggr_stat": f"SELECT {task}, * FROM ({_shares()})",
        "session_job_session_random_extract": sampled + f"SELECT {task}, {_SAMPLED_COLUMNS} FROM sampled",
        "session_job_session_detail": sampled + f"{detail} (SELECT session_id FROM sampled)",
        "session_job_top10_category": _BASE + _DETAIL + f"""
SELECT {task}, category_id, click_count, order_count, pay_count FROM top_cat""",
        "session_job_top10_session": _BASE + _DETAIL + f"""
SELECT {task}, category_id, session_id, click_count FROM top_sess""",
        "session_job_top10_session_detail": _BASE + _DETAIL + f"{detail} (SELECT session_id FROM top_sess)",
    }


def oracles() -> dict[str, str]:
    sampled = _BASE + _SELECTED + _SAMPLE.format(n=3000)
    pairs = _BASE + _PAIRS + (
        "SELECT page_split, pv FROM pairs WHERE page_split IN ('1_2', '2_3', '3_4')"
    )
    ad_stat = _BASE + _ADS + f"SELECT {_STAT_COLUMNS} FROM stat"
    daily = _BASE + _ADS + f"SELECT {_DAILY_COLUMNS} FROM daily"
    black = _BASE + _ADS + "SELECT user_id FROM black"
    trend = _BASE + _ADS + f"SELECT {_TREND_COLUMNS} FROM trend"
    sliding = _sliding("10 MINUTE", "50 MINUTE", "true")
    province_top = _province_top("date, province")
    return {
        "action_range_scan": _BASE + f"""
SELECT strftime(date, {_DAY}) AS date, {_DETAIL_COLUMNS}, city_id, action_id FROM task_act""",
        "click_city_scan": _BASE + """
SELECT c.city_id, city_name, area, click_product_id AS product_id
FROM task_act a JOIN ci c ON a.city_id = c.city_id WHERE click_product_id IS NOT NULL""",
        "session_rollup": _BASE + _PROFILES + f"""
SELECT session_id, user_id,
       coalesce(array_to_string(list_sort(kws), ','), '') AS search_keywords,
       coalesce(array_to_string(list_sort(cats), ','), '') AS click_category_ids,
       strftime(start_time, {_TIME}) AS start_time, visit_length, step_length
FROM all_sess""",
        "session_terms": _BASE + """
SELECT session_id, search_keyword, CAST(NULL AS BIGINT) AS click_category_id FROM uva
WHERE search_keyword <> ''
UNION
SELECT session_id, NULL, click_category_id FROM uva WHERE click_category_id IS NOT NULL""",
        "session_profile": _filtered("true"),
        "filter_age_between": _filtered("age >= 25 AND age <= 40"),
        "filter_professional_in": _filtered("professional IN ('BUILDING', 'MACHINERY')"),
        "filter_city_in": _filtered("city IN ('NATION_1', 'NATION_2', 'NATION_3')"),
        "filter_sex_eq": _filtered("sex = 'female'"),
        "filter_keywords_any": _filtered("list_has_any(kws, ['kw1', 'kw2'])"),
        "filter_categories_any": _filtered(
            "list_has_any(cats, CAST([3, 5, 8, 13, 21] AS BIGINT[]))"
        ),
        "filter_sessions_all": _filtered(
            "age >= 20 AND age <= 55 AND professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') "
            "AND list_has_any(kws, ['kw1', 'kw2', 'kw3', 'kw4'])"
        ),
        "visit_length_histogram": _histogram("visit_length", VISIT_BUCKETS),
        "step_length_histogram": _histogram("step_length", STEP_BUCKETS),
        "session_length_stats": _shares(),
        "session_detail": _BASE + _DETAIL + f"SELECT {_DETAIL_COLUMNS} FROM detail",
        "sessions_per_hour": sampled + f"""
SELECT strftime(date, {_DAY}) AS date, hour, hour_count FROM per_hour""",
        "sample_quota": sampled + f"""
SELECT strftime(date, {_DAY}) AS date, hour, hour_count, day_count, quota FROM quotas""",
        "sample_sessions": sampled + f"SELECT {_SAMPLED_COLUMNS} FROM sampled",
        "sampled_session_detail": sampled + f"""
SELECT {_DETAIL_COLUMNS} FROM task_act WHERE session_id IN (SELECT session_id FROM sampled)""",
        "category_ids_distinct": _BASE + _DETAIL + "SELECT category_id FROM cat_ids",
        "category_click_counts": _BASE + _DETAIL + "SELECT category_id, click_count FROM click_c",
        "category_order_counts": _BASE + _DETAIL + "SELECT category_id, order_count FROM order_c",
        "category_pay_counts": _BASE + _DETAIL + "SELECT category_id, pay_count FROM pay_c",
        "top_categories": _BASE + _DETAIL + """
SELECT category_id, click_count, order_count, pay_count FROM top_cat""",
        "session_category_clicks": _BASE + _DETAIL + """
SELECT category_id, session_id, click_count FROM sess_cat""",
        "top_sessions_per_category": _BASE + _DETAIL + """
SELECT category_id, session_id, click_count FROM top_sess""",
        "top_sessions_all_categories": _BASE + _DETAIL + """
SELECT category_id, session_id, click_count FROM ranked_sess WHERE rn <= 3""",
        "top_session_detail": _BASE + _DETAIL + f"""
SELECT {_DETAIL_COLUMNS} FROM task_act WHERE session_id IN (SELECT session_id FROM top_sess)""",
        "page_pair_counts": pairs,
        "page_pair_counts_by_range": pairs,
        "page_conversion": _BASE + _PAIRS + """
SELECT step, page_split, pv, previous_pv, convert_rate FROM rates""",
        "page_conversion_packed": _BASE + _PAIRS + """
SELECT string_agg(page_split || '=' || convert_rate, '|' ORDER BY step) AS convert_rate FROM rates""",
        "area_product_clicks": _BASE + _AREA + """
SELECT area, product_id, click_count, city_infos FROM area_clicks""",
        "area_product_named": _BASE + _AREA + """
SELECT area, product_id, click_count, city_infos, product_name, product_status FROM named""",
        "area_top_products": _area_top(3, "'D level'"),
        "area_top_products_levels": _area_top(
            5,
            "CASE WHEN area IN ('ASIA', 'EUROPE') THEN 'A level' WHEN area = 'AMERICA' THEN 'B level' "
            "WHEN area = 'AFRICA' THEN 'C level' ELSE 'D level' END",
        ),
        "sql_functions": _BASE + """
SELECT c.city_id || ':' || city_name AS city_label, count(*) AS click_count
FROM uva JOIN ci c ON uva.city_id = c.city_id
WHERE click_product_id IS NOT NULL GROUP BY 1""",
        "ad_log_parse": _BASE + _ADS + f"""
SELECT epoch_us(ts) // 1000 AS millis, strftime(ts, '%Y%m%d') AS date_key, strftime(ts, {_DAY}) AS date,
       strftime(ts, '%Y-%m-%d_%H') AS date_hour, strftime(ts, '%Y%m%d%H%M') AS minute_key,
       strftime(ts, {_TIME}) AS time, province, city, user_id, ad_id
FROM clicks""",
        "ad_filter_blacklisted": _BASE + _ADS + f"""
SELECT strftime(ts, {_TIME}) AS ts, strftime(date, {_DAY}) AS date, province, city, user_id, ad_id
FROM clicks WHERE user_id NOT IN (SELECT user_id FROM black)""",
        "ad_user_daily_clicks": daily,
        "ad_blacklist": black,
        "ad_stat": ad_stat,
        "ad_province_clicks": _BASE + _ADS + f"""
SELECT strftime(date, {_DAY}) AS date, province, ad_id, click_count FROM prov""",
        "ad_province_top": province_top,
        "ad_province_top_all_days": _province_top("province"),
        "ad_click_trend": trend,
        "ad_click_trend_trailing": _BASE + _ADS + f"""
SELECT {_TREND_COLUMNS} FROM (
  SELECT date_trunc('minute', ts) AS slot, ad_id, count(*) AS click_count FROM clicks
  WHERE ts BETWEEN TIMESTAMP '2024-01-14 12:00:00' AND TIMESTAMP '2024-01-15 12:00:30'
  GROUP BY 1, 2
)""",
        "ad_click_sliding": sliding,
        "ad_click_sliding_seconds": _sliding("10 SECOND", "3590 SECOND", "true"),
        "hot_keys": _BASE + """
SELECT user_id, count(*) AS sampled_rows FROM uva GROUP BY user_id
ORDER BY sampled_rows DESC, user_id LIMIT 10""",
        "salted_count": _BASE + """
SELECT city_id, page_id, count(*) AS action_count FROM uva GROUP BY 1, 2""",
        "salted_join": _joined_actions("JOIN"),
        "salted_join_hot": _joined_actions("LEFT JOIN"),
        "skew_split_join": _joined_actions("JOIN"),
        "sink_append": _BASE + _AREA + """
SELECT area, product_id, click_count, city_infos, CAST(1 AS BIGINT) AS task_id FROM area_clicks
UNION ALL
SELECT area, product_id, click_count, city_infos, CAST(2 AS BIGINT) AS task_id FROM named""",
        "session_job": _BASE + _DETAIL + _SAMPLE.format(n=3000) + """
SELECT 'session_aggr_stat' AS table_name, CAST(1 AS BIGINT) AS row_count
UNION ALL SELECT 'session_random_extract', count(*) FROM sampled
UNION ALL SELECT 'session_detail', count(*) FROM task_act
  WHERE session_id IN (SELECT session_id FROM sampled)
UNION ALL SELECT 'top10_category', count(*) FROM top_cat
UNION ALL SELECT 'top10_session', count(*) FROM top_sess
UNION ALL SELECT 'top10_session_detail', count(*) FROM task_act
  WHERE session_id IN (SELECT session_id FROM top_sess)""",
        **_session_job(),
        "page_job": _BASE + _PAIRS + """
SELECT CAST(3 AS BIGINT) AS task_id, string_agg(page_split || '=' || convert_rate, '|' ORDER BY step) AS convert_rate
FROM rates""",
        "product_job": _area_top(
            3,
            "CASE area WHEN 'AFRICA' THEN 'A level' WHEN 'AMERICA' THEN 'B level' WHEN 'ASIA' THEN 'C level' "
            "ELSE 'D level' END",
            "CASE area WHEN 'AFRICA' THEN 'China North' WHEN 'AMERICA' THEN 'China South' "
            "WHEN 'ASIA' THEN 'West South' ELSE area END",
            "CAST(4 AS BIGINT) AS task_id, ",
        ),
        "sink_append_new_keys": black,
        "sink_upsert_increment": daily,
        "sink_upsert_replace": ad_stat,
        "sink_replace_group": province_top,
        "stream_ad_stat": ad_stat,
        "stream_ad_user_clicks": daily,
        "stream_ad_province_top": province_top,
        "stream_ad_blacklist": black,
        "stream_ad_filtered": _BASE + _ADS + _SLICES + f"SELECT {_DAILY_COLUMNS} FROM kept",
        "stream_ad_stat_filtered": _BASE + _ADS + _SLICES + f"""
SELECT strftime(date, {_DAY}) AS date, province, city, ad_id, count(*) AS click_count FROM kept_clicks
GROUP BY ALL""",
        "stream_ad_province_top_filtered": _BASE + _ADS + _SLICES + f"""
SELECT strftime(date, {_DAY}) AS date, province, ad_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rn FROM kept_prov
) WHERE rn <= 3""",
        "stream_ad_trend": trend,
        "stream_ad_running_stat": ad_stat,
        "stream_ad_sliding": sliding,
        "stream_ad_sliding_seconds": _BASE + _ADS + f"""
SELECT strftime(CAST(window_start AS DATE), {_DAY}) AS date, ad_id, count(*) AS window_count,
       sum(n)::BIGINT AS click_count, max(n) AS most_clicks
FROM (
  SELECT window_start, ad_id, count(*) AS n FROM (
    SELECT ad_id, unnest(generate_series(time_bucket(INTERVAL 10 SECOND, ts) - INTERVAL 3590 SECOND,
                                         time_bucket(INTERVAL 10 SECOND, ts), INTERVAL 10 SECOND)) AS window_start
    FROM clicks
  ) WHERE window_start <= (SELECT max(ts) - INTERVAL 2 HOUR FROM clicks) GROUP BY ALL
) GROUP BY ALL""",
        "stream_ad_late": _BASE + _ADS + """, landed AS (
  SELECT ts, ts >= TIMESTAMP '2024-01-11 06:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:30' AS early FROM clicks
), closed AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM landed WHERE early
), judged AS (
  SELECT early, NOT early AND date_trunc('minute', ts) + INTERVAL 1 MINUTE <= mark AS late FROM landed, closed
)
SELECT count(*) AS clicks, count(*) FILTER (WHERE NOT late) AS counted, count(*) FILTER (WHERE late) AS late
FROM judged GROUP BY early""",
        "stream_ad_application": _BASE + _ADS + _SLICES + f"""
SELECT 'ad_stat' AS table_name, strftime(date, {_DAY}) AS date, province, city, NULL AS hour, NULL AS minute, ad_id,
       count(*) AS click_count FROM kept_clicks GROUP BY ALL
UNION ALL
SELECT 'ad_click_trend', date, NULL, NULL, hour, minute, ad_id, click_count FROM (SELECT {_TREND_COLUMNS} FROM trend)""",
    }
