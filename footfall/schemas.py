"""One explicit schema per logical table; nothing is inferred."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


USER_VISIT_ACTION = _table(
    date=DateType,
    user_id=LongType,
    session_id=StringType,
    page_id=LongType,
    action_time=TimestampType,
    search_keyword=StringType,
    click_category_id=LongType,
    click_product_id=LongType,
    order_category_ids=StringType,
    order_product_ids=StringType,
    pay_category_ids=StringType,
    pay_product_ids=StringType,
    city_id=LongType,
)

USER_INFO = _table(
    user_id=LongType,
    username=StringType,
    name=StringType,
    age=IntegerType,
    professional=StringType,
    city=StringType,
    sex=StringType,
)

PRODUCT_INFO = _table(product_id=LongType, product_name=StringType, extend_info=StringType)

CITY_INFO = _table(city_id=LongType, city_name=StringType, area=StringType)

TASK = _table(
    task_id=LongType,
    task_name=StringType,
    create_time=StringType,
    start_time=StringType,
    finish_time=StringType,
    task_type=StringType,
    task_status=StringType,
    task_param=StringType,
)

AD_LOG = _table(value=StringType)

AD_CLICK = _table(
    ts=TimestampType,
    date=DateType,
    province=StringType,
    city=StringType,
    user_id=LongType,
    ad_id=LongType,
)

# Visit-length buckets in seconds and step-length buckets in actions, as
# (label, lowest, highest); None means no upper end. Fixed values.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
STEP_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]

VISIT_RATIOS = [f"visit_length_{label}_ratio" for label, _, _ in VISIT_BUCKETS]
STEP_RATIOS = [f"step_length_{label}_ratio" for label, _, _ in STEP_BUCKETS]

SESSION_AGGR_STAT = _table(
    task_id=LongType,
    session_count=LongType,
    **{name: DoubleType for name in VISIT_RATIOS + STEP_RATIOS},
)

SESSION_RANDOM_EXTRACT = _table(
    task_id=LongType,
    session_id=StringType,
    start_time=TimestampType,
    search_keywords=StringType,
    click_category_ids=StringType,
)

SESSION_DETAIL = _table(
    task_id=LongType,
    user_id=LongType,
    session_id=StringType,
    page_id=LongType,
    action_time=TimestampType,
    search_keyword=StringType,
    click_category_id=LongType,
    click_product_id=LongType,
    order_category_ids=StringType,
    order_product_ids=StringType,
    pay_category_ids=StringType,
    pay_product_ids=StringType,
)

TOP10_CATEGORY = _table(
    task_id=LongType,
    category_id=LongType,
    click_count=LongType,
    order_count=LongType,
    pay_count=LongType,
)

TOP10_SESSION = _table(
    task_id=LongType, category_id=LongType, session_id=StringType, click_count=LongType
)

PAGE_SPLIT_CONVERT_RATE = _table(task_id=LongType, convert_rate=StringType)

AREA_TOP3_PRODUCT = _table(
    task_id=LongType,
    area=StringType,
    area_level=StringType,
    product_id=LongType,
    city_infos=StringType,
    click_count=LongType,
    product_name=StringType,
    product_status=StringType,
)

AD_USER_CLICK_COUNT = _table(
    date=DateType, user_id=LongType, ad_id=LongType, click_count=LongType
)

AD_BLACKLIST = _table(user_id=LongType)

AD_STAT = _table(
    date=DateType, province=StringType, city=StringType, ad_id=LongType, click_count=LongType
)

AD_PROVINCE_TOP3 = _table(
    date=DateType, province=StringType, ad_id=LongType, click_count=LongType
)

AD_CLICK_TREND = _table(
    date=DateType, hour=StringType, minute=StringType, ad_id=LongType, click_count=LongType
)

AD_TREND_SEEN = _table(trend_batch=LongType, clicks=LongType)

AD_TREND_COUNTED = _table(trend_batch=LongType, counted=LongType)

RESULT_TABLES = {
    "session_aggr_stat": SESSION_AGGR_STAT,
    "session_random_extract": SESSION_RANDOM_EXTRACT,
    "session_detail": SESSION_DETAIL,
    "top10_category": TOP10_CATEGORY,
    "top10_session": TOP10_SESSION,
    "top10_session_detail": SESSION_DETAIL,
    "page_split_convert_rate": PAGE_SPLIT_CONVERT_RATE,
    "area_top3_product": AREA_TOP3_PRODUCT,
}
