"""The generic star-schema test tables seen as this package's logical tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_CITIES = 25

# Stored columns of the test tables in use; given, so that no job infers them.
STORED = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(STORED[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_visit_action(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Actions made from ``events``, one session per user and day.

    A day is squeezed into 36 minutes of one hour, so that visits of all lengths
    occur. Days outside ``start``..``end`` are cut off on the stored timestamp,
    which the Parquet scan can use.
    """
    events = _table(spark, sf_dir, "events")
    if start is not None:
        events = events.where(f"ts >= timestamp_ntz'{start}'")
    if end is not None:
        events = events.where(f"ts < timestamp_ntz'{end}' + interval 1 day")
    # A scalar subquery, run only by queries that look at products.
    n_products = _table(spark, sf_dir, "part").select(F.expr("count(1)")).scalar()
    base = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "to_date(ts) AS date",
        "hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS second_of_day",
        "cast(get_json_object(props, '$.k') AS bigint) AS k",
    ).withColumn("product", F.col("event_id") % n_products)
    return base.selectExpr(
        "date",
        "user_id",
        "concat(user_id, '_', date) AS session_id",
        "k % 10 AS page_id",
        "cast(date AS timestamp) + make_dt_interval(0, cast(user_id % 24 AS int), 0, "
        "second_of_day div 40) AS action_time",
        "if(event_type = 'view', concat('kw', k % 10), null) AS search_keyword",
        "if(event_type = 'click', k, null) AS click_category_id",
        "if(event_type = 'click', product, null) AS click_product_id",
        "if(event_type = 'purchase', concat(k, ',', (k + 7) % 100), null) AS order_category_ids",
        "if(event_type = 'purchase', cast(product AS string), null) AS order_product_ids",
        "if(event_type = 'signup', concat(k, ',', (k + 7) % 100), null) AS pay_category_ids",
        "if(event_type = 'signup', cast(product AS string), null) AS pay_product_ids",
        f"user_id % {N_CITIES} AS city_id",
        "event_id AS action_id",
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    customer = _table(spark, sf_dir, "customer")
    return customer.join(nation, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "cast(18 + c_custkey % 50 AS int) AS age",
        "c_mktsegment AS professional",
        "n_name AS city",
        "if(c_custkey % 2 = 0, 'male', 'female') AS sex",
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        """concat('{"product_status": ', p_size % 2, '}') AS extend_info""",
    )


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "cast(n_nationkey AS bigint) AS city_id", "n_name AS city_name", "r_name AS area"
    )


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and views of ``events`` as ad clicks in their user's city."""
    clicks = (
        _table(spark, sf_dir, "events")
        .where("event_type IN ('click', 'view')")
        .selectExpr(
            "cast(ts AS timestamp) AS ts",
            f"user_id % {N_CITIES} AS city_id",
            "user_id",
            "cast(get_json_object(props, '$.k') AS bigint) % 10 AS ad_id",
        )
    )
    return clicks.join(city_info(spark, sf_dir), "city_id").selectExpr(
        "ts",
        "to_date(ts) AS date",
        "translate(area, ' ', '_') AS province",
        "city_name AS city",
        "user_id",
        "ad_id",
    )


def to_log_lines(clicks: DataFrame) -> DataFrame:
    """Clicks written as log lines; blanks inside names become underscores."""

    def word(name: str) -> Column:
        return F.translate(F.col(name), " ", "_")

    return clicks.select(
        F.concat_ws(
            " ",
            F.unix_millis("ts").cast("string"),
            word("province"),
            word("city"),
            F.col("user_id").cast("string"),
            F.col("ad_id").cast("string"),
        ).alias("value")
    )
