import pytest
from fixtures import rows
from pyspark.sql import functions as F

from footfall.operators import skew as K


@pytest.fixture(scope="module")
def sides(spark):
    """Key 0 holds well over a third of the left rows, all of them copies."""
    left = spark.createDataFrame(
        [(0, "x")] * 300 + [(i % 20, f"v{i}") for i in range(300)] + [(None, "none")], "k bigint, v string"
    ).repartition(6)
    right = spark.createDataFrame(
        [(i, f"r{i}") for i in range(0, 20, 2)] + [(0, "again"), (None, "none"), (50, "alone")], "k bigint, r string"
    )
    return left, right


def shown(df):
    return rows(df.select([F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns)]))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_all_ways_equal_the_plain_join(sides, how):
    left, right = sides
    plain = shown(left.join(right, "k", how))
    hot = K.hot_keys(left, "k", 3)
    assert shown(K.salted_join(left, right, "k", how, 7)) == plain
    assert shown(K.salted_join(left, right, "k", how, 7, hot)) == plain
    assert shown(K.salted_join(left, right, "k", how, 7, hot.limit(0))) == plain
    assert shown(K.salted_join(left, right, "k", how, 7, by=["v"])) == plain
    assert shown(K.skew_split_join(left, right, "k", how, 7, fraction=0.5, top=2)) == plain


def test_other_joins_are_refused(sides):
    with pytest.raises(ValueError):
        K.salted_join(*sides, "k", "full")


def test_copies_get_different_salts(sides):
    left, _ = sides
    salts = left.where("v = 'x'").select(K.salt(left, 16).alias("s")).distinct().count()
    assert salts > 1


def test_salts_repeat(sides):
    left, _ = sides
    once = left.select("k", "v", K.salt(left, 16).alias("s"))
    assert shown(once) == shown(once)


def test_salted_count(sides):
    left, _ = sides
    plain = left.groupBy("k", "v").agg(F.count("*").alias("n"))
    assert shown(K.salted_count(left, ["k", "v"], 5, "n")) == shown(plain)


def test_hot_keys(sides):
    left, _ = sides
    got = K.hot_keys(left, "k", 2).collect()
    assert [tuple(r) for r in got] == [(0, 315), (1, 15)]
    assert K.hot_keys(left, "k", 5, min_rows=100).count() == 1
    assert K.hot_keys(left, "k", 5, fraction=0.5, seed=3, min_rows=200).collect()[0]["k"] == 0


def test_any_number_of_hot_keys(spark):
    left = spark.range(5000).selectExpr("id % 2500 AS k", "id AS v")
    right = spark.range(0, 2500, 2).selectExpr("id AS k", "id * 10 AS r")
    hot = K.hot_keys(left, "k", 2500)
    assert hot.count() == 2500
    assert shown(K.salted_join(left, right, "k", "left", 3, hot)) == shown(left.join(right, "k", "left"))
    got = K.skew_split_join(left, right, "k", "left", 3, fraction=1.0, top=2500)
    assert shown(got) == shown(left.join(right, "k", "left"))


def test_map_columns_and_unused_columns(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "map('a', id) AS m", "array(map(id, id)) AS l")
    right = spark.range(3).selectExpr("id AS k", "id AS r")
    assert K.salted_join(df, right, "k").count() == 100
    plan = K.salted_count(df, ["k"])
    assert plan.agg(F.sum("count")).first()[0] == 100


def test_hot_keys_among_a_million(spark):
    """Far more keys than are tracked: those over the bound are found, and counted exactly."""
    many = spark.range(1_000_000).selectExpr("id + 1000 AS k")
    for k in range(5):
        many = many.unionByName(spark.range(20_000 * (k + 1)).selectExpr(f"{k}L AS k"))
    many = many.repartition(6, "k").unionByName(spark.createDataFrame([(None,)] * 9, "k long"))
    got = [tuple(r) for r in K.hot_keys(many, "k", 5, tracked=4096).collect()]
    # 7 / 4096 of 1,300,000 rows are 2,222.
    assert got == [(k, 20_000 * (k + 1)) for k in reversed(range(5))]
    assert K.hot_keys(many, "k", 9, min_rows=50_000, tracked=4096).count() == 3


def test_the_left_side_of_a_split_join_is_read_twice(spark, sides, tmp_path):
    left, right = sides
    left.write.parquet(str(tmp_path / "left"))
    stored = spark.read.parquet(str(tmp_path / "left"))
    reads = []
    materialize = K.materialize

    def counted(df, name):
        reads.append(df._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/left"))
        return materialize(df, name)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(K, "materialize", counted)
        joined = K.skew_split_join(stored, right, "k", "left", 7, top=2)
    reads.append(joined._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/left"))
    assert reads == [1, 1] and shown(joined) == shown(left.join(right, "k", "left"))
