from datetime import date

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from footfall import schemas
from footfall.sinks.keyed_table import KeyedTable
from footfall.sinks.results import append_result, read_result, replaced_runs

D = date(2024, 3, 1)
E = date(2024, 3, 2)


def frame(spark, schema, data):
    return spark.createDataFrame(data, schema)


def users_table(path, **how):
    return KeyedTable(str(path), schemas.AD_USER_CLICK_COUNT, "increment", ["date", "user_id", "ad_id"], **how)


def parts(path):
    """Names of the files of every part."""
    return {
        str(f.parent.relative_to(path)): f.name for f in (path / "rows").rglob("*.parquet")
    }


@pytest.mark.parametrize("split_by", [None, "date"])
def test_increment(spark, tmp_path, split_by):
    table = users_table(tmp_path, split_by=split_by)
    make = lambda data: frame(spark, schemas.AD_USER_CLICK_COUNT, data)
    assert rows(table.read(spark)) == []
    table.upsert(0, make([(D, 1, 1, 5), (D, 2, 1, 1)]))
    for _ in range(2):  # the same batch again
        table.upsert(1, make([(D, 1, 1, 3), (E, 1, 1, 4)]))
    table.upsert(2, make([]))
    whole = [(D, 1, 1, 8), (D, 2, 1, 1), (E, 1, 1, 4)]
    assert rows(table.read(spark)) == whole
    assert rows(table.read(spark, before=1)) == [(D, 2, 1, 1)]
    touched = make([(D, 1, 1, 0), (D, 9, 1, 0)])
    assert rows(table.read_touching(spark, touched, ["date", "user_id", "ad_id"])) == [(D, 1, 1, 8)]
    for keys in (["click_count"], ["date"], ["user_id"]):
        with pytest.raises(ValueError):
            table.read_touching(spark, touched, keys)


def test_rows_are_found_by_the_keys_their_part_goes_by(spark, tmp_path):
    table = users_table(tmp_path, split_by="date", bucket_by=["user_id"])
    make = lambda data: frame(spark, schemas.AD_USER_CLICK_COUNT, data)
    table.upsert(0, make([(D, 1, a, 1) for a in range(9)] + [(D, 2, 1, 1), (E, 1, 1, 1)]))
    got = table.read_touching(spark, make([(D, 1, 0, 0)]), ["date", "user_id"])
    assert rows(got) == [(D, 1, a, 1) for a in range(9)]


def test_only_touched_parts_are_written(spark, tmp_path):
    table = users_table(tmp_path, split_by="date", buckets=16)
    make = lambda data: frame(spark, schemas.AD_USER_CLICK_COUNT, data)
    days = [date(2024, 3, day) for day in range(1, 6)]
    table.upsert(0, make([(day, u, 1, 1) for day in days for u in range(40)]))
    before = parts(tmp_path)
    assert len(before) > 60
    table.upsert(1, make([(D, 7, 1, 2), (E, 8, 1, 2), (date(2024, 4, 1), 7, 1, 2)]))
    after = parts(tmp_path)
    changed = {part for part in after if before.get(part) != after[part]}
    assert len(changed) == 3 and before.keys() <= after.keys()
    assert {part.split("/")[1] for part in changed} == {"date=2024-03-01", "date=2024-03-02", "date=2024-04-01"}
    assert rows(table.read(spark).where("click_count > 1")) == [(D, 7, 1, 3), (E, 8, 1, 3), (date(2024, 4, 1), 7, 1, 2)]


class Lost(Exception):
    pass


@pytest.mark.parametrize("fails_at", [0, 1, 2])
def test_a_batch_that_was_lost_half_way_runs_again(spark, tmp_path, monkeypatch, fails_at):
    """Before its merged parts are all written, before its number, and before they are in place."""
    table = users_table(tmp_path, split_by="date")
    make = lambda data: frame(spark, schemas.AD_USER_CLICK_COUNT, data)
    table.upsert(0, make([(D, u, 1, 1) for u in range(20)]))
    steps = []
    store, at = KeyedTable._store, KeyedTable._at

    def lost():
        steps.append(1)
        if len(steps) == fails_at + 1:
            raise Lost

    def stored(self, frame, name, mode):
        if name == "pending" and fails_at == 0:
            store(self, frame.limit(1), name, mode)
        lost()
        store(self, frame, name, mode)
        if name == "rows":
            return

    def named(self, name):
        if name == "commit" and steps:
            lost()
        return at(self, name)

    monkeypatch.setattr(KeyedTable, "_store", stored)
    monkeypatch.setattr(KeyedTable, "_at", named)
    with pytest.raises(Lost):
        table.upsert(1, make([(D, u, 1, 5) for u in range(0, 20, 2)]))
    monkeypatch.undo()
    # Nothing of it is seen yet, and running it again does it once.
    assert rows(table.read(spark)) == [(D, u, 1, 1) for u in range(20)]
    for _ in range(2):
        table.upsert(1, make([(D, u, 1, 5) for u in range(0, 20, 2)]))
    assert rows(table.read(spark)) == [(D, u, 1, 1 if u % 2 else 6) for u in range(20)]


def test_parts_taken_away_while_they_were_put_in_place_come_back(spark, tmp_path):
    table = users_table(tmp_path, split_by="date")
    make = lambda data: frame(spark, schemas.AD_USER_CLICK_COUNT, data)
    table.upsert(0, make([(D, 1, 1, 5), (D, 2, 1, 1)]))
    table.upsert(1, make([(D, 1, 1, 2)]))
    for file in (tmp_path / "rows").rglob("*.parquet"):
        if file.name == parts(tmp_path)[str(file.parent.relative_to(tmp_path))] and rows(
            spark.read.parquet(str(file)).select("user_id")
        ) == [(1,)]:
            file.unlink()
    table.upsert(1, make([(D, 1, 1, 2)]))
    assert rows(table.read(spark)) == [(D, 1, 1, 7), (D, 2, 1, 1)]


def test_replace(spark, tmp_path):
    table = KeyedTable(str(tmp_path), schemas.AD_STAT, "replace", ["date", "province", "city", "ad_id"], "date")
    make = lambda data: frame(spark, schemas.AD_STAT, data)
    for batch_id, data in enumerate(
        [[(D, "p", "c", 1, 5), (D, "p", "c", 2, 1)], [(D, "p", "c", 1, 3)], [(E, None, "c", 1, 7)]]
    ):
        table.upsert(batch_id, make(data))
    assert rows(table.read(spark).where("province is not null")) == [(D, "p", "c", 1, 3), (D, "p", "c", 2, 1)]
    assert rows(table.read(spark).where("province is null")) == [(E, None, "c", 1, 7)]


def test_replaced_group_may_shrink(spark, tmp_path):
    table = KeyedTable(str(tmp_path), schemas.AD_PROVINCE_TOP3, "replace_group", ["date", "province"], "date")
    make = lambda data: frame(spark, schemas.AD_PROVINCE_TOP3, data)
    table.upsert(0, make([(D, "p", 1, 3), (D, "p", 2, 2), (D, "p", 3, 1), (D, "q", 1, 1)]))
    table.upsert(1, make([(D, "p", 2, 9), (D, "p", 1, 8)]))
    assert rows(table.read(spark)) == [(D, "p", 1, 8), (D, "p", 2, 9), (D, "q", 1, 1)]


def test_new_keys_come_once(spark, tmp_path):
    table = KeyedTable(str(tmp_path), schemas.AD_BLACKLIST, "new_keys", ["user_id"])
    for batch_id, ids in enumerate([[1, 2], [2, 3], []]):
        table.upsert(batch_id, frame(spark, schemas.AD_BLACKLIST, [(i,) for i in ids]))
    assert rows(table.read(spark)) == [(1,), (2,), (3,)]
    assert rows(table.read(spark, before=1)) == [(1,), (2,)]


def test_results_are_kept_per_task(spark, tmp_path):
    make = lambda *ids: spark.createDataFrame([(i, i, 0, 0) for i in ids], "category_id bigint, click_count bigint, order_count bigint, pay_count bigint")
    append_result(make(1, 2), str(tmp_path), "top10_category", 1)
    append_result(make(3), str(tmp_path), "top10_category", 2)
    append_result(make(4, 5), str(tmp_path), "top10_category", 2)
    got = read_result(spark, str(tmp_path), "top10_category").select("task_id", "category_id")
    assert rows(got) == [(1, 1), (1, 2), (2, 4), (2, 5)]
    append_result(make(1).where("false"), str(tmp_path), "top10_category", 1)
    got = read_result(spark, str(tmp_path), "top10_category").select("task_id", "category_id")
    assert rows(got) == [(2, 4), (2, 5)]


def test_empty_result_can_be_read(spark, tmp_path):
    none = spark.createDataFrame([], "category_id bigint, click_count bigint, order_count bigint, pay_count bigint")
    append_result(none, str(tmp_path), "top10_category", 1)
    assert rows(read_result(spark, str(tmp_path), "top10_category")) == []


def test_a_failed_run_leaves_the_rows_before_it(spark, tmp_path):
    columns = "category_id bigint, click_count bigint, order_count bigint, pay_count bigint"
    make = lambda *ids: spark.createDataFrame([(i, i, 0, 0) for i in ids], columns)
    append_result(make(1, 2), str(tmp_path), "top10_category", 1)
    # Some of its rows are written before it breaks off.
    broken = make(3, 4, 5, 6).repartition(4, "category_id").withColumn(
        "pay_count", F.when(F.col("category_id") == 6, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(0)
    )
    with pytest.raises(Exception, match="lost"):
        append_result(broken, str(tmp_path), "top10_category", 1)
    got = lambda: rows(read_result(spark, str(tmp_path), "top10_category").select("task_id", "category_id"))
    assert got() == [(1, 1), (1, 2)]
    assert replaced_runs(spark, str(tmp_path), "top10_category").count() == 0
    append_result(make(7), str(tmp_path), "top10_category", 1)
    assert got() == [(1, 7)]
    replaced = replaced_runs(spark, str(tmp_path), "top10_category").collect()
    assert len(replaced) == 1 and replaced[0]["task_id"] == 1


def test_results_of_nobody_yet(spark, tmp_path):
    assert rows(read_result(spark, str(tmp_path), "top10_category")) == []
    append_result(spark.createDataFrame([(5,)], "n long"), str(tmp_path), "numbers", 2)
    schema = spark.createDataFrame([], "n long").schema
    assert rows(read_result(spark, str(tmp_path), "numbers", schema)) == [(5, 2)]
    assert rows(read_result(spark, str(tmp_path), "numbers", schema, task_id=1)) == [] and schema.names == ["n"]
