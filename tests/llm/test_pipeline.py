"""The pipeline's stages against what they were given, one by one."""

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as P
from footfall.llm.queries import llm_queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Name -> (documents given, rows returned)."""
    root = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", F.lit(1))
    # Rows without id or text, and columns whose names the operators use inside.
    odd = docs.limit(2).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars", "extra")
    docs = docs.unionByName(odd).withColumns({"key": F.lit(2), "rep": F.lit(3), "row": F.lit(4), "toxic": F.lit(5)})
    out = {}
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        after = spark.read.parquet(f"{root}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect() if r.doc_id is not None]


def test_columns_and_odd_rows_stay(stages):
    for name, (given, kept) in stages.items():
        if name != "packing":
            assert kept.columns == given.columns
            assert kept.where("doc_id is null").count() == 2


def test_toxic_documents_go(stages, spark):
    given, kept = stages["toxicity"]
    ids = {d for d, _ in texts(kept)}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {d for d, _ in texts(given)} - ids
    assert gone and not any(labels.get(d) == 0 for d in gone)
    assert dict(texts(kept)).items() <= dict(texts(given)).items()


def test_one_of_each_group_stays(stages):
    given, kept = stages["near_dedup"]
    want = {d for d, _, _, stays in brute.near(texts(given), P.NEAR_PERCENT) if stays}
    assert dict(texts(kept)) == {d: t for d, t in texts(given) if d in want}


def test_near_pairs_at_the_limit_meet_as_in_op3(monkeypatch, spark):
    """The stage builds as many collections as the operator's own chance of a miss asks for."""
    asked = []
    collections_for = P.near_dedup.collections_for
    monkeypatch.setattr(P.near_dedup, "collections_for", lambda *a: asked.append(collections_for(*a)) or asked[-1])
    P.drop_near_duplicates(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(5), SF)
    assert asked == [collections_for(P.NEAR_PERCENT, miss=5e-5)]


def test_of_repeated_rows_one_stays(spark):
    """Also of those that share an id, or have none; rows without words stay all."""
    words = " ".join(f"w{i}" for i in range(30))
    rows = [(7, words)] * 5 + [(None, words.upper())] * 3 + [(9, words + " x"), (None, "alone at last"), (None, "alone at last")]
    rows += [(1, None), (1, ""), (1, ""), (3, "some other text"), (3, "which is not like it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).repartition(3)
    got = P.drop_near_duplicates(spark, docs, SF)
    assert got.columns == docs.columns
    wanted = [(7, words), (None, "alone at last"), (1, None), (1, ""), (1, ""), (3, "some other text"), (3, "which is not like it")]
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.text)) for r in got.collect())


def test_no_benchmark_passage_is_left(stages, spark):
    given, kept = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {h[0]: h for h in brute.hits(texts(given), items)}
    now = dict(texts(kept))
    for doc_id, text in texts(given):
        if not before[doc_id][5]:
            assert now[doc_id] == text
        elif before[doc_id][2] <= P.decontaminate.COVERAGE * before[doc_id][1]:
            # Words that were hit are gone, and no others.
            assert len(brute.NORMAL.findall(brute.lower(now[doc_id]))) == before[doc_id][1] - before[doc_id][2]
        else:
            assert doc_id not in now


def test_personal_data_is_replaced(stages):
    given, kept = stages["pii"]
    before, after = dict(texts(given)), dict(texts(kept))
    assert before.keys() == after.keys()
    for doc_id, text in before.items():
        spans = brute.base_spans(text)
        if not any(spans.values()) and "[" not in after[doc_id]:
            assert after[doc_id] == text
        assert not any(brute.base_spans(after[doc_id]).values())
    assert kept.where("n_chars <> char_length(text)").count() == 0


def test_all_tokens_are_packed(stages):
    from tokenizers import Tokenizer

    given, packed = stages["packing"]
    want = brute.pieces(texts(given), Tokenizer.from_file(P.packing.tokenizer_path()))
    got = packed.where("doc_id is not null").select("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert packed.where("doc_id is null").count() == 2


def test_an_empty_table_stays_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_registered():
    names = list(entry.queries())
    assert [n for n in names if n in llm_queries()] == list(llm_queries())
    assert "pipeline" in names
