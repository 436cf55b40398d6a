"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; ``run`` writes every stage's result to the shared folder and reads it
back. All stages but the last return the columns of documents. Nulls and empty
texts pass every stage as documents without words; an empty table stays empty.
Further columns of documents are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontaminate, near_dedup, packing, pii, toxicity
from footfall.llm.columns import fresh
from footfall.settings import materialize

# Near duplicates share this many hundredths of their five-word shingles.
NEAR_PERCENT = 80


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose score reaches the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.scored(docs, toxicity.fit(docs, labels))
    score, passages = scored.columns[-2:]
    return scored.where(F.col(score) < toxicity.THRESHOLD).drop(score, passages)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, one with the smallest id; any id comes before none.

    Rows are told apart by their place in the input, so of repeated rows one
    stays, too, whatever their ids. Rows without words are like nothing: all stay.
    """
    row = fresh("row", docs.columns)
    # Written with its number, so that a row has one only.
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    judged = near_dedup.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), percent=NEAR_PERCENT)
    named = numbered.select(F.col(row).alias("number"), F.col("doc_id").alias("id"))
    groups = judged.select(F.col("doc_id").alias("number"), "component_id").join(named, "number")
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "number"))
    kept = groups.groupBy("component_id").agg(first.alias("first")).select(F.col("first.number").alias(row))
    return numbered.join(kept, row, "left_semi").drop(row)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; a document that is mostly benchmark goes."""
    return _with_length(decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets."""
    return _with_length(pii.redacted(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with its sequence and the place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("pii", redact_pii),
    ("packing", pack_sequences),
]

# The stages are models and iterations that SQL cannot express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
