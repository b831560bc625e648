"""Training corpus in five stages over ``documents``.

Toxic documents go, poor ones go, one document of each near-duplicate group stays,
sources are mixed to target weights, and what is left is encoded.  Each stage takes
(spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomline.llm import bpe, mixing, ngram_join, quality, toxicity
from fathomline.llm.common import stored, table
from fathomline.llm.queries import VOCABULARY


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it learns from ``labels``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; no labels are used."""
    return quality.drop_poor(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the smallest id, rows without an id last.

    The join works on a key per (id, text), so rows that share an id but not a text are
    compared by their texts, and rows without an id are too.  Of rows equal in both one
    stays.  Documents without words are in no group and stay.
    """
    key = F.xxhash64("doc_id", "text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_key"))
    found = ngram_join.similar_documents(docs.select(key.alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_key"), "component_id"
    )
    ids = docs.select(key.alias("_key"), "doc_id").distinct()
    rank = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.col("_key"))
    groups = found.distinct().join(ids, "_key")
    first = groups.groupBy("component_id").agg(F.min_by("_key", rank).alias("_key"))
    one = Window.partitionBy("_key").orderBy(F.xxhash64("_row"))
    kept = rows.join(first.select("_key"), "_key", "left_semi").withColumn("_n", F.row_number().over(one))
    return kept.filter("_n = 1").select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lengths and digests of the ids of every document of the mix."""
    return bpe.digests(docs, bpe.Spec(spark, VOCABULARY))


STAGES = [
    ("toxicity", keep_civil),
    ("quality", keep_good),
    ("near duplicates", keep_one_of_each),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: The classifiers and the encoder have no SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
