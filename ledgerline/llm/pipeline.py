"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import store
from ledgerline.llm.mixing import mix
from ledgerline.llm.ngram_join import jaccard_classes
from ledgerline.llm.packing import pack
from ledgerline.llm.quality import judge
from ledgerline.llm.queries import VOCABULARY
from ledgerline.llm.secrets_scan import redact

ALL_PERCENT = 100


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. Rows are told apart by doc_id: of rows that share
    one, all stay if any is kept; rows without doc_id go."""
    kept = judge(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id.

    Similarity 0.8 on five-word shingles. Documents without words are no copies of each other and stay;
    exact repetitions of a row (equal doc_id) count as one document, of which one row stays.
    """
    found = jaccard_classes(docs, size=5, threshold=80)
    kept = found.where("component_id = doc_id or doc_id is null").select("doc_id").distinct()
    whole = docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
    named = whole.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(whole.where("doc_id is null"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret is replaced in the text; all documents stay."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture, once for each epoch that takes them."""
    taken = mix(docs, budget_percent=ALL_PERCENT).groupBy("doc_id").agg(F.countDistinct("epoch").alias("times"))
    times = docs.join(taken, "doc_id")
    return times.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place."""
    return pack(docs, VOCABULARY)


def run_stages(spark: SparkSession, sf_dir: str, stages: list) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in stages:
        docs, _ = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
