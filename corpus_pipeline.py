"""Training-data pipeline: stages over the documents table, each applying one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import pipeline as stages

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("near_duplicates", stages.near_duplicates),
    ("secret_scan", stages.secret_scan),
    ("mixture", stages.mixture),
    ("packing", stages.packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again as the next one's documents."""
    return stages.run_stages(spark, sf_dir, STAGES)
