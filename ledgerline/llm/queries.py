"""Registered queries of the operators, with SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.archives import archive_path, read_archives, write_archives
from ledgerline.llm.ball_tree import SEARCH_SQL, search
from ledgerline.llm.conversations import REPAIR_SQL, repair
from ledgerline.llm.html_text import extract
from ledgerline.llm.mixing import mix, mix_sql
from ledgerline.llm.ngram_join import jaccard_classes
from ledgerline.llm.packing import pack
from ledgerline.llm.quality import judge
from ledgerline.llm.quality_model import score_quality
from ledgerline.llm.secrets_scan import scan
from ledgerline.llm.text_runs import remove_repeats
from ledgerline.llm.toxicity import score_toxicity
from ledgerline.llm.vector_links import near_duplicates

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(_table(spark, sf_dir, "documents"))


def op1_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_warc_zstd_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = archive_path(spark)
    write_archives(_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 of a SHA-1 from its 40 hexadecimal digits: five of them are four letters.
BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
OP2_SQL = f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
m as (select *, min(page_id) over (partition by html) as least_id from p)
select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes,
    array_to_string(list_transform(range(32), lambda k: substr({BASE32},
        1 + cast((cast('0x' || substr(h, 1 + 5 * cast(k // 4 as int), 5) as bigint) >> cast(15 - 5 * (k % 4) as int)) & 31 as int), 1)), '') as payload_digest,
    case when page_id = least_id or least_id is null then 'response' else 'revisit' end as record_type,
    case when page_id <> least_id then least_id end as refers_to
from m
"""


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_html_block_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op5_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op6_secret_scan_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


def op7_mixing_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), VOCABULARY)


def op11_sparse_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(_table(spark, sf_dir, "conversations"))


def op13_naive_bayes_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_kneser_ney_toxicity": op1_kneser_ney_toxicity,
    "op2_warc_zstd_archives": op2_warc_zstd_archives,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_html_block_extraction": op4_html_block_extraction,
    "op5_distribution_divergence": op5_distribution_divergence,
    "op6_secret_scan_network": op6_secret_scan_network,
    "op7_mixing_to_target_weights": op7_mixing_to_target_weights,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_sparse_ball_tree_search": op11_sparse_ball_tree_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_naive_bayes_support_vectors": op13_naive_bayes_support_vectors,
}
ORACLES: dict[str, str] = {"op2_warc_zstd_archives": OP2_SQL, "op7_mixing_to_target_weights": mix_sql(), "op11_sparse_ball_tree_search": SEARCH_SQL, "op12_conversation_repair": REPAIR_SQL}
