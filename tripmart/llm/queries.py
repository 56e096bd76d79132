"""The registered queries of this folder and their DuckDB SQL.

Every query applies one operator, with production parameters, to the whole
``documents`` table (11: ``conversations``, 12: ``embeddings``, 13: ``pages``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    fingerprints,
    hard_negatives,
    html_text,
    jaccard_join,
    language,
    line_runs,
    mixing,
    packing,
    quality,
    role_repair,
    secrets,
    token_count,
    token_files,
)
from .common import read_documents, read_table
from .oracles import ORACLES
from .vocab import public_path

TOKENIZER = "word_bpe_49k.json"


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read_documents(spark, sf_dir)))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(read_documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(read_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(read_documents(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read_documents(spark, sf_dir), public_path(TOKENIZER))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "position",
        F.get("positions", F.lit(1)).alias("position_2"))


def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_documents(spark, sf_dir), public_path(TOKENIZER))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_documents(spark, sf_dir), public_path(TOKENIZER))


def op11_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.repair(role_repair.damaged(read_table(spark, sf_dir, "conversations")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_fingerprints": op2_fingerprints,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_line_dedup": op5_line_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_files": op7_token_files,
    "op8_mixing": op8_mixing,
    "op9_best_two_fit": op9_best_two_fit,
    "op10_token_counts": op10_token_counts,
    "op11_role_repair": op11_role_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_html_text": op13_html_text,
}

__all__ = ["ORACLES", "QUERIES"]
