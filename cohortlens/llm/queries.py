"""Registered queries of this package: one per operator, applied to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from . import chat_format, cover_tree, decontaminate, html_extract, merkle, mixing, near_dedup, periodic_runs, pii, posting_lists, token_counts, toxicity, url_filter
from .common import documents


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(read_table(spark, sf_dir, "pages"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.top_k(read_table(spark, sf_dir, "embeddings"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(read_table(spark, sf_dir, "conversations"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(documents(spark, sf_dir))


def op13_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_html_extract, op2_url_filter, op3_mixing, op4_near_dedup, op5_decontaminate, op6_top_k, op7_pii,
                                   op8_chat_format, op9_token_counts, op10_toxicity, op11_merkle_manifest, op12_periodic_runs, op13_posting_lists)}
ORACLE_SQL = {"op2_url_filter": url_filter.oracle_sql(), "op3_mixing": mixing.oracle_sql(), "op4_near_dedup": near_dedup.ORACLE_SQL,
              "op5_decontaminate": decontaminate.ORACLE_SQL, "op6_top_k": cover_tree.ORACLE_SQL, "op8_chat_format": chat_format.ORACLE_SQL,
              "op11_merkle_manifest": merkle.ORACLE_SQL}
