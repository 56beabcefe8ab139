"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, brown_lm, html_ttr, importance, lexical_bmw, nn_descent, quality_bt, simhash_mih, skip_chain_crf, sql, token_counts, tool_calls, toxicity_gru, winnowing
from .common import table


def op1_quality_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_bt.query(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_gru.query(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontaminate_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.query(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_mih.query(spark, table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.query(spark, table(spark, sf_dir, "documents"))


def op7_token_count_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.query(spark, table(spark, sf_dir, "documents"))


def op8_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.query(spark, table(spark, sf_dir, "documents"))


def op10_html_text_to_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_ttr.query(spark, table(spark, sf_dir, "pages"))


def op3_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.query(spark, table(spark, sf_dir, "conversations"))


def op4_nearest_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.query(spark, table(spark, sf_dir, "embeddings"))


def op11_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_bmw.query(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.query(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_skip_chain_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skip_chain_crf.query(spark, table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
