"""Queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, divergence, lexical, licenses, mixing, neardup, oracles, pagetree, pivots, privacy, quality,
               tokencount, tokenids, toxicity)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_near_duplicates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.report(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query("op2_decontaminate", oracles.OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie inside a benchmark window."""
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                                table(spark, sf_dir, "benchmark", ["item_id", "text"]))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text, with the offending offsets."""
    return toxicity.report(table(spark, sf_dir, "documents", ["doc_id", "text"]),
                           table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


@query("op3_mix_sources", oracles.OP3)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, shuffled."""
    return mixing.report(table(spark, sf_dir, "documents", ["doc_id", "source", "text"]))


@query("op5_licenses")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return licenses.report(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query("op6_pivot_top_k", oracles.OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five largest integer inner products of every 50th vector."""
    return pivots.top_k(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text."""
    return quality.report(table(spark, sf_dir, "documents", ["doc_id", "text"]),
                          table(spark, sf_dir, "labels", ["doc_id", "quality"]))


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return tokencount.report(table(spark, sf_dir, "documents", ["text"]))


@query("op9_private_data")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it, in every document."""
    return privacy.report(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query("op10_page_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pagetree.extract_pages(table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


@query("op11_ranked_search", oracles.OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty best documents of every benchmark item."""
    return lexical.report(table(spark, sf_dir, "documents", ["doc_id", "text"]),
                          table(spark, sf_dir, "benchmark", ["item_id", "text"]))


@query("op12_token_ids")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written in packed files and read back."""
    return tokenids.report(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query("op13_source_divergence", oracles.OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of every language and the terms that set each apart."""
    return divergence.report(table(spark, sf_dir, "documents", ["lang", "source", "text"]))
