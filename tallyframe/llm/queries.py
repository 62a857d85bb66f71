"""The registered queries of this package: each applies one operator, with its own defaults, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, lines, passages, pieces, prefixtrie, quality, scoring, shards, simhash, toxicity, urlfilter, warc, whitening
from .common import table
from .oracles import SQL


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urlfilter.RULES, "rule string, verdict string")
    return urlfilter.report(table(spark, sf_dir, "pages"), rules)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyframe.session import fresh_folder

    return warc.report(table(spark, sf_dir, "pages"), fresh_folder(spark, "warc"))


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.report(table(spark, sf_dir, "conversations"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.report(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_shards, op3_url_filter, op4_line_dedup, op5_sentencepiece, op6_simhash, op7_warc, op8_passages,
        op9_toxicity, op10_quality, op11_prefix_trie, op12_lm_scoring, op13_whitening,
    )
}
ORACLES: dict[str, str] = SQL
