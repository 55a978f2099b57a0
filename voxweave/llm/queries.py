"""Queries of the corpus operators, with production parameters over their whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, html, jaccard, langid, license, oracles, pii, quality, reshard, topk
from .util import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def bpe_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts again, from the ids that op 6 gives."""
    return bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return reshard.rewrite(docs, reshard.target(docs))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_exact_topk": op1_exact_topk,
    "op2_html_extraction": op2_html_extraction,
    "op3_language_id": op3_language_id,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_pii": op5_pii,
    "op6_byte_bpe": op6_byte_bpe,
    "bpe_decoding": bpe_decoding,
    "op7_license_scan": op7_license_scan,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_resharding": op9_resharding,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
}

SQL: dict[str, str] = {
    "op1_exact_topk": oracles.TOPK,
    "bpe_decoding": "SELECT doc_id, text FROM documents",
    "op7_license_scan": oracles.LICENSE,
    "op8_benchmark_decontamination": oracles.DECONTAM,
    "op10_ngram_jaccard_join": oracles.JACCARD,
}
