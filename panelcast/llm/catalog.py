"""Registered queries of the training-data operators, each over its whole table, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import op1_quality, op2_merkle, op3_licences, op4_decontaminate, op5_debruijn, op6_chat, op7_simhash, op8_bpe, op9_language, op10_lpf, op11_balltree, op12_manifest, op13_urls
from panelcast.llm.common import table


def op1_quality_crf(spark: SparkSession, sf: str) -> DataFrame:
    return op1_quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_merkle_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return op2_merkle.edited_pairs(table(spark, sf, "documents"))


def op3_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return op3_licences.scan(docs, op3_licences.learn(docs))


def op4_decontaminate_myers(spark: SparkSession, sf: str) -> DataFrame:
    return op4_decontaminate.find(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op5_debruijn_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return op5_debruijn.digests(op5_debruijn.cut(table(spark, sf, "documents"), length=35))


def op6_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    rows = op6_chat.with_hostile(table(spark, sf, "conversations"))
    return op6_chat.digests(op6_chat.format_conversations(rows))


def op7_simhash_pivots(spark: SparkSession, sf: str) -> DataFrame:
    return op7_simhash.link(table(spark, sf, "documents"), shingle=3, max_distance=3)


def op8_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return op8_bpe.round_trip(table(spark, sf, "documents"), op8_bpe.codec())


def op9_language_centroids(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return op9_language.identify(docs, op9_language.learn(docs))


def op10_suffix_lpf(spark: SparkSession, sf: str) -> DataFrame:
    return op10_lpf.digests(op10_lpf.cut(table(spark, sf, "documents"), length=200))


def op11_ball_tree_search(spark: SparkSession, sf: str) -> DataFrame:
    return op11_balltree.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return op12_manifest.manifest(table(spark, sf, "documents"))


def op13_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return op13_urls.judge(pages, op13_urls.learn(pages))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_crf": op1_quality_crf,
    "op2_merkle_fingerprints": op2_merkle_fingerprints,
    "op3_licence_scan": op3_licence_scan,
    "op4_decontaminate_myers": op4_decontaminate_myers,
    "op5_debruijn_dedup": op5_debruijn_dedup,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_simhash_pivots": op7_simhash_pivots,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_language_centroids": op9_language_centroids,
    "op10_suffix_lpf": op10_suffix_lpf,
    "op11_ball_tree_search": op11_ball_tree_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_url_rules": op13_url_rules,
}

ORACLES: dict[str, str] = {
    "op2_merkle_fingerprints": op2_merkle.ORACLE,
    "op6_chat_formatting": op6_chat.ORACLE,
    "op11_ball_tree_search": op11_balltree.ORACLE,
    "op12_merkle_manifest": op12_manifest.ORACLE,
}
