"""The operators over the whole of their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm import (
    alignment, bpe, decontaminate, language, minhash, quality_bayes, quality_rules, sharding,
    spelling, suffix_dedup, token_counts, toxicity, url_filter)
from landfall.llm.oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    return quality_rules.fit_and_judge(docs, labels)


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return token_counts.attribute(
        _table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)


def op4_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf, "documents"), 100)
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("rest")).alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"), F.sha2("rest", 256).alias("kept_sha256"))


def op5_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.decode(bpe.encode(_table(spark, sf, "documents"), path), path)
    return encoded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_quality_bayes(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    return quality_bayes.score(
        docs, quality_bayes.fit(docs, labels), F.col("source"), F.col("lang"))


def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf, "pages"))


def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign(_table(spark, sf, "documents"), 24)


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.judge(
        _table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.select("doc_id", "contaminated", "item_ids")


def op10_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"), size=3, percent=85).drop(
        "mark", "stays")


def op11_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf, "documents"))


def op12_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    found = language.label(docs, language.fit(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score",
                        F.size("spans").cast("long").alias("n_spans"))


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(
        _table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_toxicity, op2_quality_rules, op3_token_counts, op4_suffix_dedup, op5_bpe,
    op6_quality_bayes, op7_url_filter, op8_sharding, op9_decontamination, op10_minhash,
    op11_spelling, op12_language, op13_alignment)}
