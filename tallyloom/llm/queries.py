"""Registered queries of the operators, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    collocations, hard_negatives, line_dedup, merge_replay, mixing, near_dedup, packing, quality_classifier, quality_rules,
    sharding, topk, warc, wavelet,
)
from tallyloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    # the pages carry no time: a second per page_id stands in for it
    at = F.date_format(F.timestamp_seconds(F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 32))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    captures = pages.select(F.col("page_id").alias("key"), "url", at.alias("captured_at"), F.col("html").alias("payload"))
    history = warc.archived_history(captures)
    return history.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "position")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op6_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.written_and_read(table(spark, sf_dir, "documents"), vocabularies.path("byte_bpe_50k.json"))


def op7_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabularies.path("byte_bpe_50k.tiktoken")
    return merge_replay.encoded_and_decoded(table(spark, sf_dir, "documents"), ranks, vocabularies.PATTERN)


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.highest(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), vocabularies.path("word_bpe_49k.json"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.drop("n_lines")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(table(spark, sf_dir, "documents"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_warc, op2_line_dedup, op3_quality_classifier, op4_near_dedup, op5_sharding, op6_wavelet,
        op7_merge_replay, op8_topk, op9_packing, op10_quality_rules,
        op11_collocations, op12_mixing, op13_hard_negatives,
    )}
