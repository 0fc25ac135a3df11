"""The corpus operators applied to whole tables, one query per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.llm import (
    filter_audit,
    hard_negatives,
    language_id,
    mixing,
    nearest,
    quality_classifier,
    quality_rules,
    secrets,
    sentencepiece_codec,
    simhash,
    substring_dedup,
    token_counts,
    warc,
)
from counterfoil.llm.common import table
from counterfoil.session import scratch_path

PIECE_MODEL = "piece_bpe_32k.model"
NEIGHBOURS = 20
QUERY_EVERY = 20
ANCHOR_EVERY, SHIFTED_EVERY, LABELS = 100, 7, 10


@lru_cache(maxsize=1)
def piece_model(name: str = PIECE_MODEL) -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, piece_model())


def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0, NEIGHBOURS)


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger = secrets.create_ledger(spark, scratch_path(spark, "ledger"))
    return secrets.findings(docs, secrets.scan(docs, ledger)).drop("blob_id")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    # The table has no capture times; pages count as captured second by second in the order of their ids.
    second = F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)) % 100_000_000)
    return warc.round_trip(pages, F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, folder, "documents").select("doc_id", "text"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_classifier.score_quality(docs, table(spark, folder, "labels").select("doc_id", "quality"))


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode(docs, piece_model())


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % SHIFTED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", shifted)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % ANCHOR_EVERY == 0)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return filter_audit.filter_audit(docs, table(spark, folder, "labels"))


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_nearest,
        op3_language_id,
        op4_secret_scan,
        op5_mixing,
        op6_simhash,
        op7_warc,
        op8_quality_rules,
        op9_quality_classifier,
        op10_sentencepiece,
        op11_hard_negatives,
        op12_filter_audit,
        op13_substring_dedup,
    )
}
