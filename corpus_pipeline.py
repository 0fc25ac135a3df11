"""A corpus from raw documents: good ones, one of each group, without secrets, mixed, encoded.

Each stage takes (spark, docs, sf_dir); what it returns is written and read again as the
next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from counterfoil.llm import mixing, quality_classifier, secrets, sentencepiece_codec, simhash
from counterfoil.llm.common import table
from counterfoil.llm.queries import piece_model
from counterfoil.session import pin, scratch_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the threshold; the labels of those that are here are learned from."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    ledger = secrets.create_ledger(spark, scratch_path(spark, "ledger"))
    return secrets.redact(docs, secrets.scan(docs, ledger))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars and the text's identifiers."""
    return sentencepiece_codec.encode(docs, piece_model())


STAGES = [
    ("quality classifier", good_documents),
    ("SimHash near-dedup", one_of_each),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

#: Compression, fingerprints and Newton iterations are no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
