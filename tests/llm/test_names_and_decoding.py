"""Decoding by the bytes of pieces, and extra columns whose names clash but for their case."""

import random

import pytest
from pyspark.sql import functions as F

from counterfoil.llm import secrets, sentencepiece_codec, token_counts
from counterfoil.llm.common import table
from counterfoil.llm.queries import piece_model
from counterfoil.session import scratch_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(piece_model())


def test_decoding_equals_the_library(spark, codec):
    texts = [r["text"] for r in table(spark, SMALL, "documents").collect()]
    texts += ["", " ", "  two", "a▁b", "퟿\U0001f600 é\n\t x", "▁▁", "日本語 текст"]
    ids = [list(memoryview(i).cast("i")) for i in codec.encode(texts)[0]]
    assert codec.decode(ids) == codec.built.decode_batch(ids, skip_special_tokens=False)


def test_decoding_of_random_identifiers(codec):
    rng, size = random.Random(1), codec.built.get_vocab_size()
    ids = [[rng.randrange(size) for _ in range(rng.randrange(12))] for _ in range(3000)]
    ids += [[rng.randrange(300) for _ in range(rng.randrange(6))] for _ in range(3000)]
    ids += [[0], [1, 2], [size + 5], [3, size + 5, 9], []]
    assert codec.decode(ids) == codec.built.decode_batch(ids, skip_special_tokens=False)
    assert codec.decode([None, [], None]) == [None, "", None]


def test_names_that_differ_by_case(spark):
    docs = spark.createDataFrame([(1, "password = hunter2hunter2", 7)], "doc_id long, text string, n int")
    inner = F.struct(F.lit(1).alias("a b"), F.lit("x").alias("c")).alias("odd one")
    wide = docs.select("*", inner, *[F.lit("z").alias(c) for c in ("N_TOKENS", "Ids", "PARITY", "Spans", "N_Assign", "Over_Limit", "N_Chars")])
    counted = token_counts.count_tokens(wide, piece_model())
    assert counted.select("n_tokens").first()[0] > 3
    coded = sentencepiece_codec.encode(wide, piece_model())
    path = scratch_path(spark, "coded")
    coded.write.parquet(path)
    row = spark.read.parquet(path).first()
    assert row["parity"] and row["n"] == 7 and row["odd one"]["a b"] == 1
    ledger = secrets.create_ledger(spark, scratch_path(spark, "ledger"))
    scanned = secrets.scan(wide.drop("N_Chars").withColumn("N_Chars", F.lit(0)), ledger)
    found = secrets.findings(wide, scanned).first()
    assert found["n_assign"] == 1 and found["spans"].startswith("assign:0:")
    hidden = secrets.redact(wide.drop("N_Chars").withColumn("N_Chars", F.lit(0)), scanned).first()
    assert hidden["N_Chars"] == len(hidden["text"]) and "hunter2" not in hidden["text"]
