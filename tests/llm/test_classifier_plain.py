"""The quality score against plain zstandard calls, and labels that contradict each other."""

import math

import pytest
import zstandard

from counterfoil.llm import quality_classifier as qc

GOOD = ("The committee met on Tuesday and approved the annual report without changes. " * 40).encode()
BAD = ("BUY NOW!!! cheap pills click here >>> " * 80).encode()
TEXTS = ["", "x", "The committee met on Monday and approved a plan.", "BUY NOW!!! click here", "é漢字 " * 3000, GOOD.decode() * 3, None]


def plain_sizes(text, dictionary):
    """Compressed bytes of the blocks of a text, each by a compressor of its own."""
    total = 0
    for at in range(0, max(1, len(text)), 6000):
        data = zstandard.ZstdCompressionDict(dictionary)
        compressor = zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=False, write_dict_id=False)
        total += len(compressor.compress(text[at : at + 6000].encode()))
    return total


@pytest.mark.parametrize("weights", [(0.1, 25.0, 0.4), (-1.0, 3.0, -2.0)])
def test_scores_equal_plain_compression(spark, weights):
    model = qc.QualityModel(GOOD, BAD, weights)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in docs.select("doc_id", qc.quality_score("text", model).alias("score")).collect()}
    for n, text in enumerate(TEXTS):
        text = text or ""
        good, bad = plain_sizes(text, GOOD), plain_sizes(text, BAD)
        difference = (bad - good) / max(good, bad)
        ratio = math.log((min(good, bad) + 16) / (len(text.encode()) + 16))
        value = weights[0] + weights[1] * difference + weights[2] * ratio
        assert got[n] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, value)))), abs=1e-12)


def test_contradicting_labels_teach_nothing(spark):
    ids = [i for i in range(60)]
    docs = spark.createDataFrame([(i, ("good prose " if i % 2 else "BAD!! ") * (5 + i)) for i in ids], "doc_id long, text string")
    plain = [(i, i % 2) for i in ids]
    both = [(i, 1 - i % 2) for i in ids if i % 3 == 0]
    known = spark.createDataFrame([r for r in plain if r[0] % 3], "doc_id long, quality int")
    for extra in (plain + both, both + plain, [*both, *plain, *plain]):
        labels = spark.createDataFrame(extra, "doc_id long, quality int").repartition(3)
        assert qc.labelled_sample(docs, labels) == qc.labelled_sample(docs, known)
