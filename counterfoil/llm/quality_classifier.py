"""Quality by compression: dictionaries of good and of bad text, the smaller result tells.

A zstandard dictionary is built from labelled good text and another from bad. A text is
compressed whole with both; the difference of the two sizes, over the larger, says which
it resembles. A dictionary helps the start of what it compresses only, so a text goes in
blocks of the length that dictionaries are built from, each with a fresh dictionary, and
the sizes are summed. A logistic curve over that difference and the logarithm of the
compression ratio (at a high ratio both sizes are small and the difference says little)
turns it into a probability; it is fitted on whole labelled texts that built no dictionary.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import held_out, learnable

#: The sample: texts per label, the first characters of each that dictionaries are built from, and
#: the characters of a block. The curve is fitted on whole texts.
SAMPLE_TEXTS = 1024
SAMPLE_CHARS = 6000
BLOCK_CHARS = SAMPLE_CHARS
DICTIONARY_BYTES = 65_536
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the curve; ``good`` and ``bad`` are None if a label was missing."""

    good: bytes | None
    bad: bytes | None
    weights: tuple[float, float, float]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)


def measures(text: str | None, good: bytes, bad: bytes) -> tuple[float, float]:
    """Normalised size difference (above 0: good text helps more) and logarithm of the compression ratio."""
    text = text or ""
    size = as_good = as_bad = 0
    for at in range(0, len(text) or 1, BLOCK_CHARS):
        raw = text[at : at + BLOCK_CHARS].encode("utf-8", "replace")
        size += len(raw)
        as_good += len(_compressor(good).compress(raw))
        as_bad += len(_compressor(bad).compress(raw))
    return (as_bad - as_good) / max(as_good, as_bad), math.log((min(as_good, as_bad) + 16) / (size + 16))


def probability(text: str | None, model: QualityModel) -> float:
    if model.good is None or model.bad is None:
        value = model.weights[0]
    else:
        difference, ratio = measures(text, model.good, model.bad)
        value = model.weights[0] + model.weights[1] * difference + model.weights[2] * ratio
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, value))))


def _dictionary(texts: list[str]) -> bytes:
    samples = [t.encode("utf-8", "replace") for t in texts]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(samples)[-DICTIONARY_BYTES:] or b" "


def fit(built: tuple[bytes, bytes], points: np.ndarray, label: np.ndarray, rows: dict[int, int]) -> QualityModel:
    """The curve over ``points``, the measures of texts with these labels; ``rows`` says how common the labels are."""
    # Each label weighs as much as it has rows, so that scores are probabilities.
    weight = np.where(label == 1, rows[1] / label.sum(), rows[0] / (1 - label).sum())
    weight *= len(label) / weight.sum()
    middle, spread = points.mean(axis=0), points.std(axis=0) + 1e-9
    inputs = np.column_stack([np.ones(len(points)), (points - middle) / spread])
    curve = np.zeros(3)
    for _ in range(40):
        guess = 1 / (1 + np.exp(-np.clip(inputs @ curve, -30, 30)))
        bend = inputs.T @ (inputs * (weight * guess * (1 - guess))[:, None]) + 0.01 * np.eye(3)
        step = np.linalg.solve(bend, inputs.T @ (weight * (label - guess)) - 0.01 * curve)
        curve += step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
    slopes = curve[1:] / spread
    return QualityModel(*built, (float(curve[0] - slopes @ middle), float(slopes[0]), float(slopes[1])))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, texts: int = SAMPLE_TEXTS
) -> tuple[dict[int, list[tuple[str, int]]], dict[int, int]]:
    """Different beginnings per label with a doc_id of each, and the number of labelled ids of each.

    Ids are chosen from ``labels`` alone: hashes fall into ``texts`` classes, of each label
    and class the smallest is taken. At most 2 * ``texts`` beginnings reach the driver.
    """
    # An id that is labelled both ways teaches nothing.
    known = (
        labels.filter(learnable("doc_id") & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("_other"))
        .filter("quality = _other")
        .select("doc_id", "quality", F.xxhash64("doc_id").alias("h"))
    )
    parts = (
        known.groupBy("quality", F.pmod("h", F.lit(texts)).alias("part"))
        .agg(F.min(F.struct("h", "doc_id")).alias("least"), F.count("*").alias("n"))
        .select("quality", "n", "least.doc_id")
        .collect()
    )
    rows: dict[int, int] = {}
    label: dict = {}
    for part in parts:
        rows[part["quality"]] = rows.get(part["quality"], 0) + part["n"]
        label.setdefault(part["doc_id"], part["quality"])
    chosen = docs.sparkSession.createDataFrame([(i, q) for i, q in label.items()], "doc_id long, quality int")
    least = _texts_of(docs, chosen).groupBy("doc_id", "quality").agg(F.min("start").alias("start"))
    found: dict[int, dict[str, int]] = {0: {}, 1: {}}
    for row in sorted(least.collect()):
        found[row["quality"]].setdefault(row["start"], row["doc_id"])
    # In the order of a hash, so that neighbours of the alphabet do not share a half.
    order = {q: sorted(ts, key=lambda t: (zlib.crc32(t.encode("utf-8", "replace")), t)) for q, ts in found.items()}
    return {q: [(t, found[q][t]) for t in ts] for q, ts in order.items()}, rows


def _texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows with text of the ids in ``chosen`` (doc_id, quality), with their beginnings."""
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .filter(F.length("text") > 0)
        .join(F.broadcast(chosen), "doc_id")  # 2 * texts rows at most
        .withColumn("start", F.col("text").substr(1, SAMPLE_CHARS))
    )


def whole_measures(docs: DataFrame, label: dict[int, int], built: tuple[bytes, bytes]) -> pd.DataFrame:
    """doc_id, quality, difference and ratio of the whole text of each id; texts are measured where they lie.

    Of an id's texts it is the one whose beginning the sample has, as far as the beginning tells.
    """
    chosen = docs.sparkSession.createDataFrame(sorted(label.items()), "doc_id long, quality int")

    @F.pandas_udf("difference double, ratio double")
    def measured(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([measures(t, *built) for t in batch], columns=["difference", "ratio"], dtype="float64")

    least = (
        _texts_of(docs, chosen)
        .select("doc_id", "quality", "start", measured("text").alias("of"))
        .groupBy("doc_id", "quality")
        .agg(F.min(F.struct("start", "of.difference", "of.ratio")).alias("least"))
        .select("doc_id", "quality", "least.difference", "least.ratio")
    )
    return pd.DataFrame([tuple(r) for r in sorted(least.collect())], columns=least.columns)


def train(docs: DataFrame, labels: DataFrame) -> QualityModel:
    texts, rows = labelled_sample(docs, labels)
    if not texts[0] or not texts[1]:
        share = (rows.get(1, 0) + 0.5) / (rows.get(0, 0) + rows.get(1, 0) + 1)
        return QualityModel(None, None, (math.log(share / (1 - share)), 0.0, 0.0))
    built = (_dictionary([t for t, _ in texts[1][::2]]), _dictionary([t for t, _ in texts[0][::2]]))
    rest = {doc_id: q for q in (1, 0) for _, doc_id in texts[q][1::2] or texts[q]}
    points = whole_measures(docs, rest, built)
    return fit(built, points[["difference", "ratio"]].to_numpy(), points["quality"].to_numpy(dtype="float64"), rows)


def quality_score(text: str | Column, model: QualityModel) -> Column:
    """Column of probabilities that the label is 1; the model (130 KB) goes with the plan."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([probability(t, model) for t in batch], dtype="float64")

    return scored(text)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    Learned from labels whose fold is not 0. NULL and empty texts are compressed like any
    other; repeated rows get equal scores; NULL ids are not held out and carry no label; an id with both labels counts
    as not labelled.
    Without good or without bad texts every row gets the share of good labels (0.5 if
    there are none).
    """
    model = train(docs, labels)
    return docs.select(
        "doc_id", held_out("doc_id").alias("held_out"), quality_score("text", model).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns as they were."""
    return docs.filter(quality_score("text", train(docs, labels)) >= threshold)
