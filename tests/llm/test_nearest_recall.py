"""Recall of the neighbour search on 20,000 vectors, in clusters and scattered, and with many blocks of queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from counterfoil.llm import nearest


def vectors_of(kind, n=20_000, size=24):
    rng = np.random.default_rng(7)
    if kind == "scattered":
        return (rng.normal(size=(n, size)) * rng.uniform(0.5, 1.5, size=(n, 1))).astype(np.float32)
    centres = rng.normal(size=(40, size))
    return (centres[rng.integers(40, size=n)] + rng.normal(size=(n, size)) * 0.3).astype(np.float32)


def recall(spark, matrix, every, k=20):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<float>")
    found = {}
    for r in nearest.search(df, F.col("vec_id") % every == 0, k).select("query_id", "vec_id").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    exact = matrix.astype(np.float64)
    shares = []
    for q in range(0, len(matrix), every):
        scores = exact @ exact[q]
        scores[q] = -np.inf
        shares.append(len(found[q] & set(np.argsort(-scores)[:k].tolist())) / k)
        assert len(found[q]) == k
    return float(np.mean(shares))


@pytest.mark.parametrize("kind, least", [("clustered", 0.95), ("scattered", 0.9)])
def test_recall(spark, kind, least):
    assert recall(spark, vectors_of(kind), 100) >= least


def test_many_blocks_of_queries_find_the_same(spark, monkeypatch):
    matrix = vectors_of("clustered", 3000, 8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<float>")
    search = lambda: sorted(map(tuple, nearest.search(df, F.col("vec_id") % 5 == 0, 5).collect()))
    want = search()
    monkeypatch.setattr(nearest, "BLOCK_QUERIES", 7)
    assert search() == want


def test_one_id_with_two_vectors(spark):
    rows = [(i, [float(i), 1.0]) for i in range(40)] + [(20, [-5.0, 0.0]), (7, [-9.0, 2.0]), (7, [100.0, 0.0])]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)
        got = [tuple(r) for r in nearest.search(df, F.col("vec_id") == 20, 3).collect()]
        assert sorted(got) == [(20, 1, 7, 45.0), (20, 2, 0, -0.0), (20, 3, 1, -5.0)]
