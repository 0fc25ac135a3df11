"""Hard negatives against a plain loop."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from counterfoil.llm import hard_negatives as hn
from counterfoil.llm.common import table
from counterfoil.llm.queries import QUERIES

SMALL, SCHEMA = "/root/testdata/sf0.001", "vec_id long, embedding array<float>, label int"


def plain(rows, every, positives=5, negatives=10):
    fine = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v) or not v:
            continue
        one = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        fine[i] = min(fine.get(i, one), one)
    out = []
    for a, (label, vector) in fine.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), i, l) for i, (l, v) in fine.items() if i != a)
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out += [(a, i, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("tile,block", [(8192, 8192), (40, 8), (7, 1)])
def test_equals_loop(spark, tile, block):
    rng = np.random.default_rng(tile)
    centres = rng.normal(size=(5, 6))
    rows = [(int(i), (centres[i % 5] + rng.normal(size=6) * 0.4).tolist(), int(rng.integers(4))) for i in range(400)]
    rows += [(i, [0.5] * 6, i % 3) for i in range(400, 560)] + [(i, [0.0] * 6, 1) for i in range(560, 575)]
    rows += [(600, None, 1), (610, [1.0] * 6, None), (None, [1.0] * 6, 1), (620, [1.0, None] + [1.0] * 4, 2), (630, [], 1)]
    rows += [(640, [float("nan")] * 6, 1), (650, [float("inf")] * 6, 1), (660, [1.0, 2.0], 1)]
    rows += [rows[10], (20, [0.25] * 6, 0), (20, [0.25] * 6, 3), (700, [-1.0] * 6, 9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("tile", F.lit(1)).withColumn("Vector", F.lit("x"))
    got = hn.hard_negatives(df, F.col("vec_id") % 10 == 0, tile_rows=tile, block_rows=block)
    want = plain([r for r in rows if r[0] != 660], 10)
    assert found(got) == want
    assert len(want) > 1000


def test_nothing_to_search(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(hn.hard_negatives(empty, F.col("vec_id") % 10 == 0)) == []
    no_anchor = spark.createDataFrame([(1, [1.0], 1)], SCHEMA)
    assert found(hn.hard_negatives(no_anchor, F.col("vec_id") % 10 == 0)) == []
    alone = spark.createDataFrame([(10, [1.0], 1), (11, [1.0], 2)], SCHEMA)
    assert found(hn.hard_negatives(alone, F.col("vec_id") % 10 == 0)) == []


def test_scores_beyond_64_bits_are_an_error(spark):
    huge = spark.createDataFrame([(10, [1e30, 1.0], 1), (11, [1.0, 1.0], 1)], SCHEMA)
    with pytest.raises(ValueError):
        hn.hard_negatives(huge, F.col("vec_id") % 10 == 0)


def test_large_whole_numbers_are_exact():
    vectors = np.array([[1 << 29, 1], [1 << 29, 2], [1, 1]] * 50, dtype=np.int64)
    tree = hn.Tree(vectors, np.arange(150), np.zeros(150, int))
    [(ids, scores)] = tree.search(np.array([1 << 29, 3]), np.ones(150, bool), [hn.LEAST], [hn.MOST], 3)
    assert ids.tolist() == [1, 4, 7] and scores.tolist() == [(1 << 58) + 6] * 3


def test_tree_opens_few_leaves():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-1000, 1000, size=(20_000, 2))
    tree = hn.Tree(vectors, np.arange(20_000), np.zeros(20_000, int))
    anchor = np.array([500, -700])
    [(ids, scores)] = tree.search(anchor, np.ones(20_000, bool), [hn.LEAST], [hn.MOST], 10)
    assert scores.tolist() == sorted((vectors @ anchor).tolist(), reverse=True)[:10]
    assert tree.opened < 20
    tree.opened = 0
    [(_, window)] = tree.search(anchor, np.ones(20_000, bool), [1000], [2000], 10)
    inside = [s for s in (vectors @ anchor).tolist() if 1000 <= s <= 2000]
    assert window.tolist() == sorted(inside, reverse=True)[:10]
    assert tree.opened < 100


def test_query_on_embeddings(spark):
    rows = [
        (r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
        for r in table(spark, SMALL, "embeddings").collect()
    ]
    assert found(QUERIES["op11_hard_negatives"](spark, SMALL)) == plain(rows, 100)
