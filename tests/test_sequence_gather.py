import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from counterfoil.operators.gather import array_parts, gather_array, gather_text, text_parts
from counterfoil.operators.sequence import sum_before, value_before
from tests.conftest import rows

W = 1 << 16


def hot_rows(seed=1, n=400):
    """One key holds most rows; positions spread over many blocks."""
    rng = random.Random(seed)
    seqs = rng.sample(range(0, 12 * W), n)
    return [(0 if rng.random() < 0.7 else rng.randrange(1, 5), s, rng.randrange(-3, 9), rng.choice([None, "a", "b", "c"])) for s in seqs]


def test_sum_before(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k int, seq long, v long, t string")
    for keys, levels in ((["k"], 1), (["k"], 2), ([], 1), ([], 2), ([], 0)):
        got = {r["seq"]: r["before"] for r in sum_before(df, keys, "seq", {"before": "v"}, levels).collect()}
        for k, s, _, _ in data:
            assert got[s] == sum(v for k2, s2, v, _ in data if s2 < s and (k2 == k or not keys))
        assert len(got) == len(data)


@pytest.mark.parametrize("levels, spread", [(0, 1), (1, 1), (2, 1), (2, 1 << 24)])
def test_value_before(spark, levels, spread):
    data = [(k, s * spread, v, t) for k, s, v, t in hot_rows(2)]
    df = spark.createDataFrame(data, "k int, seq long, v long, t string")
    got = value_before(df, ["k"], "seq", {"last_t": F.col("t"), "prev": F.struct("t")}, levels)
    by_seq = {r["seq"]: (r["last_t"], r["prev"]) for r in got.collect()}
    for k, s, _, _ in data:
        earlier = sorted((s2, t) for k2, s2, _, t in data if k2 == k and s2 < s)
        known = [t for _, t in earlier if t is not None]
        last_t, prev = by_seq[s]
        assert last_t == (known[-1] if known else None)
        assert (prev is None) == (not earlier) and (prev is None or prev["t"] == earlier[-1][1])


def children(seed=3, n=300):
    rng = random.Random(seed)
    pairs = {(0 if rng.random() < 0.6 else rng.randrange(1, 4), rng.randrange(0, 5 * W)) for _ in range(n)}
    return [(k, i, f"{i} x" if i % 7 else None, rng.randrange(1, 4)) for k, i in pairs]


def test_gather_in_id_order(spark):
    data = children()
    df = spark.createDataFrame(data, "k int, id long, label string, n long")
    want, repeated = defaultdict(list), defaultdict(list)
    for k, i, label, n in sorted(data, key=lambda r: r[1]):
        if label:
            want[k].append(label)
            repeated[k] += [label] * n
    once = {r["k"]: r["out"] for r in gather_text(df, ["k"], "id", "label", ",", "out").collect()}
    assert once == {k: ",".join(v) for k, v in want.items()}
    often = {r["k"]: r["out"] for r in gather_text(df, ["k"], "id", "label", "|", "out", "n").collect()}
    assert often == {k: "|".join(v) for k, v in repeated.items()}
    arrays = {r["k"]: r["out"] for r in gather_array(df, ["k"], "id", F.col("label"), "out", "n").collect()}
    assert {k: [x for x in v if x] for k, v in arrays.items()} == dict(repeated)


def test_parts_put_together_equal_the_whole(spark):
    df = spark.createDataFrame(children(4), "k int, id long, label string, n long")
    whole = {r["k"]: r["out"] for r in gather_text(df, ["k"], "id", "label", ",", "out").collect()}
    parts = defaultdict(list)
    for r in text_parts(df, ["k"], "id", "label", ",").orderBy("k", "part").collect():
        parts[r["k"]].append(r["text"])
    assert {k: ",".join(v) for k, v in parts.items()} == whole and len(parts[0]) == 5


def test_a_hot_pair_is_cut_into_pieces(spark):
    df = spark.createDataFrame([(1, 5, "a", 150_000), (1, 6, "b", 10), (1, 7, "c", 3)], "k int, id long, label string, n long")
    for cut, size in (
        (text_parts(df, ["k"], "id", "label", ",", "n"), F.size(F.split("text", ","))),
        (array_parts(df, ["k"], "id", F.col("label"), "n"), F.size("items")),
    ):
        sizes = [r[0] for r in cut.orderBy("part", "piece").select(size).collect()]
        assert sizes == [W, W, 150_013 - 2 * W]
    last = array_parts(df, ["k"], "id", F.col("label"), "n").orderBy("piece").collect()[-1]["items"]
    assert last[-14:] == ["a"] + ["b"] * 10 + ["c"] * 3
    assert rows(gather_array(df, ["k"], "id", F.col("label"), "o", "n").select(F.size("o"))) == [(150_013,)]
