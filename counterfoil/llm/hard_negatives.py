"""Hard negatives by inner product, found exactly with STR-packed R-trees.

Vectors are packed by sort-tile-recursion: cut into slabs of equal size along the widest
coordinate, each slab along the next one. A tile is the work of a task, which packs its rows once
more into leaves and nodes of an R-tree. The minimum bounding box of a node gives an interval per
coordinate, hence an interval of the inner products with an anchor. Nodes wait in a queue, best
upper end first; nodes outside all score windows of the anchor, or strictly below the k-th best of
each, are never opened.

Anchors are packed in the same way into blocks. A block meets a tile only if the interval of the
two boxes reaches a window of the block. First come the positives: a search in the anchor's own tile
gives a score that its k-th positive reaches at least, then all tiles are searched from there. Their scores
set the windows of the negatives. Scores are whole numbers, so results are exact and the same in every run.
"""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.session import pin

#: Rows of a tile and of a block of anchors, twice as many at most; rows of a leaf; leaves of a node.
TILE_ROWS = 8192
BLOCK_ROWS = 8192
LEAF_ROWS = 64
FANOUT = 8
#: Scores at the ends of a window that is open.
LEAST, MOST = -(1 << 62), 1 << 62


class Tree:
    """An R-tree over whole-number vectors, packed by sort-tile-recursion, in leaves and one level of nodes."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        order = self._packed(vectors)
        # Products of small whole numbers are exact in double precision, and faster.
        most = float(np.abs(vectors).max(initial=0))
        kind = np.float64 if vectors.shape[1] * most * most < 2.0**53 else np.int64
        self.vectors, self.ids, self.labels = vectors[order].astype(kind), ids[order], labels[order]
        self.low, self.high = self._boxes(self.vectors, self.vectors, LEAF_ROWS)
        self.node_low, self.node_high = self._boxes(self.low, self.high, FANOUT)
        self.opened = 0

    @staticmethod
    def _packed(vectors: np.ndarray) -> np.ndarray:
        widest = np.argsort(-vectors.var(axis=0), kind="stable")
        first, second = widest[0], widest[min(1, len(widest) - 1)]
        slab = LEAF_ROWS * max(1, round((len(vectors) / LEAF_ROWS) ** 0.5))
        order = np.argsort(vectors[:, first], kind="stable")
        parts = [order[at : at + slab] for at in range(0, len(order), slab)]
        return np.concatenate([part[np.argsort(vectors[part, second], kind="stable")] for part in parts])

    @staticmethod
    def _boxes(low: np.ndarray, high: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        starts = np.arange(0, len(low), size)
        return np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)

    def search(
        self, anchor: np.ndarray, allowed: np.ndarray, lows: list[int], highs: list[int], k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (low to high, both included) the k best rows that are allowed: ids and scores, ties to smaller ids."""
        anchor = anchor.astype(self.vectors.dtype)
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        node_most = (self.node_high @ up + self.node_low @ down).tolist()
        node_least = (self.node_low @ up + self.node_high @ down).tolist()
        most = (self.high @ up + self.low @ down).tolist()
        least = (self.low @ up + self.high @ down).tolist()
        windows = range(len(lows))
        kth, top = list(lows), max(highs, default=MOST)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(lows)

        def needed(lower, upper) -> bool:
            return any(lower <= highs[w] and upper >= kth[w] for w in windows)

        turn = count()
        queue = [(-min(node_most[n], top), next(turn), True, n) for n in range(len(node_most)) if needed(node_least[n], node_most[n])]
        heapq.heapify(queue)
        while queue:
            bound, _, is_node, at = heapq.heappop(queue)
            if -bound < min(kth):
                break
            if is_node:
                if needed(node_least[at], node_most[at]):
                    for leaf in range(at * FANOUT, min(at * FANOUT + FANOUT, len(most))):
                        if needed(least[leaf], most[leaf]):
                            heapq.heappush(queue, (-min(most[leaf], top), next(turn), False, leaf))
                continue
            if not needed(least[at], most[at]):
                continue
            self.opened += 1
            rows = slice(at * LEAF_ROWS, (at + 1) * LEAF_ROWS)
            scores = self.vectors[rows] @ anchor
            fit = allowed[rows] & (scores >= min(kth)) & (scores <= top)
            if not fit.any():
                continue
            ids, scores = self.ids[rows][fit], scores[fit].astype(np.int64)
            for w in windows:
                fits = (scores >= kth[w]) & (scores <= highs[w])
                if fits.any():
                    ids_w, scores_w = np.concatenate([best[w][0], ids[fits]]), np.concatenate([best[w][1], scores[fits]])
                    order = np.lexsort((ids_w, -scores_w))[:k]
                    best[w] = ids_w[order], scores_w[order]
                    if len(order) == k:
                        kth[w] = max(kth[w], int(scores_w[order[-1]]))
        return best


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector): components as floor(scale * x), x as double.

    Rows take no part if vec_id, label or vector is NULL, if the vector is empty or a component is NULL or not finite, or
    if the vector is not of the most frequent length (the larger of two). Of several rows with one vec_id the least by
    label and vector stays. Scores must fit in 64 bits: larger components are an error.
    """
    numbers = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
        .filter("vec_id is not null and embedding is not null and label is not null and size(embedding) > 0")
        .filter(finite)
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", numbers.alias("vector"), F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))).alias("most"))).alias("one"))
        .select("vec_id", "one.*")
    )
    rows = pin(rows)
    size = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.max("most").alias("most")).orderBy(
        F.desc("n"), F.desc("size")
    ).first()
    if size and size["size"] * (scale * size["most"] + 1) ** 2 >= 2.0**62:
        raise ValueError("inner products of these vectors do not fit in 64 bits")
    return rows.filter(F.size("vector") == (size["size"] if size else 0)).drop("most")


def _place(bounds: str, value: Column) -> Column:
    return F.size(F.filter(bounds, lambda b: b < value))


def packed(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame, int]:
    """``rows`` with the columns ``name`` and ``name``_part, the boxes of these (low, high), and how many tiles there can be.

    Tiles are slabs along the widest coordinate, cut along the second one, of about ``size`` rows. Bounds are quantiles, so
    equal values can make a tile larger: it is cut into parts by a hash of the id.
    """
    spread = rows.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(
        F.var_pop("x").alias("v"), F.count("*").alias("n")
    ).orderBy(F.desc("v"), "at").take(2)
    first, second = spread[0]["at"], spread[-1]["at"]
    slabs = max(1, round((spread[0]["n"] / size) ** 0.5))
    cuts = F.array(*[F.lit((i + 1) / slabs) for i in range(slabs - 1)])

    def bounds(column: str) -> Column:
        return F.percentile_approx(column, cuts, 10_000) if slabs > 1 else F.array().cast("array<bigint>")

    placed = rows.withColumn("_x", F.element_at("vector", first + 1)).withColumn("_y", F.element_at("vector", second + 1))
    across = placed.agg(bounds("_x").alias("b")).first()["b"]
    slab = _place(F.array(*map(F.lit, across)).cast("array<bigint>"), F.col("_x"))
    placed = placed.withColumn("_slab", slab)
    along = placed.groupBy("_slab").agg(bounds("_y").alias("_bounds"))
    tiled = placed.join(along, "_slab").withColumn(name, F.col("_slab") * slabs + _place("_bounds", F.col("_y")))
    tiled = tiled.select(*rows.columns, name)
    parts = pin(tiled.groupBy(name).agg(F.ceil(F.count("*") / (2 * size)).cast("int").alias("_parts")))
    part = F.pmod(F.xxhash64("vec_id"), F.col("_parts")).cast("int").alias(f"{name}_part")
    tiled = pin(tiled.join(parts, name).select(*rows.columns, name, part))
    keys = [name, f"{name}_part"]
    sides = tiled.select(*keys, F.posexplode("vector").alias("at", "x")).groupBy(*keys, "at").agg(
        F.min("x").alias("low"), F.max("x").alias("high")
    )
    box = F.sort_array(F.collect_list(F.struct("at", "low", "high")))
    boxes = sides.groupBy(*keys).agg(box.alias("box")).select(
        *keys, F.col("box.low").alias(f"{name}_low"), F.col("box.high").alias(f"{name}_high")
    )
    return tiled, pin(boxes), slabs * slabs


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack(vectors.to_numpy()).astype(np.int64)


FOUND = "anchor_id long, window int, vec_id long, score long"


def _frame(found: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in FOUND.split(", ")]
    if not found:
        return pd.DataFrame({n: np.zeros(0, np.int64) for n in names})
    return pd.DataFrame({n: np.concatenate(part) for n, part in zip(names, zip(*found))})


def _answers(tree: Tree, anchors: pd.DataFrame, same: bool, k: int) -> pd.DataFrame:
    found = []
    for id_, label, vector, lows, highs in zip(*(anchors[c] for c in ("vec_id", "label", "vector", "lows", "highs"))):
        allowed = (tree.labels == label) & (tree.ids != id_) if same else tree.labels != label
        best = tree.search(np.asarray(vector), allowed, [int(x) for x in lows], [int(x) for x in highs], k)
        for window, (ids, scores) in enumerate(best):
            found.append((np.full(len(ids), id_), np.full(len(ids), window), ids, scores))
    return _frame(found)


def _tree(rows: pd.DataFrame) -> Tree:
    rows = rows.sort_values("vec_id", ignore_index=True)
    return Tree(_matrix(rows["vector"]), rows["vec_id"].to_numpy(), rows["label"].to_numpy())


class Packed:
    """Rows in tiles and anchors in blocks."""

    def __init__(self, rows: DataFrame, is_anchor: Column, tile_rows: int = TILE_ROWS, block_rows: int = BLOCK_ROWS):
        self.rows, self.tiles, self.most = packed(rows, tile_rows, "tile")
        # A block lies in the same folders of space as tiles do, so that boxes of both are small.
        self.anchors, self.blocks, _ = packed(self.rows.filter(is_anchor), block_rows, "block")

    def own_tile(self, k: int) -> DataFrame:
        """(vec_id, low): the score of the k-th row of the anchor's label in its own tile, where there are as many."""
        anchors = self.anchors.select("vec_id").withColumn("_asks", F.lit(True))
        asking = self.rows.join(anchors, "vec_id", "left")

        def searched(cell: pd.DataFrame) -> pd.DataFrame:
            asks = cell[cell["_asks"].notna()]
            if not len(asks):
                return _frame([])
            asks = asks.assign(lows=[[LEAST]] * len(asks), highs=[[MOST]] * len(asks))
            return _answers(_tree(cell), asks, True, k)

        near = asking.groupBy("tile", "tile_part").applyInPandas(searched, FOUND)
        return near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.min("score").alias("low"), F.count("*").alias("n")).filter(
            F.col("n") >= k
        ).drop("n")

    def search(self, anchors: DataFrame, same: bool, k: int) -> DataFrame:
        """Per anchor and window up to k answers of every tile; ``anchors`` adds lows and highs to vec_id and block."""
        asked = pin(anchors)
        keys = ["block", "block_part"]
        reach = asked.groupBy(*keys).agg(
            F.min(F.array_min("lows")).alias("_lowest"), F.max(F.array_max("highs")).alias("_highest")
        )
        # Boxes of blocks against boxes of tiles: per coordinate the extremes of four products.
        pairs = (
            self.blocks.join(reach, keys)
            .withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(self.most - 1))))
            .join(self.tiles, "tile")
        )
        corners = F.arrays_zip("block_low", "block_high", "tile_low", "tile_high")

        def corner(pick) -> Column:
            return F.aggregate(
                corners, F.lit(0).cast("long"),
                lambda s, c: s + pick(
                    c["block_low"] * c["tile_low"], c["block_low"] * c["tile_high"],
                    c["block_high"] * c["tile_low"], c["block_high"] * c["tile_high"],
                ),
            )

        met = pin(
            pairs.filter((corner(F.greatest) >= F.col("_lowest")) & (corner(F.least) <= F.col("_highest"))).select(
                "tile", "tile_part", *keys
            )
        )
        cell = ["tile", "tile_part", *keys]
        left = self.rows.join(met, ["tile", "tile_part"]).select(*cell, "vec_id", "label", "vector")
        right = asked.join(met, keys).select(
            *[F.col(c).alias(f"_{c}") for c in cell], "vec_id", "label", "vector", "lows", "highs"
        )

        def searched(near: pd.DataFrame, far: pd.DataFrame) -> pd.DataFrame:
            return _answers(_tree(near), far, same, k) if len(near) and len(far) else _frame([])

        return (
            left.groupBy(*cell)
            .cogroup(right.groupBy(*[f"_{c}" for c in cell]))
            .applyInPandas(searched, FOUND)
        )


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return pin(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))


def _percent(score: str, percent: int) -> str:
    """``percent`` per cent of a whole number, rounded down, without fractions."""
    return f"(({score} * {percent} - pmod({score} * {percent}, 100)) div 100)"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    tile_rows: int = TILE_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` is (vec_id, embedding, label); see ``whole_vectors`` for what takes part. An anchor's positives are the
    rows of its label with the largest inner products, its negatives for a positive the best rows of other labels whose score
    is from ``least`` to ``most`` per cent of the positive's. Ties go to smaller vec_ids. Fewer rows give fewer results.
    """
    rows = whole_vectors(vectors)
    if rows.filter(is_anchor).isEmpty():
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    space = Packed(rows, is_anchor, tile_rows, block_rows)
    anchors = space.anchors.select("vec_id", "label", "vector", "block", "block_part")
    known = anchors.join(space.own_tile(positives), "vec_id", "left").select(
        *anchors.columns,
        F.array(F.coalesce("low", F.lit(LEAST))).alias("lows"),
        F.array(F.lit(MOST)).alias("highs"),
    )
    found = _first(space.search(known, True, positives), positives, "anchor_id")
    pair = found.select("anchor_id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # least * p <= 100 * n <= most * p, as whole numbers.
    windows = pair.selectExpr(
        "*", f"-{_percent('-positive_score', least)} AS low", f"{_percent('positive_score', most)} AS high"
    )
    windows = windows.filter("low <= high")
    listed = windows.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score", "low", "high"))).alias("w")
    )
    listed = pin(listed)
    asked = anchors.join(listed, "vec_id").select(
        *anchors.columns, F.col("w.low").alias("lows"), F.col("w.high").alias("highs")
    )
    best = _first(space.search(asked, False, negatives), negatives, "anchor_id", "window")
    return (
        best.join(listed.withColumnRenamed("vec_id", "anchor_id"), "anchor_id")
        .withColumn("_pair", F.element_at("w", F.col("window") + 1))
        .select(
            "anchor_id", F.col("_pair.positive_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
            F.col("_pair.positive_score").alias("positive_score"), F.col("score").alias("negative_score"),
        )
    )
