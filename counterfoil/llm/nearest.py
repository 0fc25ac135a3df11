"""Approximate nearest neighbours by largest inner product, with an adaptive dimension scan.

One more component makes all vectors equally long, so that the largest inner product is
the least distance. Vectors are turned by a random rotation and kept in lists around
k-means centres. A query probes its nearest lists. In a list, distances grow block of
columns by block of columns; after each block a hypothesis test compares what a candidate
has so far, scaled to all dimensions, with the distance of the query's k-th best among a
sample, and candidates that fail are abandoned. What survives gets its inner product on the original
vectors in double precision. A query left with fewer than k answers although there are more
candidates is searched again in twice as many lists without a bound, at last in all.

Lists are cut into groups of bounded size and queries into blocks of bounded size; each
pair of a group and a block is one step of a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.session import pin

#: Lists follow the square root of the number of vectors; centres are fitted on a bounded sample.
MOST_LISTS = 4096
SAMPLE_PER_LIST = 40
SAMPLE_BYTES = 64_000_000
#: As many lists are probed as hold this share of the neighbours that sampled vectors have in the sample.
COVERED = 0.97
SAMPLED_QUERIES = 512
#: Vectors of the sample that give each query its first bound.
PILOTS = 8192
GROUP_ROWS = 8192
BLOCK_QUERIES = 4096
COLUMNS = 16
#: How sure the test is to keep what belongs to the best; larger abandons less.
MARGIN = 2.1
SEED = 42


@dataclass(frozen=True)
class Space:
    """Rotation of ``size`` + 1 dimensions, centres turned by it, and the squared length that all vectors get."""

    rotation: np.ndarray
    centres: np.ndarray
    square: float
    pilots: np.ndarray
    probed: int

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(0.0, self.square - (vectors * vectors).sum(axis=1)))
        return np.column_stack([vectors, lift]) @ self.rotation

    def query(self, vectors: np.ndarray) -> np.ndarray:
        """A query at the length of the vectors, without lift: its order of inner products is the order of distances."""
        lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        scaled = vectors * (np.sqrt(self.square) / lengths)
        return np.column_stack([scaled, np.zeros(len(vectors))]) @ self.rotation

    def lists(self, points: np.ndarray, number: int) -> np.ndarray:
        """The ``number`` nearest lists of each point, nearest first."""
        apart = (self.centres**2).sum(axis=1) - 2 * points @ self.centres.T
        if number == 1:
            return apart.argmin(axis=1)[:, None]
        return np.argsort(apart, axis=1, kind="stable")[:, :number]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.vstack(vectors.to_numpy()).astype(np.float64)


def fit(sample: np.ndarray, square: float, lists: int, k: int) -> Space:
    """Rotation, centres and number of probed lists from a sample without order."""
    random = np.random.default_rng(SEED)
    turned, _ = np.linalg.qr(random.standard_normal((sample.shape[1] + 1, sample.shape[1] + 1)))

    def space(centres: np.ndarray, probed: int = 1) -> Space:
        return Space(turned, centres, square, sample[:PILOTS], probed)

    points = space(np.zeros((1, sample.shape[1] + 1))).turned(sample)
    centres = points[random.permutation(len(points))[:lists]]
    for _ in range(8):
        near = space(centres).lists(points, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        count = np.bincount(near, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(1, count)[:, None], centres)
    fitted = space(centres)
    home = fitted.lists(points, 1)[:, 0]
    queries = sample[:SAMPLED_QUERIES]
    products = queries @ sample.T
    np.fill_diagonal(products, -np.inf)
    best = np.argsort(-products, axis=1)[:, :k]
    order = fitted.lists(fitted.query(queries), len(centres))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres))[None, :], axis=1)
    needed = np.take_along_axis(place, home[best], axis=1)
    return space(centres, int(np.quantile(needed, COVERED)) + 1)


def bounds(space: Space, queries: np.ndarray, k: int) -> np.ndarray:
    """Per query a squared distance that its k nearest do not pass: the k-th among the pilots."""
    if len(space.pilots) < k:
        return np.full(len(queries), np.inf)
    scaled = queries * (np.sqrt(space.square) / np.sqrt((queries * queries).sum(axis=1, keepdims=True)))
    products = scaled @ space.pilots.T
    kth = -np.partition(-products, k - 1, axis=1)[:, k - 1]
    return (2 * space.square - 2 * kth) * (1 + 1e-9) + 1e-9 * space.square


def scan(
    queries: np.ndarray,
    turned_queries: np.ndarray,
    limits: np.ndarray,
    vectors: np.ndarray,
    turned: np.ndarray,
    ids: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to k best candidates of each query within its limit: places of queries, ids, inner products.

    Candidates come column block by column block; see the module. Ties go to smaller ids.
    """
    size = turned.shape[1]
    blocks = [np.ascontiguousarray(turned[:, lo : lo + COLUMNS]) for lo in range(0, size, COLUMNS)]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for at, (query, point, bound) in enumerate(zip(queries, turned_queries, limits)):
        alive, partial, seen = None, 0.0, 0
        for block in blocks:
            apart = (block if alive is None else block[alive]) - point[seen : seen + block.shape[1]]
            partial = partial + np.einsum("ij,ij->i", apart, apart)
            seen += block.shape[1]
            # Under the hypothesis that the candidate is within the bound, this much is too much.
            margin = (seen / size) * (1 + MARGIN / np.sqrt(seen)) ** 2 if seen < size else 1.0
            stay = np.flatnonzero(partial <= bound * margin)
            alive, partial = stay if alive is None else alive[stay], partial[stay]
            if not len(alive):
                break
        if len(alive):
            # Products of two floats are exact in double precision; equal vectors get equal sums.
            scores = (vectors[alive] * query).sum(axis=1)
            order = np.lexsort((ids[alive], -scores))[:k]
            found.append((np.full(len(order), at), ids[alive][order], scores[order]))
    return tuple(np.concatenate(part) for part in zip(*found))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) without vectors that are NULL, empty, zero or hold NULL or non-finite components, or ids that are NULL.

    Inner products need equal dimensions: the most frequent one stays, the larger if two are.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    some = F.exists("embedding", lambda x: x != 0)
    fine = vectors.select("vec_id", "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    ).filter(finite & some)
    size = fine.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("size")
    ).first()
    return fine.filter(F.size("embedding") == (size["size"] if size else 0))


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` that ``is_query`` holds for, its k nearest found.

    ``vectors``: (vec_id, embedding); nearest is the largest inner product, ties go to the smaller
    vec_id, a query is no candidate of its own. Rows that ``usable`` leaves out take no part; too
    few candidates give fewer rows, none give none.

    Equal vectors are one candidate: of each, the k + 1 smallest ids stand in a list, which
    loses no answer, and equal queries are searched once. Rows with one id count as one, with the least of their vectors.
    """
    spark = vectors.sparkSession
    # Of several vectors with one id the least stays.
    rows = pin(usable(vectors).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    about = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("embedding")).alias("size"),
        F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("square"),
    ).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not about["n"]:
        return spark.createDataFrame([], schema)
    lists = int(min(MOST_LISTS, max(1, round(about["n"] ** 0.5 / 2))))
    take = int(min(lists * SAMPLE_PER_LIST, max(lists, SAMPLE_BYTES // (8 * about["size"]))))
    by_hash = rows.select("embedding").distinct().orderBy(F.xxhash64("embedding"), "embedding").limit(take)
    sample = np.array([r["embedding"] for r in by_hash.collect()], dtype=np.float64)
    space = fit(sample, about["square"] * (1 + 1e-12), min(lists, len(sample)), k)

    @F.pandas_udf("int")
    def home(vector: pd.Series) -> pd.Series:
        return pd.Series(space.lists(space.turned(_matrix(vector)), 1)[:, 0]).astype("int32")

    def probes(width: int):
        @F.pandas_udf("lists array<int>, bound double")
        def probed(vector: pd.Series) -> pd.DataFrame:
            queries = _matrix(vector)
            lists = space.lists(space.query(queries), width).astype("int32")
            return pd.DataFrame({"lists": list(lists), "bound": bounds(space, queries, k + 1)})

        return probed

    copies = Window.partitionBy("embedding").orderBy("vec_id")
    candidates = pin(
        rows.withColumn("copy", F.row_number().over(copies))
        .filter(F.col("copy") <= k + 1)
        .select("vec_id", "embedding", home("embedding").alias("list"))
    )
    # Lists larger than a group are cut by a hash of the id.
    groups = pin(candidates.groupBy("list").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("groups")))
    asked = pin(rows.filter(is_query).groupBy("embedding").agg(F.min("vec_id").alias("asker")))
    cells = candidates.join(groups, "list").select(
        "vec_id", "embedding", "list", F.pmod(F.xxhash64("vec_id"), F.col("groups")).cast("int").alias("part")
    )
    asking_keys = [F.col(c).alias(f"_{c}") for c in ("list", "part", "block")]

    def scanned(key, near: pd.DataFrame, far: pd.DataFrame) -> pd.DataFrame:
        if not len(near) or not len(far):
            return pd.DataFrame({"asker": [], "vec_id": [], "score": []}).astype(
                {"asker": "int64", "vec_id": "int64", "score": "float64"}
            )
        near = near.sort_values("vec_id", ignore_index=True)
        vectors, queries = _matrix(near["embedding"]), _matrix(far["embedding"])
        at, ids, scores = scan(
            queries,
            space.query(queries),
            far["bound"].to_numpy(),
            vectors,
            space.turned(vectors),
            near["vec_id"].to_numpy(),
            k + 1,
        )
        return pd.DataFrame({"asker": far["asker"].to_numpy()[at], "vec_id": ids, "score": scores})

    keys = ["list", "part", "block"]
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")

    def best_in(asking: DataFrame, width: int, bounded: bool) -> DataFrame:
        """The k + 1 best of each asker (asker, embedding) in its ``width`` nearest lists.

        Blocks of askers are cut inside each list, so a list's candidates are copied once per block of those that
        probe it, whatever the number of all askers.
        """
        probed = asking.withColumn("to", probes(width)("embedding")).select(
            "asker",
            "embedding",
            (F.col("to.bound") if bounded else F.lit(float("inf"))).alias("bound"),
            F.explode("to.lists").alias("list"),
        )
        probed = pin(probed.join(groups, "list"))
        # Written, a row per list, so that Spark knows its size and does not deal out queries by list for it.
        blocks = pin(probed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks")))
        probing = pin(
            probed.join(blocks, "list")
            .withColumn("block", F.pmod(F.xxhash64("asker"), F.col("blocks")).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        )
        # Each block of queries meets each group it probes.
        met = probing.select("list", "part", "block").distinct()
        left = cells.join(met, ["list", "part"]).select("list", "part", "block", "vec_id", "embedding")
        found = (
            left.groupBy(*keys)
            .cogroup(probing.select(*asking_keys, "asker", "embedding", "bound").groupBy("_list", "_part", "_block"))
            .applyInPandas(scanned, "asker long, vec_id long, score double")
        )
        return pin(found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place"))

    top = best_in(asked, space.probed, True)
    # An asker is a candidate of its own, so k answers are k + 1 rows. Who has fewer looks again, without a bound, in
    # twice as many lists each time, at last in all.
    enough = min(k + 1, candidates.count())
    width = space.probed
    while True:
        counts = top.groupBy("asker").agg(F.count("*").alias("n"))
        short = pin(asked.join(counts, "asker", "left").filter(F.coalesce("n", F.lit(0)) < enough).drop("n"))
        if short.isEmpty():
            break
        width = min(2 * width, len(space.centres))
        top = pin(top.join(short.select("asker"), "asker", "left_anti").unionByName(best_in(short, width, False)))
        if width == len(space.centres):
            break
    # Every query with the answers to its vector, less itself.
    answers = (
        rows.filter(is_query)
        .select(F.col("vec_id").alias("query_id"), "embedding")
        .join(asked, "embedding")
        .join(top, "asker")
        .filter("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        .filter(F.col("rank") <= k)
    )
    return answers.select("query_id", "rank", "vec_id", "score")
