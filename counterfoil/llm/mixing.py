"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the copies the mix takes of it. Rates are as near to 1 as
the targets allow, in the sense of entropy with the bounds 0 and 3, under one constraint
per source: rates times sizes sum up to the source's target. The solution tilts rates
exponentially in the size, rate / (3 - rate) = 1/2 * exp(t * size / mean), and the dual
problem is smooth and convex in the tilts t. Newton's steps run on all machines: each
round is one aggregation of (source, size) counts, kept between the roots of a bracket.

Rates are then rounded to copies. Sizes of a source go from large to small, what
rounding one size leaves over is carried to the next, so that a source ends within a
few words of its target. Copies of one size go to its documents in the order of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.llm.common import WORD_SQL
from counterfoil.session import pin

# Weights of the sources in order, and how often a document may be taken.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Newton steps; a source that is not there by then halves its bracket until it is a point.
ROUNDS = 40
#: Bracket of the tilts, and the tilt of a source that is taken as often as it may be.
STEEPEST = 1e4
FULL = 1e12
EXACT = "decimal(38,6)"
BUCKETS = 256


def words_of(text: str | Column) -> Column:
    whole = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_count(whole, F.lit(WORD_SQL)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row per source.

    Weights repeat over the sources in the order of their code points, NULL last. A source
    gets level * weight, at most ``most`` times its size; the level is where all targets
    sum up to all sizes. Both windows hold a row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    which = F.row_number().over(by_name) - 1
    weight = F.array(*[F.lit(w) for w in weights])[which % len(weights)]
    cap = most * F.col("source_size")
    ranked = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = ranked.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upto), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    )
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        # The level if all sources of smaller ratio are capped; the first that is not gives the level of all.
        .withColumn("level", level)
        .withColumn("first", F.when(F.col("level") <= F.col("ratio"), F.struct(F.row_number().over(ranked), "level")))
        .withColumn("level", F.min("first").over(everything)["level"])
        .select(
            "source",
            "source_size",
            F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
        )
    )


def _rate(tilt: Column, size: Column, mean: Column, most: int) -> Column:
    return most / (1 + (most - 1) * F.exp(-tilt * size / mean))


def tilts(counts: DataFrame, goals: DataFrame, most: int = MOST, rounds: int = ROUNDS) -> DataFrame:
    """(source, tilt, mean) that meet ``goals`` (source, source_size, target), counts: (source, size, n).

    Distributed Newton iterations: the gradient of the dual is the source's taken words less
    its target, the curvature sums rate * (most - rate) / most * size**2 / mean. A step that
    leaves the bracket of known signs is replaced by its middle. Sums are exact decimals, so
    reruns and other partitionings agree. Stops when every source is within a
    millionth of its target, has reached a bound, or has a bracket that is a point; after ``rounds`` steps brackets
    are halved, so that comes.
    """
    full = F.col("target") >= most * F.col("source_size") * (1 - 1e-9)
    state = pin(
        counts.groupBy("source")
        .agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).cast("double").alias("mean"))
        .join(goals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .filter("source_size > 0")
        .select(
            "source",
            "mean",
            "target",
            F.when(full, F.lit(FULL)).otherwise(F.lit(0.0)).alias("tilt"),
            F.lit(-STEEPEST).alias("low"),
            F.lit(STEEPEST).alias("high"),
            full.alias("done"),
        )
    )
    for turn in count():
        size = F.col("size").cast("double")
        rate = _rate(F.col("tilt"), size, F.col("mean"), most)
        sums = (
            counts.withColumnRenamed("source", "_s")
            .join(state.filter("not done"), F.col("source").eqNullSafe(F.col("_s")))
            .groupBy(F.col("_s").alias("_of"))
            .agg(
                F.sum((F.col("n") * size * rate).cast(EXACT)).cast("double").alias("taken"),
                F.sum((F.col("n") * size * size / F.col("mean") * rate * (most - rate) / most).cast(EXACT))
                .cast("double")
                .alias("bend"),
            )
        )
        over = F.col("taken") - F.col("target")
        near = F.abs(over) <= 1e-6 * F.col("target")
        step = F.col("tilt") - F.when(F.col("bend") > 1e-9, over / F.col("bend"))
        moved = state.join(sums, F.col("source").eqNullSafe(F.col("_of")), "left")
        low = F.when(over <= 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(over >= 0, F.least("high", "tilt")).otherwise(F.col("high"))
        moved = (
            moved.withColumn("_low", low)
            .withColumn("_high", high)
            .withColumn("_near", F.coalesce(near, F.col("done")))
            .withColumn(
                "_next",
                F.when((step > F.col("_low")) & (step < F.col("_high")) & F.lit(turn < rounds), step).otherwise(
                    (F.col("_low") + F.col("_high")) / 2
                ),
            )
        )
        still = F.col("done") | F.col("_near")
        state = pin(
            moved.select(
                "source",
                "mean",
                "target",
                F.when(still, F.col("tilt")).otherwise(F.col("_next")).alias("tilt"),
                F.when(still, F.col("low")).otherwise(F.col("_low")).alias("low"),
                F.when(still, F.col("high")).otherwise(F.col("_high")).alias("high"),
                (still | (F.col("_high") - F.col("_low") < 1e-9)).alias("done"),
            )
        )
        if state.filter("not done").isEmpty():
            break
    return state.select("source", "tilt", "mean")


def copies_by_size(counts: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """(source, size, n, rate, copies): copies that all documents of a size get together.

    A source is one group of its different sizes; k different sizes need k**2 / 2 words, so
    even 10**13 words have fewer than five million.
    """
    solved = tilts(counts, goals, most)
    rows = (
        counts.join(solved.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("rate", _rate(F.col("tilt"), F.col("size").cast("double"), F.col("mean"), most))
        .join(goals.select(F.col("source").alias("_g"), "target"), F.col("source").eqNullSafe(F.col("_g")))
        .select("source", "size", "n", "rate", "target")
    )

    def rounded(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", ascending=False, ignore_index=True)
        copies, carried = [], 0.0
        for size, n, rate in zip(group["size"].tolist(), group["n"].tolist(), group["rate"].tolist()):
            wanted = n * rate * size + carried
            number = min(most * n, max(0, round(wanted / size))) if size else 0
            carried = wanted - number * size if size else carried
            copies.append(number)
        group["copies"] = copies
        return group[["source", "size", "n", "rate", "copies"]]

    kind = counts.schema["source"].dataType.simpleString()
    return rows.groupBy("source").applyInPandas(
        rounded, f"source {kind}, size bigint, n bigint, rate double, copies bigint"
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken for each row of ``docs`` (doc_id, source, text).

    NULL texts have size 0; documents of size 0 are taken 0 times. A NULL source is a source.
    Repeated rows count one by one. Nothing to mix gives an empty result. Which documents of a
    size get one copy more is settled by a hash of doc_id; rows with equal ids share or
    divide copies in any order. Ranks are counted within hash buckets and
    carried over 256 of them, so a size that a third of all rows share is no single task's work.
    """
    sized = pin(docs.select("doc_id", "source", words_of("text").alias("size")))
    counts = pin(sized.groupBy("source", "size").agg(F.count("*").alias("n")), rows=sized.count())
    goals = pin(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))))
    given = pin(copies_by_size(counts, goals, most))
    hashed = sized.withColumn("hash", F.xxhash64("doc_id")).withColumn("bucket", F.shiftrightunsigned("hash", 56))
    key = ["source", "size"]
    before = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        hashed.groupBy(*key, "bucket")
        .agg(F.count("*").alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("bucket").alias("_b"), "before")
    )
    of_size = given.select(F.col("source").alias("_gs"), F.col("size").alias("_gz"), "n", "rate", "copies")
    per_bucket = (
        carried.join(of_size, F.col("_s").eqNullSafe(F.col("_gs")) & (F.col("_z") == F.col("_gz")))
        .join(goals.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t")))
        .select("_s", "_z", "_b", "before", "n", "rate", F.col("copies").alias("all"), "source_size", "target")
    )
    rank = F.row_number().over(Window.partitionBy(*key, "bucket").orderBy("hash", "doc_id"))
    ranked = hashed.withColumn("rank", rank)
    each = (F.col("all") / F.col("n")).cast("long")
    extra = (F.col("before") + F.col("rank") <= F.col("all") - each * F.col("n")).cast("long")
    taken_by = (
        ranked.join(
            per_bucket,
            F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("bucket") == F.col("_b")),
            "left",
        )
        .withColumn("copies", F.coalesce(each + extra, F.lit(0)))
        .select("doc_id", "source", "size", "source_size", "target", "rate", "copies")
    )
    # Sources without a word have no rates.
    whole = taken_by.join(
        goals.select(F.col("source").alias("_t"), F.col("source_size").alias("_all"), F.col("target").alias("_goal")),
        F.col("source").eqNullSafe(F.col("_t")),
    )
    return whole.select(
        "doc_id",
        "source",
        "size",
        F.col("_all").alias("source_size"),
        F.col("_goal").alias("target"),
        F.coalesce("rate", F.lit(0.0)).alias("rate"),
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix: each row of ``docs`` as often as it is taken, all columns as they were."""
    narrow = (
        mix(docs, weights, most)
        .groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_words"))
        .agg(F.sum("copies").alias("_all"), F.count("*").alias("_rows"))
        .filter("_all > 0")
    )
    same = (
        F.col("id").eqNullSafe(F.col("_id"))
        & F.col("from").eqNullSafe(F.col("_source"))
        & (F.col("size") == F.col("_words"))
    )
    # Rows with equal id, source and size divide their copies.
    place = F.row_number().over(Window.partitionBy("id", "from", "size").orderBy("id"))
    copies = (F.col("_all") / F.col("_rows")).cast("int") + (place <= F.col("_all") % F.col("_rows")).cast("int")
    return (
        docs.select(
            F.col("doc_id").alias("id"),
            F.col("source").alias("from"),
            words_of("text").alias("size"),
            F.struct("*").alias("row"),
        )
        .join(narrow, same)
        .withColumn("copies", copies)
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("row.*")
    )
