"""Stock decisions for products with very many changes, block by block on all machines.

Whether a change is accepted depends on the stock left and on the state of its line, hence on
all changes before it. The changes of a product are cut into blocks of bounded size, and each
block is walked by itself, from bounds on the stock left at its start and on the state of each line
it touches. Where the lower bound covers a change it is accepted, where the upper one does not it is
refused. What a block does to the bounds is a step of the form max(stock - a, b); steps of blocks in a row
add up with a running sum and a running maximum, so what a round of walks learns of one block reaches all
later ones at once. Rounds tighten the starts until they are exact; a last walk of all blocks decides.

Each round makes at least the first inexact block of a product exact. Where stock lasts, all changes
fit and one round tells every start; where it has run short, the upper bound falls to what the smallest
refused changes leave. A feed that keeps both bounds apart over many blocks takes a round for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.functions.stock_fold import ENDS, bound_blocks
from counterfoil.operators.sequence import block_of, sum_before
from counterfoil.session import pin

_LINE = ["product_id", "order_id"]
_AT = ["product_id", "_block"]


def cut(rows: DataFrame, block_rows: int) -> DataFrame:
    """``rows`` with ``_block``: the changes of a product in order, about ``block_rows`` of them a block."""
    chunks = rows.groupBy("product_id", block_of("seq").alias("_chunk")).agg(F.count("*").alias("_n"))
    earlier = sum_before(chunks, ["product_id"], "_chunk", {"_earlier": "_n"}, levels=1)
    blocks = earlier.select("product_id", "_chunk", F.floor(F.col("_earlier") / block_rows).alias("_block"))
    return rows.withColumn("_chunk", block_of("seq")).join(blocks, ["product_id", "_chunk"]).drop("_chunk")


def _first_starts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bounds that hold without a walk: (product, block, left_low, left_high) and the lines of every block."""
    takes = F.when((F.col("op") != "delete") & ~F.col("moved"), F.col("quantity")).otherwise(0)
    held = F.when(F.col("has_line"), F.col("held")).otherwise(0)
    lines = rows.groupBy(*_LINE).agg(
        F.min("_block").alias("_first"),
        F.greatest(F.max(takes), F.max(held)).cast("long").alias("_most"),
        F.first("has_line").alias("has_line"),
        F.max(held).cast("long").alias("held"),
        F.first("born").alias("born"),
    )
    # Stock and all lines together never grow.
    total = lines.groupBy("product_id").agg(F.sum("held").alias("_held"))
    before = Window.partitionBy("product_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    stock = (
        rows.groupBy(*_AT)
        .agg(F.sum(takes).alias("_takes"), F.first("available").cast("long").alias("available"))
        .join(total, "product_id")
        .withColumn("_taken", F.coalesce(F.sum("_takes").over(before), F.lit(0)))
    )
    first = F.col("_block") == 0
    low = F.greatest(F.col("available") - F.col("_taken"), F.least(F.col("available"), F.lit(0)))
    starts = stock.select(
        *_AT,
        F.when(first, F.col("available")).otherwise(low).alias("left_low"),
        F.when(first, F.col("available")).otherwise(F.col("available") + F.col("_held")).alias("left_high"),
    )
    untouched = F.col("_block") == F.col("_first")
    line_starts = rows.select(*_LINE, "_block").distinct().join(lines, _LINE).select(
        *_LINE, "_block",
        (untouched & F.col("has_line")).alias("certain"),
        (~untouched | F.col("has_line")).alias("possible"),
        F.when(untouched, F.col("held")).otherwise(1).alias("line_low"),
        F.when(untouched, F.col("held")).otherwise(F.col("_most")).alias("line_high"),
        F.when(untouched, F.col("born")).alias("line_born"),
        # What the line is before any change, for blocks that no earlier one has changed it for.
        F.struct("has_line", "held", "born").alias("_origin"),
    )
    return starts, line_starts


def _walked(rows: DataFrame, starts: DataFrame, line_starts: DataFrame) -> DataFrame:
    """What each block leaves, from bounds at its start."""
    given = rows.select(*_AT, "seq", "op", "order_id", F.col("quantity").cast("long").alias("quantity"), "moved")
    given = given.join(starts, _AT).join(line_starts.drop("_origin"), [*_LINE, "_block"])
    in_order = given.repartition(*_AT).sortWithinPartitions(*_AT, "seq")
    return pin(in_order.mapInArrow(bound_blocks, ENDS))


def _next_starts(ends: DataFrame, starts: DataFrame, line_starts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bounds at the start of every block from what the blocks before it leave."""
    order = Window.partitionBy("product_id").orderBy("_block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    stock = starts.join(ends.where("order_id is null").select(*_AT, "least", "cap", "most", "floor"), _AT)
    # Steps max(s - a, b) in a row: max(s, largest of b + sum of a up to it) - sum of all a.
    sums = stock.select(
        "*",
        *[F.sum(c).over(order).alias(f"_{c}") for c in ("least", "most")],
        *[F.first(c).over(order).alias(f"_{c}") for c in ("left_low", "left_high")],
    )
    new = sums.select(
        *_AT,
        F.greatest(
            "left_low",
            F.greatest("_left_low", F.max(F.col("floor") + F.col("_most")).over(before)) - (F.col("_most") - F.col("most")),
        ).alias("left_low"),
        F.least(
            "left_high",
            F.greatest("_left_high", F.max(F.col("cap") + F.col("_least")).over(before)) - (F.col("_least") - F.col("least")),
        ).alias("left_high"),
    )
    along = Window.partitionBy(*_LINE).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    states = line_starts.join(
        ends.where("order_id is not null").select(*_LINE, "_block", F.struct("certain", "possible", "low", "high", "born").alias("_end")),
        [*_LINE, "_block"], "left",
    ).withColumn("_last", F.last("_end", True).over(along))
    known = F.col("_last").isNotNull()
    return pin(new), pin(
        states.select(
            *_LINE, "_block",
            F.when(known, F.col("_last.certain")).otherwise(F.col("_origin.has_line")).alias("certain"),
            F.when(known, F.col("_last.possible")).otherwise(F.col("_origin.has_line")).alias("possible"),
            F.when(known, F.col("_last.low")).otherwise(F.col("_origin.held")).alias("line_low"),
            F.when(known, F.col("_last.high")).otherwise(F.col("_origin.held")).alias("line_high"),
            F.when(known, F.col("_last.born")).otherwise(F.col("_origin.born")).alias("line_born"),
            "_origin",
        )
    )


def _open(starts: DataFrame, line_starts: DataFrame) -> DataFrame:
    """Blocks whose start is not exact."""
    vague = (F.col("certain") != F.col("possible")) | (
        F.col("possible") & ((F.col("line_low") != F.col("line_high")) | F.col("line_born").isNull())
    )
    return starts.where("left_low <> left_high").select(*_AT).unionByName(line_starts.where(vague).select(*_AT)).distinct()


def exact_starts(rows: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """``rows`` cut into blocks, with stock and line as they are at the start of the block; and how many rounds it took.

    ``rows`` are changes of products whose stock is known, with columns available, has_line, held and born.
    """
    rows = pin(cut(rows, block_rows))
    starts, line_starts = map(pin, _first_starts(rows))
    open_, rounds, ends = pin(_open(starts, line_starts)), 0, None
    while not open_.isEmpty():
        rounds += 1
        # Blocks that were exact when they were walked are not walked again.
        again = rows if ends is None else rows.join(walk_again, _AT, "left_semi")
        found = _walked(again, starts, line_starts)
        ends = found if ends is None else pin(ends.join(walk_again, _AT, "left_anti").unionByName(found))
        walk_again = open_
        starts, line_starts = _next_starts(ends, starts, line_starts)
        open_ = pin(_open(starts, line_starts))
    exact = rows.drop("available", "has_line", "held", "born").join(
        starts.select(*_AT, F.col("left_low").cast("int").alias("available")), _AT
    ).join(
        line_starts.select(
            *_LINE, "_block", F.col("certain").alias("has_line"),
            F.when(F.col("certain"), F.col("line_low")).cast("int").alias("held"),
            F.coalesce("line_born", F.lit(False)).alias("born"),
        ),
        [*_LINE, "_block"],
    )
    return exact.select(*rows.columns), rounds
