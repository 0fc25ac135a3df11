"""Sales of any range of days from sums of aligned blocks of 1, 2, 4, ... days.

A day lies in one block of each size. Sums are kept per product and block, and changes of lines add to them.
Any range of days is at most two blocks of each size, so a report reads some thirty rows of a product, whatever the
range and however many lines there are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.model import MONEY, Pos
from counterfoil.operators.money import with_line_total

#: Sizes of blocks are powers of two below this one; the largest have 32,768 days.
LEVELS = 16
_EPOCH = dt.date(1970, 1, 1)
#: Lines and priced lines tell when a sum is gone or unknown.
SUMS = ("lines", "priced", "quantity", "amount")


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    kinds = dict.fromkeys(SUMS, "long") | {"amount": MONEY}
    return rows.groupBy(*by).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in kinds.items()])


def _of_days(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Sums per product and day of ``lines`` (order_id, product_id, and the sums of one line); orders without date count nowhere."""
    dated = orders.where("datePlaced is not null").select(F.col("id").alias("order_id"), F.unix_date("datePlaced").alias("day"))
    # Lines of an order and product are few; sums over products and days follow the look-up of the day.
    return _summed(lines.join(dated, "order_id"), "product_id", "day")


def day_sums(pos: Pos) -> DataFrame:
    """(product_id, day, lines, priced, quantity, amount) of all lines."""
    one = with_line_total(pos.lines).select(
        "order_id", "product_id", F.lit(1).alias("lines"), F.col("lineTotal").isNotNull().cast("int").alias("priced"),
        "quantity", F.coalesce("lineTotal", F.lit(0)).alias("amount"),
    )
    return _of_days(one, pos.orders)


def changed_days(accepted: DataFrame, orders: DataFrame) -> DataFrame:
    """What accepted changes of lines add to ``day_sums``."""
    sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    changes = accepted.select(
        "order_id", "product_id", sign.alias("lines"),
        F.when(F.col("unit_price").isNotNull(), sign).otherwise(0).alias("priced"),
        F.col("delta").alias("quantity"),
        F.coalesce(F.col("delta") * F.col("unit_price"), F.lit(0)).cast(MONEY).alias("amount"),
    )
    return _of_days(changes, orders)


def blocks(days: DataFrame) -> DataFrame:
    """(product_id, level, block, sums): level l has blocks of 2**l days, numbered from 1970 on."""
    # A product has a row a day at most, so its days are brought together once and no block is shuffled. Each row becomes
    # a row per level, hence more tasks.
    tasks = 4 * int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level")
    placed = days.repartition(tasks, "product_id").select("*", levels).withColumn("block", F.expr("shiftright(day, level)"))
    return _summed(placed, "product_id", "level", "block")


def updated(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """``stored`` blocks after ``changes`` (``changed_days``); blocks without lines go."""
    # Blocks of one day are the days' sums; the larger ones are put together from them again.
    days = stored.where("level = 0").select("product_id", F.col("block").alias("day"), *SUMS)
    both = _summed(days.unionByName(changes), "product_id", "day")
    return blocks(both).where("lines <> 0")


def cover(start: dt.date, end: dt.date) -> list[tuple[int, int]]:
    """The blocks (level, block) that make up the days from ``start`` to ``end``, both included; none if end is before start."""
    low, high = (start - _EPOCH).days, (end - _EPOCH).days + 1
    found = []
    for level in range(LEVELS):
        if low >= high:
            break
        if level == LEVELS - 1:
            found += [(level, block) for block in range(low, high)]
            break
        if low & 1:
            found.append((level, low))
            low += 1
        if high & 1:
            high -= 1
            found.append((level, high))
        low, high = low >> 1, high >> 1
    return found


def _within(start: dt.date, end: dt.date) -> Column:
    wanted = F.lit(False)
    by_level: dict[int, list[int]] = {}
    for level, block in cover(start, end):
        by_level.setdefault(level, []).append(block)
    for level, numbers in by_level.items():
        wanted |= (F.col("level") == level) & F.col("block").isin(numbers)
    return wanted


def sales_report(
    stored: DataFrame, products: DataFrame, start: dt.date, end: dt.date, product_id: int | None = None
) -> DataFrame:
    """``money.sales_report`` from stored blocks; no line and no order is read."""
    rows = stored.where(_within(start, end))
    if product_id is not None:
        rows = rows.where(F.col("product_id") == product_id)
    totals = _summed(rows, "product_id").where("lines <> 0").select(
        F.col("product_id").alias("Product ID"),
        F.col("quantity").alias("Quantity Sold"),
        F.when(F.col("priced") > 0, F.col("amount")).alias("Total Sales Amount"),
    )
    known = totals.join(products.select(F.col("id").alias("Product ID")), "Product ID")
    if product_id is None:
        return known
    return known.agg(*[F.max(f"`{name}`").alias(name) for name in known.columns])
