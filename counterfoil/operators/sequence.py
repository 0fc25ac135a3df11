"""Running sums and previous values over long ordered sequences.

A plain window sorts a whole key group in one task. Here the order column, a unique
whole number, is cut into blocks of 2**16 positions. The row-level window runs inside
(key, block), which holds at most 65,536 rows whatever the skew of the key. What a block
passes on to later ones is worked out the same way, over blocks of blocks, so that with
three levels no window holds more than 65,536 rows of a key, whatever its 64-bit positions.

The rows are repartitioned by (key, block) by name. Left to itself Spark keeps rows that
a join has already brought together by key alone, and a hot key would stay in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16
BLOCK_ROWS = 1 << BLOCK_BITS
LEVELS = 3
_BLOCK = "_seq_block"


def block_of(seq: str | Column) -> Column:
    return F.shiftright(F.col(seq) if isinstance(seq, str) else seq, BLOCK_BITS)


def _before(keys: Sequence[str], order: str):
    # Without keys the last window, over the few blocks of the top level, is one group.
    return (
        Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )


def sum_before(
    df: DataFrame, keys: Sequence[str], seq: str, sums: Mapping[str, str], levels: int = LEVELS
) -> DataFrame:
    """Add, per entry out -> column of ``sums``, the sum over earlier rows of the same keys.

    ``levels=0`` is for callers who know that no key has more rows than one block.
    """
    keys = list(keys)

    def earlier(window) -> list[Column]:
        return [F.coalesce(F.sum(value).over(window), F.lit(0)).alias(out) for out, value in sums.items()]

    if levels == 0:
        return df.select("*", *earlier(_before(keys, seq)))
    rows = df.withColumn(_BLOCK, block_of(seq))
    blocks = rows.groupBy(*keys, F.col(_BLOCK).alias("_pos")).agg(*[F.sum(v).alias(v) for v in sums.values()])
    carried = sum_before(blocks, keys, "_pos", {f"_carried_{out}": v for out, v in sums.items()}, levels - 1)
    return (
        rows.repartition(*keys, _BLOCK)
        .select("*", *earlier(_before([*keys, _BLOCK], seq)))
        .join(carried.drop(*sums.values()).withColumnRenamed("_pos", _BLOCK), [*keys, _BLOCK])
        .select(*df.columns, *[(F.col(out) + F.col(f"_carried_{out}")).alias(out) for out in sums])
    )


def value_before(
    df: DataFrame, keys: Sequence[str], seq: str, values: Mapping[str, Column], levels: int = LEVELS
) -> DataFrame:
    """Add, per entry of ``values``, the last non-NULL value of an earlier row of the same keys.

    ``levels=0`` is for callers who know that no key has more rows than one block.
    """
    keys = list(keys)

    def earlier(window, named: Mapping[str, Column]) -> list[Column]:
        return [F.last(value, True).over(window).alias(name) for name, value in named.items()]

    if levels == 0:
        return df.select("*", *earlier(_before(keys, seq), values))
    inside = {f"_in_{name}": F.col(f"_v_{name}") for name in values}
    rows = df.select("*", block_of(seq).alias(_BLOCK), *[v.alias(f"_v_{name}") for name, v in values.items()])
    last = [
        F.max_by(f"_v_{name}", F.when(F.col(f"_v_{name}").isNotNull(), F.col(seq))).alias(f"_v_{name}")
        for name in values
    ]
    blocks = rows.groupBy(*keys, F.col(_BLOCK).alias("_pos")).agg(*last)
    carried = value_before(
        blocks, keys, "_pos", {f"_carried_{name}": F.col(f"_v_{name}") for name in values}, levels - 1
    ).select(*keys, F.col("_pos").alias(_BLOCK), *[f"_carried_{name}" for name in values])
    return (
        rows.repartition(*keys, _BLOCK)
        .select("*", *earlier(_before([*keys, _BLOCK], seq), inside))
        .join(carried, [*keys, _BLOCK])
        .select(*df.columns, *[F.coalesce(f"_in_{name}", f"_carried_{name}").alias(name) for name in values])
    )
