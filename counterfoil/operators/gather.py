"""Collect the children of a parent in id order, in pieces of bounded size.

Children are first grouped by (parent, id block): at most 65,536 different ids per
group, so no task sorts or holds all children of a hot parent while it builds names,
labels or structs. The pieces, already in order, are then put together into the one
value the result asks for. Where even that value is too large for a row, the
``*_parts`` forms return the pieces themselves.

Rows are repartitioned by (parent, block) by name: after a join on the parent key Spark
would otherwise keep all blocks of a hot parent in the task where the join left them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.operators.sequence import BLOCK_ROWS, block_of, sum_before


def _in_pieces(df: DataFrame, keys: Sequence[str], order_id: str, copies: str) -> DataFrame:
    """Cut repeated children so that no (part, piece) holds more than 65,536 copies in all.

    Copies lie end to end in id order within their block; a row is split where a multiple
    of the piece size falls between its copies. ``copies`` becomes the count per piece.
    """
    blocks = df.withColumn("part", block_of(order_id))
    spread = blocks.repartition(*keys, "part")
    placed = sum_before(spread, [*keys, "part"], order_id, {"_start": copies}, levels=0)
    last = F.col("_start") + F.col(copies) - 1
    spanned = F.sequence(block_of("_start"), block_of(last))
    cut = placed.withColumn("piece", F.explode(spanned))
    first = F.greatest(F.col("_start"), F.col("piece") * BLOCK_ROWS)
    until = F.least(last, F.col("piece") * BLOCK_ROWS + (BLOCK_ROWS - 1))
    return cut.withColumn(copies, until - first + 1).drop("_start")


def _repeat(item: Column, copies: str) -> Column:
    return F.array_repeat(item, F.col(copies).cast("int"))


def _text_groups(
    df: DataFrame, by: Sequence[str], order_id: str, label: str, sep: str, copies: str | None
) -> DataFrame:
    text = F.col(label) if copies is None else F.array_join(_repeat(F.col(label), copies), sep)
    sorted_texts = F.sort_array(F.collect_list(F.struct(F.col(order_id).alias("i"), text.alias("t"))))
    joined = F.array_join(F.transform(sorted_texts, lambda p: p["t"]), sep)
    return df.repartition(*by).groupBy(*by).agg(joined.alias("text"))


def text_parts(
    df: DataFrame, keys: Sequence[str], order_id: str, label: str, sep: str, copies: str | None = None
) -> DataFrame:
    """One row per (keys, part): the labels of one id block joined by ``sep``, in id order.

    NULL labels are skipped. ``copies`` names a count column: the label is then repeated,
    and a part falls into pieces of at most 65,536 labels.
    """
    labelled = df.where(F.col(label).isNotNull())
    if copies:
        pieces = _in_pieces(labelled, keys, order_id, copies)
        return _text_groups(pieces, [*keys, "part", "piece"], order_id, label, sep, copies)
    return _text_groups(
        labelled.withColumn("part", block_of(order_id)), [*keys, "part"], order_id, label, sep, None
    )


def text_pieces(
    df: DataFrame, keys: Sequence[str], order_id: str, labels: DataFrame, label: str, sep: str, copies: str
) -> DataFrame:
    """``text_parts`` with ``copies``, of children that get their label by ``order_id`` from ``labels``.

    Pieces are cut before labels are looked up, so that texts are shuffled once. Children without a label leave room in theirs.
    """
    pieces = _in_pieces(df, keys, order_id, copies).join(labels.where(F.col(label).isNotNull()), order_id)
    return _text_groups(pieces, [*keys, "part", "piece"], order_id, label, sep, copies)


def gather_text(
    df: DataFrame, keys: Sequence[str], order_id: str, label: str, sep: str, out: str, copies: str | None = None
) -> DataFrame:
    """One row per keys: all labels joined by ``sep``; keys without a label are absent."""
    labelled = df.where(F.col(label).isNotNull()).withColumn("part", block_of(order_id))
    parts = F.sort_array(F.collect_list(F.struct("part", "text")))
    return (
        _text_groups(labelled, [*keys, "part"], order_id, label, sep, copies)
        .groupBy(*keys)
        .agg(F.array_join(F.transform(parts, lambda p: p["text"]), sep).alias(out))
    )


def _array_groups(df: DataFrame, by: Sequence[str], order_id: str, item: Column, copies: str | None) -> DataFrame:
    """Rows are shuffled with their plain columns; items are made behind the shuffle.

    Items of the same columns under other names, as the house styles have them, then come from one shuffle.
    """
    count = F.col(copies).cast("int") if copies else F.lit(1)
    # A child without id, which outer joins leave, comes first.
    place = F.coalesce(F.col(order_id), F.lit(-1))
    children = df.repartition(*by).select(*by, place.alias("_i"), item.alias("_item"), count.alias("_n"))
    in_order = F.sort_array(F.collect_list(F.struct("_i", "_item", "_n")))
    items = F.transform(in_order, lambda p: p["_item"])
    if copies:
        items = F.flatten(F.transform(in_order, lambda p: F.array_repeat(p["_item"], p["_n"])))
    return children.groupBy(*by).agg(items.alias("items"))


def array_parts(
    df: DataFrame, keys: Sequence[str], order_id: str, item: Column, copies: str | None = None
) -> DataFrame:
    """One row per (keys, part): the items of one id block as an array, in id order.

    With ``copies`` a part falls into pieces of at most 65,536 items.
    """
    if copies:
        pieces = _in_pieces(df, keys, order_id, copies)
        return _array_groups(pieces, [*keys, "part", "piece"], order_id, item, copies)
    return _array_groups(df.withColumn("part", block_of(order_id)), [*keys, "part"], order_id, item, None)


def gather_array(
    df: DataFrame, keys: Sequence[str], order_id: str, item: Column, out: str, copies: str | None = None
) -> DataFrame:
    """One row per keys with the array of all its items in id order."""
    rows = df.withColumn("part", F.coalesce(block_of(order_id), F.lit(-1)))
    parts = F.sort_array(F.collect_list(F.struct("part", "items")))
    return (
        _array_groups(rows, [*keys, "part"], order_id, item, copies)
        .groupBy(*keys)
        .agg(F.flatten(F.transform(parts, lambda p: p["items"])).alias(out))
    )
