"""Order-line changes applied as sets: validation, stock guard, totals, tax.

A change is a row (op, seq, order_id, product_id, quantity, new_order_id, new_product_id);
``op`` is insert, update or delete, ``seq`` is unique and gives the order in which the
changes were made. The new ids are only set on an update that tries to move a line.

Whether a change is accepted can depend on every earlier change of its product, because
a rejected change uses no stock. Only products that could run out need that row-by-row
look: a product whose known stock covers all quantities asked for in the batch, or whose
stock is unknown, is decided with window functions alone. The rest is walked, product by
product; the changes of a product are cut into blocks of bounded size, and where there are
several, ``stock_blocks`` finds out what each block starts from, so that all are walked at once.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions.stock_fold import (
    ALREADY_THERE, BAD_OP, FOLDED, KEY_CHANGE, NO_KEY, NO_LINE, NO_ORDER, NO_PRODUCT, fold_products,
)
from counterfoil.model import MONEY, PRICE, Pos
from counterfoil.operators.money import sales_tax
from counterfoil.operators.prices import apply_price_changes
from counterfoil.operators.sequence import BLOCK_ROWS, LEVELS, value_before
from counterfoil.operators.stock_blocks import exact_starts
from counterfoil.session import passing_shuffles, pin

BATCH = "Another change of the batch was rejected"

_log = logging.getLogger(__name__)

DECISION = [
    "op", "seq", "order_id", "product_id", "quantity", "accepted", "reason", "old_quantity", "delta", "unit_price",
]


def clamp_quantity(quantity: Column) -> Column:
    """Missing or below one -> one."""
    return F.when(quantity.isNull() | (quantity < 1), 1).otherwise(quantity)


def _prepared(changes: DataFrame, lines: DataFrame, products: DataFrame, orders: DataFrame | None) -> DataFrame:
    """Changes with their line, price and stock; ``_changes`` where stock may run short. Lines are cut down to the touched keys first."""
    # New ids say something on updates only; every decider sees the same flag.
    moved = F.coalesce(F.col("op") == "update", F.lit(False)) & (
        F.coalesce(F.col("new_order_id") != F.col("order_id"), F.lit(False))
        | F.coalesce(F.col("new_product_id") != F.col("product_id"), F.lit(False))
    )
    rows = changes.select(
        "op", "seq", "order_id", "product_id",
        F.when(F.col("op") != "delete", clamp_quantity(F.col("quantity"))).cast("int").alias("quantity"),
        moved.alias("moved"),
    )
    # What is known of the keys and of the products is put together first, so that the changes themselves, which are wide,
    # are shuffled once for each. Changes without a key find nothing, and are refused for that.
    keys = ["order_id", "product_id"]
    touched = changes.select(*keys).distinct()
    held = lines.join(touched, keys, "left_semi").select(
        *keys, F.col("quantity").alias("held"), F.col("unitPrice").alias("held_price"), F.lit(True).alias("has_line")
    )
    touched = touched.join(held, keys, "left")
    if orders is None:
        touched = touched.withColumn("known_order", F.lit(True))
    else:
        known = orders.select(F.col("id").alias("order_id")).join(
            changes.select("order_id").distinct(), "order_id", "left_semi"
        )
        touched = touched.join(known.withColumn("known_order", F.lit(True)), "order_id", "left")
    stock = products.select(
        F.col("id").alias("product_id"), "currentPrice", F.col("availableQuantity").alias("available"),
        F.lit(True).alias("known_product"),
    ).join(_short_products(changes, products), "product_id", "left")
    # Written: disks hold the shuffles of the keys or those of the changes.
    rows = rows.join(pin(touched), keys, "left").join(stock, "product_id", "left")
    insert = F.col("op") == "insert"
    keyless = F.col("order_id").isNull() | F.col("product_id").isNull() | F.col("seq").isNull()
    refused = (
        F.when(keyless, NO_KEY)
        .when(~F.coalesce(F.col("op").isin("insert", "update", "delete"), F.lit(False)), BAD_OP)
        .when(insert & F.col("known_order").isNull(), NO_ORDER)
        .when(insert & F.col("known_product").isNull(), NO_PRODUCT)
    )
    return rows.select(
        "op", "seq", "order_id", "product_id", "quantity", "moved", "available", "currentPrice", "held", "held_price",
        F.coalesce("has_line", F.lit(False)).alias("has_line"), F.lit(False).alias("born"), refused.alias("refused"),
        "_changes",
    )


def _short_products(changes: DataFrame, products: DataFrame) -> DataFrame:
    """Products whose known stock is below all that is asked for, with the number of their changes."""
    asked = F.sum(F.when(F.col("op") != "delete", clamp_quantity(F.col("quantity"))))
    demand = changes.groupBy("product_id").agg(asked.alias("_asked"), F.count("*").alias("_changes"))
    stock = products.select(F.col("id").alias("product_id"), "availableQuantity")
    return (
        demand.join(stock, "product_id")
        .where(F.col("_asked") > F.col("availableQuantity"))
        .select("product_id", "_changes")
    )


def _decide_free(rows: DataFrame, levels: int) -> DataFrame:
    """Decisions where stock cannot run out: only the life of each line matters."""
    line = ["product_id", "order_id"]
    op = F.col("op")
    # Whether a line is there depends on the last insert or delete, accepted or not.
    rows = value_before(rows, line, "seq", {"put_there": F.when(op != "update", op == "insert")}, levels)
    there = F.coalesce("put_there", "has_line")
    reason = (
        F.when((op == "insert") & F.col("there"), ALREADY_THERE)
        .when((op != "insert") & ~F.col("there"), NO_LINE)
        .when(F.col("moved"), KEY_CHANGE)
    )
    rows = rows.withColumn("there", there).withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())
    rows = value_before(
        rows,
        line,
        "seq",
        {
            "set_quantity": F.when(F.col("accepted") & (op != "delete"), F.col("quantity")),
            "reborn": F.when(F.col("accepted") & (op == "insert"), F.lit(True)),
        },
        levels,
    )
    old = F.when(F.col("there"), F.coalesce("set_quantity", "held"))
    return rows.withColumn("old_quantity", old).withColumn("born", F.coalesce("reborn", F.col("born")))


def _delta() -> Column:
    """Stock taken by the change; negative when it gives stock back."""
    op = F.col("op")
    return (
        F.when(op == "insert", F.col("quantity"))
        .when(op == "update", F.col("quantity") - F.col("old_quantity"))
        .otherwise(-F.col("old_quantity"))
    )


def _decide_tight(rows: DataFrame, block_rows: int, crowded: bool) -> DataFrame:
    """Decisions where stock may run out: each block of a product's changes is walked from its exact start."""
    many = F.col("_changes") > block_rows
    blocks = rows.where(~many).withColumn("_block", F.lit(0).cast("long")) if crowded else rows.withColumn(
        "_block", F.lit(0).cast("long")
    )
    if crowded:
        cut, rounds = exact_starts(rows.where(many), block_rows)
        _log.info("starts of all blocks of changes exact after %d rounds", rounds)
        blocks = blocks.unionByName(cut)
    schema = T.StructType([*blocks.schema.fields, *T.StructType.fromDDL(FOLDED).fields])
    in_order = blocks.repartition("product_id", "_block").sortWithinPartitions("product_id", "_block", "seq")
    walked = in_order.mapInArrow(fold_products, schema)
    return walked.drop("born", "_block", "_changes").withColumnRenamed("was_born", "born")


def decide_changes(
    changes: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    orders: DataFrame | None = None,
    mode: str = "row",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every change with ``accepted``, the ``reason`` if not, and what it does to stock and totals.

    ``row``: each change stands alone, a rejected one leaves no trace. ``batch``: one
    rejected change rejects all. With ``orders`` given, inserts for unknown orders are
    rejected as well.
    """
    # Looked up once and written out; both ways to decide below read it.
    prepared = pin(_prepared(changes, lines, products, orders))
    ready = prepared.where(F.col("refused").isNull()).drop("refused")
    per_line = prepared.groupBy("product_id", "order_id").agg(
        F.count("*").alias("n"), F.max("_changes").alias("_changes")
    )
    with passing_shuffles(changes.sparkSession):
        longest, most = per_line.agg(F.max("n"), F.max("_changes")).first()
    free = ready.where(F.col("_changes").isNull()).drop("_changes")
    decided = [_decide_free(free, levels=LEVELS if (longest or 0) > block_rows else 0)]
    if most:
        decided.append(_decide_tight(ready.where(F.col("_changes").isNotNull()), block_rows, most > block_rows))
    refused = prepared.where(F.col("refused").isNotNull()).drop("_changes")
    decided.append(
        refused.withColumnsRenamed({"refused": "reason"})
        .withColumn("accepted", F.lit(False))
        .withColumn("old_quantity", F.lit(None).cast("int"))
    )
    delta = F.when(F.col("accepted"), _delta())
    price = F.when(F.col("accepted") & ((F.col("op") == "insert") | F.col("born")), F.col("currentPrice")).when(
        F.col("accepted"), F.col("held_price")
    )
    parts = [part.withColumn("delta", delta).withColumn("unit_price", price).select(*DECISION) for part in decided]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    if mode == "batch":
        result = pin(result)
        bad = result.agg(F.count_if(~F.col("accepted")).alias("n")).scalar()
        result = result.withColumn(
            "reason", F.coalesce("reason", F.when(bad > 0, F.lit(BATCH)))
        ).withColumn("accepted", F.col("reason").isNull())
    return result


def validate_changes(
    changes: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    orders: DataFrame | None = None,
    mode: str = "row",
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reason); decided once and written out."""
    decided = pin(decide_changes(changes, lines, products, orders, mode, block_rows))
    return decided.where("accepted"), decided.where(~F.col("accepted"))


def or_fail(decisions: DataFrame) -> DataFrame:
    """The decisions; running them fails with the reason of a rejected change."""
    return decisions.withColumn(
        "accepted", F.when(F.col("accepted"), F.lit(True)).otherwise(F.raise_error(F.col("reason")).cast("boolean"))
    )


def batch_stock_check(changes: DataFrame, products: DataFrame) -> DataFrame:
    """For a batch of inserts: per product the quantity asked for, the stock, and whether it fits."""
    asked = (
        changes.where(F.col("op") == "insert")
        .groupBy("product_id")
        .agg(F.sum(clamp_quantity(F.col("quantity"))).alias("requested"))
    )
    stock = products.select(F.col("id").alias("product_id"), F.col("availableQuantity").alias("available"))
    fits = F.coalesce(F.col("requested") <= F.col("available"), F.lit(True))
    return asked.join(stock, "product_id", "left").withColumn("fits", fits)


@dataclass(frozen=True)
class Touched:
    """Keys that accepted changes reached."""

    orders: DataFrame
    customers: DataFrame
    products: DataFrame


def stock_use(accepted: DataFrame) -> DataFrame:
    return accepted.groupBy("product_id").agg(F.sum("delta").alias("used"))


def line_images(accepted: DataFrame) -> DataFrame:
    """The last state of every changed line; ``gone`` when it was deleted."""
    last = F.max_by(F.struct("op", "quantity", "unit_price"), "seq")
    return accepted.groupBy("order_id", "product_id").agg(last.alias("_last")).select(
        "order_id", "product_id",
        F.col("_last.quantity").alias("quantity"),
        F.col("_last.unit_price").cast(PRICE).alias("unitPrice"),
        (F.col("_last.op") == "delete").alias("gone"),
    )


def order_deltas(accepted: DataFrame) -> DataFrame:
    """Per order: ``added`` money, and whether a change of unknown price made the total unknown.

    A line without price turns the total into NULL; the next change starts from zero
    again. So only the changes after the last priceless one count.
    """
    amounts = accepted.select(
        F.col("order_id").alias("id"), "seq", (F.col("delta") * F.col("unit_price")).cast(MONEY).alias("amount")
    )
    sums = amounts.groupBy("id").agg(
        F.sum("amount").cast(MONEY).alias("_all"),
        F.max(F.when(F.col("amount").isNull(), F.col("seq"))).alias("_unknown_at"),
    )
    # Few orders have such a change; only theirs are summed again.
    unknown = sums.where(F.col("_unknown_at").isNotNull()).select("id", "_unknown_at")
    after = (
        amounts.join(unknown, "id")
        .where(F.col("seq") > F.col("_unknown_at"))
        .groupBy("id")
        .agg(F.sum("amount").cast(MONEY).alias("_after"))
    )
    reset = F.col("_unknown_at").isNotNull()
    return sums.join(after, "id", "left").select(
        "id", F.when(reset, F.col("_after")).otherwise(F.col("_all")).alias("added"), reset.alias("reset")
    )


def new_subtotal(null_subtotal: str = "zero") -> Column:
    """Subtotal after the changes, over columns subtotal, added, reset.

    ``zero``: a NULL subtotal counts as 0. ``keep``: it stays NULL.
    """
    if null_subtotal == "keep":
        return F.when(~F.col("reset"), F.col("subtotal") + F.col("added")).cast(MONEY)
    start = F.when(F.col("reset"), F.lit(0)).otherwise(F.coalesce("subtotal", F.lit(0)))
    return (start + F.col("added")).cast(MONEY)


def apply_changes(pos: Pos, accepted: DataFrame, null_subtotal: str = "zero") -> tuple[Pos, Touched]:
    """The tables after the accepted changes: stock, lines, subtotals and tax of touched orders."""
    use = stock_use(accepted).withColumnRenamed("product_id", "id")
    stock = (F.col("availableQuantity") - F.coalesce("used", F.lit(0))).cast("int")
    products = pos.products.join(use, "id", "left").select(
        *[stock.alias(c) if c == "availableQuantity" else F.col(c) for c in pos.products.columns]
    )

    # The few changed lines leave and come back; the rest is not shuffled for them.
    images = line_images(accepted)
    kept = pos.lines.join(images.select("order_id", "product_id"), ["order_id", "product_id"], "left_anti")
    lines = kept.select(*pos.lines.columns).unionByName(images.where(~F.col("gone")).drop("gone"))

    deltas = order_deltas(accepted)
    subtotal = F.when(F.col("reset").isNotNull(), new_subtotal(null_subtotal)).otherwise(F.col("subtotal"))
    orders = pos.orders.join(deltas, "id", "left").select(
        *[subtotal.alias(c) if c == "subtotal" else F.col(c) for c in pos.orders.columns]
    )
    touched_orders = accepted.select(F.col("order_id").alias("id")).distinct()
    orders = sales_tax(orders, pos.customers, pos.tax_rates, touched=touched_orders)
    touched = Touched(
        orders=touched_orders,
        customers=pos.orders.join(touched_orders, "id", "left_semi").select("customer_id").distinct(),
        products=accepted.select("product_id").distinct(),
    )
    return pos.with_(products=products, lines=lines, orders=orders), touched


def at_price(accepted: DataFrame, price_changes: DataFrame) -> DataFrame:
    """Accepted changes with the price each line was inserted at.

    Line and price changes share one numbering: an insert takes the last price that was
    set before it, and later changes of that line keep it. Stock decisions do not depend on
    prices, so they are made first.
    """
    inserted = F.col("op") == "insert"
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("long")
    events = accepted.where(inserted).select("product_id", "seq", "order_id", F.lit(None).cast(PRICE).alias("price"), "op")
    events = events.unionByName(
        price_changes.select("product_id", "seq", no_number.alias("order_id"), F.col("price").cast(PRICE).alias("price"), no_text.alias("op"))
    )
    set_price = F.when(F.col("op").isNull(), F.struct("price"))
    at_insert = value_before(events, ["product_id"], "seq", {"_set": set_price}).where("op is not null")
    born = accepted.join(at_insert.select("seq", "product_id", "_set"), ["seq", "product_id"], "left").withColumn(
        "_price", F.when(F.col("_set").isNotNull(), F.col("_set.price")).otherwise(F.col("unit_price"))
    )
    last_insert = F.when(inserted, F.struct(F.col("_price").alias("price")))
    placed = value_before(born, ["order_id", "product_id"], "seq", {"_birth": last_insert}, levels=0)
    price = (
        F.when(inserted, F.col("_price")).when(F.col("_birth").isNotNull(), F.col("_birth.price")).otherwise(F.col("unit_price"))
    )
    return placed.select(*[price.alias(c) if c == "unit_price" else F.col(c) for c in accepted.columns])


def apply_events(pos: Pos, changes: DataFrame, price_changes: DataFrame) -> tuple[Pos, Touched, DataFrame]:
    """Line and price changes of one feed, in ``seq`` order; returns the tables, touched keys and rejected changes.

    The price history grows by the real price changes; those of unknown products are rejected, with the columns of a
    rejected line change and their price.
    """
    ok, rejected = validate_changes(changes, pos.lines, pos.products, pos.orders)
    known = pos.products.select(F.col("id").alias("product_id"))
    unknown = price_changes.join(known, "product_id", "left_anti").select(
        F.lit("price").alias("op"), "seq", "product_id", F.col("price").cast(PRICE).alias("price"),
        F.lit(False).alias("accepted"), F.lit(NO_PRODUCT).alias("reason"),
    )
    rejected = rejected.unionByName(unknown, allowMissingColumns=True)
    after, touched = apply_changes(pos, pin(at_price(ok, price_changes)))
    products, history = apply_price_changes(after.products, price_changes)
    return after.with_(products=products, price_history=pos.price_history.unionByName(history)), touched, rejected


def add_items(pos: Pos, items: DataFrame) -> tuple[Pos, Touched, DataFrame]:
    """Insert items (order_id, product_id, quantity, seq); returns the tables, touched keys and rejects."""
    changes = items.select(
        F.lit("insert").alias("op"), "seq", "order_id", "product_id", "quantity",
        F.lit(None).cast("long").alias("new_order_id"), F.lit(None).cast("long").alias("new_product_id"),
    )
    ok, rejected = validate_changes(changes, pos.lines, pos.products, pos.orders)
    after, touched = apply_changes(pos, ok)
    return after, touched, rejected
