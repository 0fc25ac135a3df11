"""Derived money columns, sales tax and the sales report."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.model import MONEY, PRICE, Pos

# Fixed value: added before rounding, so that a product just below half a cent rounds up.
EPSILON = Decimal("0.000001")


def line_total(quantity: Column, unit_price: Column) -> Column:
    return (quantity * unit_price).cast(MONEY)


def fill_unit_price(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines without a unit price take the current price of their product."""
    prices = products.select(F.col("id").alias("product_id"), "currentPrice")
    return lines.join(prices, "product_id", "left").select(
        *[
            F.coalesce("unitPrice", "currentPrice").cast(PRICE).alias(c) if c == "unitPrice" else F.col(c)
            for c in lines.columns
        ]
    )


def with_line_total(lines: DataFrame) -> DataFrame:
    return lines.withColumn("lineTotal", line_total(F.col("quantity"), F.col("unitPrice")))


def fill_order_total(orders: DataFrame, lines: DataFrame, column: str = "subtotal") -> DataFrame:
    """Orders without a total take the sum of their lines; orders without lines stay NULL."""
    sums = (
        with_line_total(lines)
        .groupBy(F.col("order_id").alias("id"))
        .agg(F.sum("lineTotal").cast(MONEY).alias("_sum"))
    )
    return orders.join(sums, "id", "left").select(
        *[F.coalesce(column, "_sum").alias(c) if c == column else F.col(c) for c in orders.columns]
    )


def order_total() -> Column:
    return (F.col("subtotal") + F.col("salesTax")).cast(MONEY)


def with_order_total(orders: DataFrame) -> DataFrame:
    return orders.withColumn("total", order_total())


def priced(pos: Pos) -> Pos:
    """Unit prices, order totals and the zero default for the tax filled in."""
    lines = fill_unit_price(pos.lines, pos.products)
    orders = fill_order_total(pos.orders, lines)
    return pos.with_(
        lines=lines,
        orders=orders.withColumn("salesTax", F.coalesce("salesTax", F.lit(0)).cast(MONEY)),
    )


def sales_tax(
    orders: DataFrame,
    customers: DataFrame,
    rates: DataFrame,
    epsilon: Decimal | None = EPSILON,
    touched: DataFrame | None = None,
    rate_column: str = "estimatedCombinedRate",
) -> DataFrame:
    """Recompute ``salesTax`` from the rate at the customer's zip; no rate means no tax.

    With ``touched`` (column ``id``) only those orders are recomputed, as the row
    triggers would; the others keep their tax.
    """
    home = customers.select(F.col("id").alias("customer_id"), "zip")
    by_zip = rates.select("zip", F.col(rate_column).alias("_rate"))
    exact = F.col("subtotal") * F.coalesce("_rate", F.lit(Decimal("0.00000")))
    if epsilon is not None:
        exact = exact + F.lit(epsilon)
    tax = F.round(exact, 2).cast(MONEY)
    source = orders.join(home, "customer_id", "left").join(by_zip, "zip", "left")
    if touched is not None:
        marks = touched.select("id").distinct().withColumn("_touched", F.lit(True))
        source = source.join(marks, "id", "left")
        tax = F.when(F.col("_touched"), tax).otherwise(F.col("salesTax"))
    return source.select(*[tax.alias(c) if c == "salesTax" else F.col(c) for c in orders.columns])


def sales_report(pos: Pos, start: dt.date, end: dt.date, product_id: int | None = None) -> DataFrame:
    """Quantity and sales of orders placed from ``start`` to ``end``, both days included.

    With a product: exactly one row, all NULL when nothing was sold. Without: one row
    per product that had sales.
    """
    placed = pos.orders.where(F.col("datePlaced").between(F.lit(start), F.lit(end)))
    lines = with_line_total(pos.lines)
    if product_id is not None:
        lines = lines.where(F.col("product_id") == product_id)
    sold = lines.join(placed.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    sums = [
        F.sum("quantity").cast("long").alias("Quantity Sold"),
        F.sum("lineTotal").cast(MONEY).alias("Total Sales Amount"),
    ]
    # Summed before the look-up of the product, so that a hot product shrinks before it is shuffled.
    # An inner join, because Spark moves a semi join below the sum.
    totals = sold.groupBy(F.col("product_id").alias("Product ID")).agg(*sums)
    known = totals.join(pos.products.select(F.col("id").alias("Product ID")), "Product ID")
    if product_id is None:
        return known
    return known.agg(*[F.max(f"`{name}`").alias(name) for name in known.columns])
