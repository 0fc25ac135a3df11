"""The document questions, answered from the tables without building a document.

Each gives what its namesake in ``document_queries`` gives for the exported documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.functions.text import full_name
from counterfoil.model import MONEY, Pos


def best_customers(pos: Pos, k: int = 1) -> DataFrame:
    """The ``k`` customers with a known zip who spent most; namesakes are told apart by their id."""
    spent = pos.orders.groupBy(F.col("customer_id").alias("id")).agg(F.sum("subtotal").alias("_spent"))
    buyers = pos.customers.join(pos.cities.select("zip"), "zip", "left_semi")
    return (
        buyers.join(spent, "id", "left")
        .select(
            F.col("id").alias("CustomerID"),
            full_name(F.col("firstName"), F.col("lastName")).alias("Customer Name"),
            F.coalesce("_spent", F.lit(0)).cast(MONEY).alias("totalSpent"),
        )
        .orderBy(F.col("totalSpent").desc(), "CustomerID")
        .limit(k)
    )


def _known_orders(pos: Pos) -> DataFrame:
    """(order_id, customer_id) of orders whose customer is known."""
    return pos.orders.select(F.col("id").alias("order_id"), "customer_id").join(
        pos.customers.select(F.col("id").alias("customer_id")), "customer_id", "left_semi"
    )


def best_products(pos: Pos, k: int = 1) -> DataFrame:
    """The ``k`` products on most order lines."""
    bought = pos.lines.join(_known_orders(pos), "order_id", "left_semi")
    counted = bought.groupBy(F.col("product_id").alias("ProductID")).agg(F.count("*").alias("purchases"))
    known = counted.join(pos.products.select(F.col("id").alias("ProductID")), "ProductID", "left_semi")
    return known.orderBy(F.col("purchases").desc(), "ProductID").limit(k)


def unsold_products(pos: Pos) -> DataFrame:
    """Products on no line of an order with a buyer."""
    placed = pos.orders.where(F.col("customer_id").isNotNull()).select(F.col("id").alias("order_id"))
    sold = pos.lines.join(placed, "order_id", "left_semi").select(F.col("product_id").alias("id")).distinct()
    return pos.products.join(sold, "id", "left_anti").select(
        F.col("id").alias("ProductID"), F.col("name").alias("Product Name")
    )


def recall(pos: Pos, product_id: int) -> DataFrame:
    """Buyer of every order that contains the product."""
    goods = pos.products.where(F.col("id") == product_id).select(F.col("id").alias("product_id"))
    sold = pos.lines.where(F.col("product_id") == product_id).join(goods, "product_id", "left_semi")
    orders = pos.orders.select(F.col("id").alias("order_id"), F.col("customer_id").alias("id"))
    return (
        orders.join(sold.select("order_id").distinct(), "order_id", "left_semi")
        .join(pos.customers, "id")
        .select(F.col("id").alias("CustomerID"), full_name(F.col("firstName"), F.col("lastName")).alias("Customer Name"))
    )


def suspicious_orders(pos: Pos, min_total=10000, max_items: int = 10) -> DataFrame:
    """Orders above the total or with more different items than allowed."""
    goods = pos.products.select(F.col("id").alias("product_id"))
    items = (
        pos.lines.join(goods, "product_id", "left_semi").groupBy("order_id").agg(F.count("*").alias("n_items"))
    )
    totals = pos.orders.select(F.col("id").alias("order_id"), F.col("subtotal").alias("OrderTotal"))
    return (
        items.join(totals, "order_id")
        .where((F.col("OrderTotal") > min_total) | (F.col("n_items") > max_items))
        .join(_known_orders(pos).select("order_id"), "order_id", "left_semi")
        .select(F.col("order_id").alias("OrderID"), "OrderTotal", "n_items")
    )
