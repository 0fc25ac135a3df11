"""Questions asked of document tables. Every spelling of the fields, and every way of
writing "no children", that the exports use is accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.model import MONEY

# Alternative field names in the exports.
ITEM_ARRAYS = ("Products", "Items", "Product")
ORDER_TOTALS = ("OrderTotal", "Order Total", "Total Order")
ORDER_ARRAYS = ("Orders", "Order Details")
BUYER_ARRAYS = ("Customers", "Customer")


def _first(names, present) -> str | None:
    return next((name for name in names if name in present), None)


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def customers_in_region(docs: DataFrame, pattern: str) -> DataFrame:
    """Documents whose address matches the pattern, upper and lower case alike."""
    return docs.where(F.col("Address").rlike("(?i)" + pattern))


def _spent(docs: DataFrame) -> Column:
    """Total of one document: a flat field, or the sum over its orders; missing counts as 0."""
    flat = _first(ORDER_TOTALS, docs.columns)
    if flat:
        return F.coalesce(_column(flat).cast(MONEY), F.lit(0).cast(MONEY))
    array = _first(ORDER_ARRAYS, docs.columns)
    if array is None:
        return F.lit(0).cast(MONEY)
    total = _first(ORDER_TOTALS, docs.schema[array].dataType.elementType.names)
    summed = F.aggregate(
        _column(array),
        F.lit(0).cast(MONEY),
        lambda acc, order: (acc + F.coalesce(order[total].cast(MONEY), F.lit(0).cast(MONEY))).cast(MONEY),
    )
    return F.coalesce(summed, F.lit(0).cast(MONEY))


def best_customers(docs: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` customers who spent most; by CustomerID when there is one, else by name."""
    who = ["CustomerID", "Customer Name"] if "CustomerID" in docs.columns else ["Customer Name"]
    return (
        docs.groupBy(*who)
        .agg(F.sum(_spent(docs)).cast(MONEY).alias("totalSpent"))
        .orderBy(F.col("totalSpent").desc(), *[_column(name) for name in who])
        .limit(k)
    )


def _purchases(docs: DataFrame) -> Column:
    """Number of real buyers in the document: none for null, [] and [{null}]."""
    buyers = _column(_first(BUYER_ARRAYS, docs.columns))
    return F.coalesce(F.size(F.filter(buyers, lambda b: b["CustomerID"].isNotNull())), F.lit(0))


def best_products(docs: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` products with most purchases."""
    return (
        docs.select("ProductID", _purchases(docs).alias("n"))
        .where(F.col("n") > 0)
        .groupBy("ProductID")
        .agg(F.sum("n").alias("purchases"))
        .orderBy(F.col("purchases").desc(), "ProductID")
        .limit(k)
    )


def unsold_products(docs: DataFrame) -> DataFrame:
    """Products without a single buyer."""
    return docs.where(_purchases(docs) == 0)


def recall(docs: DataFrame, product_id: int) -> DataFrame:
    """Buyer of every order that contains the product."""
    array = _first(ITEM_ARRAYS, docs.columns)
    key = _first(("ProductID", "PRODUCT ID"), docs.schema[array].dataType.elementType.names)
    return docs.where(F.exists(_column(array), lambda p: p[key] == product_id)).select(
        F.col("Buyer.CustomerID").alias("CustomerID"), F.col("Buyer.`Customer Name`").alias("Customer Name")
    )


def with_order_totals(docs: DataFrame, orders: DataFrame) -> DataFrame:
    """Order documents with the total that the export leaves out."""
    totals = orders.select(F.col("id").alias("OrderID"), F.col("subtotal").alias("OrderTotal"))
    return docs.join(totals, "OrderID", "left")


def suspicious_orders(docs: DataFrame, min_total=10000, max_items: int = 10) -> DataFrame:
    """Orders above the total or with more different items than allowed."""
    total = _column(_first(ORDER_TOTALS, docs.columns))
    items = _column(_first(ITEM_ARRAYS, docs.columns))
    return docs.where((total > min_total) | (F.coalesce(F.size(items), F.lit(0)) > max_items))
