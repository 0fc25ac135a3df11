"""Reporting views and their keyed refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions.text import customer_label, place, product_label
from counterfoil.model import Pos
from counterfoil.operators.gather import gather_text, text_parts


def _sort_text(column: str, ignore_case: bool) -> Column:
    return F.collate(F.col(column), "UTF8_LCASE") if ignore_case else F.col(column)


def v_customers(pos: Pos, ignore_case: bool = False) -> DataFrame:
    """Names in phone-book order; ``ignore_case`` sorts as a case-insensitive database does."""
    names = pos.customers.select("lastName", "firstName").orderBy(
        _sort_text("lastName", ignore_case), _sort_text("firstName", ignore_case)
    )
    return names.select(F.col("lastName").alias("Last Name"), F.col("firstName").alias("First Name"))


def v_customers2(pos: Pos) -> DataFrame:
    """Customers with a known zip and their two address lines, by zip."""
    second = F.coalesce(F.concat(F.lit(", "), F.col("address2")), F.lit(""))
    return (
        pos.customers.join(pos.cities, "zip")
        .select(
            F.col("id").alias("customer_number"),
            F.col("firstName").alias("first_name"),
            F.col("lastName").alias("last_name"),
            F.concat(F.col("address1"), second).alias("addr1"),
            place(gap="   ").alias("addr2"),
            "zip",
        )
        .orderBy("zip", "customer_number")
        .drop("zip")
    )


def bought_pairs(pos: Pos) -> DataFrame:
    """Each (product, customer) pair once, with the number of order lines behind it."""
    orders = pos.orders.select(F.col("id").alias("order_id"), "customer_id")
    return (
        pos.lines.select("order_id", "product_id")
        .join(orders, "order_id")
        .groupBy("product_id", "customer_id")
        .agg(F.count("*").alias("copies"))
    )


def product_buyers_parts(pos: Pos, distinct: bool = True) -> DataFrame:
    """Buyers per product in pieces (productID, part, customers), for products of any popularity."""
    return text_parts(*_buyer_labels(pos, distinct)).withColumnsRenamed(
        {"product_id": "productID", "text": "customers"}
    )


def customer_purchases_parts(pos: Pos, distinct: bool = True) -> DataFrame:
    """Products per customer in pieces (customer number, part, products)."""
    return text_parts(*_purchase_labels(pos, distinct)).withColumnsRenamed(
        {"customer_id": "customer number", "text": "products"}
    )


def _buyer_labels(pos: Pos, distinct: bool, pairs: DataFrame | None = None):
    buyers = pos.customers.select(F.col("id").alias("customer_id"), customer_label().alias("label"))
    labelled = (bought_pairs(pos) if pairs is None else pairs).join(buyers, "customer_id")
    return labelled, ["product_id"], "customer_id", "label", ",", None if distinct else "copies"


def _purchase_labels(pos: Pos, distinct: bool, pairs: DataFrame | None = None):
    goods = pos.products.select(F.col("id").alias("product_id"), product_label().alias("label"))
    labelled = (bought_pairs(pos) if pairs is None else pairs).join(goods, "product_id")
    return labelled, ["customer_id"], "product_id", "label", "|", None if distinct else "copies"


def product_buyers(pos: Pos, distinct: bool = True, pairs: DataFrame | None = None) -> DataFrame:
    """Every product with its buyers as one text, by buyer id; NULL when nobody bought it.

    ``pairs``: ``bought_pairs`` of ``pos``, where they are at hand.
    """
    labelled, keys, order_id, label, sep, copies = _buyer_labels(pos, distinct, pairs)
    texts = gather_text(labelled, keys, order_id, label, sep, "customers", copies)
    return pos.products.select(F.col("id").alias("productID"), F.col("name").alias("productName")).join(
        texts.withColumnRenamed("product_id", "productID"), "productID", "left"
    )


def v_product_buyers(pos: Pos, distinct: bool = True) -> DataFrame:
    """``product_buyers`` in product order."""
    return product_buyers(pos, distinct).orderBy("productID")


def customer_purchases(pos: Pos, distinct: bool = True, pairs: DataFrame | None = None) -> DataFrame:
    """Every customer with the bought products as one text, by product id; ``pairs`` as for ``product_buyers``."""
    labelled, keys, order_id, label, sep, copies = _purchase_labels(pos, distinct, pairs)
    texts = gather_text(labelled, keys, order_id, label, sep, "products", copies)
    return pos.customers.select(
        F.col("id").alias("customer number"), F.col("firstName").alias("fn"), F.col("lastName").alias("ln")
    ).join(texts.withColumnRenamed("customer_id", "customer number"), "customer number", "left")


def v_customer_purchases(pos: Pos, distinct: bool = True, ignore_case: bool = False) -> DataFrame:
    """``customer_purchases`` in name order."""
    return customer_purchases(pos, distinct).orderBy(
        _sort_text("ln", ignore_case), _sort_text("fn", ignore_case), "customer number"
    )


def _only(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(F.col(key).alias(column)).distinct(), column, "left_semi")


def customer_rows(pos: Pos, keys: DataFrame, distinct: bool = True) -> DataFrame:
    """``customer_purchases`` for the given customers (column ``customer_id``) only.

    The base tables are cut down to the keys before anything is grouped.
    """
    orders = _only(pos.orders, "customer_id", keys, "customer_id")
    touched = pos.with_(
        customers=_only(pos.customers, "id", keys, "customer_id"),
        orders=orders,
        lines=_only(pos.lines, "order_id", orders, "id"),
    )
    return customer_purchases(touched, distinct)


def product_rows(pos: Pos, keys: DataFrame, distinct: bool = True) -> DataFrame:
    """``product_buyers`` for the given products (column ``product_id``) only."""
    touched = pos.with_(
        products=_only(pos.products, "id", keys, "product_id"),
        lines=_only(pos.lines, "product_id", keys, "product_id"),
    )
    return product_buyers(touched, distinct)


def refresh_customers(mv: DataFrame, pos: Pos, keys: DataFrame, distinct: bool = True) -> DataFrame:
    """``mv`` with the rows of the given customers computed afresh.

    A key that is no customer any more loses its row.
    """
    gone = keys.select(F.col("customer_id").alias("customer number")).distinct()
    return mv.join(gone, "customer number", "left_anti").unionByName(customer_rows(pos, keys, distinct))


def refresh_products(mv: DataFrame, pos: Pos, keys: DataFrame, distinct: bool = True) -> DataFrame:
    """``mv`` with the rows of the given products computed afresh."""
    gone = keys.select(F.col("product_id").alias("productID")).distinct()
    return mv.join(gone, "productID", "left_anti").unionByName(product_rows(pos, keys, distinct))
