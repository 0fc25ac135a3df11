"""Cleaning steps from raw text tables to the typed model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.functions.cleaning import (
    CANCELLED, blank_to_null, day_of, money, us_date, whole_number, zip_code,
)
from counterfoil.model import MONEY, PRICE


def clean_products(raw: DataFrame) -> DataFrame:
    """Typed products; rows without a name are dropped."""
    return raw.where(F.col("name") != "").select(
        F.col("id").try_cast("long").alias("id"),
        "name",
        money(F.col("price")).alias("currentPrice"),
        whole_number(F.col("quantity_on_hand")).alias("availableQuantity"),
    )


def clean_customers(raw: DataFrame, with_phone: bool = False) -> DataFrame:
    """Typed customers. The exports have no phone numbers; the column, always NULL, was dropped later."""
    phone = [F.lit(None).cast("string").alias("phone")] if with_phone else []
    return raw.select(
        F.col("Id").try_cast("long").alias("id"),
        blank_to_null(F.col("FirstName")).alias("firstName"),
        blank_to_null(F.col("LastName")).alias("lastName"),
        blank_to_null(F.col("Email")).alias("email"),
        blank_to_null(F.col("Address1")).alias("address1"),
        blank_to_null(F.col("Address2")).alias("address2"),
        *phone,
        us_date(F.col("Birthdate")).alias("birthdate"),
        zip_code(F.col("ZIP")).alias("zip"),
    )


def city_dimension(raw_customers: DataFrame) -> DataFrame:
    """Every (zip, city, state) seen, complete ones only. A zip with two spellings has two rows."""
    return (
        raw_customers.select(
            zip_code(F.col("ZIP")).alias("zip"),
            blank_to_null(F.col("city")).alias("city"),
            blank_to_null(F.col("state")).alias("state"),
        )
        .dropna()
        .distinct()
    )


def one_city_per_zip(cities: DataFrame) -> DataFrame:
    """Keeps the zip unique: of two spellings the first in text order stays."""
    first = cities.groupBy("zip").agg(F.min(F.struct("city", "state")).alias("c"))
    return first.select("zip", "c.city", "c.state")


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Keeps a declared key unique, so that joins on it repeat nothing.

    Of several rows with one key the least by its other columns, in their order and NULLs
    first, stays; a row whose key is NULL cannot be referred to and goes. Both kinds are
    what ``quality.pk_violations`` reports of the input.
    """
    others = [c for c in df.columns if c != key]
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
    return first.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def clean_orders(raw: DataFrame, customers: DataFrame) -> DataFrame:
    """Typed orders of known customers; money columns start NULL."""
    typed = raw.select(
        F.col("id").try_cast("long").alias("id"),
        day_of(F.col("orderDate")).alias("datePlaced"),
        day_of(F.col("dateShipped"), CANCELLED).alias("dateShipped"),
        F.col("customerId").try_cast("long").alias("customer_id"),
        F.lit(None).cast(MONEY).alias("subtotal"),
        F.lit(None).cast(MONEY).alias("salesTax"),
    )
    return typed.join(customers.select(F.col("id").alias("customer_id")), "customer_id", "left_semi").select(
        *typed.columns
    )


def orderlines_from_scans(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of known orders. Quantity is how often the pair was scanned, not the file's own column.

    Counting comes before the look-up: a hot pair is folded to one row before any shuffle.
    """
    counted = (
        raw.groupBy(
            F.col("orderId").try_cast("long").alias("order_id"),
            F.col("productId").try_cast("long").alias("product_id"),
        )
        .agg(F.count("*").cast("int").alias("quantity"))
        .withColumn("unitPrice", F.lit(None).cast(PRICE))
    )
    return counted.join(orders.select(F.col("id").alias("order_id")), "order_id", "left_semi").select(
        "order_id", "product_id", "quantity", "unitPrice"
    )
