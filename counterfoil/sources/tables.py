"""The point-of-sale model over the shared star-schema parquet tables.

Parts are products, nations are cities, line items become order lines by counting the
rows of an (order, part) pair, as scans at a till are counted. Suppliers come in twice,
as products without price or stock that nobody buys and as customers who never order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.model import MONEY, PRICE, PRICE_HISTORY, RATE, Pos

# Fixed value: suppliers get ids above those of parts and customers.
SUPPLIER_BASE = 1_000_000_000_000


# The columns used; declared, so that building a query reads no file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
    "l_linestatus string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _null(kind) -> Column:
    return F.lit(None).cast(kind)


def products(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast(PRICE).alias("currentPrice"),
        (F.col("p_size") * 5).cast("int").alias("availableQuantity"),
    )
    unsold = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + SUPPLIER_BASE).alias("id"),
        F.col("s_name").alias("name"),
        _null(PRICE).alias("currentPrice"),
        _null("int").alias("availableQuantity"),
    )
    return parts.unionByName(unsold)


def cities(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _zip("n_nationkey"), F.col("n_name").alias("city"), F.substring("r_name", 1, 2).alias("state")
    )


def _zip(nation_key: str):
    return F.lpad(F.col(nation_key).cast("string"), 5, "0").alias("zip")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    def named(name: str):
        return [
            F.split_part(name, F.lit("#"), F.lit(1)).alias("firstName"),
            F.split_part(name, F.lit("#"), F.lit(2)).alias("lastName"),
        ]

    shoppers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        *named(F.col("c_name")),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("address1"),
        F.when(F.col("c_acctbal") < 3000, F.concat(F.lit("Unit "), F.col("c_nationkey").cast("string"))).alias(
            "address2"
        ),
        F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 365).alias("birthdate"),
        _zip("c_nationkey"),
    )
    idle = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + SUPPLIER_BASE).alias("id"),
        *named(F.col("s_name")),
        _null("string").alias("email"),
        _null("string").alias("address1"),
        _null("string").alias("address2"),
        _null("date").alias("birthdate"),
        _zip("s_nationkey"),
    )
    return shoppers.unionByName(idle)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    placed = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        placed.alias("datePlaced"),
        F.when(F.col("o_orderstatus") != "P", F.date_add(placed, 7)).alias("dateShipped"),
        F.col("o_custkey").alias("customer_id"),
        _null(MONEY).alias("subtotal"),
        _null(MONEY).alias("salesTax"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
        .agg(F.count("*").cast("int").alias("quantity"))
        .withColumn("unitPrice", _null(PRICE))
    )


def tax_rates(spark: SparkSession, folder: str) -> DataFrame:
    """One rate per nation outside Africa, so that some zips have none."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    taxed = region.where(F.col("r_name") != "AFRICA")
    return nation.join(taxed, F.col("n_regionkey") == F.col("r_regionkey")).select(
        _zip("n_nationkey"),
        F.substring("r_name", 1, 2).alias("state"),
        F.col("n_name").alias("taxRegionName"),
        (F.col("n_nationkey") * F.lit("0.00375").cast(RATE)).cast(RATE).alias("estimatedCombinedRate"),
    )


def price_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a price feed: coarse prices, so that repeats occur."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("product_id"),
        (F.floor(F.col("value") / 50) * 50).cast(PRICE).alias("price"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def line_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a feed of order-line changes; the event type names the operation.

    Every third change names another product; that refuses updates and means nothing to the rest.
    """
    kind = F.col("event_type")
    op = F.when(kind == "view", "update").when(kind == "error", "delete").otherwise("insert")
    return table(spark, folder, "events").select(
        op.alias("op"),
        F.col("event_id").alias("seq"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("order_id"),
        F.col("user_id").alias("product_id"),
        F.floor(F.col("value") / 25).cast("int").alias("quantity"),
        _null("long").alias("new_order_id"),
        F.when(F.col("event_id") % 3 == 0, F.col("user_id") + 1).alias("new_product_id"),
    )


def empty_price_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PRICE_HISTORY)


def pos_from_tables(spark: SparkSession, folder: str) -> Pos:
    return Pos(
        products=products(spark, folder),
        cities=cities(spark, folder),
        customers=customers(spark, folder),
        orders=orders(spark, folder),
        lines=lines(spark, folder),
        price_history=empty_price_history(spark),
        tax_rates=tax_rates(spark, folder),
    )
