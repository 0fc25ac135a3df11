"""Raw text exports written from the shared tables, with the defects real exports have.

Which rows carry a defect depends on their own values (account balance, size, status),
and every row of the table is exported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.functions.cleaning import CANCELLED, NO_DATE
from counterfoil.sources.csv import TAX_COLUMNS
from counterfoil.sources.tables import table, tax_rates

# Fixed value: added to a key to make it name nothing.
UNKNOWN = 1_000_000_000_000


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    size, kind = F.col("p_size"), F.col("p_type")
    amount = F.col("p_retailprice").cast("decimal(10,2)")
    return table(spark, folder, "part").select(
        _text("p_partkey").alias("id"),
        F.when(size == 13, "").otherwise(F.col("p_name")).alias("name"),
        F.when(size == 50, "$99,999.00")
        .when(size == 49, "")
        .when(kind == "SMALL", F.concat(F.lit("$"), _text(amount), F.lit("5")))
        .otherwise(F.concat(F.lit('"$'), F.format_number(amount * 10, 2), F.lit('"')))
        .alias("price"),
        F.when(size < 4, F.concat(F.lit("-"), _text("p_size")))
        .when(size < 7, "")
        .when(size < 9, "n/a")
        .otherwise(_text("p_size"))
        .alias("quantity_on_hand"),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("c_acctbal")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", F.substring("r_name", 1, 2).alias("r_code")
    )
    born = F.date_add(F.lit("1950-01-01").cast("date"), F.floor(F.abs(balance)).cast("int"))
    return (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _text("c_custkey").alias("Id"),
            F.when(balance < -800, "").otherwise(F.split_part("c_name", F.lit("#"), F.lit(1))).alias("FirstName"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("LastName"),
            F.when(balance > 9500, "").when(balance < 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("city"),
            F.col("r_code").alias("state"),
            F.when(balance > 9800, "").when(balance > 9700, "12x45").otherwise(_text("c_nationkey")).alias("ZIP"),
            F.when(balance < -900, "").otherwise(F.col("c_mktsegment")).alias("Address1"),
            F.when(balance < 3000, F.concat(F.lit("Unit "), _text("c_nationkey"))).otherwise("").alias("Address2"),
            F.when(balance < 500, "").otherwise(F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("Email"),
            F.when(balance < -700, NO_DATE)
            .when(balance < -600, "2/30/1990")
            .when(balance < -500, "")
            .when(balance < 5000, F.date_format(born, "M/d/yyyy"))
            .otherwise(F.date_format(born, "MM/dd/yyyy"))
            .alias("Birthdate"),
        )
    )


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    placed = F.col("o_orderdate").cast("timestamp")
    sent = placed + F.expr("interval '7' day")
    unknown = (status == "P") & (priority == "5-LOW")
    return table(spark, folder, "orders").select(
        _text("o_orderkey").alias("id"),
        _text(F.when(unknown, F.col("o_custkey") + UNKNOWN).otherwise(F.col("o_custkey"))).alias("customerId"),
        F.when((status == "P") & (priority == "1-URGENT"), NO_DATE)
        .when(status == "P", F.date_format(placed, "yyyy-M-d H:m:s"))
        .when(status == "O", F.date_format(placed, "yyyy-MM-dd"))
        .otherwise(F.date_format(placed, "yyyy-MM-dd HH:mm:ss"))
        .alias("orderDate"),
        F.when(priority == "2-HIGH", CANCELLED)
        .when(priority == "3-MEDIUM", "")
        .otherwise(F.date_format(sent, "yyyy-MM-dd HH:mm:ss"))
        .alias("dateShipped"),
    )


def raw_orderlines(spark: SparkSession, folder: str) -> DataFrame:
    unknown = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    return table(spark, folder, "lineitem").select(
        _text(F.when(unknown, F.col("l_orderkey") + UNKNOWN).otherwise(F.col("l_orderkey"))).alias("orderId"),
        _text("l_partkey").alias("productId"),
        _text(F.col("l_quantity").cast("int")).alias("quantity"),
    )


def raw_tax_rates(spark: SparkSession, folder: str) -> DataFrame:
    """The wide rate file; zips lack their leading zeros, only the combined rate is known."""
    rates = tax_rates(spark, folder)
    known = {
        "state": F.col("state"), "zip": F.regexp_replace("zip", "^0+(?=.)", ""),
        "taxRegionName": F.col("taxRegionName"), "estimatedCombinedRate": _text("estimatedCombinedRate"),
    }
    return rates.select(*[known.get(c, F.lit("")).alias(c) for c in TAX_COLUMNS])


def write_csv(raw: DataFrame, path: str) -> str:
    """Text columns as CSV files with a header each, quotes doubled, Windows line ends on the last column."""
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in raw.columns]
    last = F.concat(texts[-1], F.lit("\r")).alias(raw.columns[-1])
    raw.select(*texts[:-1], last).write.options(header=True, quote='"', escape='"', emptyValue="", nullValue="").csv(path)
    return path
