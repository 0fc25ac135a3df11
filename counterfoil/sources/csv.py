"""The CSV exports, read as text by position; cleaning is a separate step."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions.cleaning import zip_code
from counterfoil.model import RATE
from counterfoil.sources.quoted_lines import records

# The columns of each export in file order.
PRODUCT_COLUMNS = ("id", "name", "price", "quantity_on_hand")
CUSTOMER_COLUMNS = (
    "Id", "FirstName", "LastName", "city", "state", "ZIP", "Address1", "Address2", "Email", "Birthdate",
)
ORDER_COLUMNS = ("id", "customerId", "orderDate", "dateShipped")
ORDERLINE_COLUMNS = ("orderId", "productId", "quantity")
TAX_COLUMNS = (
    "state", "zip", "taxRegionName", "estimatedCombinedRate", "stateRate", "estimatedCountyRate",
    "estimatedCityRate", "estimatedSpecialRate", "riskLevel",
)
NARROW_TAX_COLUMNS = ("zip", "taxRate")


#: How a record is taken apart.
DIALECT = {"sep": ",", "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": ""}


def read_text_csv(spark: SparkSession, path: str, columns: tuple[str, ...], missing: str = "error") -> DataFrame:
    """Columns by position, all text, the header of every file skipped, line breaks inside quotes kept.

    Files are read in splits, however large; see ``quoted_lines``. Blank lines are no records. ``missing="empty"``
    turns an absent path into an empty table.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    try:
        found = records(spark, path)
    except AnalysisException as error:
        if missing == "empty" and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
    # Files with Windows line ends leave a carriage return behind each record.
    text = F.regexp_replace("record", "\r$", "")
    header = (F.col("split") == 0) & (F.col("at") == 0)
    fields = F.from_csv(text, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), DIALECT)
    return found.where(~header & (F.trim(text) != "")).select(fields.alias("_r")).select("_r.*")


def read_products(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, PRODUCT_COLUMNS, **options)


def read_customers(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, CUSTOMER_COLUMNS, **options)


def read_orders(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, ORDER_COLUMNS, **options)


def read_orderlines(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_text_csv(spark, path, ORDERLINE_COLUMNS, **options)


def read_sales_tax(spark: SparkSession, path: str, **options) -> DataFrame:
    """The wide rate file, which has the state first; typed, zip first."""
    raw = read_text_csv(spark, path, TAX_COLUMNS, **options)
    rates = [name for name in TAX_COLUMNS if name.endswith("Rate")]
    return raw.select(
        zip_code(F.trim("zip")).alias("zip"),
        "state",
        "taxRegionName",
        *[F.col(name).try_cast(RATE).alias(name) for name in rates],
        F.col("riskLevel").try_cast("int").alias("riskLevel"),
    )


def read_narrow_sales_tax(spark: SparkSession, path: str, **options) -> DataFrame:
    """The older two-column rate file."""
    raw = read_text_csv(spark, path, NARROW_TAX_COLUMNS, **options)
    return raw.select(zip_code(F.trim("zip")).alias("zip"), F.col("taxRate").try_cast(RATE).alias("taxRate"))
