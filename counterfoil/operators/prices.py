"""Price changes and their log.

``seq`` is unique and gives the order of the changes; the stamp ``ts`` is set as they are
made, so both orders agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.model import PRICE
from counterfoil.operators.sequence import value_before


def price_steps(products: DataFrame, changes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Each change of a known product with the price before it; changes without stamp get ``as_of``."""
    current = products.select(F.col("id").alias("product_id"), F.col("currentPrice").alias("_current"))
    stepped = value_before(changes, ["product_id"], "seq", {"_earlier": F.struct("price")}).join(current, "product_id")
    old = F.when(F.col("_earlier").isNull(), F.col("_current")).otherwise(F.col("_earlier.price"))
    stamp = F.coalesce("ts", as_of if as_of is not None else F.current_timestamp())
    return stepped.select(
        "product_id",
        old.cast(PRICE).alias("oldPrice"),
        F.col("price").cast(PRICE).alias("newPrice"),
        stamp.alias("ts"),
        "seq",
    )


def logged(steps: DataFrame, log_unchanged: bool = False) -> DataFrame:
    """The steps worth a log row: real changes between known prices, or all of them."""
    return steps if log_unchanged else steps.where(F.col("oldPrice") != F.col("newPrice"))


def apply_price_changes(
    products: DataFrame, changes: DataFrame, log_unchanged: bool = False, as_of: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(products with their last price, log of the changes)."""
    last = changes.groupBy(F.col("product_id").alias("id")).agg(F.max_by(F.struct("price"), "seq").alias("_last"))
    price = F.when(F.col("_last").isNotNull(), F.col("_last.price")).otherwise(F.col("currentPrice")).cast(PRICE)
    priced = products.join(last, "id", "left").select(
        *[price.alias(c) if c == "currentPrice" else F.col(c) for c in products.columns]
    )
    return priced, logged(price_steps(products, changes, as_of), log_unchanged)
