"""The model under its table and view names, for plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from counterfoil.model import Pos
from counterfoil.operators import money, views


def named_tables(pos: Pos) -> dict[str, DataFrame]:
    """Tables with their computed columns, and the reporting views, by name."""
    return {
        "Product": pos.products,
        "City": pos.cities,
        "Customer": pos.customers,
        "Order": money.with_order_total(pos.orders),
        "Orderline": money.with_line_total(pos.lines),
        "PriceHistory": pos.price_history,
        "SalesTax": pos.tax_rates,
        "v_customers": views.v_customers(pos),
        "v_customers2": views.v_customers2(pos),
        "v_ProductBuyers": views.v_product_buyers(pos),
        "v_CustomerPurchases": views.v_customer_purchases(pos),
    }


def register_views(pos: Pos) -> None:
    """Make every table and view a temporary view of the session."""
    for name, df in named_tables(pos).items():
        df.createOrReplaceTempView(f"`{name}`")
