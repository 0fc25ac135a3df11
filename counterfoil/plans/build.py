"""From a folder of CSV exports to the priced and taxed model, and its materialized views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from counterfoil.model import PRICE_HISTORY, Pos
from counterfoil.operators import etl, money, views
from counterfoil.session import pin
from counterfoil.sources import csv
from counterfoil.sources.snapshots import latest, materialize


def build_pos(spark: SparkSession, folder: str, missing: str = "error") -> Pos:
    """The model as loaded: products, cities, customers, orders, lines, in reference order.

    Ids and zips that the files repeat are made unique by ``etl.one_row_per_key``.
    """
    options = {"missing": missing}
    raw_customers = csv.read_customers(spark, f"{folder}/customers.csv", **options)
    customers = etl.one_row_per_key(etl.clean_customers(raw_customers), "id")
    placed = etl.clean_orders(csv.read_orders(spark, f"{folder}/orders.csv", **options), customers)
    orders = etl.one_row_per_key(placed, "id")
    products = etl.clean_products(csv.read_products(spark, f"{folder}/products.csv", **options))
    return Pos(
        products=etl.one_row_per_key(products, "id"),
        cities=etl.one_city_per_zip(etl.city_dimension(raw_customers)),
        customers=customers,
        orders=orders,
        lines=etl.orderlines_from_scans(csv.read_orderlines(spark, f"{folder}/orderlines.csv", **options), orders),
        price_history=spark.createDataFrame([], PRICE_HISTORY),
        tax_rates=etl.one_row_per_key(csv.read_sales_tax(spark, f"{folder}/TAXRATES.csv", **options), "zip"),
    )


def priced_and_taxed(pos: Pos, scope: str = "all") -> Pos:
    """Prices and totals filled in; tax on all orders, or 0.00 until a change touches one."""
    pos = money.priced(pos)
    if scope == "touched":
        return pos
    return pos.with_(orders=money.sales_tax(pos.orders, pos.customers, pos.tax_rates))


def refresh_full(pos: Pos, root: str) -> dict[str, str]:
    """Both materialized views computed afresh, each published as a new version; lines are paired with buyers once."""
    pairs = pin(views.bought_pairs(pos))
    return {
        "mv_product_buyers": materialize(views.product_buyers(pos, pairs=pairs), f"{root}/mv_product_buyers"),
        "mv_customer_purchases": materialize(views.customer_purchases(pos, pairs=pairs), f"{root}/mv_customer_purchases"),
    }


def refresh_keys(spark: SparkSession, pos: Pos, root: str, customers: DataFrame, products: DataFrame) -> dict[str, str]:
    """New versions of both views in which only the given keys were computed afresh."""
    buyers = latest(spark, f"{root}/mv_product_buyers")
    purchases = latest(spark, f"{root}/mv_customer_purchases")
    return {
        "mv_product_buyers": materialize(
            views.refresh_products(buyers, pos, products), f"{root}/mv_product_buyers"
        ),
        "mv_customer_purchases": materialize(
            views.refresh_customers(purchases, pos, customers), f"{root}/mv_customer_purchases"
        ),
    }
