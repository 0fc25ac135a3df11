"""All declared rules of the model checked in one report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.model import TEXT_LENGTHS, Pos
from counterfoil.operators import quality

KEYS = {
    "product": ["id"],
    "city": ["zip"],
    "customer": ["id"],
    "order": ["id"],
    "orderline": ["order_id", "product_id"],
    "sales_tax": ["zip"],
}
REFERENCES = [
    ("customer", "zip", "city", "zip"),
    ("order", "customer_id", "customer", "id"),
    ("orderline", "order_id", "order", "id"),
    ("orderline", "product_id", "product", "id"),
    ("price_history", "product_id", "product", "id"),
]
REQUIRED = {"product": ["name"], "city": ["city", "state"], "price_history": ["ts"]}


def _tables(pos: Pos) -> dict[str, DataFrame]:
    return {
        "product": pos.products,
        "city": pos.cities,
        "customer": pos.customers,
        "order": pos.orders,
        "orderline": pos.lines,
        "price_history": pos.price_history,
        "sales_tax": pos.tax_rates,
    }


def _per_column(rule: str, table: str, counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "column_name", "n").select(
        F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), "column_name", "n"
    )


def quality_report(pos: Pos) -> DataFrame:
    """One row per rule (rule, table_name, column_name) with the number of rows or keys breaking it."""
    tables = _tables(pos)
    rows = []
    for name, keys in KEYS.items():
        broken = quality.pk_violations(tables[name], keys).agg(F.count("*").alias(",".join(keys)))
        rows.append(_per_column("unique", name, broken))
    for child, key, parent, parent_key in REFERENCES:
        orphans = quality.fk_orphans(tables[child], key, tables[parent], parent_key).agg(F.count("*").alias(key))
        rows.append(_per_column("reference", child, orphans))
    for name, columns in REQUIRED.items():
        rows.append(_per_column("required", name, quality.null_counts(tables[name], columns)))
    for name, limits in TEXT_LENGTHS.items():
        present = {c: n for c, n in limits.items() if c in tables[name].columns}
        rows.append(_per_column("length", name, quality.length_violations(tables[name], present)))
    return reduce(DataFrame.unionByName, rows)
