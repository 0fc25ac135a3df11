"""The document exports of one house style, each under its file name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from counterfoil.model import Pos
from counterfoil.operators import documents
from counterfoil.sources.documents import write_documents


def export_documents(pos: Pos, style: str = "A") -> dict[str, DataFrame]:
    """File name -> documents. ``custom.json`` answers another question in each style:
    the price history of every product (A), the customers who spent most (B)."""
    docs = {
        "cust1.json": documents.doc_customers(pos, style),
        "prod.json": documents.doc_products(pos, style),
        "ord.json": documents.doc_orders_dated(pos) if style == "C" else documents.doc_orders(pos),
        "cust2.json": documents.doc_customer_orders(pos, style),
    }
    if style == "A":
        docs["custom.json"] = documents.doc_price_history(pos)
    if style == "B":
        docs["custom.json"] = documents.doc_top_customers(pos)
    return docs


def write_exports(pos: Pos, folder: str, style: str = "A") -> list[str]:
    """Write every export of the style below ``folder``; returns the paths."""
    paths = []
    for name, docs in export_documents(pos, style).items():
        write_documents(docs, f"{folder}/{name}")
        paths.append(f"{folder}/{name}")
    return paths
