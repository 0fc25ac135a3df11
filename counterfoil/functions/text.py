"""Column functions for names, labels and addresses. Any NULL part makes the text NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def customer_label() -> Column:
    return F.concat(
        F.col("id").cast("string"), F.lit(" "), F.col("firstName"), F.lit(" "), F.col("lastName")
    )


def product_label() -> Column:
    return F.concat(F.col("id").cast("string"), F.lit(" "), F.col("name"))


def place(comma: bool = True, gap: str = " ") -> Column:
    """City, state and zip on one line."""
    return F.concat(F.col("city"), F.lit(", " if comma else " "), F.col("state"), F.lit(gap), F.col("zip"))


def address(style: str = "A") -> Column:
    """Address block, one part per line.

    A: second line left out when NULL or empty. B: left out only when NULL.
    C: as B, and no comma after the city. B-lines: second line always there,
    blank when NULL, and a NULL first line is skipped instead of making all NULL.
    """
    first, second = F.col("address1"), F.col("address2")
    if style == "B-lines":
        return F.concat_ws("\n", first, F.coalesce(second, F.lit("")), place())
    has_second = second.isNotNull() & (second != "") if style == "A" else second.isNotNull()
    middle = F.when(has_second, F.concat(F.lit("\n"), second)).otherwise("")
    return F.concat(first, middle, F.lit("\n"), place(comma=style != "C"))
