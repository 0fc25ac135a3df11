"""Column functions that turn raw export text into typed values; bad text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from counterfoil.model import PRICE

# Texts that stand for "no date" in the exports.
NO_DATE = "0000-00-00"
CANCELLED = "Cancelled"


def money(text: Column) -> Column:
    """``$1,234.50`` -> 1234.50, rounded half up; out of range or no number -> NULL."""
    return F.regexp_replace(text, r'[$,"]', "").try_cast(PRICE)


def whole_number(text: Column) -> Column:
    """Digits only; signs, blanks and decimals -> NULL."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def us_date(text: Column) -> Column:
    """``2/3/1980`` or ``02/03/1980`` -> date."""
    return F.try_to_date(text, "M/d/yyyy")


def day_of(text: Column, *none_texts: str) -> Column:
    """Date part of ``yyyy-m-d h:m:s`` or ``yyyy-m-d`` text; the given texts -> NULL."""
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s")),
        F.try_to_timestamp(text, F.lit("yyyy-M-d")),
    ).cast("date")
    return F.when(~text.isin(NO_DATE, "", *none_texts), parsed)


def zip_code(text: Column) -> Column:
    """One to five digits, zero-padded to five; anything else -> NULL."""
    return F.when(text.rlike("^[0-9]{1,5}$"), F.lpad(text, 5, "0"))
