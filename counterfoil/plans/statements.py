"""SQL statements with named parameters over DataFrames."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_statement(spark: SparkSession, text: str, args: dict[str, Any] | None = None, **tables: DataFrame) -> DataFrame:
    """Run ``text``; ``:name`` markers take values from ``args``, ``{name}`` takes a DataFrame.

    Values never become part of the text, so they cannot change the statement.
    """
    return spark.sql(text, args=args, **tables)


INSERT_CUSTOMER = """
SELECT CAST(:id AS BIGINT) AS id, CAST(:firstName AS STRING) AS firstName, CAST(:lastName AS STRING) AS lastName
"""


def insert_customer(customers: DataFrame, id: int, first_name: str, last_name: str) -> DataFrame:
    """``customers`` with one more row, built by a parameterized statement."""
    row = run_statement(
        customers.sparkSession, INSERT_CUSTOMER, {"id": id, "firstName": first_name, "lastName": last_name}
    )
    return customers.unionByName(row, allowMissingColumns=True)
