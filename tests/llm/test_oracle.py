"""Corpus queries that SQL can express, against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from counterfoil.llm import oracle, queries

FOLDER = os.environ.get("COUNTERFOIL_TABLES", "/root/testdata/sf0.001")


def canon(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"create view {file.split('.')[0]} as select * from '{FOLDER}/{file}'")
    cursor = connection.execute(oracle.ORACLE_SQL[name])
    want = canon([c[0] for c in cursor.description], cursor.fetchall())
    df = queries.QUERIES[name](spark, FOLDER)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == want
