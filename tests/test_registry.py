"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from counterfoil.plans import registry

FOLDER = os.environ.get("COUNTERFOIL_TABLES", "/root/testdata/sf0.001")
# The corpus queries have their own tests, where they are present.
QUERIES = registry.QUERIES
ORACLE = {name: text for name, text in entry_points.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"create view {file.split('.')[0]} as select * from '{FOLDER}/{file}'")
    return connection


def canon(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(row[i]) for i in order) for row in data)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    cursor = duck.execute(ORACLE[name])
    want = canon([c[0] for c in cursor.description], cursor.fetchall())
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == want


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["best_customer", "top10_customers", "best_product", "unsold_products", "recall", "fraud"])
def test_questions_build_no_documents(spark, name):
    plan = QUERIES[f"mongo_{name}"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def _counts_lines(spark, name):
    """Whether the tasks of the query itself count the line items, beside what reads the lines."""
    return any("lineitem.parquet" in file for file in QUERIES[name](spark, FOLDER).inputFiles())


def test_rules_read_lines_that_were_counted_before(spark):
    assert not _counts_lines(spark, "dq_report")


@pytest.mark.parametrize("name", ["event_lines", "changed_lines", "stream_event_lines"])
def test_changes_are_put_into_lines_that_were_counted_before(spark, name):
    assert not _counts_lines(spark, name)


def test_typed_comparison_needs_no_python(spark):
    plan = QUERIES["doc_diff"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_house_styles_share_the_shuffle_of_their_items(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["doc_diff"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    shuffles = [line for line in plan.splitlines() if "hashpartitioning(order_id" in line and "REPARTITION_BY_COL" in line]
    assert len([line for line in shuffles if "ReusedExchange" not in line]) == 1


def test_the_files_of_ids_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    rows = QUERIES["same_ids_from_files"](spark, FOLDER).collect()
    written = [f for d, _, names in os.walk(tmp_path) for f in names if f.startswith("part-")]
    assert len(rows) == 2 and written and all(f.endswith(".json.gz") for f in written)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_filters_and_columns_reach_the_scan(spark):
    report = scans(QUERIES["sales_report"](spark, FOLDER))
    lines = next(s for s in report if "lineitem" in s)
    assert "EqualTo(l_partkey,1)" in lines and "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in lines
    placed = next(s for s in report if "orders.parquet" in s)
    assert "GreaterThanOrEqual(o_orderdate" in placed and "LessThan(o_orderdate" in placed
    buyers = scans(QUERIES["v_product_buyers"](spark, FOLDER))
    assert not any("l_quantity" in s or "c_acctbal" in s for s in buyers)


def test_hot_parents_are_shuffled_by_block(spark):
    plan = QUERIES["v_product_buyers"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "part#" in plan
