"""What steps leave on the disks when their result is written."""

import os
import time

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import changes
from counterfoil.operators.compare import typed_diff
from counterfoil.plans import registry
from counterfoil.plans.registry import QUERIES
from counterfoil.session import passing_shuffles, pin
from counterfoil.sources.documents import write_documents

FOLDER = "/root/testdata/sf0.001"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f for f in files.mkString("\n").splitlines() if os.path.basename(f).startswith("shuffle_")}


def left_by(spark, step):
    """Shuffle files that ``step`` leaves; Spark removes files a moment later."""
    known, result = shuffle_files(spark), step()
    for _ in range(50):
        if not (left := shuffle_files(spark) - known):
            break
        time.sleep(0.1)
    return result, left


def counted(spark):
    return spark.range(3000, numPartitions=4).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))


@pytest.mark.parametrize("outside", ["true", "false"])
def test_written_steps_leave_no_shuffle_files(spark, tmp_path, outside):
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, outside)
    try:
        pinned, left = left_by(spark, lambda: pin(counted(spark)))
        assert not left and pinned.agg(F.count("*"), F.sum("n")).first() == (700, 3000)
        _, left = left_by(spark, lambda: write_documents(counted(spark), f"{tmp_path}/docs"))
        assert not left and spark.read.text(f"{tmp_path}/docs").count() == 700
        with pytest.raises(ZeroDivisionError), passing_shuffles(spark):
            1 // 0
        assert spark.conf.get(CLEANUP) == outside
    finally:
        spark.conf.set(CLEANUP, before)


def test_compared_exports_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    rows = QUERIES["compare_exports"](spark, FOLDER).collect()
    written = [f for d, _, names in os.walk(tmp_path) for f in names if f.startswith("part-")]
    assert len(rows) == 3 and written and all(f.endswith(".json.gz") for f in written)


def test_document_sets_are_compared_one_after_the_other(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["doc_diff"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Items of products belong to another set; of the last one only the right side is still to be nested.
    nested = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert not [line for line in nested if "hashpartitioning(product_id" in line]
    assert len([line for line in nested if "hashpartitioning(customer_id" in line]) == 1


@pytest.mark.parametrize("apart", [True, False])
def test_typed_sides_written_apart(spark, apart):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b")], "`A B` int, c string")
    right = spark.createDataFrame([(1, "a"), (3, None), (None, "b"), (None, "b")], "AB int, c string")
    assert typed_diff(left, right, apart=apart).first() == (2, 2, 2)


def test_views_are_refreshed_one_after_the_other(spark):
    plan = QUERIES["mv_recomputed_keys"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    nested = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert [line for line in nested if "hashpartitioning(customer_id" in line]
    assert not [line for line in nested if "hashpartitioning(product_id" in line]


def test_changes_are_shuffled_once_for_their_keys_and_once_for_their_product(spark):
    feed = "op string, seq long, order_id long, product_id long, quantity int, new_order_id long, new_product_id long"
    rows = [("update", 1, 1, 1, 5, None, None), ("insert", 2, 1, 2, 9, None, None), ("insert", 3, 8, 2, 1, None, None),
            ("insert", 4, 1, 7, 1, None, None), ("delete", 5, 1, None, 1, None, None), ("delete", 6, None, 1, 1, None, None),
            ("update", 6, 1, 1, 5, None, None)]
    feed = spark.createDataFrame(rows, feed)
    lines = spark.createDataFrame([(1, 1, 3, None), (4, 2, 1, None)], "order_id long, product_id long, quantity int, unitPrice double")
    lines = lines.withColumn("unitPrice", F.col("unitPrice").cast("decimal(6,2)"))
    goods = "id long, name string, currentPrice double, availableQuantity int"
    goods = spark.createDataFrame([(1, "a", 2.0, 50), (2, "b", 3.0, 4), (2, "b", 3.0, 4), (3, "c", 1.0, None)], goods)
    orders = spark.createDataFrame([(1,), (4,)], "id long")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        prepared = changes._prepared(feed, lines, goods, orders)
        plan = prepared._jdf.queryExecution().executedPlan().toString()
        found = {(r["seq"], r["op"], r["product_id"], r["has_line"], r["held"], r["available"], r["_changes"], r["refused"])
                 for r in prepared.collect()}
        assert prepared.count() == 7 + 6  # four for each change of the product that is there twice
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert plan.count("Exchange hashpartitioning(order_id") == 2  # changes, and what is known of their keys
    assert found == {
        (1, "update", 1, True, 3, 50, None, None), (6, "update", 1, True, 3, 50, None, None),
        (2, "insert", 2, False, None, 4, 2, None), (3, "insert", 2, False, None, 4, 2, changes.NO_ORDER),
        (4, "insert", 7, False, None, None, None, changes.NO_PRODUCT),
        (5, "delete", None, False, None, None, None, changes.NO_KEY), (6, "delete", 1, False, None, 50, None, changes.NO_KEY),
    }
