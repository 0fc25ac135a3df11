"""Small tables that are written between steps lie in few files, however many partitions a shuffle has."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from counterfoil import session
from counterfoil.llm import mixing, secrets, simhash, warc
from counterfoil.llm.components import components
from counterfoil.session import pin, scratch_path, shared_folder

PARTITIONS = 24
ADAPTIVE = "spark.sql.adaptive.coalescePartitions.enabled"


@pytest.fixture
def dealt(spark):
    """Many partitions that stay as they are; gives the numbers of files of the tables pinned meanwhile."""
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", ADAPTIVE)}
    spark.conf.set("spark.sql.shuffle.partitions", str(PARTITIONS))
    spark.conf.set(ADAPTIVE, "false")
    folder = Path(shared_folder(spark).removeprefix("file:"))
    known = set(folder.glob("pinned-*"))
    yield lambda: [len(list(p.glob("part-*"))) for p in set(folder.glob("pinned-*")) - known]
    for key, value in before.items():
        spark.conf.set(key, value)


def few(spark):
    return spark.sparkContext.defaultParallelism


def test_files_follow_the_rows(spark, dealt, monkeypatch):
    rows = spark.range(2000).repartition(PARTITIONS, "id")
    assert len(pin(rows).inputFiles()) == PARTITIONS
    table = pin(rows, rows=2000)
    assert len(table.inputFiles()) == few(spark) and table.agg(F.sum("id")).first()[0] == 1999 * 1000
    monkeypatch.setattr(session, "FILE_ROWS", 200)
    assert len(pin(rows, rows=2000).inputFiles()) == 10
    assert len(pin(rows, rows=10**9).inputFiles()) == PARTITIONS


def test_rounds_of_components(spark, dealt):
    edges = pin(spark.range(600).select(F.col("id").alias("a"), (F.col("id") + 600).alias("b")).repartition(4))
    got = {tuple(r) for r in components(edges).collect()}
    assert got == {(i, i % 600) for i in range(1200)}
    assert max(dealt()) <= few(spark)


def test_fingerprints(spark, dealt):
    texts = [(i, f"the text of number {i % 200} " + " ".join(f"w{i % 200 * 7 + k}" for k in range(30))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert len(got) == 400 and all(got[i] == got[i % 200] <= i % 200 for i in got)
    # The pairs themselves leave a heavy join, which keeps its tasks.
    assert sorted(dealt())[-2] <= few(spark)


def test_index_keeps_its_order(spark, dealt):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.org/{i % 40}", f"<p>{i % 90}") for i in range(300)], "page_id long, url string, html string")
    index, folder = warc.archive_pages(pages.repartition(3), F.lit("2024-01-01T00:00:00Z"))
    rows = index.orderBy("place").collect()
    keys = [(r["urlkey"], r["stamp"], r["record_id"]) for r in rows]
    assert len(keys) == 300 and keys == sorted(keys)
    seen = {}
    for r in rows:
        seen[r["urlkey"]] = seen.get(r["urlkey"], 0) + 1
        assert r["capture"] == seen[r["urlkey"]]
    assert len({r["place"]["part"] for r in rows}) > few(spark)  # ranges are as many as before
    assert warc.read(index, folder).count() == 300
    # Repeated payloads alone are written by hash.
    assert sorted(dealt())[-2] <= few(spark)


def test_spans_and_sizes(spark, dealt):
    texts = [(i, f"password = hunter{i:08d}x and {'word ' * (i % 150)}", f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(2)
    scanned = secrets.scan(docs, secrets.create_ledger(spark, scratch_path(spark, "ledger")))
    assert secrets.findings(docs, scanned).agg(F.sum("n_assign")).first()[0] == 300
    assert secrets.redact(docs, scanned).filter(F.col("text").contains("hunter")).isEmpty()
    assert mixing.mix(docs).count() == 300
    assert max(dealt()) <= few(spark)
