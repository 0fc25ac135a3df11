"""Views kept by counts equal views computed afresh, whatever changes and however often a refresh is run."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from counterfoil.model import LINE_CHANGE
from counterfoil.operators import changes as ch
from counterfoil.operators import counted, views
from tests.conftest import rows

FULL = {
    counted.BUYERS: (counted.buyers_of, lambda pos: views.product_buyers(pos)),
    counted.ALL_BUYERS: (counted.buyers_of, lambda pos: views.product_buyers(pos, distinct=False)),
    counted.PURCHASES: (counted.purchases_of, lambda pos: views.customer_purchases(pos)),
    counted.ALL_PURCHASES: (counted.purchases_of, lambda pos: views.customer_purchases(pos, distinct=False)),
}


def files(folder):
    return {f for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet") for f in [f"{d}/{n}"]}


def feed(spark, seed, at):
    rng = random.Random(seed)
    data = [
        (rng.choice(["insert", "insert", "update", "delete"]), at + n, rng.choice([10, 11, 12, 14, 15]),
         rng.choice([1, 2, 3, 5, 8]), 1, None, None)
        for n in range(30)
    ]
    return spark.createDataFrame(data, LINE_CHANGE)


@pytest.mark.parametrize("view", list(FULL), ids=lambda v: v.name)
def test_refreshes_equal_a_recomputation(spark, priced_shop, tmp_path, view):
    lines = f"{tmp_path}/lines"
    priced_shop.lines.write.parquet(lines)
    pos = priced_shop.with_(
        lines=spark.read.parquet(lines), products=priced_shop.products.withColumn("availableQuantity", F.lit(20))
    )
    stored = counted.CountedView(spark, f"{tmp_path}/views", view, folders=8).create(pos)
    read, full = FULL[view]
    assert rows(read(stored, pos)) == rows(full(pos))
    for number in (1, 2):
        accepted, _ = ch.validate_changes(feed(spark, number, number * 100), pos.lines, pos.products, pos.orders)
        after, _ = ch.apply_changes(pos, accepted)
        changes = counted.changed_pairs(accepted, pos.orders)
        stored.refresh(changes, number, pos)
        assert rows(read(stored, pos)) == rows(full(after))
        # Run again, all of it or what a failure left undone: nothing counts twice.
        stored.refresh(changes, number, pos)
        assert rows(read(stored, pos)) == rows(full(after))
        lines = f"{tmp_path}/lines-{number}"
        after.lines.write.parquet(lines)
        pos = after.with_(lines=spark.read.parquet(lines))


def test_a_refresh_reads_no_lines_and_writes_what_it_touches(spark, priced_shop, tmp_path):
    lines = f"{tmp_path}/lines"
    priced_shop.lines.write.parquet(lines)
    pos = priced_shop.with_(lines=spark.read.parquet(lines))
    stored = counted.CountedView(spark, f"{tmp_path}/views", counted.BUYERS, folders=64).create(pos)
    shutil.rmtree(lines)
    before = {name: files(f"{stored.root}/{name}") for name in ("pairs", "texts")}
    changes = spark.createDataFrame([(2, 1, -1), (3, 4, 1)], "product_id long, customer_id long, change int")
    want = {r["owner"]: r["text"] for r in stored.lists().collect()}
    stored.refresh(changes, 1, pos)
    for name, old in before.items():
        new = files(f"{stored.root}/{name}")
        assert len(old - new) <= 2 and old & new
    got = {r["owner"]: r["text"] for r in stored.lists().collect()}
    assert got[1] == want[1] and got[3].endswith("4 Dee Fox")
    pairs = {(r["owner"], r["member"]): r["copies"] for r in stored._read("pairs").collect()}
    assert pairs[3, 4] == 1


def test_a_refresh_that_failed_between_pairs_and_texts(spark, priced_shop, tmp_path, monkeypatch):
    stored = counted.CountedView(spark, f"{tmp_path}/views", counted.BUYERS, folders=4).create(priced_shop)
    changes = spark.createDataFrame([(5, 2, 1), (1, 1, -2)], "product_id long, customer_id long, change int")
    write = counted.CountedView._write

    def broken(self, df, name):
        if name == "texts":
            raise OSError("lost")
        write(self, df, name)

    monkeypatch.setattr(counted.CountedView, "_write", broken)
    with pytest.raises(OSError):
        stored.refresh(changes, 7, priced_shop)
    monkeypatch.setattr(counted.CountedView, "_write", write)
    stored.refresh(changes, 7, priced_shop)
    lists = {r["owner"]: r["text"] for r in stored.lists().collect()}
    assert lists[5] == "2 Bob Ray"
    pairs = {(r["owner"], r["member"]): r["copies"] for r in stored._read("pairs").collect()}
    before = {(r["product_id"], r["customer_id"]): r["copies"] for r in views.bought_pairs(priced_shop).collect()}
    assert pairs[5, 2] == 1 and pairs[1, 1] == before[1, 1] - 2
    stored.refresh(changes.limit(0), 8, priced_shop)


def test_pairs_of_many_members_are_cut_in_blocks(spark, priced_shop, tmp_path):
    """Members far apart are in texts of their own; one that changes leaves the others alone."""
    far = spark.createDataFrame([(n << 16, f"F{n}", f"L{n}") for n in range(5)], "id long, firstName string, lastName string")
    orders = spark.createDataFrame([(100 + n, n << 16) for n in range(5)], "id long, customer_id long")
    lines = spark.createDataFrame([(100 + n, 1) for n in range(4)], "order_id long, product_id long")
    pos = priced_shop.with_(customers=far, orders=orders, lines=lines)
    stored = counted.CountedView(spark, f"{tmp_path}/views", counted.BUYERS, folders=32).create(pos)
    assert stored.texts().count() == 4
    accepted = spark.createDataFrame([("insert", 104, 1), ("delete", 100, 1)], "op string, order_id long, product_id long")
    stored.refresh(counted.changed_pairs(accepted, orders), 1, pos)
    assert [r["part"] for r in stored.texts().orderBy("part").collect()] == [1, 2, 3, 4]
    assert stored.lists().first()["text"] == ",".join(f"{n << 16} F{n} L{n}" for n in range(1, 5))


@pytest.mark.parametrize("view", [counted.BUYERS, counted.ALL_BUYERS], ids=lambda v: v.name)
def test_a_folder_is_written_by_several_tasks(spark, priced_shop, tmp_path, view):
    """A view of few folders is not put together by as few tasks, whether it is created or refreshed."""
    orders = spark.createDataFrame([(100 + n, n % 4 + 1) for n in range(200)], "id long, customer_id long")
    lines = spark.createDataFrame([(100 + n, n) for n in range(200)], "order_id long, product_id long")
    pos = priced_shop.with_(orders=orders, lines=lines)
    changes = spark.createDataFrame([(n, 5, 1) for n in range(200)], "product_id long, customer_id long, change int")

    def written(name):
        found = {}
        for file in files(f"{stored.root}/{name}"):
            found.setdefault(os.path.dirname(file), set()).add(file)
        return [len(of) for of in found.values()]

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored = counted.CountedView(spark, f"{tmp_path}/views", view, folders=2).create(pos)
        created = written("pairs") + written("texts")
        stored.refresh(changes, 1, pos)
        assert min(created + written("pairs") + written("texts")) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lists = {r["owner"]: r["text"] for r in stored.lists().collect()}
    assert len(lists) == 200 and lists[0] == "1 Ann Lee,5 Eve Sun"
