import datetime as dt
import json
import os
import random
import time
from decimal import Decimal as D

import pytest

from counterfoil.operators import changes as ch
from counterfoil.operators import views
from counterfoil.session import job_scratch, pin
from counterfoil.streaming import jobs
from tests.conftest import rows
from tests.test_changes import FEED

NAMES = ("op", "seq", "order_id", "product_id", "quantity", "new_order_id", "new_product_id")


def drop(folder, name, records, at):
    """A change file with a set time, so that the stream takes the files in order."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.json"
    with open(path, "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in records)
    os.utime(path, (at, at))


def line_files(folder, cuts):
    now = int(time.time()) - 1000
    for n, (a, b) in enumerate(cuts):
        drop(folder, f"f{n}", [dict(zip(NAMES, row)) for row in FEED[a:b]], now + 10 * n)


def run(spark, make_source, source_path, pos, root, **options):
    """All files that are there, one a micro-batch."""
    jobs.start(make_source(spark, source_path, 1), pos, root, once=True, **options).awaitTermination()
    return jobs.log(spark, root)


def outcomes(log, *columns):
    return rows(log.select("seq", *columns))


def test_line_stream_equals_one_batch(spark, priced_shop, tmp_path):
    feed, root = f"{tmp_path}/feed", f"{tmp_path}/lines"
    line_files(feed, [(0, 4), (4, 9)])
    log = run(spark, jobs.line_change_stream, feed, priced_shop, root)
    now, touched = jobs.settled(priced_shop, log)
    stock = {r["id"]: r["availableQuantity"] for r in now.products.collect()}
    assert (stock[1], stock[3], stock[8]) == (3, None, 0)
    orders = {r["id"]: (r["subtotal"], r["salesTax"]) for r in now.orders.collect()}
    assert orders[10] == (D("3558.50"), D("293.58")) and orders[12] == (D("2488.99"), D("0.00"))
    fresh = views.refresh_products(views.product_buyers(priced_shop), now, touched.products)
    assert rows(fresh) == rows(views.product_buyers(now))
    assert rows(jobs.rejected(log).select("seq")) == [(2,), (4,), (8,)]

    # A late change is refused; what the state holds of the first two batches counts.
    late = [dict(zip(NAMES, ("insert", 3, 14, 1, 1, None, None))), dict(zip(NAMES, ("insert", 20, 14, 1, 1, None, None)))]
    drop(feed, "f9", late, int(time.time()))
    log = run(spark, jobs.line_change_stream, feed, priced_shop, root)
    assert rows(jobs.rejected(log).where("reason = 'Late change'").select("seq")) == [(3,)]
    now, _ = jobs.settled(priced_shop, log)
    assert {r["id"]: r["availableQuantity"] for r in now.products.collect()}[1] == 2


def test_a_batch_that_is_done_again_changes_nothing(spark, priced_shop, tmp_path):
    """The last commit of the checkpoint is lost: Spark runs that batch anew on the state before it, the log keeps it once."""
    feed, root = f"{tmp_path}/feed", f"{tmp_path}/lines"
    line_files(feed, [(0, 3), (3, 6)])
    before = run(spark, jobs.line_change_stream, feed, priced_shop, root)
    want = outcomes(before, "accepted", "delta")
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{root}/checkpoint/commits/{name}"):
            os.unlink(f"{root}/checkpoint/commits/{name}")
    assert outcomes(run(spark, jobs.line_change_stream, feed, priced_shop, root), "accepted", "delta") == want
    line_files(feed, [(0, 3), (3, 6), (6, 9)])
    log = run(spark, jobs.line_change_stream, feed, priced_shop, root)
    assert [r[0] for r in outcomes(log)] == list(range(1, 10))
    whole = ch.decide_changes(
        spark.createDataFrame(FEED, jobs.LINE_CHANGE), priced_shop.lines, priced_shop.products, priced_shop.orders
    )
    columns = ("accepted", "reason", "old_quantity", "delta", "unit_price")
    assert outcomes(log, *columns) == outcomes(whole, *columns)


def test_a_stream_that_stops_half_way_goes_on(spark, priced_shop, tmp_path):
    """A batch fails in the sink, after its events were decided; the next start decides them again, once."""
    feed, root = f"{tmp_path}/feed", f"{tmp_path}/lines"
    line_files(feed, [(0, 5)])
    run(spark, jobs.line_change_stream, feed, priced_shop, root)
    line_files(feed, [(0, 5), (5, 9)])
    metadata = f"{root}/log/_spark_metadata"
    os.makedirs(f"{metadata}/1")  # stands where the sink wants to write the mark of the batch
    with pytest.raises(Exception):
        run(spark, jobs.line_change_stream, feed, priced_shop, root)
    os.rmdir(f"{metadata}/1")
    log = run(spark, jobs.line_change_stream, feed, priced_shop, root)
    assert {r[0]: r[1] for r in outcomes(log, "accepted")} == {s: s not in (2, 4, 8) for s in range(1, 10)}
    assert log.count() == 9


def test_guard_stream(spark, shop, tmp_path):
    feed, root = f"{tmp_path}/feed", f"{tmp_path}/guard"
    line_files(feed, [(0, 2), (2, 3), (3, 9)])
    log = run(spark, jobs.line_change_stream, feed, shop, root, check_orders=False)
    assert {r["seq"]: r["accepted"] for r in log.collect()} == {s: s not in (2, 4, 8) for s in range(1, 10)}


def test_log_of_a_stream_that_never_ran(spark, tmp_path):
    assert jobs.log(spark, f"{tmp_path}/none").collect() == []


def test_price_stream(spark, shop, tmp_path):
    feed, root = f"{tmp_path}/feed", f"{tmp_path}/prices"
    now = int(time.time()) - 1000
    change = lambda p, price, seq: {"product_id": p, "price": price, "ts": "2024-03-01T10:00:00", "seq": seq}
    drop(feed, "a", [change(1, 1234.50, 1), change(1, 1200.00, 2)], now)
    drop(feed, "b", [change(1, 1200.00, 3), change(7, 10.00, 4), change(1, 1100.00, 2), change(99, 5.00, 5)], now + 10)
    log = run(spark, jobs.price_change_stream, feed, shop, root)
    after, _ = jobs.settled(shop, log)
    steps = ("product_id", "oldPrice", "newPrice", "seq")
    assert rows(after.price_history.select(*steps)) == [(1, D("1234.50"), D("1200.00"), 2)]
    assert rows(jobs.price_log(log, log_unchanged=True).select(*steps)) == [
        (1, D("1200.00"), D("1200.00"), 3), (1, D("1234.50"), D("1200.00"), 2), (1, D("1234.50"), D("1234.50"), 1),
        (7, None, D("10.00"), 4),
    ]
    assert {r["id"]: r["currentPrice"] for r in after.products.collect()}[7] == D("10.00")
    assert rows(jobs.rejected(log).select("seq", "reason")) == [(2, jobs.LATE), (5, "No such product")]


def test_refusals_of_a_stream(spark, shop, tmp_path):
    """Malformed changes are refused as in a batch, make nothing late and need no state."""
    data = [
        ("drop", 900, 10, 3, 1, None, None), ("insert", 5, None, 1, 1, None, None), ("insert", 6, 10, None, 1, None, None),
        ("update", None, 10, 1, 1, None, None), ("insert", 7, 99, 1, 1, None, None), ("insert", 8, 10, 99, 1, None, None),
        (None, 9, 10, 1, 1, None, None), ("update", 11, 10, 1, 3, 11, 1),
    ]
    feed, now = f"{tmp_path}/feed", int(time.time()) - 1000
    drop(feed, "a", [dict(zip(NAMES, row)) for row in data], now)
    drop(feed, "b", [dict(zip(NAMES, ("insert", 20, 10, 3, 1, None, None)))], now + 10)
    log = run(spark, jobs.line_change_stream, feed, shop, f"{tmp_path}/lines")
    whole = ch.decide_changes(spark.createDataFrame(data, jobs.LINE_CHANGE), shop.lines, shop.products, shop.orders)
    assert outcomes(log.where("seq is null or seq <> 20"), "reason") == outcomes(whole, "reason")
    assert rows(log.where("seq = 20").select("accepted")) == [(True,)]


def test_event_stream_equals_one_batch(spark, priced_shop, tmp_path):
    """Line and price changes of one feed, cut into three micro-batches."""
    rng = random.Random(5)
    lines, sets = [], []
    for seq in range(1, 61):
        product = rng.choice([1, 2, 3, 8])
        if rng.random() < 0.4:
            sets.append((product, D(rng.randrange(100, 900)), dt.datetime(2024, 3, 1, 10, 0, seq % 60), seq))
        else:
            op = rng.choice(["insert", "insert", "update", "delete"])
            lines.append((op, seq, rng.choice([10, 11, 12, 14]), product, rng.randrange(1, 3), None, None))
    sets.append((99, D(7), None, 61))
    records = [dict(zip(NAMES, row)) for row in lines]
    records += [{"op": "price", "product_id": p, "price": float(v), "ts": t and t.isoformat(), "seq": s} for p, v, t, s in sets]
    records.sort(key=lambda r: r["seq"])
    feed, root, now = f"{tmp_path}/feed", f"{tmp_path}/events", int(time.time()) - 1000
    for n in range(3):
        drop(feed, f"f{n}", records[n * 21 : (n + 1) * 21], now + 10 * n)
    log = run(spark, jobs.event_stream, feed, priced_shop, root)

    after, _, rejected = ch.apply_events(
        priced_shop, spark.createDataFrame(lines, jobs.LINE_CHANGE), spark.createDataFrame(sets, jobs.PRICE_CHANGE)
    )
    got, _ = jobs.settled(priced_shop, log)
    for table in ("lines", "products", "orders"):
        columns = getattr(after, table).columns
        assert rows(getattr(got, table).select(*columns)) == rows(getattr(after, table))
    steps = ("product_id", "oldPrice", "newPrice", "seq")
    assert rows(got.price_history.select(*steps)) == rows(after.price_history.select(*steps))
    # Batch and stream refuse the same, price changes of unknown products included.
    assert rows(jobs.rejected(log).select("seq", "reason")) == rows(rejected.select("seq", "reason"))
    assert (61, "No such product") in rows(rejected.select("seq", "reason"))


def test_scratch_tables_of_a_job_go_with_it(spark):
    with job_scratch(spark) as folder:
        pinned = pin(spark.range(5))
        path = pinned.inputFiles()[0].removeprefix("file:").replace("//", "")
        assert pinned.count() == 5 and os.path.exists(path) and os.path.basename(folder) in path
    assert not os.path.exists(path)
    kept = pin(spark.range(3))
    assert kept.count() == 3


def test_a_table_pinned_by_folders_keeps_its_rows(spark):
    df = spark.range(10).selectExpr("id % 3 as part", "id")
    pinned = pin(df, "part")
    assert pinned.columns == ["part", "id"] and rows(pinned) == rows(df)


def test_state_holds_products_with_events_only(spark, priced_shop, tmp_path):
    """Stock and price of the others are looked up when they have one; rows with one id count as one."""
    feed, root = f"{tmp_path}/feed", f"{tmp_path}/lines"
    twice = priced_shop.with_(products=priced_shop.products.unionAll(priced_shop.products))
    line_files(feed, [(0, 3), (3, 9)])
    log = run(spark, jobs.line_change_stream, feed, twice, root)
    assert [r[0] for r in outcomes(log)] == list(range(1, 10))
    state = spark.read.format("statestore").option("stateVarName", "product").load(f"{root}/checkpoint")
    assert state.count() == len({row[3] for row in FEED if row[3] is not None}) < priced_shop.products.count()
