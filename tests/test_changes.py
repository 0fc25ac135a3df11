import itertools
import random
from decimal import Decimal as D

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from counterfoil.functions.stock_fold import ALREADY_THERE, KEY_CHANGE, NO_LINE, NOT_ENOUGH, Bounds
from counterfoil.model import LINE_CHANGE, PRICE_CHANGE
from counterfoil.operators import changes as ch
from counterfoil.operators import money, prices, views
from counterfoil.operators.stock_blocks import exact_starts
from tests.conftest import rows

FEED = [
    ("insert", 1, 11, 1, None, None, None),
    ("insert", 2, 14, 1, 9, None, None),
    ("insert", 3, 12, 1, 4, None, None),
    ("insert", 4, 10, 8, 1, None, None),
    ("insert", 5, 10, 3, 50, None, None),
    ("update", 6, 10, 2, 0, None, None),
    ("update", 7, 12, 1, 2, None, None),
    ("update", 8, 10, 2, 5, None, 3),
    ("delete", 9, 11, 1, None, None, None),
]


def feed_of(spark, data=FEED):
    return spark.createDataFrame(data, LINE_CHANGE)


def decide(spark, pos, data=FEED, **options):
    decided = ch.decide_changes(feed_of(spark, data), pos.lines, pos.products, pos.orders, **options)
    return {r["seq"]: r for r in decided.collect()}


def test_fixture_feed_row_by_row(spark, priced_shop):
    got = decide(spark, priced_shop)
    reasons = {s: r["reason"] for s, r in got.items() if not r["accepted"]}
    assert reasons == {2: NOT_ENOUGH, 4: NOT_ENOUGH, 8: KEY_CHANGE}
    assert {s: r["delta"] for s, r in got.items() if r["accepted"]} == {1: 1, 3: 4, 5: 50, 6: 0, 7: -2, 9: -1}
    assert got[1]["quantity"] == 1 and got[3]["unit_price"] == D("1234.50")


def test_apply_fixture_feed(spark, priced_shop):
    p = priced_shop
    ok, rejected = ch.validate_changes(feed_of(spark), p.lines, p.products, p.orders)
    assert rejected.count() == 3
    after, touched = ch.apply_changes(p, ok)
    stock = {r["id"]: r["availableQuantity"] for r in after.products.collect()}
    assert stock[1] == 3 and stock[8] == 0 and stock[3] is None and stock[2] == 12
    assert rows(after.lines.drop("unitPrice")) == [
        (10, 1, 2), (10, 2, 1), (10, 3, 50), (11, 2, 1), (12, 1, 2), (12, 3, 1), (14, 2, 3),
    ]
    orders = {r["id"]: (r["subtotal"], r["salesTax"]) for r in after.orders.collect()}
    assert orders[12] == (D("2488.99"), D("0.00"))
    assert orders[10] == (D("3558.50"), D("293.58"))
    assert orders[14] == (D("270.00"), D("0.00")) and orders[15] == (None, D("0.00"))
    assert rows(touched.customers) == [(1,), (2,)] and rows(touched.products) == [(1,), (2,), (3,)]
    stale = views.product_buyers(p)
    fresh = views.refresh_products(stale, after, touched.products)
    assert rows(fresh) == rows(views.product_buyers(after))
    purchases = views.refresh_customers(views.customer_purchases(p), after, touched.customers)
    assert rows(purchases) == rows(views.customer_purchases(after))


def test_batch_fails_as_a_whole(spark, priced_shop):
    inserts = [row for row in FEED if row[0] == "insert"]
    got = decide(spark, priced_shop, inserts, mode="batch")
    assert not any(r["accepted"] for r in got.values())
    assert got[2]["reason"] == NOT_ENOUGH and got[5]["reason"] == ch.BATCH
    fine = decide(spark, priced_shop, [inserts[0], inserts[4]], mode="batch")
    assert all(r["accepted"] for r in fine.values())
    check = ch.batch_stock_check(feed_of(spark, inserts), priced_shop.products)
    assert rows(check) == [(1, 14, 5, False), (3, 50, None, True), (8, 1, 0, False)]


def test_refusals(spark, priced_shop):
    data = [
        ("insert", 1, 10, 1, 1, None, None),
        ("update", 2, 11, 7, 1, None, None),
        ("delete", 3, 11, 7, 1, None, None),
        ("insert", 4, 99, 1, 1, None, None),
        ("insert", 5, 10, 99, 1, None, None),
        ("replace", 6, 10, 1, 1, None, None),
        ("insert", 7, None, 1, 1, None, None),
        ("update", 8, 10, 1, 3, 10, 1),
        ("update", 9, 10, 1, 3, 11, 1),
    ]
    got = {s: r["reason"] for s, r in decide(spark, priced_shop, data).items()}
    assert got == {
        1: ALREADY_THERE, 2: NO_LINE, 3: NO_LINE, 4: ch.NO_ORDER, 5: ch.NO_PRODUCT, 6: ch.BAD_OP, 7: ch.NO_KEY,
        8: None, 9: KEY_CHANGE,
    }


def test_strict_mode_raises(spark, priced_shop):
    p = priced_shop
    decided = ch.decide_changes(feed_of(spark), p.lines, p.products)
    with pytest.raises(PySparkException, match="USER_RAISED_EXCEPTION"):
        ch.or_fail(decided).collect()
    good = decided.where("accepted")
    assert ch.or_fail(good).count() == 6


def test_totals_after_a_priceless_line(spark, priced_shop):
    # Product 7 has no price: its line makes the total unknown, the next change starts at zero.
    data = [("insert", 1, 14, 7, 1, None, None), ("update", 2, 14, 2, 5, None, None)]
    ok, _ = ch.validate_changes(feed_of(spark, data), priced_shop.lines, priced_shop.products)
    totals = {r["id"]: r["subtotal"] for r in ch.apply_changes(priced_shop, ok)[0].orders.collect()}
    assert totals[14] == D("180.00")
    totals = {r["id"]: r["subtotal"] for r in ch.apply_changes(priced_shop, ok.where("seq = 1"))[0].orders.collect()}
    assert totals[14] is None and totals[10] == D("2559.00")
    kept = {r["id"]: r["subtotal"] for r in ch.apply_changes(priced_shop, ok, "keep")[0].orders.collect()}
    assert kept[14] is None and kept[10] == D("2559.00")
    data = [("insert", 1, 15, 2, 1, None, None)]
    ok, _ = ch.validate_changes(feed_of(spark, data), priced_shop.lines, priced_shop.products)
    first = {m: {r["id"]: r["subtotal"] for r in ch.apply_changes(priced_shop, ok, m)[0].orders.collect()}[15] for m in ("zero", "keep")}
    assert first == {"zero": D("90.00"), "keep": None}


def test_add_items(spark, priced_shop):
    items = spark.createDataFrame([(11, 1, 2, 1), (11, 8, 1, 2)], "order_id long, product_id long, quantity int, seq long")
    after, touched, rejected = ch.add_items(priced_shop, items)
    assert {r["id"]: r["availableQuantity"] for r in after.products.collect()}[1] == 3  # taken once
    assert {r["id"]: r["subtotal"] for r in after.orders.collect()}[11] == D("2559.00")
    assert rows(rejected.select("seq")) == [(2,)] and rows(touched.orders) == [(11,)]


def simulate(feed, stock, lines):
    """The row rules, one change at a time."""
    stock, lines, out = dict(stock), dict(lines), {}
    for op, seq, order, product, quantity, _, _ in sorted(feed, key=lambda r: r[1]):
        key, left = (order, product), stock[product]
        quantity = 1 if quantity is None or quantity < 1 else quantity
        old = lines.get(key)
        if op == "insert":
            reason, used = (ALREADY_THERE if old else None), quantity
        elif old is None:
            reason, used = NO_LINE, 0
        else:
            reason, used = None, quantity - old if op == "update" else -old
        if reason is None and left is not None and used > 0 and used > left:
            reason = NOT_ENOUGH
        if reason is None:
            if op == "delete":
                del lines[key]
            else:
                lines[key] = quantity
            if left is not None:
                stock[product] = left - used
        out[seq] = reason
    return out, stock, lines


@pytest.mark.parametrize(
    "seed, plenty, block_rows", [(1, False, 65_536), (2, True, 65_536), (2, True, 0), (3, False, 40), (4, False, 7)]
)
def test_random_feeds_against_the_row_rules(spark, seed, plenty, block_rows):
    """Decisions by windows, in one walk and in blocks all equal the row-by-row simulation; one product is hot."""
    rng = random.Random(seed)
    seqs = rng.sample(range(0, 20 << 16), 500)
    feed = [
        (
            rng.choice(["insert", "insert", "update", "delete"]), s, rng.randrange(12),
            1 if rng.random() < 0.5 else rng.randrange(2, 6), rng.choice([None, 0, 1, 2, 3, 5]), None, None,
        )
        for s in seqs
    ]
    stock = {p: (None if p == 5 else 10_000 if plenty else rng.randrange(0, 25)) for p in range(1, 6)}
    held = {(o, p): rng.randrange(1, 4) for o in range(12) for p in range(1, 6) if rng.random() < 0.3}
    products = spark.createDataFrame(
        [(p, "x", D("2.50"), s) for p, s in stock.items()], "id long, name string, currentPrice decimal(6,2), availableQuantity int"
    )
    lines = spark.createDataFrame(
        [(o, p, q, D("1.00")) for (o, p), q in held.items()], "order_id long, product_id long, quantity int, unitPrice decimal(6,2)"
    )
    want, stock_after, lines_after = simulate(feed, stock, held)
    decided = ch.decide_changes(feed_of(spark, feed), lines, products, block_rows=block_rows)
    got = {r["seq"]: r for r in decided.collect()}
    assert {s: r["reason"] for s, r in got.items()} == want
    accepted = decided.where("accepted")
    used = {r["product_id"]: r["used"] for r in ch.stock_use(accepted).collect()}
    assert {p: None if s is None else s - used.get(p, 0) for p, s in stock.items()} == stock_after
    images = {(r["order_id"], r["product_id"]): r for r in ch.line_images(accepted).collect()}
    final = {k: q for k, q in held.items() if k not in images}
    final.update({k: r["quantity"] for k, r in images.items() if not r["gone"]})
    assert final == lines_after
    # A line born in this batch has the current price, one from before keeps its own.
    born = set()
    for op, s, o, p, *_ in sorted(feed, key=lambda r: r[1]):
        if got[s]["accepted"]:
            if op == "insert":
                born.add((o, p))
            assert got[s]["unit_price"] == (D("2.50") if (o, p) in born else D("1.00"))


@pytest.mark.parametrize("seed, stock", [(21, (0, 1, 7, 64, 300)), (22, (1, 2, 3, 1000, None)), (23, (15, 16, 17, 31, 33))])
def test_many_inserts_of_a_product(spark, seed, stock):
    """Blocks accept exactly what the row rules accept, repeated lines included."""
    rng = random.Random(seed)
    size = lambda: rng.choice([None, 1, 1, 2, 3, rng.randrange(1, 20), rng.randrange(1, 400)])
    feed = [
        ("insert", s, rng.randrange(60), 1 if rng.random() < 0.4 else rng.randrange(2, 6), size(), None, None)
        for s in rng.sample(range(1 << 21), 500)
    ]
    stock = dict(zip(range(1, 6), stock))
    held = {(o, p): 2 for o in range(60) for p in stock if rng.random() < 0.1}
    products = spark.createDataFrame(
        [(p, "x", D("2.50"), s) for p, s in stock.items()],
        "id long, name string, currentPrice decimal(6,2), availableQuantity int",
    )
    lines = spark.createDataFrame(
        [(o, p, q, D("1.00")) for (o, p), q in held.items()],
        "order_id long, product_id long, quantity int, unitPrice decimal(6,2)",
    )
    want, _, lines_after = simulate(feed, stock, held)
    got = {r["seq"]: r for r in ch.decide_changes(feed_of(spark, feed), lines, products, block_rows=30).collect()}
    folded = {r["seq"]: r for r in ch.decide_changes(feed_of(spark, feed), lines, products).collect()}
    assert {s: r["reason"] for s, r in got.items()} == want
    assert got == folded
    accepted = {(r["order_id"], r["product_id"]): r["quantity"] for r in got.values() if r["accepted"]}
    assert {**held, **accepted} == lines_after


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_bounds_hold_what_may_happen(data):
    """From any stock and lines within the bounds, the walk ends within the bounds, and with the net use if there is one."""
    small = st.integers(0, 6)
    low, high = sorted([data.draw(small), data.draw(small)])
    starts = {}
    for order in range(2):
        a, b = sorted([data.draw(st.integers(1, 4)), data.draw(st.integers(1, 4))])
        possible = data.draw(st.booleans())
        starts[order] = (possible and data.draw(st.booleans()), possible, *((a, b) if possible else (0, 0)), None if possible else False)
    feed = data.draw(
        st.lists(st.tuples(st.sampled_from(["insert", "update", "delete"]), st.integers(0, 1), st.integers(1, 5), st.booleans()), max_size=8)
    )
    bounds = Bounds(1, 0, low, high)
    for op, order, quantity, moved in feed:
        bounds.apply(op, order, quantity, op == "update" and moved, starts[order])
    for stock in range(low, high + 1):
        ways = [[None] * (not starts[o][0]) + list(range(starts[o][2], starts[o][3] + 1)) * starts[o][1] for o in range(2)]
        for lines in itertools.product(*ways):
            held = {(o, 1): q for o, q in enumerate(lines) if q is not None}
            rows = [(op, n, o, 1, q, None, None) for n, (op, o, q, moved) in enumerate(feed) if not (op == "update" and moved)]
            _, after, left = simulate(rows, {1: stock}, held)
            assert bounds.low <= after[1] <= bounds.high
            assert max(stock - bounds.most, bounds.floor) <= after[1] <= max(stock - bounds.least, bounds.cap)
            for order in range(2):
                certain, possible, least, most, _ = bounds.lines.get(order, starts[order])
                q = left.get((order, 1))
                assert (possible and least <= q <= most) if q is not None else not certain


def crowded_rows(spark, feed, stock, held):
    """Prepared changes of products with known stock, as the decisions get them."""
    rows = [
        (op, seq, order, product, q if op != "delete" else None, False, stock[product], held.get((order, product)), (order, product) in held, False)
        for op, seq, order, product, q in feed
    ]
    return spark.createDataFrame(
        rows, "op string, seq long, order_id long, product_id long, quantity int, moved boolean, available int, held int, has_line boolean, born boolean"
    )


@pytest.mark.parametrize("kinds", [["insert"], ["insert", "insert", "update", "delete"]])
def test_rounds_do_not_grow_with_rows(spark, kinds):
    """Stock that runs short, and stock that lasts for most of the feed, need about as many rounds for 8 blocks as for 32."""
    rounds = []
    for size in (1600, 6400):
        rng = random.Random(size)
        feed = [(rng.choice(kinds), n * 2000, rng.randrange(size), 1 + n % 2, rng.randrange(1, 9)) for n in range(size)]
        stock = {1: 100, 2: int(size * 1.2)}
        exact, n = exact_starts(crowded_rows(spark, feed, stock, {}), 100)
        rounds.append(n)
        assert exact.select("_block").distinct().count() >= size / 400
        firsts = {r["product_id"]: r["available"] for r in exact.where("_block = 0").select("product_id", "available").distinct().collect()}
        assert firsts == stock
    assert max(rounds) <= 8, rounds


@pytest.mark.parametrize("seed", [11, 12])
def test_totals_and_views_after_changes_equal_a_recomputation(spark, priced_shop, seed):
    rng = random.Random(seed)
    feed = [
        (rng.choice(["insert", "update", "delete"]), s, rng.choice([10, 11, 12, 14, 15]), rng.choice([1, 2, 3, 5, 8]),
         rng.randrange(4), None, None)
        for s in rng.sample(range(1 << 20), 60)
    ]
    p = priced_shop
    ok, _ = ch.validate_changes(feed_of(spark, feed), p.lines, p.products, p.orders)
    after, touched = ch.apply_changes(p, ok)
    again = after.with_(orders=after.orders.withColumn("subtotal", F.lit(None).cast("decimal(18,2)")))
    recomputed = money.fill_order_total(again.orders, after.lines)
    recomputed = money.sales_tax(recomputed, p.customers, p.tax_rates, touched=touched.orders)
    zero = F.coalesce("subtotal", F.lit(0)).cast("decimal(18,2)")
    tax = F.coalesce("salesTax", F.lit(0)).cast("decimal(18,2)")
    assert rows(after.orders.select("id", zero, tax)) == rows(recomputed.select("id", zero, tax))
    taken = {k: 0 for k in (1, 2, 3, 5, 8)}
    for df, sign in ((after.lines, 1), (p.lines, -1)):
        for r in df.collect():
            taken[r["product_id"]] += sign * r["quantity"]
    before = {r["id"]: r["availableQuantity"] for r in p.products.collect()}
    stock = {r["id"]: r["availableQuantity"] for r in after.products.collect()}
    assert all(before[k] is None or before[k] - n == stock[k] for k, n in taken.items())
    fresh = views.refresh_customers(views.customer_purchases(p), after, touched.customers)
    assert rows(fresh) == rows(views.customer_purchases(after))
    fresh = views.refresh_products(views.product_buyers(p), after, touched.products)
    assert rows(fresh) == rows(views.product_buyers(after))


def test_price_log(spark, shop):
    ts = F.to_timestamp(F.lit("2024-03-01 00:00:00")) + F.make_interval(secs=F.col("seq"))
    data = [(1, D("1234.50"), None, 1), (1, D("1200.00"), None, 2), (1, D("1200.00"), None, 3), (7, D("10.00"), None, 4), (99, D("1.00"), None, 5)]
    feed = spark.createDataFrame(data, PRICE_CHANGE).withColumn("ts", ts)
    products, history = prices.apply_price_changes(shop.products, feed)
    assert rows(history.select("product_id", "oldPrice", "newPrice", "seq")) == [(1, D("1234.50"), D("1200.00"), 2)]
    now = {r["id"]: r["currentPrice"] for r in products.collect()}
    assert now[1] == D("1200.00") and now[7] == D("10.00") and now[2] == D("90.00") and 99 not in now
    _, every = prices.apply_price_changes(shop.products, feed, log_unchanged=True)
    assert rows(every.select("oldPrice", "newPrice", "seq")) == [
        (D("1200.00"), D("1200.00"), 3), (D("1234.50"), D("1200.00"), 2), (D("1234.50"), D("1234.50"), 1), (None, D("10.00"), 4),
    ]


def test_price_to_null_and_back_is_not_logged(spark, shop):
    feed = spark.createDataFrame([(2, None, None, 1), (2, D("90.00"), None, 2), (2, D("91.00"), None, 70_000)], PRICE_CHANGE)
    stamp = F.to_timestamp(F.lit("2024-03-01 00:00:00"))
    _, history = prices.apply_price_changes(shop.products, feed, as_of=stamp)
    got = history.collect()
    assert [(r["oldPrice"], r["newPrice"], r["seq"], str(r["ts"])) for r in got] == [
        (D("90.00"), D("91.00"), 70_000, "2024-03-01 00:00:00")
    ]


@pytest.mark.parametrize("stock", [1000, 1])
def test_new_ids_mean_something_on_updates_only(spark, priced_shop, stock):
    """The same answer where stock is plenty (decided by windows) and where it is tight (walked)."""
    pos = priced_shop.with_(
        products=priced_shop.products.withColumn("availableQuantity", F.lit(stock)), lines=priced_shop.lines.limit(0)
    )
    data = [
        ("insert", 1, 10, 1, 1, 11, 2),
        ("update", 2, 10, 1, 1, 11, None),
        ("delete", 3, 10, 1, None, 11, 2),
        ("insert", 4, 11, 1, 1, None, 3),
    ]
    got = {seq: r["accepted"] for seq, r in decide(spark, pos, data).items()}
    assert got == {1: True, 2: False, 3: True, 4: True}


def test_price_and_line_changes_of_one_feed(spark, priced_shop):
    """Every line keeps the price of the moment it was inserted, as a walk over the feed gives it."""
    rng = random.Random(11)
    for _ in range(3):
        numbers = rng.sample(range(1, 200_000), 90)
        feed, prices = [], []
        for seq in numbers:
            product = rng.choice([1, 2, 3, 8])
            if rng.random() < 0.4:
                prices.append((product, D(rng.randrange(100, 900)), None, seq))
            else:
                op = rng.choice(["insert", "insert", "update", "delete"])
                feed.append((op, seq, rng.choice([10, 11, 12, 14]), product, rng.randrange(1, 3), None, None))
        lines = spark.createDataFrame(feed, LINE_CHANGE)
        sets = spark.createDataFrame(prices, PRICE_CHANGE)
        decided = ch.decide_changes(lines, priced_shop.lines, priced_shop.products, priced_shop.orders)
        accepted = {r["seq"] for r in decided.collect() if r["accepted"]}
        now = {r["id"]: r["currentPrice"] for r in priced_shop.products.collect()}
        held = {(r["order_id"], r["product_id"]): (r["quantity"], r["unitPrice"]) for r in priced_shop.lines.collect()}
        for change in sorted(feed + prices, key=lambda c: c[1] if isinstance(c[0], str) else c[3]):
            if not isinstance(change[0], str):
                now[change[0]] = change[1]
                continue
            op, seq, order, product, quantity = change[:5]
            if seq not in accepted:
                continue
            if op == "delete":
                held.pop((order, product))
            else:
                held[order, product] = (quantity, now[product] if op == "insert" else held[order, product][1])
        after, _, rejected = ch.apply_events(priced_shop, lines, sets)
        got = {(r["order_id"], r["product_id"]): (r["quantity"], r["unitPrice"]) for r in after.lines.collect()}
        assert got == held
        assert {r["id"]: r["currentPrice"] for r in after.products.collect()} == now
        assert rejected.count() == len(feed) - len(accepted)
