import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from counterfoil.operators import money, views
from counterfoil.plans.build import refresh_full
from counterfoil.plans.catalog import register_views
from counterfoil.sources.snapshots import latest
from tests.conftest import rows


def test_customer_views(shop):
    assert [tuple(r) for r in views.v_customers(shop).collect()] == [
        ("Fox", "Dee"), ("Kim", None), ("Lee", "Ann"), ("Lee", "Ann"), ("Ray", "Bob"), ("Sun", "Eve"),
    ]
    got = [(r["customer_number"], r["addr1"], r["addr2"]) for r in views.v_customers2(shop).collect()]
    assert got == [
        (4, "4 Ash St", "Adjuntas, PR   00601"),
        (2, "2 Oak St", "Boston, MA   02108"),
        (1, "1 Elm St, Unit 2", "AUSTIN, TX   78701"),
        (3, None, "AUSTIN, TX   78701"),
        (6, "6 Elm St", "AUSTIN, TX   78701"),
    ]


def test_sorting_without_case(spark, shop):
    people = spark.createDataFrame([("a", "lee"), ("b", "Fox"), ("c", None), ("d", "Zed")], "firstName string, lastName string")
    order = lambda **kw: [r[1] for r in views.v_customers(shop.with_(customers=people), **kw).collect()]
    assert order() == ["c", "b", "d", "a"] and order(ignore_case=True) == ["c", "b", "a", "d"]


def test_plain_sql_over_the_registered_names(spark, priced_shop):
    register_views(priced_shop)
    got = spark.sql("""
        SELECT o.id, sum(l.lineTotal), max(o.total) FROM `Order` o JOIN Orderline l ON l.order_id = o.id
        WHERE o.customer_id IN (SELECT id FROM Customer WHERE lastName = 'Lee') GROUP BY o.id
    """)
    assert rows(got) == [(10, D("2559.00"), D("2559.00")), (11, D("90.00"), D("90.00"))]
    assert spark.sql("SELECT customers FROM v_ProductBuyers WHERE productID = 2").first()[0] == "1 Ann Lee,2 Bob Ray"
    assert spark.sql("SELECT * FROM v_CustomerPurchases").count() == 6


def test_product_buyers(shop):
    got = {r["productID"]: r["customers"] for r in views.v_product_buyers(shop).collect()}
    assert got[1] == "1 Ann Lee" and got[2] == "1 Ann Lee,2 Bob Ray" and got[8] is None and len(got) == 7
    twice = {r["productID"]: r["customers"] for r in views.v_product_buyers(shop, distinct=False).collect()}
    assert twice[2] == "1 Ann Lee,1 Ann Lee,2 Bob Ray"


def test_labels_with_a_null_part_are_skipped(shop):
    nameless = shop.with_(orders=shop.orders.withColumn("customer_id", F.lit(3).cast("long")))
    assert views.v_product_buyers(nameless).where("customers is not null").count() == 0


def test_customer_purchases(shop):
    got = {r["customer number"]: r["products"] for r in views.v_customer_purchases(shop).collect()}
    assert got[1] == "1 Chair, oak|2 Desk" and got[2] == '2 Desk|3 Lamp "Luna"' and got[6] is None


def test_ids_sort_as_numbers(spark, shop):
    lines = spark.createDataFrame([(10, p) for p in (10, 9, 2, 100)], "order_id long, product_id long")
    goods = spark.createDataFrame([(p, "x") for p in (2, 9, 10, 100)], "id long, name string")
    got = views.customer_purchases(shop.with_(lines=lines, products=goods)).where("products is not null")
    assert got.first()["products"] == "2 x|9 x|10 x|100 x"


@pytest.mark.parametrize("distinct", [True, False])
def test_keyed_refresh_equals_full(spark, shop, distinct):
    stale = views.customer_purchases(shop.with_(lines=shop.lines.where("order_id > 10")), distinct)
    keys = spark.createDataFrame([(1,), (1,), (77,)], "customer_id long")
    assert rows(views.refresh_customers(stale, shop, keys, distinct)) == rows(views.customer_purchases(shop, distinct))
    stale = views.product_buyers(shop.with_(lines=shop.lines.where("product_id <> 2")), distinct)
    keys = spark.createDataFrame([(2,)], "product_id long")
    assert rows(views.refresh_products(stale, shop, keys, distinct)) == rows(views.product_buyers(shop, distinct))


def test_refresh_drops_a_vanished_customer(spark, shop):
    mv = views.customer_purchases(shop)
    gone = shop.with_(customers=shop.customers.where("id <> 6"))
    keys = spark.createDataFrame([(6,)], "customer_id long")
    assert views.refresh_customers(mv, gone, keys).where("`customer number` = 6").count() == 0


def test_prices_and_totals(shop):
    pos = money.priced(shop)
    assert {(r["order_id"], r["product_id"]): r["unitPrice"] for r in pos.lines.collect()}[(14, 2)] == D("90.00")
    totals = {r["id"]: r["subtotal"] for r in pos.orders.collect()}
    assert totals == {10: D("2559.00"), 11: D("90.00"), 12: D("19.99"), 14: D("270.00"), 15: None}


def test_set_prices_and_totals_stay(spark, shop):
    lines = shop.lines.withColumn("unitPrice", F.when(F.col("order_id") == 10, F.lit(1)).cast("decimal(6,2)"))
    filled = money.fill_unit_price(lines, shop.products)
    assert {r["order_id"]: r["unitPrice"] for r in filled.collect()}[10] == D("1.00")
    orders = shop.orders.withColumn("subtotal", F.when(F.col("id") == 10, F.lit(7)).cast("decimal(18,2)"))
    assert {r["id"]: r["subtotal"] for r in money.fill_order_total(orders, filled).collect()}[10] == D("7.00")


def test_line_of_unknown_product_keeps_no_price(spark, shop):
    lines = shop.lines.withColumn("product_id", F.lit(55).cast("long"))
    assert money.fill_unit_price(lines, shop.products).where("unitPrice is not null").count() == 0
    assert money.fill_order_total(shop.orders, lines).where("subtotal is not null").count() == 0


@pytest.mark.parametrize(
    "subtotal, rate, with_epsilon, without",
    [
        ("1.00", "0.00500", "0.01", "0.01"),
        ("100.50", "0.08250", "8.29", "8.29"),
        ("0.49", "0.01020", "0.00", "0.00"),
        ("4.99", "0.00100", "0.00", "0.00"),
        ("4.999", "0.00100", "0.01", "0.00"),
        (None, "0.01000", None, None),
        ("10.00", None, "0.00", "0.00"),
    ],
)
def test_tax_rounding(spark, subtotal, rate, with_epsilon, without):
    dec = lambda x: None if x is None else D(x)
    orders = spark.createDataFrame(
        [(1, 5, dec(subtotal), None)], "id long, customer_id long, subtotal decimal(18,3), salesTax decimal(18,2)"
    )
    customers = spark.createDataFrame([(5, "00001")], "id long, zip string")
    rates = spark.createDataFrame([("00001", dec(rate))], "zip string, estimatedCombinedRate decimal(6,5)")
    got = [
        money.sales_tax(orders, customers, rates, epsilon=e).first()["salesTax"] for e in (money.EPSILON, None)
    ]
    assert got == [dec(with_epsilon), dec(without)]


def test_tax_scope_and_total(spark, priced_shop):
    p = priced_shop
    touched = spark.createDataFrame([(10,)], "id long")
    taxed = money.with_order_total(money.sales_tax(p.orders, p.customers, p.tax_rates, touched=touched))
    got = {r["id"]: (r["salesTax"], r["total"]) for r in taxed.collect()}
    assert got[10] == (D("211.12"), D("2770.12")) and got[11] == (D("0.00"), D("90.00")) and got[15] == (D("0.00"), None)


def test_narrow_rates(spark, priced_shop):
    rates = spark.createDataFrame([("02108", D("0.10000"))], "zip string, taxRate decimal(6,5)")
    taxed = money.sales_tax(priced_shop.orders, priced_shop.customers, rates, epsilon=None, rate_column="taxRate")
    assert {r["id"]: r["salesTax"] for r in taxed.collect()} == {
        10: D("0.00"), 11: D("0.00"), 12: D("2.00"), 14: D("27.00"), 15: None,
    }


def test_sales_report(priced_shop):
    jan = (dt.date(2024, 1, 5), dt.date(2024, 1, 31))
    assert rows(money.sales_report(priced_shop, *jan, 2)) == [(2, 2, D("180.00"))]
    assert rows(money.sales_report(priced_shop, *jan, 3)) == [(None, None, None)]
    assert rows(money.sales_report(priced_shop, *jan)) == [(1, 2, D("2469.00")), (2, 2, D("180.00"))]


def test_a_full_refresh_pairs_lines_once(spark, shop, tmp_path, monkeypatch):
    made = []
    paired = views.bought_pairs
    monkeypatch.setattr(views, "bought_pairs", lambda pos: made.append(1) or paired(pos))
    refresh_full(shop, f"{tmp_path}/views")
    assert len(made) == 1
    assert rows(latest(spark, f"{tmp_path}/views/mv_product_buyers")) == rows(views.product_buyers(shop))
    assert rows(latest(spark, f"{tmp_path}/views/mv_customer_purchases")) == rows(views.customer_purchases(shop))
