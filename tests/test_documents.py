import json
from decimal import Decimal as D

from pyspark.sql import functions as F

from counterfoil.operators import document_queries as dq
from counterfoil.operators import documents as d
from counterfoil.operators.prices import apply_price_changes
from counterfoil.sources.documents import as_json


def load(df):
    return [json.loads(r[0]) for r in df.select(as_json(df)).collect()]


def by(docs, key):
    return {doc[key]: doc for doc in docs}


def test_customers(shop):
    address = {doc["Customer Name"]: doc["Address"] for doc in load(d.doc_customers(shop))}
    assert address["Bob Ray"] == "2 Oak St\nBoston, MA 02108" and address[None] is None
    assert "1 Elm St\nUnit 2\nAUSTIN, TX 78701" in [doc["Address"] for doc in load(d.doc_customers(shop))]
    assert "Eve Sun" not in address
    assert "2 Oak St\nBoston MA 02108" in [doc["Address"] for doc in load(d.doc_customers(shop, "C"))]


def test_empty_second_line_differs_by_style(shop):
    blank = shop.with_(customers=shop.customers.withColumn("address2", F.lit("")))
    a, b = (load(d.doc_customers(blank, s)) for s in "AB")
    assert "2 Oak St\nBoston, MA 02108" in [x["Address"] for x in a]
    assert "2 Oak St\n\nBoston, MA 02108" in [x["Address"] for x in b]


def test_products(shop):
    a = by(load(d.doc_products(shop)), "ProductID")
    assert list(a[1]) == ["ProductID", "ProductName", "CurrentPrice", "Customers"]
    assert [c["CustomerID"] for c in a[2]["Customers"]] == [1, 1, 2] and a[8]["Customers"] is None
    b = by(load(d.doc_products(shop, "B")), "ProductID")
    assert b[8]["Customers"] == [{"CustomerID": None, "Customer Name": None}] and b[2]["Current Price"] == 90.0
    c = by(load(d.doc_products(shop, "C", "empty_array")), "ProductID")
    assert c[8]["Customer"] == [] and list(c[8]) == ["ProductID", "current price", "name", "Customer"]


def test_orders(shop):
    inner = by(load(d.doc_orders(shop)), "OrderID")
    assert set(inner) == {10, 11, 12, 14}
    assert inner[10] == {
        "OrderID": 10,
        "Buyer": {"CustomerID": 1, "Customer Name": "Ann Lee"},
        "Products": [
            {"ProductID": 1, "Product Name": "Chair, oak", "Quantity": 2},
            {"ProductID": 2, "Product Name": "Desk", "Quantity": 1},
        ],
    }
    outer = by(load(d.doc_orders(shop, outer=True)), "OrderID")
    assert outer[15]["Items"] is None and outer[12]["Items"][0]["ProductName"] == 'Lamp "Luna"'
    dated = by(load(d.doc_orders_dated(shop)), "Order ID")
    assert dated[15]["Product"] == [{"PRODUCT ID": None, "PRODUCT NAME": None, "Quantity": None}]
    assert dated[10]["Order Shipped"] == "2024-01-07"


def test_customer_orders(priced_shop):
    docs = load(d.doc_customer_orders(priced_shop))
    ann = next(x for x in docs if x["Address"] and x["Address"].startswith("1 Elm"))
    assert [(o["OrderID"], o["OrderTotal"], len(o["Items"])) for o in ann["Orders"]] == [(10, 2559.0, 2), (11, 90.0, 1)]
    six = next(x for x in docs if x["Address"] and x["Address"].startswith("6 Elm"))
    assert six["Orders"] is None
    dee = next(x for x in docs if x["Customer Name"] == "Dee Fox")
    assert dee["Orders"] == [
        {"OrderID": 15, "OrderTotal": None, "OrderDate": "2024-02-10", "ShippingDate": None, "Items": None}
    ]
    b = load(d.doc_customer_orders(priced_shop, "B"))
    assert "2 Oak St\n\nBoston, MA 02108" in [x["Address"] for x in b]
    assert "\nAUSTIN, TX 78701" in [x["Address"] for x in b]  # no first line: skipped, not NULL
    c = load(d.doc_customer_orders(priced_shop, "C"))
    assert list(c[0]) == ["Customer Name", "Address", "Order Details"]


def test_nested_and_top(priced_shop):
    docs = by(load(d.doc_customers_nested(priced_shop)), "customer_id")
    assert docs[5]["orders"] is None and docs[4]["orders"] == [{"order_id": 15, "items": None}]
    assert docs[2]["orders"][1]["items"] == [{"product": "Desk", "qty": 3, "price": 90.0}]
    top = load(d.doc_top_customers(priced_shop, 2))
    assert [(x["CustomerID"], x["Total Spent"]) for x in top] == [(1, 2649.0), (2, 289.99)]
    assert top[0]["Orders"][0]["Items"][0]["Line Total"] == 2469.0
    everyone = load(d.doc_top_customers(priced_shop, 10))
    assert [x["CustomerID"] for x in everyone] == [1, 2, 4] and everyone[2]["Total Spent"] is None


def test_price_history_documents(spark, shop):
    feed = spark.createDataFrame(
        [(2, D("95.00"), 1), (2, D("80.00"), 2)], "product_id long, price decimal(6,2), seq long"
    ).withColumn("ts", F.lit("2024-03-01 10:00:00").cast("timestamp"))
    products, history = apply_price_changes(shop.products, feed)
    docs = by(load(d.doc_price_history(shop.with_(products=products, price_history=history))), "ProductID")
    assert docs[1]["PriceHistory"] is None and docs[2]["CurrentPrice"] == 80.0
    assert docs[2]["PriceHistory"] == [
        {"OldPrice": 90.0, "NewPrice": 95.0, "Timestamp": "2024-03-01 10:00:00"},
        {"OldPrice": 95.0, "NewPrice": 80.0, "Timestamp": "2024-03-01 10:00:00"},
    ]


def test_questions(shop, priced_shop):
    found = dq.customers_in_region(d.doc_customers(shop), "tx")
    assert {r["Customer Name"] for r in found.collect()} == {"Ann Lee"}
    for style in "ABC":
        best = dq.best_customers(d.doc_customer_orders(priced_shop, style), 2).collect()
        assert [tuple(r) for r in best] == [("Ann Lee", D("2649.00")), ("Bob Ray", D("289.99"))]
        product = dq.best_products(d.doc_products(shop, style), 1).collect()
        assert [tuple(r) for r in product] == [(2, 3)]
        assert {r["ProductID"] for r in dq.unsold_products(d.doc_products(shop, style)).collect()} == {5, 6, 7, 8}
    assert dq.unsold_products(d.doc_products(shop, "A", "empty_array")).count() == 4
    flat = d.doc_top_customers(priced_shop, 3).withColumnRenamed("Total Spent", "Order Total").drop("Orders")
    assert dq.best_customers(flat, 1).first()["totalSpent"] == D("2649.00")
    for outer in (False, True):
        buyers = dq.recall(d.doc_orders(shop, outer), 2).collect()
        assert sorted(tuple(r) for r in buyers) == [(1, "Ann Lee"), (1, "Ann Lee"), (2, "Bob Ray")]


def test_suspicious_orders(priced_shop):
    docs = dq.with_order_totals(d.doc_orders(priced_shop, outer=True), priced_shop.orders)
    ids = lambda **kw: {r["OrderID"] for r in dq.suspicious_orders(docs, **kw).collect()}
    assert ids() == set() and ids(min_total=200) == {10, 14} and ids(max_items=1) == {10}
