import datetime as dt
import json
import os
import shutil
from decimal import Decimal as D

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from counterfoil import model
from counterfoil.operators import documents, etl, quality, views
from counterfoil.plans.build import build_pos, refresh_full, refresh_keys
from counterfoil.plans.checks import quality_report
from counterfoil.plans.statements import insert_customer, run_statement
from counterfoil.sources import csv
from counterfoil.sources.documents import read_documents, read_lines, write_documents
from counterfoil.sources.snapshots import latest, materialize, touch, versions
from tests.conftest import rows


def test_products(shop):
    got = {r["id"]: (r["name"], r["currentPrice"], r["availableQuantity"]) for r in shop.products.collect()}
    assert got == {
        1: ("Chair, oak", D("1234.50"), 5),
        2: ("Desk", D("90.00"), 12),
        3: ('Lamp "Luna"', D("19.99"), None),
        5: ("Shelf", D("12.00"), None),
        6: ("Sofa", None, 1),
        7: ("Stool", None, None),
        8: ("Bench", D("40.00"), 0),
    }


def test_customers(shop):
    got = {r["id"]: r for r in shop.customers.collect()}
    assert [got[i]["zip"] for i in range(1, 7)] == ["78701", "02108", "78701", "00601", None, "78701"]
    day = dt.date(1980, 2, 3)
    assert [got[i]["birthdate"] for i in range(1, 7)] == [day, day, None, None, None, dt.date(1999, 12, 31)]
    assert got[3]["firstName"] is None and got[3]["address1"] is None and got[2]["address2"] is None


def test_cities_report_two_spellings(spark, exports, shop):
    seen = etl.city_dimension(csv.read_customers(spark, f"{exports}/customers.csv"))
    assert rows(quality.pk_violations(seen, ["zip"])) == [("78701", 2)]
    assert rows(shop.cities) == [
        ("00601", "Adjuntas", "PR"), ("02108", "Boston", "MA"), ("78701", "AUSTIN", "TX"),
    ]


def test_orders(shop):
    got = {r["id"]: (r["datePlaced"], r["dateShipped"], r["customer_id"]) for r in shop.orders.collect()}
    assert got == {
        10: (dt.date(2024, 1, 5), dt.date(2024, 1, 7), 1),
        11: (dt.date(2024, 1, 31), None, 1),
        12: (None, None, 2),
        14: (dt.date(2024, 2, 1), dt.date(2024, 2, 3), 2),
        15: (dt.date(2024, 2, 10), None, 4),
    }


def test_orderlines_count_scans(shop):
    assert rows(shop.lines.drop("unitPrice")) == [(10, 1, 2), (10, 2, 1), (11, 2, 1), (12, 3, 1), (14, 2, 3)]


def test_tax_rates(spark, exports, shop):
    got = {r["zip"]: (r["state"], r["estimatedCombinedRate"], r["riskLevel"]) for r in shop.tax_rates.collect()}
    assert got == {"78701": ("TX", D("0.08250"), 1), "00601": ("PR", D("0.11500"), 1)}
    narrow = csv.read_narrow_sales_tax(spark, f"{exports}/sales_tax_rates.csv")
    assert rows(narrow) == [("00501", D("0.08000"))]


def test_csv_line_breaks_and_carriage_returns(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_bytes(b'id,name,price,quantity_on_hand\r\n1,"two\nlines",$1.00,7\r\n2,"",$2.00,8\r\n')
    raw = csv.read_products(spark, str(path))
    assert [r["quantity_on_hand"] for r in raw.collect()] == ["7", "8"]
    assert rows(etl.clean_products(raw).select("name", "availableQuantity")) == [("two\nlines", 7)]


def test_several_files_each_with_a_header(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"{n}.csv").write_text(f"orderId,productId,quantity\n{n},5,1\n")
    assert rows(csv.read_orderlines(spark, str(tmp_path))) == [("1", "5", "1"), ("2", "5", "1")]


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException):
        csv.read_products(spark, f"{tmp_path}/none.csv")
    empty = csv.read_products(spark, f"{tmp_path}/none.csv", missing="empty")
    assert empty.columns == ["id", "name", "price", "quantity_on_hand"] and empty.count() == 0
    assert build_pos(spark, str(tmp_path), missing="empty").lines.count() == 0


def test_phone_column_only_on_request(spark, exports):
    raw = csv.read_customers(spark, f"{exports}/customers.csv")
    assert "phone" not in etl.clean_customers(raw).columns
    assert etl.clean_customers(raw, with_phone=True).where("phone is not null").count() == 0


def test_documents_roundtrip(spark, shop, tmp_path):
    docs = documents.doc_orders(shop, outer=True)
    write_documents(docs, f"{tmp_path}/ord.json")
    lines = [json.loads(r["doc"]) for r in read_lines(spark, f"{tmp_path}/ord.json").collect()]
    assert {d["OrderID"]: d["Items"] for d in lines}[15] is None
    assert rows(read_documents(spark, f"{tmp_path}/ord.json", docs.schema)) == rows(docs)
    assert read_lines(spark, f"{tmp_path}/none.json") is None


def test_snapshots_ignore_unfinished_versions(spark, tmp_path):
    root = f"{tmp_path}/mv"
    materialize(spark.range(3), root)
    materialize(spark.range(5), root)
    touch(spark, f"{root}/version-000000009-broken/part.parquet")
    assert len(versions(spark, root)) == 2
    assert latest(spark, root).count() == 5
    materialize(spark.range(7), root)
    assert latest(spark, root).count() == 7


def test_snapshots_by_partition(spark, shop, tmp_path):
    root = f"{tmp_path}/orders"
    placed = shop.orders.withColumn("year", F.year("datePlaced"))
    materialize(placed, root, partition_by=["year"])
    scan = latest(spark, root).where("year = 2024")
    assert scan.count() == 4
    assert "PartitionFilters: [isnotnull(year" in scan._jdf.queryExecution().executedPlan().toString()


def test_schemas_of_the_loaded_model(shop):
    kinds = lambda schema: {f.name: f.dataType for f in schema}
    for df, schema in (
        (shop.products, model.PRODUCT), (shop.cities, model.CITY), (shop.customers, model.CUSTOMER),
        (shop.orders, model.ORDER), (shop.lines, model.ORDERLINE), (shop.tax_rates, model.SALES_TAX),
        (shop.price_history, model.PRICE_HISTORY),
    ):
        assert kinds(df.schema) == kinds(schema)


def test_quality_report(shop):
    got = {(r["rule"], r["table_name"], r["column_name"]): r["n"] for r in quality_report(shop).collect()}
    broken = {key: n for key, n in got.items() if n}
    assert broken == {} and ("reference", "orderline", "order_id") in got
    orphaned = shop.with_(orders=shop.orders.where("id <> 10"), cities=shop.cities.unionAll(shop.cities))
    got = {(r["rule"], r["table_name"], r["column_name"]): r["n"] for r in quality_report(orphaned).collect()}
    assert {key: n for key, n in got.items() if n} == {
        ("reference", "orderline", "order_id"): 2, ("unique", "city", "zip"): 3,
    }


def test_refresh_jobs(spark, shop, tmp_path):
    root = str(tmp_path)
    refresh_full(shop, root)
    fewer = shop.with_(lines=shop.lines.where("order_id <> 14"))
    customers = spark.createDataFrame([(2,)], "customer_id long")
    products = spark.createDataFrame([(2,)], "product_id long")
    refresh_keys(spark, fewer, root, customers, products)
    assert rows(latest(spark, f"{root}/mv_product_buyers")) == rows(views.product_buyers(fewer))
    assert rows(latest(spark, f"{root}/mv_customer_purchases")) == rows(views.customer_purchases(fewer))


def test_statements_keep_values_out_of_the_text(spark, shop):
    more = insert_customer(shop.customers, 100002, "John'; --", "Doe")
    assert rows(more.where("id = 100002").select("firstName", "lastName", "zip")) == [("John'; --", "Doe", None)]
    got = run_statement(spark, "SELECT id FROM {p} WHERE name = :name", {"name": "Desk"}, p=shop.products)
    assert rows(got) == [(2,)]


def test_unparsed_counts(spark, exports):
    from counterfoil.functions.cleaning import money, whole_number

    raw = csv.read_products(spark, f"{exports}/products.csv")
    checks = {"price": money(F.col("price")), "quantity_on_hand": whole_number(F.col("quantity_on_hand"))}
    assert rows(quality.unparsed_counts(raw, checks)) == [(1, 2)]


def test_repeated_keys_leave_one_row_each(spark):
    rates = spark.createDataFrame(
        [("00501", "NY", 0.08), ("00501", "NY", 0.07), ("00601", None, 0.1), ("00601", "PR", 0.05), (None, "TX", 0.01)],
        "zip string, state string, rate double",
    )
    assert rows(etl.one_row_per_key(rates, "zip")) == [("00501", "NY", 0.07), ("00601", None, 0.1)]
    assert etl.one_row_per_key(rates, "zip").columns == rates.columns
    assert etl.one_row_per_key(rates.limit(0), "zip").count() == 0


def test_foreign_folders_and_equal_numbers_of_versions(spark, tmp_path):
    root = f"{tmp_path}/mv"
    os.makedirs(f"{root}/notes")
    os.makedirs(f"{root}/version-x")
    first = materialize(spark.range(1), root)
    second = materialize(spark.range(2), root)
    # A refresh that began after the second one, and took its number.
    number = os.path.basename(second).split("-")[1]
    late = f"{root}/version-{number}-{10**19 + 1:020d}-00000000"
    shutil.copytree(first, late)
    assert versions(spark, root)[-1] == os.path.basename(late) and latest(spark, root).count() == 1
    assert int(os.path.basename(materialize(spark.range(3), root)).split("-")[1]) == int(number) + 1
    assert latest(spark, root).count() == 3
