"""Every registered query: a function of the session and the folder of the shared tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.functions import cleaning
from counterfoil.model import MONEY, RATE, Pos
from counterfoil.operators import changes as ch
from counterfoil.operators import compare, counted, documents, dyadic, etl, money, prices, quality, questions, views
from counterfoil.operators import document_queries as dq
from counterfoil.plans.build import build_pos, refresh_full
from counterfoil.plans.checks import quality_report
from counterfoil.plans.statements import run_statement
from counterfoil.session import pin, scratch_path
from counterfoil.sources import csv, raw_exports, tables
from counterfoil.sources.documents import as_json, read_documents, read_lines, write_documents
from counterfoil.sources.snapshots import latest, materialize
from counterfoil.streaming import jobs

# Parameters of the queries that take some.
REPORT_START, REPORT_END, REPORT_PRODUCT = dt.date(1996, 1, 1), dt.date(1998, 12, 31), 1
REGION_PATTERN = ", am "
RECALLED_PRODUCT = 1

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _pos(spark: SparkSession, folder: str) -> Pos:
    return tables.pos_from_tables(spark, folder)


def _priced(spark: SparkSession, folder: str) -> Pos:
    return money.priced(_pos(spark, folder))


def _written(pos: Pos) -> Pos:
    """The model with its lines written once: what reads them shares no task with the counting behind them."""
    return pos.with_(lines=pin(pos.lines))


def _lines_with_status(spark: SparkSession, folder: str, status: str) -> DataFrame:
    """Order lines counted from the line items of one status only."""
    rows = tables.table(spark, folder, "lineitem").where(F.col("l_linestatus") == status)
    return (
        rows.groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
        .agg(F.count("*").cast("int").alias("quantity"))
        .withColumn("unitPrice", F.lit(None).cast("decimal(6,2)"))
    )


# --- cleaning -----------------------------------------------------------------------


@query
def etl_clean_products(spark, folder):
    return etl.clean_products(raw_exports.raw_products(spark, folder))


@query
def etl_clean_customers(spark, folder):
    return etl.clean_customers(raw_exports.raw_customers(spark, folder))


@query
def etl_city_dimension(spark, folder):
    return etl.city_dimension(raw_exports.raw_customers(spark, folder))


def _clean_orders(spark, folder):
    customers = etl.clean_customers(raw_exports.raw_customers(spark, folder))
    return etl.clean_orders(raw_exports.raw_orders(spark, folder), customers)


@query
def etl_clean_orders(spark, folder):
    return _clean_orders(spark, folder).select("id", "datePlaced", "dateShipped", "customer_id")


def _clean_lines(spark, folder):
    return etl.orderlines_from_scans(raw_exports.raw_orderlines(spark, folder), _clean_orders(spark, folder))


@query
def etl_orderlines(spark, folder):
    return _clean_lines(spark, folder).select("order_id", "product_id", "quantity")


@query
def etl_counts(spark, folder):
    raw = raw_exports.raw_customers(spark, folder)
    loaded = {
        "product": etl_clean_products(spark, folder),
        "city": etl.one_city_per_zip(etl.city_dimension(raw)),
        "customer": etl.clean_customers(raw),
        "order": _clean_orders(spark, folder),
        "orderline": _clean_lines(spark, folder),
    }
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n")) for name, df in loaded.items()]
    return reduce(DataFrame.unionByName, counts)


# --- CSV files --------------------------------------------------------------------------

_EXPORTS = {
    "products": raw_exports.raw_products,
    "customers": raw_exports.raw_customers,
    "orders": raw_exports.raw_orders,
    "orderlines": raw_exports.raw_orderlines,
    "TAXRATES": raw_exports.raw_tax_rates,
}


def _csv(spark, folder, *names: str) -> str:
    """A folder with the named exports as CSV files."""
    root = scratch_path(spark, "exports")
    for name in names:
        raw_exports.write_csv(_EXPORTS[name](spark, folder), f"{root}/{name}.csv")
    return root


@query
def csv_products(spark, folder):
    return etl.clean_products(csv.read_products(spark, f"{_csv(spark, folder, 'products')}/products.csv"))


@query
def csv_customers(spark, folder):
    return etl.clean_customers(csv.read_customers(spark, f"{_csv(spark, folder, 'customers')}/customers.csv"))


@query
def csv_sales_tax(spark, folder):
    rates = csv.read_sales_tax(spark, f"{_csv(spark, folder, 'TAXRATES')}/TAXRATES.csv")
    return rates.select("zip", "state", "taxRegionName", "estimatedCombinedRate")


@query
def csv_narrow_sales_tax(spark, folder):
    path = f"{scratch_path(spark, 'exports')}/rates.csv"
    raw = raw_exports.raw_tax_rates(spark, folder).select("zip", F.col("estimatedCombinedRate").alias("taxRate"))
    return csv.read_narrow_sales_tax(spark, raw_exports.write_csv(raw, path))


@query
def csv_orders(spark, folder):
    pos = build_pos(spark, _csv(spark, folder, "products", "customers", "orders"), missing="empty")
    return pos.orders.select("id", "datePlaced", "dateShipped", "customer_id")


@query
def csv_orderlines(spark, folder):
    return build_pos(spark, _csv(spark, folder, *_EXPORTS)).lines.select("order_id", "product_id", "quantity")


@query
def csv_counts_without_lines(spark, folder):
    """The model of a folder in which two files are missing."""
    pos = build_pos(spark, _csv(spark, folder, "products", "customers", "orders"), missing="empty")
    loaded = {
        "product": pos.products, "city": pos.cities, "customer": pos.customers, "order": pos.orders,
        "orderline": pos.lines, "sales_tax": pos.tax_rates,
    }
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n")) for name, df in loaded.items()]
    return reduce(DataFrame.unionByName, counts)


@query
def etl_products_repeated_ids(spark, folder):
    """Products exported twice, the second time under a later name."""
    again = F.when(F.col("name") != "", F.concat("name", F.lit(" (again)"))).otherwise(F.col("name"))
    raw = raw_exports.raw_products(spark, folder)
    both = etl.clean_products(raw.unionByName(raw.withColumn("name", again)))
    return etl.one_row_per_key(both, "id")


# --- views ----------------------------------------------------------------------------


@query
def v_customers(spark, folder):
    return views.v_customers(_pos(spark, folder))


@query
def v_customers2(spark, folder):
    return views.v_customers2(_pos(spark, folder))


@query
def v_product_buyers(spark, folder):
    return views.v_product_buyers(_pos(spark, folder))


@query
def v_product_buyers_all(spark, folder):
    return views.v_product_buyers(_pos(spark, folder), distinct=False)


@query
def v_customer_purchases(spark, folder):
    return views.v_customer_purchases(_pos(spark, folder))


@query
def v_customer_purchases_all(spark, folder):
    return views.v_customer_purchases(_pos(spark, folder), distinct=False)


@query
def product_buyers_parts(spark, folder):
    return views.product_buyers_parts(_pos(spark, folder))


@query
def customer_purchases_parts(spark, folder):
    return views.customer_purchases_parts(_pos(spark, folder))


@query
def mv_product_buyers(spark, folder):
    root = scratch_path(spark, "mv_product_buyers")
    materialize(views.product_buyers(_pos(spark, folder)), root)
    return latest(spark, root).select("*")


@query
def mv_customer_purchases(spark, folder):
    root = scratch_path(spark, "mv_customer_purchases")
    materialize(views.customer_purchases(_pos(spark, folder)), root)
    return latest(spark, root).select("*")


@query
def mv_refresh_full(spark, folder):
    """Both views published from the fulfilled lines, then afresh from all lines."""
    root, pos = scratch_path(spark, "mv_refresh_full"), _pos(spark, folder)
    refresh_full(pos.with_(lines=_lines_with_status(spark, folder, "F")), root)
    refresh_full(pos, root)
    return _both_views(latest(spark, f"{root}/mv_product_buyers"), latest(spark, f"{root}/mv_customer_purchases"))


def _both_views(buyers: DataFrame, purchases: DataFrame) -> DataFrame:
    return buyers.select(
        F.lit("mv_product_buyers").alias("view_name"), F.col("productID").alias("id"), F.col("customers").alias("list")
    ).unionByName(
        purchases.select(
            F.lit("mv_customer_purchases").alias("view_name"),
            F.col("customer number").alias("id"),
            F.col("products").alias("list"),
        )
    )


def _counted(spark, folder, view: counted.View) -> tuple[counted.CountedView, Pos]:
    """A counted view of the fulfilled lines, brought up to date by the open ones."""
    pos = _pos(spark, folder)
    fulfilled = _lines_with_status(spark, folder, "F")
    stored = counted.CountedView(spark, scratch_path(spark, "counted"), view, folders=16)
    stored.create(pos.with_(lines=fulfilled))
    keys = ["order_id", "product_id"]
    opened = _lines_with_status(spark, folder, "O").join(fulfilled.select(*keys), keys, "left_anti")
    inserted = opened.select(F.lit("insert").alias("op"), *keys)
    stored.refresh(counted.changed_pairs(inserted, pos.orders), 1, pos)
    return stored, pos


@query
def mv_refresh_customers(spark, folder):
    """Purchases of the fulfilled lines, brought up to date by the pairs of open lines."""
    return counted.purchases_of(*_counted(spark, folder, counted.PURCHASES))


@query
def mv_refresh_products(spark, folder):
    """Buyers of the fulfilled lines, brought up to date by the pairs of open lines."""
    return counted.buyers_of(*_counted(spark, folder, counted.BUYERS))


@query
def mv_refresh_products_all(spark, folder):
    """The same with a label per order line."""
    return counted.buyers_of(*_counted(spark, folder, counted.ALL_BUYERS))


@query
def mv_refresh_customers_all(spark, folder):
    """The same for purchases."""
    return counted.purchases_of(*_counted(spark, folder, counted.ALL_PURCHASES))


@query
def mv_recomputed_keys(spark, folder):
    """Views of the fulfilled lines in which the customers and products of open lines are computed afresh."""
    pos, fulfilled = _pos(spark, folder), _lines_with_status(spark, folder, "F")
    old, opened = pos.with_(lines=fulfilled), _lines_with_status(spark, folder, "O")
    customers = pos.orders.join(opened.select(F.col("order_id").alias("id")), "id", "left_semi").select("customer_id")
    # Each view is written before and after its refresh, so that disks hold the shuffles of one step at a time.
    pairs = pin(views.bought_pairs(old))
    buyers = pin(views.product_buyers(old, pairs=pairs))
    buyers = pin(views.refresh_products(buyers, pos, opened.select("product_id")))
    purchases = pin(views.customer_purchases(old, pairs=pairs))
    return _both_views(buyers, views.refresh_customers(purchases, pos, customers))


# --- money ----------------------------------------------------------------------------


@query
def fill_unit_price(spark, folder):
    pos = _pos(spark, folder)
    return money.with_line_total(money.fill_unit_price(pos.lines, pos.products))


@query
def fill_order_total(spark, folder):
    return _priced(spark, folder).orders.select("id", F.col("subtotal").alias("orderTotal"))


def _taxed(spark, folder, **options):
    pos = _priced(spark, folder)
    taxed = money.sales_tax(pos.orders, pos.customers, pos.tax_rates, **options)
    return money.with_order_total(taxed).select("id", "customer_id", "subtotal", "salesTax", "total")


@query
def sales_tax(spark, folder):
    return _taxed(spark, folder)


@query
def sales_tax_no_epsilon(spark, folder):
    return _taxed(spark, folder, epsilon=None)


@query
def sales_tax_touched(spark, folder):
    """Only orders with open lines are taxed; the rest keep 0.00."""
    opened = _lines_with_status(spark, folder, "O").select(F.col("order_id").alias("id"))
    return _taxed(spark, folder, touched=opened)


@query
def sales_tax_repeated_zip(spark, folder):
    """Every zip stands in the rate file twice, the second time with a higher rate."""
    pos = _priced(spark, folder)
    higher = (F.col("estimatedCombinedRate") + F.lit("0.01").cast(RATE)).cast(RATE)
    repeated = pos.tax_rates.unionByName(pos.tax_rates.withColumn("estimatedCombinedRate", higher))
    taxed = money.sales_tax(pos.orders, pos.customers, etl.one_row_per_key(repeated, "zip"))
    return money.with_order_total(taxed).select("id", "customer_id", "subtotal", "salesTax", "total")


@query
def sales_report(spark, folder):
    return money.sales_report(_priced(spark, folder), REPORT_START, REPORT_END, REPORT_PRODUCT)


@query
def sales_report_all(spark, folder):
    return money.sales_report(_priced(spark, folder), REPORT_START, REPORT_END)


def _sales_blocks(spark, folder) -> tuple[DataFrame, Pos]:
    """Blocks of days of the fulfilled items, brought up to date by what the open ones add."""
    pos = _priced(spark, folder)
    fulfilled = money.priced(pos.with_(lines=_lines_with_status(spark, folder, "F")))
    stored = pin(dyadic.blocks(dyadic.day_sums(fulfilled)), "level")
    keys = ["order_id", "product_id"]
    before = fulfilled.lines.select(*keys, F.col("quantity").alias("_before"))
    changes = pos.lines.join(before, keys, "left").select(
        *keys, F.when(F.col("_before").isNull(), "insert").otherwise("update").alias("op"),
        (F.col("quantity") - F.coalesce("_before", F.lit(0))).alias("delta"), F.col("unitPrice").alias("unit_price"),
    ).where("delta <> 0")
    return pin(dyadic.updated(stored, dyadic.changed_days(changes, pos.orders)), "level"), pos


@query
def sales_report_blocks(spark, folder):
    """``sales_report`` from blocks of days."""
    stored, pos = _sales_blocks(spark, folder)
    return dyadic.sales_report(stored, pos.products, REPORT_START, REPORT_END, REPORT_PRODUCT)


@query
def sales_report_all_blocks(spark, folder):
    """``sales_report_all`` from blocks of days."""
    stored, pos = _sales_blocks(spark, folder)
    return dyadic.sales_report(stored, pos.products, REPORT_START, REPORT_END)


@query
def sales_report_statement(spark, folder):
    """The report as a parameterized statement."""
    pos = _priced(spark, folder)
    text = """
        SELECT max(l.product_id) AS `Product ID`, sum(l.quantity) AS `Quantity Sold`,
               CAST(sum(l.lineTotal) AS DECIMAL(18,2)) AS `Total Sales Amount`
        FROM {lines} l JOIN {orders} o ON l.order_id = o.id
        WHERE l.product_id = :product AND o.datePlaced BETWEEN :start AND :end
    """
    args = {"product": REPORT_PRODUCT, "start": REPORT_START, "end": REPORT_END}
    return run_statement(spark, text, args, lines=money.with_line_total(pos.lines), orders=pos.orders)


# --- prices ---------------------------------------------------------------------------


def _price_run(spark, folder, log_unchanged=False):
    return prices.apply_price_changes(
        tables.products(spark, folder), tables.price_changes(spark, folder), log_unchanged
    )


@query
def price_history(spark, folder):
    return _price_run(spark, folder)[1].select("product_id", "oldPrice", "newPrice", "seq")


@query
def price_history_unchanged(spark, folder):
    """The log of the price procedure, which writes a row even when the price stays."""
    return _price_run(spark, folder, True)[1].select("product_id", "oldPrice", "newPrice", "seq")


@query
def price_history_stamped(spark, folder):
    """Changes that come without a stamp get the one of the run."""
    feed = tables.price_changes(spark, folder)
    partly = feed.withColumn("ts", F.when(F.col("seq") % 2 == 0, F.col("ts")))
    log = prices.apply_price_changes(tables.products(spark, folder), partly, as_of=F.lit(REPORT_END).cast("timestamp"))
    return log[1].select("product_id", "seq", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query
def update_price(spark, folder):
    return _price_run(spark, folder)[0]


# --- documents --------------------------------------------------------------------------


def _json(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, as_json(df).alias("doc"))


@query
def doc_customers(spark, folder):
    return _json(documents.doc_customers(_pos(spark, folder)))


@query
def doc_customers_plain(spark, folder):
    return _json(documents.doc_customers(_pos(spark, folder), "C"))


@query
def doc_products(spark, folder):
    return _json(documents.doc_products(_pos(spark, folder)), "ProductID")


@query
def doc_products_outer(spark, folder):
    return _json(documents.doc_products(_pos(spark, folder), "B"), "ProductID")


@query
def doc_products_empty_array(spark, folder):
    return _json(documents.doc_products(_pos(spark, folder), "C", "empty_array"), "ProductID")


@query
def doc_product_parts(spark, folder):
    return _json(documents.doc_product_parts(_pos(spark, folder)), "ProductID")


@query
def doc_order_parts(spark, folder):
    return _json(documents.doc_order_parts(_pos(spark, folder)), "OrderID")


@query
def doc_customer_order_parts(spark, folder):
    return _json(documents.doc_customer_order_parts(_priced(spark, folder)), "CustomerID")


@query
def doc_orders(spark, folder):
    return _json(documents.doc_orders(_pos(spark, folder)), "OrderID")


@query
def doc_orders_outer(spark, folder):
    return _json(documents.doc_orders(_pos(spark, folder), outer=True), "OrderID")


@query
def doc_orders_dated(spark, folder):
    return _json(documents.doc_orders_dated(_pos(spark, folder)))


@query
def doc_orders_dated_orphans(spark, folder):
    """The same where nameless products and customers without a unit are unknown."""
    pos = _pos(spark, folder)
    known = pos.customers.where(F.col("address2").isNotNull())
    return _json(documents.doc_orders_dated(pos.with_(products=etl_clean_products(spark, folder), customers=known)))


@query
def doc_orders_roundtrip(spark, folder):
    docs = documents.doc_orders(_pos(spark, folder))
    path = scratch_path(spark, "ord.json")
    write_documents(docs, path)
    return _json(read_documents(spark, path, docs.schema), "OrderID")


@query
def doc_customer_orders(spark, folder):
    return _json(documents.doc_customer_orders(_priced(spark, folder)))


@query
def doc_customer_orders_outer(spark, folder):
    return _json(documents.doc_customer_orders(_priced(spark, folder), "B"))


@query
def doc_customer_orders_plain(spark, folder):
    pos = _priced(spark, folder)
    taxed = pos.with_(orders=money.sales_tax(pos.orders, pos.customers, pos.tax_rates))
    return _json(documents.doc_customer_orders(taxed, "C"))


@query
def doc_price_history(spark, folder):
    pos = _pos(spark, folder)
    products, history = _price_run(spark, folder)
    return _json(documents.doc_price_history(pos.with_(products=products, price_history=history)), "ProductID")


@query
def doc_top_customers(spark, folder):
    return _json(documents.doc_top_customers(_priced(spark, folder)), "CustomerID")


@query
def doc_customers_nested(spark, folder):
    return _json(documents.doc_customers_nested(_priced(spark, folder)), "customer_id")


# --- questions to documents --------------------------------------------------------------


@query
def mongo_customers_in_region(spark, folder):
    return dq.customers_in_region(documents.doc_customers(_pos(spark, folder)), REGION_PATTERN)


@query
def mongo_best_customer(spark, folder):
    return questions.best_customers(_priced(spark, folder), 1)


@query
def mongo_top10_customers(spark, folder):
    return questions.best_customers(_priced(spark, folder), 10)


@query
def mongo_top10_namesakes(spark, folder):
    """The same where all customers have one name."""
    pos = _priced(spark, folder)
    named = pos.customers.withColumns({"firstName": F.lit("Ann"), "lastName": F.lit("Lee")})
    return questions.best_customers(pos.with_(customers=named), 10)


@query
def mongo_best_product(spark, folder):
    return questions.best_products(_pos(spark, folder), 1)


@query
def mongo_unsold_products(spark, folder):
    return questions.unsold_products(_pos(spark, folder))


@query
def mongo_recall(spark, folder):
    return questions.recall(_pos(spark, folder), RECALLED_PRODUCT)


@query
def mongo_fraud(spark, folder):
    return questions.suspicious_orders(_priced(spark, folder))


# The same questions to the documents themselves.


@query
def mongo_best_customer_docs(spark, folder):
    return dq.best_customers(documents.doc_customer_orders(_priced(spark, folder)), 1)


@query
def mongo_top10_customers_docs(spark, folder):
    return dq.best_customers(documents.doc_customer_orders(_priced(spark, folder), "B"), 10)


@query
def mongo_best_product_docs(spark, folder):
    return dq.best_products(documents.doc_products(_pos(spark, folder)), 1)


@query
def mongo_unsold_products_docs(spark, folder):
    docs = documents.doc_products(_pos(spark, folder), "B")
    return dq.unsold_products(docs).select("ProductID", "Product Name")


@query
def mongo_recall_docs(spark, folder):
    return dq.recall(documents.doc_orders(_pos(spark, folder)), RECALLED_PRODUCT)


@query
def mongo_fraud_docs(spark, folder):
    pos = _priced(spark, folder)
    docs = dq.with_order_totals(documents.doc_orders(pos), pos.orders)
    return dq.suspicious_orders(docs).select(
        "OrderID", "OrderTotal", F.size("Products").cast("long").alias("n_items")
    )


# --- changes ------------------------------------------------------------------------------


@query
def clamp_quantity(spark, folder):
    feed = tables.line_changes(spark, folder)
    return feed.select("seq", ch.clamp_quantity(F.col("quantity")).cast("int").alias("quantity"))


def _insert_feed(spark, folder):
    """Every event as an insert into the order of its own number."""
    return tables.line_changes(spark, folder).withColumn("op", F.lit("insert")).withColumn("order_id", F.col("seq"))


def _line_feed(spark, folder, op, rows=None):
    """One change per (order, product) of the line items."""
    source = tables.table(spark, folder, "lineitem") if rows is None else rows
    none = F.lit(None).cast("long")
    return source.groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")).agg(
        F.max("l_quantity").cast("int").alias("quantity")
    ).select(
        F.lit(op).alias("op"),
        (F.col("order_id") * 1_000_000_000 + F.col("product_id")).alias("seq"),
        "order_id", "product_id", "quantity", none.alias("new_order_id"), none.alias("new_product_id"),
    )


def _books(pos: Pos, feed: DataFrame) -> DataFrame:
    """Stock of all products and totals of all orders after the feed."""
    feed = pin(feed)
    ok, _ = ch.validate_changes(feed, pos.lines, pos.products, pos.orders)
    after, _ = ch.apply_changes(pos, ok)
    none = F.lit(None).cast(MONEY)
    stock = after.products.select(
        F.lit("stock").alias("kind"), "id", F.col("availableQuantity").cast(MONEY).alias("amount"), none.alias("tax")
    )
    totals = after.orders.select(
        F.lit("order").alias("kind"), "id", F.col("subtotal").alias("amount"), F.col("salesTax").alias("tax")
    )
    return stock.unionByName(totals)


@query
def apply_inserts(spark, folder):
    return _books(_priced(spark, folder), _insert_feed(spark, folder))


@query
def apply_updates(spark, folder):
    return _books(_priced(spark, folder), _line_feed(spark, folder, "update"))


@query
def apply_deletes(spark, folder):
    """Returned lines are deleted."""
    returned = tables.table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return _books(_priced(spark, folder), _line_feed(spark, folder, "delete", returned))


def _after(spark, folder, null_subtotal="zero", prices_too=False) -> Pos:
    """The model after the mixed event feed, with the price feed between its changes if wanted."""
    pos = _written(_priced(spark, folder))
    feed = tables.line_changes(spark, folder)
    if prices_too:
        # One numbering for both: the price of an event is set just before its line changes.
        ordered = feed.withColumn("seq", F.col("seq") * 2 + 1)
        return ch.apply_events(pos, ordered, tables.price_changes(spark, folder).withColumn("seq", F.col("seq") * 2))[0]
    ok, _ = ch.validate_changes(feed, pos.lines, pos.products, pos.orders)
    return ch.apply_changes(pos, ok, null_subtotal)[0]


@query
def changed_lines(spark, folder):
    return _after(spark, folder).lines


@query
def changed_purchases(spark, folder):
    return views.customer_purchases(_after(spark, folder))


@query
def null_subtotal_keep(spark, folder):
    """Orders without lines keep their NULL subtotal when one is added."""
    return _after(spark, folder, "keep").orders.select("id", "subtotal")


def _streamed(spark, folder, name, feed: DataFrame, pos: Pos, source, **options) -> DataFrame:
    """The log of a stream over ``feed``."""
    root = scratch_path(spark, name)
    feed.write.json(f"{root}-feed")
    jobs.start(source(spark, f"{root}-feed"), pos, root, once=True, **options).awaitTermination()
    return jobs.log(spark, root)


def _streamed_events(spark, folder) -> Pos:
    """The model after the line and price feeds ran through one stream."""
    pos = _written(_priced(spark, folder))
    sets = tables.price_changes(spark, folder).withColumn("seq", F.col("seq") * 2)
    lines = tables.line_changes(spark, folder).withColumn("seq", F.col("seq") * 2 + 1)
    feed = lines.unionByName(sets.withColumn("op", F.lit(jobs.SET_PRICE)), allowMissingColumns=True)
    return jobs.settled(pos, _streamed(spark, folder, "events", feed, pos, jobs.event_stream))[0]


@query
def stream_event_lines(spark, folder):
    """The lines of ``event_lines``, from a stream."""
    return _streamed_events(spark, folder).lines


@query
def stream_event_prices(spark, folder):
    """The price history of ``event_prices``, from a stream."""
    history = _streamed_events(spark, folder).price_history
    return history.select("product_id", "oldPrice", "newPrice", F.shiftright("seq", 1).alias("seq"))


@query
def event_lines(spark, folder):
    """Lines after line and price changes of one feed, each at the price of the moment it was inserted."""
    return _after(spark, folder, prices_too=True).lines


@query
def event_prices(spark, folder):
    """Price history of the same feed."""
    history = _after(spark, folder, prices_too=True).price_history
    return history.select("product_id", "oldPrice", "newPrice", F.shiftright("seq", 1).alias("seq"))


@query
def deletes_or_fail(spark, folder):
    """Decisions of a feed of which no change may be rejected."""
    pos = _pos(spark, folder)
    returned = tables.table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    feed = _line_feed(spark, folder, "delete", returned)
    decided = ch.or_fail(ch.decide_changes(feed, pos.lines, pos.products, pos.orders))
    return decided.select("order_id", "product_id", "accepted", "delta")


_DECIDED = ("seq", "op", "order_id", "product_id", "accepted", "reason", "old_quantity", "delta")


@query
def apply_changes(spark, folder):
    """Every event as a change: inserts, updates and deletes mixed."""
    pos = _pos(spark, folder)
    decided = ch.decide_changes(tables.line_changes(spark, folder), pos.lines, pos.products, pos.orders)
    return decided.select(*_DECIDED)


@query
def reject_oversold(spark, folder):
    pos = _pos(spark, folder)
    decided = ch.decide_changes(_insert_feed(spark, folder), pos.lines, pos.products, pos.orders)
    return decided.where(~F.col("accepted")).select("seq", "product_id", "quantity", "reason")


@query
def batch_stock_check(spark, folder):
    return ch.batch_stock_check(_insert_feed(spark, folder), tables.products(spark, folder))


@query
def stream_line_changes(spark, folder):
    """The event feed decided by a stream; returns stock and buyers after its log is settled, of touched products anew."""
    pos = _written(_priced(spark, folder))
    entries = _streamed(spark, folder, "lines", tables.line_changes(spark, folder), pos, jobs.line_change_stream)
    after, touched = jobs.settled(pos, entries)
    buyers = views.refresh_products(views.product_buyers(pos), after, touched.products)
    stock = after.products.select(
        F.lit("stock").alias("kind"), "id", F.col("availableQuantity").cast("string").alias("value")
    )
    lists = buyers.select(F.lit("buyers").alias("kind"), F.col("productID").alias("id"), F.col("customers").alias("value"))
    return stock.unionByName(lists)


@query
def stream_stock_guard(spark, folder):
    """The event feed checked by a stream against stock."""
    feed, pos = tables.line_changes(spark, folder), _pos(spark, folder)
    entries = _streamed(spark, folder, "guard", feed, pos, jobs.line_change_stream, check_orders=False)
    return entries.select(*_DECIDED)


def _streamed_prices(spark, folder) -> Pos:
    pos = _pos(spark, folder)
    feed = tables.price_changes(spark, folder)
    return jobs.settled(pos, _streamed(spark, folder, "prices", feed, pos, jobs.price_change_stream))[0]


@query
def stream_price_history(spark, folder):
    """The price feed logged by a stream."""
    return _streamed_prices(spark, folder).price_history.select("product_id", "oldPrice", "newPrice", "seq")


@query
def stream_price_documents(spark, folder):
    """Price history documents after the price stream."""
    return _json(documents.doc_price_history(_streamed_prices(spark, folder)), "ProductID")


# --- quality and comparison -----------------------------------------------------------------


@query
def upsert_orderlines(spark, folder):
    """Fulfilled lines, with the open line items put on top."""
    target = _lines_with_status(spark, folder, "F").select("order_id", "product_id", "quantity")
    opened = tables.table(spark, folder, "lineitem").where(F.col("l_linestatus") == "O")
    source = opened.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_linenumber") * 1000 + F.col("l_quantity").cast("int")).alias("seq"),
    )
    return quality.upsert(target, source, ["order_id", "product_id"], "seq")


@query
def dq_pk_orderline(spark, folder):
    items = tables.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
    )
    return quality.pk_violations(items, ["order_id", "product_id"])


@query
def dq_pk_city(spark, folder):
    return quality.pk_violations(etl.city_dimension(raw_exports.raw_customers(spark, folder)), ["zip"])


@query
def dq_fk_orphans(spark, folder):
    """Scanned lines whose order is unknown, and orders whose customer is unknown."""
    scans = raw_exports.raw_orderlines(spark, folder).select(F.col("orderId").cast("long").alias("key"))
    orders = raw_exports.raw_orders(spark, folder).select(
        F.col("id").cast("long").alias("id"), F.col("customerId").cast("long").alias("key")
    )
    lines = quality.fk_orphans(scans, "key", orders, "id").select(F.lit("orderline.order_id").alias("fk"), "key")
    placed = quality.fk_orphans(orders.select("key"), "key", tables.customers(spark, folder), "id").select(
        F.lit("order.customer_id").alias("fk"), "key"
    )
    return lines.unionByName(placed)


@query
def dq_nulls(spark, folder):
    return quality.null_counts(tables.products(spark, folder), ["name", "currentPrice", "availableQuantity"])


@query
def dq_lengths(spark, folder):
    """Names longer than six and markets longer than eight characters."""
    people = tables.customers(spark, folder).select("firstName", "address1")
    return quality.length_violations(people, {"firstName": 6, "address1": 8})


@query
def dq_unparsed(spark, folder):
    return quality.unparsed_counts(
        raw_exports.raw_products(spark, folder),
        {"price": cleaning.money(F.col("price")), "quantity_on_hand": cleaning.whole_number(F.col("quantity_on_hand"))},
    )


@query
def dq_report(spark, folder):
    """Every declared rule over the cleaned exports, cities with all their spellings."""
    raw = raw_exports.raw_customers(spark, folder)
    pos = _pos(spark, folder).with_(
        products=etl_clean_products(spark, folder),
        cities=etl.city_dimension(raw),
        customers=etl.clean_customers(raw),
        orders=_clean_orders(spark, folder),
        lines=_clean_lines(spark, folder),
        price_history=_price_run(spark, folder)[1],
    )
    return quality_report(_written(pos))


@query
def check_ids(spark, folder):
    """Orders that have lines against orders that are not pending, by place in the sorted ids."""
    pos = _pos(spark, folder)
    sent = pos.with_(orders=pos.orders.where(F.col("dateShipped").isNotNull()))
    return compare.id_positions_missing(documents.doc_orders(pos), documents.doc_orders(sent, outer=True))


@query
def doc_diff(spark, folder):
    """The same four exports in two house styles, compared as multisets."""
    pos = _priced(spark, folder)
    # Read by eight document sets, so written once.
    pos = pos.with_(lines=pin(pos.lines), orders=pin(pos.orders))
    pairs = {
        "cust1.json": (documents.doc_customers(pos), documents.doc_customers(pos, "B")),
        "cust2.json": (documents.doc_customer_orders(pos), documents.doc_customer_orders(pos, "B")),
        "ord.json": (documents.doc_orders(pos), documents.doc_orders(pos)),
        "prod.json": (documents.doc_products(pos), documents.doc_products(pos, "B")),
    }
    # One set after the other, so that disks hold the shuffles of one at a time; equal sides share theirs.
    rows = []
    for name, (a, b) in pairs.items():
        row = compare.typed_diff(a, b, apart=name != "ord.json").select(F.lit(name).alias("dataset"), "*")
        rows.append(row if name == "cust2.json" else pin(row))
    return reduce(DataFrame.unionByName, rows)


@query
def compare_exports(spark, folder):
    """Export folders of two house styles, file by file; one side lacks a file."""
    pos, root = _priced(spark, folder), scratch_path(spark, "compare")
    pos = pos.with_(lines=pin(pos.lines), orders=pin(pos.orders))
    # Nobody but this query reads the files.
    write_documents(documents.doc_customers(pos), f"{root}/left/cust1.json", "gzip")
    write_documents(documents.doc_customers(pos, "B"), f"{root}/right/cust1.json", "gzip")
    write_documents(documents.doc_products(pos), f"{root}/left/prod.json", "gzip")
    write_documents(documents.doc_products(pos, "B"), f"{root}/right/prod.json", "gzip")
    write_documents(documents.doc_orders(pos), f"{root}/left/ord.json", "gzip")
    names = ["cust1.json", "prod.json", "ord.json", "custom.json"]
    return compare.compare_folders(spark, f"{root}/left", f"{root}/right", names)


@query
def same_ids_from_files(spark, folder):
    """Whether two order files hold the same ids: with and without orders that have no lines, and a file with itself."""
    pos, root = _pos(spark, folder), scratch_path(spark, "ids")
    # Nobody but this query reads the two files.
    write_documents(documents.doc_orders(pos), f"{root}/ord.json", "gzip")
    write_documents(documents.doc_orders(pos, outer=True), f"{root}/all.json", "gzip")

    def ids(name: str) -> DataFrame:
        return read_lines(spark, f"{root}/{name}").select(F.get_json_object("doc", "$.OrderID").cast("long").alias("OrderID"))

    cases = {"itself": "ord.json", "all": "all.json"}
    rows = [compare.same_ids(ids("ord.json"), ids(b)).select(F.lit(case).alias("case"), "same") for case, b in cases.items()]
    return reduce(DataFrame.unionByName, rows)
