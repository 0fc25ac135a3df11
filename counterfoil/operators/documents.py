"""Nested documents: customers, products and orders with their children as arrays.

Children are built bottom-up, items into orders into customers, each level grouped by
its parent key; arrays are in id order. Three house styles differ in field names and in
what a parent without children gets:

========  =======================  ================================
``null``         ``"Customers": null``
``null_object``  ``"Customers": [{"CustomerID": null, ...}]``
``empty_array``  ``"Customers": []``
========  =======================  ================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions.text import address, full_name
from counterfoil.model import MONEY, Pos
from counterfoil.operators.gather import array_parts, gather_array
from counterfoil.operators.money import order_total, with_line_total
from counterfoil.operators.views import bought_pairs
from counterfoil.session import pin

# The field names of the three house styles.
PRODUCT_FIELDS = {
    "A": ("ProductID", "ProductName", "CurrentPrice", "Customers"),
    "B": ("ProductID", "Product Name", "Current Price", "Customers"),
    "C": ("ProductID", "name", "current price", "Customer"),
}
CUSTOMER_ORDER_FIELDS = {
    "A": ("OrderID", "OrderTotal", "OrderDate", "ShippingDate", "Items"),
    "B": ("OrderID", "Order Total", "Order Date", "Shipping Date", "Items"),
    "C": ("Order ID", "Total Order", "Order Place", "Order Shipped", "OrderItems"),
}
EMPTY_DEFAULT = {"A": "null", "B": "null_object", "C": "null_object"}


def _or_empty(children: Column, item: Column, empty: str) -> Column:
    """``children`` or, for a parent without any, the wanted stand-in."""
    if empty == "null":
        return F.when(F.size(children) > 0, children)
    stand_in = F.array(item) if empty == "null_object" else F.filter(F.array(item), lambda _: F.lit(False))
    return F.when(F.size(children) > 0, children).otherwise(stand_in)


def _named(**fields: Column) -> Column:
    return F.struct(*[column.alias(name) for name, column in fields.items()])


def _buyer(customer_id: str = "customer_id") -> Column:
    return F.struct(
        F.col(customer_id).alias("CustomerID"), full_name(F.col("firstName"), F.col("lastName")).alias("Customer Name")
    )


def _no_buyer() -> Column:
    return F.struct(F.lit(None).cast("long").alias("CustomerID"), F.lit(None).cast("string").alias("Customer Name"))


def doc_customers(pos: Pos, style: str = "A") -> DataFrame:
    """Name and address block of every customer with a known zip."""
    return pos.customers.join(pos.cities, "zip").select(
        full_name(F.col("firstName"), F.col("lastName")).alias("Customer Name"), address(style).alias("Address")
    )


def _product_buyers(pos: Pos, style: str) -> DataFrame:
    # A buyer appears once per order line, hence the copies.
    buyers = pos.customers.select(F.col("id").alias("customer_id"), "firstName", "lastName")
    kind = "inner" if style == "A" else "left"
    return bought_pairs(pos).join(buyers, "customer_id", kind)


def doc_products(pos: Pos, style: str = "A", empty: str | None = None) -> DataFrame:
    """Every product with the array of its buyers, one entry per order line."""
    id_, name, price, children = PRODUCT_FIELDS[style]
    bought = gather_array(_product_buyers(pos, style), ["product_id"], "customer_id", _buyer(), "_buyers", "copies")
    rows = pos.products.join(bought.withColumnRenamed("product_id", "id"), "id", "left")
    fields = {
        id_: F.col("id"),
        name: F.col("name"),
        price: F.col("currentPrice"),
        children: _or_empty(F.col("_buyers"), _no_buyer(), empty or EMPTY_DEFAULT[style]),
    }
    if style == "C":
        fields = {key: fields[key] for key in (id_, price, name, children)}
    return rows.select(*[column.alias(key) for key, column in fields.items()])


def doc_product_parts(pos: Pos) -> DataFrame:
    """Buyers per product in bounded pieces (ProductID, part, Customers), for very popular products."""
    return array_parts(
        _product_buyers(pos, "A"), ["product_id"], "customer_id", _buyer(), "copies"
    ).withColumnsRenamed({"product_id": "ProductID", "items": "Customers"})


def _named_lines(pos: Pos, extra: tuple[str, ...] = (), kind: str = "inner") -> DataFrame:
    goods = pos.products.select(F.col("id").alias("product_id"), F.col("id").alias("known_id"), "name")
    lines = pos.lines if not extra else with_line_total(pos.lines)
    return lines.select("order_id", "product_id", "quantity", *extra).join(goods, "product_id", kind)


def order_items(
    pos: Pos, item: Column, out: str = "Items", extra: tuple[str, ...] = (), kind: str = "inner"
) -> DataFrame:
    """Per order id the array of its lines, by product id; with ``kind="left"`` also lines of unknown products."""
    return gather_array(_named_lines(pos, extra, kind), ["order_id"], "product_id", item, out)


def _item(id_: str = "ProductID", name: str = "ProductName", quantity: str = "Quantity") -> Column:
    return _named(**{id_: F.col("product_id"), name: F.col("name"), quantity: F.col("quantity")})


def _no_item(*fields: str) -> Column:
    kinds = ("long", "string", "int")
    return _named(**{field: F.lit(None).cast(kind) for field, kind in zip(fields, kinds, strict=True)})


def doc_orders(pos: Pos, outer: bool = False) -> DataFrame:
    """Every order with its buyer and lines.

    Inner form: orders without lines are left out, the array is ``Products``.
    Outer form: they stay with a null array, which is named ``Items``.
    """
    name, array = ("ProductName", "Items") if outer else ("Product Name", "Products")
    items = order_items(pos, _item(name=name), "_items").withColumnRenamed("order_id", "OrderID")
    buyers = pos.customers.select(F.col("id").alias("customer_id"), "firstName", "lastName")
    orders = pos.orders.select(F.col("id").alias("OrderID"), "customer_id").join(buyers, "customer_id")
    return orders.join(items, "OrderID", "left" if outer else "inner").select(
        "OrderID", _buyer().alias("Buyer"), F.col("_items").alias(array)
    )


def doc_order_parts(pos: Pos) -> DataFrame:
    """Lines per order in bounded pieces (OrderID, part, Products), for orders of very many products."""
    return array_parts(
        _named_lines(pos), ["order_id"], "product_id", _item(name="Product Name")
    ).withColumnsRenamed({"order_id": "OrderID", "items": "Products"})


def doc_orders_dated(pos: Pos) -> DataFrame:
    """Style C of the order document: with dates, and orders kept without buyer or lines.

    A line of an unknown product keeps its quantity, with null id and name; an unknown buyer has a null id.
    """
    fields = ("PRODUCT ID", "PRODUCT NAME", "Quantity")
    item = _named(**dict(zip(fields, (F.col("known_id"), F.col("name"), F.col("quantity")), strict=True)))
    items = order_items(pos, item, "_items", kind="left").withColumnRenamed("order_id", "id")
    buyers = pos.customers.select(
        F.col("id").alias("customer_id"), F.col("id").alias("buyer_id"), "firstName", "lastName"
    )
    return (
        pos.orders.join(buyers, "customer_id", "left")
        .join(items, "id", "left")
        .select(
            F.col("id").alias("Order ID"),
            F.col("datePlaced").alias("Order Placed"),
            F.col("dateShipped").alias("Order Shipped"),
            _buyer("buyer_id").alias("Customer"),
            _or_empty(F.col("_items"), _no_item(*fields), "null_object").alias("Product"),
        )
    )


def _orders_with_items(pos: Pos, item: Column, extra: tuple[str, ...] = ()) -> DataFrame:
    items = order_items(pos, item, "_items", extra).withColumnRenamed("order_id", "id")
    return pos.orders.join(items, "id", "left")


def _order(fields: tuple[str, ...]) -> Column:
    """One order; style C shows its total with tax, the others the subtotal."""
    id_, total, placed, shipped, items = fields
    taxed = fields == CUSTOMER_ORDER_FIELDS["C"]
    return _named(
        **{
            id_: F.col("id"),
            total: order_total() if taxed else F.col("subtotal"),
            placed: F.col("datePlaced"),
            shipped: F.col("dateShipped"),
            items: F.col("_items"),
        }
    )


def _orders_of_customers(pos: Pos, fields: tuple[str, ...], item: Column, extra: tuple[str, ...] = ()) -> DataFrame:
    """Per customer id the array of its orders, each with its items, by order id."""
    rows = _orders_with_items(pos, item, extra)
    return gather_array(rows, ["customer_id"], "id", _order(fields), "_orders").withColumnRenamed("customer_id", "id")


def doc_customer_order_parts(pos: Pos) -> DataFrame:
    """Orders per customer in bounded pieces (CustomerID, part, Orders), for customers of very many orders."""
    rows = _orders_with_items(pos, _item())
    return array_parts(rows, ["customer_id"], "id", _order(CUSTOMER_ORDER_FIELDS["A"])).withColumnsRenamed(
        {"customer_id": "CustomerID", "items": "Orders"}
    )


def doc_customer_orders(pos: Pos, style: str = "A", empty: str | None = None) -> DataFrame:
    """Name, address and all orders with their items, of every customer with a known zip."""
    fields = CUSTOMER_ORDER_FIELDS[style]
    name = "Product Name" if style == "B" else "ProductName"
    item = _item(name=name)
    if style == "C":
        item = _named(ProductID=F.col("product_id"), Quantity=F.col("quantity"), ProductName=F.col("name"))
    nested = _orders_of_customers(pos, fields, item)
    order_type = nested.schema["_orders"].dataType.elementType
    no_order = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in order_type])
    block = address({"A": "A", "B": "B-lines", "C": "C"}[style])
    array = "Order Details" if style == "C" else "Orders"
    return (
        pos.customers.join(pos.cities, "zip")
        .join(nested, "id", "left")
        .select(
            full_name(F.col("firstName"), F.col("lastName")).alias("Customer Name"),
            block.alias("Address"),
            _or_empty(F.col("_orders"), no_order, empty or EMPTY_DEFAULT[style]).alias(array),
        )
    )


def doc_price_history(pos: Pos) -> DataFrame:
    """Every product with its price changes in the order they were made."""
    change = _named(OldPrice=F.col("oldPrice"), NewPrice=F.col("newPrice"), Timestamp=F.col("ts"))
    history = gather_array(pos.price_history, ["product_id"], "seq", change, "_history")
    return pos.products.join(history.withColumnRenamed("product_id", "id"), "id", "left").select(
        F.col("id").alias("ProductID"),
        F.col("name").alias("ProductName"),
        F.col("currentPrice").alias("CurrentPrice"),
        F.col("_history").alias("PriceHistory"),
    )


def doc_top_customers(pos: Pos, k: int = 10) -> DataFrame:
    """The ``k`` customers who spent most, best first, with orders and priced items.

    The k ids are found first and written out; only their orders and lines are then nested.
    """
    top = pin(
        pos.orders.groupBy("customer_id")
        .agg(F.sum("subtotal").cast(MONEY).alias("_spent"))
        .join(pos.customers.select(F.col("id").alias("customer_id")), "customer_id")
        .orderBy(F.col("_spent").desc_nulls_last(), "customer_id")
        .limit(k)
    )
    orders = pos.orders.join(top.select("customer_id"), "customer_id", "left_semi")
    lines = pos.lines.join(orders.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    item = _named(
        **{
            "ProductID": F.col("product_id"),
            "Product Name": F.col("name"),
            "Quantity": F.col("quantity"),
            "Unit Price": F.col("unitPrice"),
            "Line Total": F.col("lineTotal"),
        }
    )
    nested = _orders_of_customers(
        pos.with_(orders=orders, lines=lines), CUSTOMER_ORDER_FIELDS["B"], item, ("unitPrice", "lineTotal")
    )
    return (
        pos.customers.join(top.withColumnRenamed("customer_id", "id"), "id")
        .join(nested, "id")
        .orderBy(F.col("_spent").desc_nulls_last(), "id")
        .select(
            F.col("id").alias("CustomerID"),
            full_name(F.col("firstName"), F.col("lastName")).alias("Customer Name"),
            F.col("_spent").alias("Total Spent"),
            F.col("_orders").alias("Orders"),
        )
    )


def doc_customers_nested(pos: Pos) -> DataFrame:
    """All customers, with or without a known zip, with orders and priced items."""
    item = _named(product=F.col("name"), qty=F.col("quantity"), price=F.col("unitPrice"))
    items = order_items(pos, item, "items", ("unitPrice",)).withColumnRenamed("order_id", "id")
    orders = pos.orders.select("id", "customer_id").join(items, "id", "left")
    order = _named(order_id=F.col("id"), items=F.col("items"))
    nested = gather_array(orders, ["customer_id"], "id", order, "orders").withColumnRenamed("customer_id", "id")
    return pos.customers.join(nested, "id", "left").select(
        F.col("id").alias("customer_id"),
        full_name(F.col("firstName"), F.col("lastName")).alias("name"),
        "orders",
    )
