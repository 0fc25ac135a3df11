"""The registered queries as plain SQL over the same tables, for an independent check.

Nothing here is shared with the DataFrame code but the parameters: the SQL states the
result directly, with subqueries and recursion where the operators use joins and folds.
"""

from __future__ import annotations

SUPPLIER_BASE = 1_000_000_000_000
UNKNOWN = 1_000_000_000_000

# --- the model over the shared tables ---------------------------------------------------

MODEL = {
    "product": f"""
        select p_partkey as id, p_name as name, cast(p_retailprice as decimal(6,2)) as price,
               cast(p_size * 5 as integer) as qty
        from part
        union all
        select {SUPPLIER_BASE} + s_suppkey, s_name, null, null from supplier""",
    "city": """
        select lpad(cast(n_nationkey as varchar), 5, '0') as zip, n_name as city, substr(r_name, 1, 2) as state
        from nation join region on n_regionkey = r_regionkey""",
    "cust": f"""
        select c_custkey as id, split_part(c_name, '#', 1) as fn, split_part(c_name, '#', 2) as ln,
               c_mktsegment as a1,
               case when c_acctbal < 3000 then 'Unit ' || cast(c_nationkey as varchar) end as a2,
               lpad(cast(c_nationkey as varchar), 5, '0') as zip
        from customer
        union all
        select {SUPPLIER_BASE} + s_suppkey, split_part(s_name, '#', 1), split_part(s_name, '#', 2), null, null,
               lpad(cast(s_nationkey as varchar), 5, '0')
        from supplier""",
    "ord": """
        select o_orderkey as id, o_custkey as cid, cast(o_orderdate as date) as dp,
               case when o_orderstatus <> 'P' then cast(o_orderdate as date) + 7 end as ds
        from orders""",
    "ol": """
        select l_orderkey as oid, l_partkey as pid, cast(count(*) as integer) as q
        from lineitem group by 1, 2""",
    "olp": """
        select ol.*, product.price as up, cast(ol.q * product.price as decimal(18,2)) as lt
        from ol left join product on pid = product.id""",
    "ordt": """
        select ord.*, (select cast(sum(lt) as decimal(18,2)) from olp where oid = ord.id) as subtotal from ord""",
    "rate": """
        select lpad(cast(n_nationkey as varchar), 5, '0') as zip,
               cast(n_nationkey * cast(0.00375 as decimal(6,5)) as decimal(6,5)) as rate
        from nation join region on n_regionkey = r_regionkey where r_name <> 'AFRICA'""",
    "sale": "select pid, cid, oid from ol join ord on oid = ord.id",
    # Raw exports with their defects.
    "raw_product": """
        select cast(p_partkey as varchar) as id,
               case when p_size = 13 then '' else p_name end as name,
               case when p_size = 50 then '$99,999.00' when p_size = 49 then ''
                    when p_type = 'SMALL' then '$' || cast(cast(p_retailprice as decimal(10,2)) as varchar) || '5'
                    else '"$' || format('{:,.2f}', cast(cast(p_retailprice as decimal(10,2)) * 10 as double)) || '"'
               end as price,
               case when p_size < 4 then '-' || cast(p_size as varchar) when p_size < 7 then ''
                    when p_size < 9 then 'n/a' else cast(p_size as varchar) end as quantity
        from part""",
    "raw_customer": """
        select c_custkey as id,
               case when c_acctbal < -800 then '' else split_part(c_name, '#', 1) end as fn,
               split_part(c_name, '#', 2) as ln,
               case when c_acctbal > 9500 then '' when c_acctbal < 0 then lower(n_name) else n_name end as city,
               substr(r_name, 1, 2) as state,
               case when c_acctbal > 9800 then '' when c_acctbal > 9700 then '12x45'
                    else cast(c_nationkey as varchar) end as zip,
               case when c_acctbal < -900 then '' else c_mktsegment end as a1,
               case when c_acctbal < 3000 then 'Unit ' || cast(c_nationkey as varchar) else '' end as a2,
               case when c_acctbal < 500 then '' else lower(c_name) || '@example.com' end as email,
               case when c_acctbal < -700 then '0000-00-00' when c_acctbal < -600 then '2/30/1990'
                    when c_acctbal < -500 then ''
                    else strftime(date '1950-01-01' + cast(floor(abs(c_acctbal)) as integer), '%m/%d/%Y')
               end as birthdate
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "clean_customer": """
        select id, nullif(fn, '') as fn, nullif(ln, '') as ln, nullif(email, '') as email, nullif(a1, '') as a1,
               nullif(a2, '') as a2, cast(try_strptime(birthdate, '%m/%d/%Y') as date) as birthdate,
               case when regexp_full_match(zip, '[0-9]{1,5}') then lpad(zip, 5, '0') end as zip,
               nullif(city, '') as city, nullif(state, '') as state
        from raw_customer""",
    "clean_city": """
        select distinct zip, city, state from clean_customer
        where zip is not null and city is not null and state is not null""",
    "raw_order": f"""
        select o_orderkey as id,
               case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then o_custkey + {UNKNOWN}
                    else o_custkey end as cid,
               case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then '0000-00-00'
                    else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as placed,
               case when o_orderpriority = '2-HIGH' then 'Cancelled' when o_orderpriority = '3-MEDIUM' then ''
                    else strftime(o_orderdate + interval 7 day, '%Y-%m-%d %H:%M:%S') end as shipped
        from orders""",
    "clean_order": """
        select id, cast(try_strptime(placed, '%Y-%m-%d %H:%M:%S') as date) as dp,
               cast(try_strptime(shipped, '%Y-%m-%d %H:%M:%S') as date) as ds, cid
        from raw_order where cid in (select id from clean_customer)""",
    "raw_line": f"""
        select case when l_returnflag = 'R' and l_linenumber = 7 then l_orderkey + {UNKNOWN} else l_orderkey end as oid,
               l_partkey as pid
        from lineitem""",
    "clean_line": """
        select oid, pid, cast(count(*) as integer) as q from raw_line
        where oid in (select id from clean_order) group by 1, 2""",
    "clean_product": """
        select cast(id as bigint) as id, name,
               try_cast(replace(replace(replace(price, '$', ''), ',', ''), '"', '') as decimal(6,2)) as price,
               case when regexp_full_match(quantity, '[0-9]+') then cast(quantity as integer) end as qty
        from raw_product where name <> ''""",
    # Feeds.
    "price_feed": """
        select user_id as pid, cast(floor(value / 50) * 50 as decimal(6,2)) as price, ts, event_id as seq
        from events""",
    "price_step": """
        select pid, price, ts, seq,
               case when row_number() over w = 1 then product_price else lag(price) over w end as old
        from (select f.*, p.price as product_price from price_feed f join product p on f.pid = p.id)
        window w as (partition by pid order by ts, seq)""",
    "line_feed": """
        select case event_type when 'view' then 'update' when 'error' then 'delete' else 'insert' end as op,
               event_id as seq, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as oid, user_id as pid,
               greatest(cast(floor(value / 25) as integer), 1) as q,
               event_id % 3 = 0 and event_type = 'view' as moved
        from events""",
    "insert_feed": "select 'insert' as op, seq, seq as oid, pid, q, false as moved from line_feed",
    "update_feed": """
        select 'update' as op, l_orderkey * 1000000000 + l_partkey as seq, l_orderkey as oid, l_partkey as pid,
               cast(max(l_quantity) as integer) as q, false as moved
        from lineitem group by l_orderkey, l_partkey""",
    "delete_feed": """
        select distinct 'delete' as op, l_orderkey * 1000000000 + l_partkey as seq, l_orderkey as oid,
               l_partkey as pid, 1 as q, false as moved
        from lineitem where l_returnflag = 'R'""",
}

# Which of them each one reads.
_NEEDS = {
    "olp": ["ol", "product"],
    "ordt": ["ord", "olp"],
    "sale": ["ol", "ord"],
    "clean_customer": ["raw_customer"],
    "clean_city": ["clean_customer"],
    "clean_order": ["raw_order", "clean_customer"],
    "clean_line": ["raw_line", "clean_order"],
    "clean_product": ["raw_product"],
    "price_step": ["price_feed", "product"],
    "insert_feed": ["line_feed"],
}


def _with(needs: list[str], body: str, recursive: str = "") -> str:
    names: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in names:
            names.append(name)

    for need in needs:
        add(need)
    parts = [f"{name} as ({MODEL[name].strip()})" for name in names]
    if recursive:
        parts.append(recursive)
    head = "with recursive " if recursive else "with "
    return head + ",\n".join(parts) + "\n" + body.strip()


# --- JSON texts -----------------------------------------------------------------------------


def _string(expr: str) -> str:
    return f"coalesce(cast(to_json({expr}) as varchar), 'null')"


def _plain(expr: str) -> str:
    return f"coalesce(cast({expr} as varchar), 'null')"


def _day(expr: str) -> str:
    return f"coalesce('\"' || strftime({expr}, '%Y-%m-%d') || '\"', 'null')"


def _object_of(fields: list[tuple[str, str]]) -> str:
    inner = " || ',' || ".join(f"'\"{name}\":' || {text}" for name, text in fields)
    return f"('{{' || {inner} || '}}')"


def _array(item: str, order: str) -> str:
    return f"'[' || string_agg({item}, ',' order by {order}) || ']'"


_NAME = "fn || ' ' || ln"
_PLACE = "city || ', ' || state || ' ' || city.zip"
_ADDRESS = f"a1 || coalesce(chr(10) || a2, '') || chr(10) || {_PLACE}"
_ADDRESS_C = "a1 || coalesce(chr(10) || a2, '') || chr(10) || city || ' ' || state || ' ' || city.zip"
_ADDRESS_B = f"coalesce(a1 || chr(10), '') || coalesce(a2, '') || chr(10) || {_PLACE}"
_BUYER = _object_of([("CustomerID", _plain("cust.id")), ("Customer Name", _string(_NAME))])
_NO_BUYER = "'[{\"CustomerID\":null,\"Customer Name\":null}]'"


def _doc_products(id_first: list[tuple[str, str]], array: str, empty: str) -> str:
    buyers = f"(select {_array(_BUYER, 'cust.id')} from sale join cust on cid = cust.id where pid = product.id)"
    doc = _object_of([*id_first, (array, f"coalesce({buyers}, {empty})")])
    return _with(["product", "sale", "cust"], f'select id as "ProductID", {doc} as doc from product')


_TAX = "cast(round(subtotal * coalesce(rate, 0) + cast(0.000001 as decimal(7,6)), 2) as decimal(18,2))"


def _customer_orders(style: str) -> str:
    names = {
        "A": ("OrderID", "OrderTotal", "OrderDate", "ShippingDate", "Items"),
        "B": ("OrderID", "Order Total", "Order Date", "Shipping Date", "Items"),
        "C": ("Order ID", "Total Order", "Order Place", "Order Shipped", "OrderItems"),
    }[style]
    item_fields = [("ProductID", _plain("pid")), ("ProductName", _string("name")), ("Quantity", _plain("q"))]
    if style == "B":
        item_fields[1] = ("Product Name", _string("name"))
    if style == "C":
        item_fields = [item_fields[0], item_fields[2], item_fields[1]]
    order = _object_of(
        [
            (names[0], _plain("ordt.id")),
            (names[1], _plain(f"cast(subtotal + {_TAX} as decimal(18,2))" if style == "C" else "subtotal")),
            (names[2], _day("dp")),
            (names[3], _day("ds")),
            (names[4], "coalesce(items, 'null')"),
        ]
    )
    empty = "'null'" if style == "A" else "'[{" + ",".join(f'"{n}":null' for n in names) + "}]'"
    address = {"A": _ADDRESS, "B": _ADDRESS_B, "C": _ADDRESS_C}[style]
    doc = _object_of(
        [
            ("Customer Name", _string(_NAME)),
            ("Address", _string(address)),
            ("Order Details" if style == "C" else "Orders", f"coalesce(os.orders, {empty})"),
        ]
    )
    return _with(
        ["product", "city", "cust", "ordt", "rate"],
        f"""
        , item as (select oid, {_array(_object_of(item_fields), 'pid')} as items
                   from ol join product on pid = product.id group by oid),
        os as (select cid, {_array(order, 'ordt.id')} as orders
               from ordt left join item on oid = ordt.id join cust on cust.id = cid
               left join rate on rate.zip = cust.zip group by cid)
        select {doc} as doc from cust join city on cust.zip = city.zip left join os on os.cid = cust.id""",
    )


# --- string lists -------------------------------------------------------------------------------


def _buyers(distinct: bool) -> str:
    pairs = "select distinct pid, cid from sale" if distinct else "select pid, cid from sale"
    return f"""(select string_agg(cust.id || ' ' || fn || ' ' || ln, ',' order by cust.id)
                from ({pairs}) s join cust on cid = cust.id where pid = product.id)"""


def _goods(distinct: bool) -> str:
    pairs = "select distinct pid, cid from sale" if distinct else "select pid, cid from sale"
    return f"""(select string_agg(product.id || ' ' || name, '|' order by product.id)
                from ({pairs}) s join product on pid = product.id where cid = cust.id)"""


def _product_buyers(distinct: bool = True) -> str:
    return _with(
        ["product", "cust", "sale"],
        f'select id as "productID", name as "productName", {_buyers(distinct)} as customers from product order by id',
    )


def _customer_purchases(distinct: bool = True) -> str:
    return _with(
        ["product", "cust", "sale"],
        f'select id as "customer number", fn, ln, {_goods(distinct)} as products from cust order by ln, fn, id',
    )


# --- line changes ---------------------------------------------------------------------------------

# One step per change and product: stock left and the lines of the product (0 = no line).
_WALK = """
    held as (select pid, map_from_entries(list((oid, q))) as lines from ol group by pid),
    step as (select *, row_number() over (partition by pid order by seq) as n from {feed}),
    walk as (
        select id as pid, cast(0 as bigint) as n, cast(qty as bigint) as stock,
               coalesce(held.lines, cast(map([], []) as map(bigint, integer))) as lines,
               cast(null as bigint) as seq, cast(null as varchar) as op, cast(null as bigint) as oid,
               cast(null as integer) as q, cast(null as integer) as old, cast(null as varchar) as reason
        from product left join held on held.pid = product.id
        where id in (select pid from step)
        union all
        select pid, n,
               case when reason is null then stock - used else stock end,
               case when reason is null
                    then map_concat(lines, map([oid], [case when op = 'delete' then 0 else q end])) else lines end,
               seq, op, oid, q, nullif(old, 0), reason
        from (
            select *,
                   case when op <> 'insert' and old = 0 then 'No such line'
                        when op = 'insert' and oid not in (select id from ord) then 'No such order'
                        when op = 'insert' and old > 0 then 'Line already exists'
                        when moved then 'Cannot change product_id or order_id in Orderline'
                        when used > 0 and used > stock then 'Not enough product quantity available' end as reason
            from (
                select *, case op when 'delete' then -old when 'update' then q - old else q end as used
                from (
                    select s.pid, s.n, w.stock, w.lines, s.seq, s.op, s.oid, s.q, s.moved,
                           coalesce(w.lines[s.oid], 0) as old
                    from walk w join step s on s.pid = w.pid and s.n = w.n + 1
                )
            )
        )
    )"""


def _walked(feed: str, body: str, more: list[str] | None = None) -> str:
    return _with(["product", "ord", "ol", feed, *(more or [])], body, _WALK.format(feed=feed))


_DELTA = """case when reason is null then
    case op when 'delete' then -old when 'update' then q - old else q end end"""

_DECIDED = f"""
    select seq, op, oid as order_id, pid as product_id, reason is null as accepted, reason,
           case when op = 'insert' and coalesce(reason, '') <> 'Line already exists' then null else old end
               as old_quantity,
           cast({_DELTA} as integer) as delta
    from walk where n > 0"""

_STOCK = f"""
    select 'stock' as kind, id, cast(qty - coalesce(
               (select sum({_DELTA}) from walk where n > 0 and pid = product.id), 0) as decimal(18,2)) as amount,
           cast(null as decimal(18,2)) as tax
    from product"""

# All lines of the shared tables have a price, so every accepted change moves the total.
_BOOKS = f"""
    {_STOCK}
    union all
    select 'order', id, total, case when moved is null then cast(0 as decimal(18,2)) else
           cast(round(total * coalesce(rate, 0) + cast(0.000001 as decimal(7,6)), 2) as decimal(18,2)) end
    from (
        select o.id, m.moved, rate.rate,
               case when m.moved is null then o.subtotal
                    else cast(coalesce(o.subtotal, 0) + m.moved as decimal(18,2)) end as total
        from ordt o join cust on cust.id = o.cid left join rate on rate.zip = cust.zip
        left join (
            select oid, cast(sum(({_DELTA}) * product.price) as decimal(18,2)) as moved
            from walk join product on walk.pid = product.id where n > 0 and reason is null group by oid
        ) m on m.oid = o.id
    )"""


# The lines after the feed, with the number of the insert that made them, if one did.
_NOW = """
    , last as (select pid, oid, arg_max(op, seq) as op, arg_max(q, seq) as q,
                      max(case when op = 'insert' then seq end) as birth
               from walk where n > 0 and reason is null group by 1, 2),
    now as (
        select pid, oid, q, cast(null as bigint) as birth from ol where (pid, oid) not in (select pid, oid from last)
        union all
        select pid, oid, q, birth from last where op <> 'delete'
    )"""
_NOW_LINE = 'select oid as order_id, pid as product_id, q as quantity, {price} as "unitPrice" from now join product on pid = id'


def _books(feed: str) -> str:
    return _walked(feed, _BOOKS, ["cust", "ordt", "rate"])


def _taxed(epsilon: str, only: str = "") -> str:
    tax = f"cast(round(subtotal * coalesce(rate, 0){epsilon}, 2) as decimal(18,2))"
    if only:
        tax = f"case when o.id in ({only}) then {tax} else cast(0 as decimal(18,2)) end"
    return _with(
        ["ordt", "cust", "rate"],
        f"""
        select id, cid as customer_id, subtotal, tax as "salesTax", cast(subtotal + tax as decimal(18,2)) as total
        from (select o.*, {tax} as tax from ordt o left join cust on cid = cust.id left join rate on cust.zip = rate.zip)
        """,
    )


_EPS = " + cast(0.000001 as decimal(7,6))"
_HISTORY = 'select pid as product_id, old as "oldPrice", price as "newPrice", seq from price_step'
_FULL_NAME = "fn || ' ' || ln"
_SPENT = """
    select cust.id as "CustomerID", {name} as "Customer Name",
           cast(coalesce(sum(subtotal), 0) as decimal(18,2)) as "totalSpent"
    from cust join city on cust.zip = city.zip left join ordt on cid = cust.id
    group by cust.id, {name} order by 3 desc, 1 limit {k}"""
#: Documents without ids tell customers by their names.
_SPENT_BY_NAME = """
    select fn || ' ' || ln as "Customer Name", cast(coalesce(sum(subtotal), 0) as decimal(18,2)) as "totalSpent"
    from cust join city on cust.zip = city.zip left join ordt on cid = cust.id
    group by 1 order by 2 desc, 1 limit {k}"""


def _top_customers() -> str:
    item = _object_of(
        [
            ("ProductID", _plain("pid")), ("Product Name", _string("name")), ("Quantity", _plain("q")),
            ("Unit Price", _plain("up")), ("Line Total", _plain("lt")),
        ]
    )
    order = _object_of(
        [
            ("OrderID", _plain("ordt.id")), ("Order Total", _plain("subtotal")), ("Order Date", _day("dp")),
            ("Shipping Date", _day("ds")), ("Items", "coalesce(items, 'null')"),
        ]
    )
    doc = _object_of(
        [
            ("CustomerID", _plain("cust.id")), ("Customer Name", _string(_NAME)), ("Total Spent", _plain("spent")),
            ("Orders", "orders"),
        ]
    )
    return _with(
        ["product", "cust", "ordt"],
        f"""
        , item as (select oid, {_array(item, 'pid')} as items from olp join product on pid = product.id group by oid),
        os as (select cid, cast(sum(subtotal) as decimal(18,2)) as spent, {_array(order, 'ordt.id')} as orders
               from ordt left join item on oid = ordt.id group by cid)
        select cust.id as "CustomerID", {doc} as doc from cust join os on os.cid = cust.id
        order by spent desc nulls last, cust.id limit 10""",
    )


def _customers_nested() -> str:
    item = _object_of([("product", _string("name")), ("qty", _plain("q")), ("price", _plain("up"))])
    order = _object_of([("order_id", _plain("ord.id")), ("items", "coalesce(items, 'null')")])
    doc = _object_of(
        [("customer_id", _plain("cust.id")), ("name", _string(_NAME)), ("orders", "coalesce(orders, 'null')")]
    )
    return _with(
        ["product", "cust", "ord", "olp"],
        f"""
        , item as (select oid, {_array(item, 'pid')} as items from olp join product on pid = product.id group by oid),
        os as (select cid, {_array(order, 'ord.id')} as orders from ord left join item on oid = ord.id group by cid)
        select cust.id as customer_id, {doc} as doc from cust left join os on os.cid = cust.id""",
    )


def _doc_orders(outer: bool) -> str:
    name, array = ("ProductName", "Items") if outer else ("Product Name", "Products")
    item = _object_of([("ProductID", _plain("pid")), (name, _string("name")), ("Quantity", _plain("q"))])
    doc = _object_of([("OrderID", _plain("ord.id")), ("Buyer", _BUYER), (array, "coalesce(items, 'null')")])
    kind = "left join" if outer else "join"
    return _with(
        ["product", "cust", "ord", "ol"],
        f"""
        , item as (select oid, {_array(item, 'pid')} as items from ol join product on pid = product.id group by oid)
        select ord.id as "OrderID", {doc} as doc
        from ord join cust on cid = cust.id {kind} item on oid = ord.id""",
    )


def _doc_order_parts() -> str:
    item = _object_of([("ProductID", _plain("pid")), ("Product Name", _string("name")), ("Quantity", _plain("q"))])
    doc = _object_of([("OrderID", _plain("oid")), ("part", _plain("part")), ("Products", _array(item, "pid"))])
    return _with(
        ["product", "ol"],
        f"""
        select oid as "OrderID", {doc} as doc
        from (select *, pid // 65536 as part from ol) l join product on pid = product.id group by oid, part""",
    )


def _doc_customer_order_parts() -> str:
    item = _object_of([("ProductID", _plain("pid")), ("ProductName", _string("name")), ("Quantity", _plain("q"))])
    order = _object_of(
        [
            ("OrderID", _plain("ordt.id")), ("OrderTotal", _plain("subtotal")), ("OrderDate", _day("dp")),
            ("ShippingDate", _day("ds")), ("Items", "coalesce(items, 'null')"),
        ]
    )
    doc = _object_of(
        [("CustomerID", _plain("cid")), ("part", _plain("ordt.id // 65536")), ("Orders", _array(order, "ordt.id"))]
    )
    return _with(
        ["product", "ordt", "ol"],
        f"""
        , item as (select oid, {_array(item, 'pid')} as items from ol join product on pid = product.id group by oid)
        select cid as "CustomerID", {doc} as doc
        from ordt left join item on oid = ordt.id group by cid, ordt.id // 65536""",
    )


def _doc_orders_dated() -> str:
    item = _object_of([("PRODUCT ID", _plain("pid")), ("PRODUCT NAME", _string("name")), ("Quantity", _plain("q"))])
    empty = "'[{\"PRODUCT ID\":null,\"PRODUCT NAME\":null,\"Quantity\":null}]'"
    doc = _object_of(
        [
            ("Order ID", _plain("ord.id")), ("Order Placed", _day("dp")), ("Order Shipped", _day("ds")),
            ("Customer", _BUYER), ("Product", f"coalesce(items, {empty})"),
        ]
    )
    return _with(
        ["product", "cust", "ord", "ol"],
        f"""
        , item as (select oid, {_array(item, 'pid')} as items from ol join product on pid = product.id group by oid)
        select {doc} as doc from ord left join cust on cid = cust.id left join item on oid = ord.id""",
    )


def _doc_orders_dated_orphans() -> str:
    item = _object_of([("PRODUCT ID", _plain("p.id")), ("PRODUCT NAME", _string("name")), ("Quantity", _plain("q"))])
    empty = "'[{\"PRODUCT ID\":null,\"PRODUCT NAME\":null,\"Quantity\":null}]'"
    doc = _object_of(
        [
            ("Order ID", _plain("ord.id")), ("Order Placed", _day("dp")), ("Order Shipped", _day("ds")),
            ("Customer", _BUYER), ("Product", f"coalesce(items, {empty})"),
        ]
    )
    return _with(
        ["clean_product", "cust", "ord", "ol"],
        f"""
        , item as (select oid, {_array(item, 'pid')} as items from ol left join clean_product p on pid = p.id group by oid)
        select {doc} as doc from ord
        left join (select * from cust where a2 is not null) cust on cid = cust.id left join item on oid = ord.id""",
    )


def _doc_price_history() -> str:
    change = _object_of(
        [
            ("OldPrice", _plain("old")), ("NewPrice", _plain("step.price")),
            ("Timestamp", "'\"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '\"'"),
        ]
    )
    now = "coalesce((select arg_max(price, seq) from price_feed f where f.pid = product.id), product.price)"
    history = f"""(select {_array(change, 'seq')} from price_step step
                   where step.pid = product.id and old <> step.price)"""
    doc = _object_of(
        [
            ("ProductID", _plain("id")), ("ProductName", _string("name")), ("CurrentPrice", _plain(now)),
            ("PriceHistory", f"coalesce({history}, 'null')"),
        ]
    )
    return _with(["product", "price_feed", "price_step"], f'select id as "ProductID", {doc} as doc from product')


_PRODUCT_A = [
    ("ProductID", _plain("id")), ("ProductName", _string("name")), ("CurrentPrice", _plain("price")),
]
_PRODUCT_B = [
    ("ProductID", _plain("id")), ("Product Name", _string("name")), ("Current Price", _plain("price")),
]
_PRODUCT_C = [("ProductID", _plain("id")), ("current price", _plain("price")), ("name", _string("name"))]



def _report_row(rule: str, table: str, column: str, count: str) -> str:
    return f"select '{rule}' as rule, '{table}' as table_name, '{column}' as column_name, ({count}) as n"


def _unique(table: str, source: str, column: str, keys: str) -> str:
    repeated = f"select count(*) from (select {keys} from {source} group by all having count(*) > 1)"
    return _report_row("unique", table, column, repeated)


def _reference(table: str, column: str, child: str, key: str, parent: str, parent_key: str) -> str:
    orphans = f"select count(*) from {child} c where {key} is not null"
    return _report_row("reference", table, column, f"{orphans} and {key} not in (select {parent_key} from {parent})")


def _counted(rule: str, table: str, column: str, source: str, condition: str) -> str:
    return _report_row(rule, table, column, f"select count(*) from {source} where {condition}")


def _dq_report() -> str:
    lengths = [
        ("product", "clean_product", "name", "name", 128), ("city", "clean_city", "city", "city", 32),
        ("city", "clean_city", "state", "state", 4), ("customer", "clean_customer", "firstName", "fn", 32),
        ("customer", "clean_customer", "lastName", "ln", 30), ("customer", "clean_customer", "email", "email", 128),
        ("customer", "clean_customer", "address1", "a1", 100), ("customer", "clean_customer", "address2", "a2", 50),
        ("sales_tax", "rates", "state", "state", 2), ("sales_tax", "rates", "taxRegionName", "region", 64),
    ]
    rows = [
        _unique("product", "clean_product", "id", "id"),
        _unique("city", "clean_city", "zip", "zip"),
        _unique("customer", "clean_customer", "id", "id"),
        _unique("order", "clean_order", "id", "id"),
        _unique("orderline", "clean_line", "order_id,product_id", "oid, pid"),
        _unique("sales_tax", "rates", "zip", "zip"),
        _reference("customer", "zip", "clean_customer", "zip", "clean_city", "zip"),
        _reference("order", "customer_id", "clean_order", "cid", "clean_customer", "id"),
        _reference("orderline", "order_id", "clean_line", "oid", "clean_order", "id"),
        _reference("orderline", "product_id", "clean_line", "pid", "clean_product", "id"),
        _reference("price_history", "product_id", "logged", "pid", "clean_product", "id"),
        _counted("required", "product", "name", "clean_product", "name is null"),
        _counted("required", "city", "city", "clean_city", "city is null"),
        _counted("required", "city", "state", "clean_city", "state is null"),
        _counted("required", "price_history", "ts", "logged", "ts is null"),
        *[_counted("length", t, name, source, f"length({c}) > {n}") for t, source, name, c, n in lengths],
    ]
    needs = ["clean_product", "clean_city", "clean_customer", "clean_order", "clean_line", "price_step", "rate"]
    named = """
        , rates as (select rate.zip, n_name as region, substr(r_name, 1, 2) as state
                    from rate join nation on rate.zip = lpad(cast(n_nationkey as varchar), 5, '0')
                    join region on n_regionkey = r_regionkey),
        logged as (select * from price_step where old <> price)
        """
    return _with(needs, named + "\nunion all\n".join(rows))


_OPEN_ORDERS = "select l_orderkey from lineitem where l_linestatus = 'O'"

_REPORT = """
    select {key} as "Product ID", cast(sum(q) as bigint) as "Quantity Sold",
           cast(sum(lt) as decimal(18,2)) as "Total Sales Amount"
    from olp join ord on oid = ord.id
    where dp between date '{start}' and date '{end}' {more}"""


def oracle_sql(start, end, product: int, region: str, recalled: int) -> dict[str, str]:
    """One SQL text per registered query."""
    report = {"start": start, "end": end}
    one_report = _with(["olp", "ord"], _REPORT.format(key="max(pid)", more=f"and pid = {product}", **report))
    product_part = _object_of(
        [
            ("ProductID", _plain("pid")), ("part", _plain("part")), ("piece", "'0'"),
            ("Customers", _array(_BUYER, "cust.id")),
        ]
    )
    texts = {
        "etl_clean_products": _with(
            ["clean_product"], 'select id, name, price as "currentPrice", qty as "availableQuantity" from clean_product'
        ),
        "etl_clean_customers": _with(
            ["clean_customer"],
            """select id, fn as "firstName", ln as "lastName", email, a1 as address1, a2 as address2, birthdate, zip
               from clean_customer""",
        ),
        "etl_city_dimension": _with(["clean_city"], "select zip, city, state from clean_city"),
        "etl_clean_orders": _with(
            ["clean_order"], 'select id, dp as "datePlaced", ds as "dateShipped", cid as customer_id from clean_order'
        ),
        "etl_orderlines": _with(["clean_line"], "select oid as order_id, pid as product_id, q as quantity from clean_line"),
        "etl_counts": _with(
            ["clean_product", "clean_city", "clean_customer", "clean_order", "clean_line"],
            """
            select 'product' as table_name, count(*) as n from clean_product
            union all select 'city', count(distinct zip) from clean_city
            union all select 'customer', count(*) from clean_customer
            union all select 'order', count(*) from clean_order
            union all select 'orderline', count(*) from clean_line""",
        ),
        "v_customers": _with(["cust"], 'select ln as "Last Name", fn as "First Name" from cust order by 1, 2'),
        "v_customers2": _with(
            ["cust", "city"],
            """select id as customer_number, fn as first_name, ln as last_name,
                      a1 || coalesce(', ' || a2, '') as addr1,
                      city || ', ' || state || '   ' || city.zip as addr2
               from cust join city on cust.zip = city.zip order by city.zip, id""",
        ),
        "v_product_buyers": _product_buyers(),
        "v_product_buyers_all": _product_buyers(False),
        "v_customer_purchases": _customer_purchases(),
        "v_customer_purchases_all": _customer_purchases(False),
        "product_buyers_parts": _with(
            ["cust", "sale"],
            """select pid as "productID", cid // 65536 as part,
                      string_agg(cust.id || ' ' || fn || ' ' || ln, ',' order by cust.id) as customers
               from (select distinct pid, cid from sale) s join cust on cid = cust.id group by 1, 2""",
        ),
        "customer_purchases_parts": _with(
            ["product", "sale"],
            """select cid as "customer number", pid // 65536 as part,
                      string_agg(product.id || ' ' || name, '|' order by product.id) as products
               from (select distinct pid, cid from sale) s join product on pid = product.id group by 1, 2""",
        ),
        "mv_product_buyers": _product_buyers(),
        "mv_customer_purchases": _customer_purchases(),
        "mv_refresh_full": _with(
            ["product", "cust", "sale"],
            f"""select 'mv_product_buyers' as view_name, id, {_buyers(True)} as list from product
                union all
                select 'mv_customer_purchases', id, {_goods(True)} from cust""",
        ),
        "mv_refresh_customers": _customer_purchases(),
        "mv_refresh_products": _product_buyers(),
        "mv_refresh_products_all": _product_buyers(False),
        "mv_refresh_customers_all": _customer_purchases(False),
        "mv_recomputed_keys": _with(
            ["product", "cust", "sale"],
            f"""select 'mv_product_buyers' as view_name, id, {_buyers(True)} as list from product
                union all
                select 'mv_customer_purchases', id, {_goods(True)} from cust""",
        ),
        "fill_unit_price": _with(
            ["olp"],
            """select oid as order_id, pid as product_id, q as quantity, up as "unitPrice", lt as "lineTotal" from olp""",
        ),
        "fill_order_total": _with(["ordt"], 'select id, subtotal as "orderTotal" from ordt'),
        "sales_tax": _taxed(_EPS),
        "sales_tax_no_epsilon": _taxed(""),
        "sales_tax_touched": _taxed(_EPS, _OPEN_ORDERS),
        "sales_report": one_report,
        "sales_report_statement": one_report,
        "sales_report_blocks": one_report,
        "sales_report_all_blocks": _with(["olp", "ord"], _REPORT.format(key="pid", more="group by pid", **report)),
        "sales_report_all": _with(["olp", "ord"], _REPORT.format(key="pid", more="group by pid", **report)),
        "price_history": _with(["price_step"], _HISTORY + " where old <> price"),
        "price_history_unchanged": _with(["price_step"], _HISTORY),
        "stream_price_history": _with(["price_step"], _HISTORY + " where old <> price"),
        "update_price": _with(
            ["product", "price_feed"],
            """select id, name,
                      coalesce((select arg_max(f.price, seq) from price_feed f where pid = id), product.price)
                          as "currentPrice",
                      qty as "availableQuantity"
               from product""",
        ),
        "doc_customers": _with(
            ["cust", "city"],
            f"""select {_object_of([("Customer Name", _string(_NAME)), ("Address", _string(_ADDRESS))])} as doc
                from cust join city on cust.zip = city.zip""",
        ),
        "doc_customers_plain": _with(
            ["cust", "city"],
            f"""select {_object_of([("Customer Name", _string(_NAME)), ("Address", _string(_ADDRESS_C))])} as doc
                from cust join city on cust.zip = city.zip""",
        ),
        "doc_products": _doc_products(_PRODUCT_A, "Customers", "'null'"),
        "doc_products_outer": _doc_products(_PRODUCT_B, "Customers", _NO_BUYER),
        "doc_products_empty_array": _doc_products(_PRODUCT_C, "Customer", "'[]'"),
        "doc_product_parts": _with(
            ["cust", "sale"],
            f"""select pid as "ProductID", {product_part} as doc
                from (select pid, cid, cid // 65536 as part from sale) s join cust on cid = cust.id
                group by pid, part""",
        ),
        "doc_order_parts": _doc_order_parts(),
        "doc_customer_order_parts": _doc_customer_order_parts(),
        "doc_orders": _doc_orders(False),
        "doc_orders_outer": _doc_orders(True),
        "doc_orders_dated": _doc_orders_dated(),
        "doc_orders_roundtrip": _doc_orders(False),
        "doc_customer_orders": _customer_orders("A"),
        "doc_customer_orders_outer": _customer_orders("B"),
        "doc_customer_orders_plain": _customer_orders("C"),
        "doc_price_history": _doc_price_history(),
        "doc_top_customers": _top_customers(),
        "doc_customers_nested": _customers_nested(),
        "mongo_customers_in_region": _with(
            ["cust", "city"],
            f"""select fn || ' ' || ln as "Customer Name", {_ADDRESS} as "Address"
                from cust join city on cust.zip = city.zip where contains(lower({_ADDRESS}), '{region}')""",
        ),
        "mongo_best_customer": _with(["cust", "city", "ordt"], _SPENT.format(k=1, name=_FULL_NAME)),
        "mongo_top10_customers": _with(["cust", "city", "ordt"], _SPENT.format(k=10, name=_FULL_NAME)),
        "mongo_top10_namesakes": _with(["cust", "city", "ordt"], _SPENT.format(k=10, name="'Ann Lee'")),
        "mongo_best_customer_docs": _with(["cust", "city", "ordt"], _SPENT_BY_NAME.format(k=1)),
        "mongo_top10_customers_docs": _with(["cust", "city", "ordt"], _SPENT_BY_NAME.format(k=10)),
        "mongo_best_product": _with(
            ["sale", "cust"],
            """select pid as "ProductID", count(*) as purchases from sale join cust on cid = cust.id
               group by 1 order by 2 desc, 1 limit 1""",
        ),
        "mongo_unsold_products": _with(
            ["product", "sale"],
            'select id as "ProductID", name as "Product Name" from product where id not in (select pid from sale)',
        ),
        "mongo_recall": _with(
            ["sale", "cust"],
            f"""select cust.id as "CustomerID", fn || ' ' || ln as "Customer Name"
                from sale join cust on cid = cust.id where pid = {recalled}""",
        ),
        "mongo_fraud": _with(
            ["ordt", "ol"],
            """select id as "OrderID", subtotal as "OrderTotal", count(*) as n_items
               from ordt join ol on oid = id group by 1, 2 having subtotal > 10000 or count(*) > 10""",
        ),
        "clamp_quantity": _with(["line_feed"], "select seq, q as quantity from line_feed"),
        "apply_inserts": _books("insert_feed"),
        "apply_updates": _books("update_feed"),
        "apply_deletes": _books("delete_feed"),
        "apply_changes": _walked("line_feed", _DECIDED),
        "stream_stock_guard": _walked("line_feed", _DECIDED),
        "reject_oversold": _walked(
            "insert_feed", "select seq, pid as product_id, q as quantity, reason from walk where reason is not null"
        ),
        "batch_stock_check": _with(
            ["insert_feed", "product"],
            """select pid as product_id, cast(sum(q) as bigint) as requested, any_value(qty) as available,
                      coalesce(sum(q) <= any_value(qty), true) as fits
               from insert_feed left join product on pid = id group by pid""",
        ),
        "stream_line_changes": _walked(
            "line_feed",
            f"""
            , last as (select pid, oid, arg_max(op, seq) as op from walk where n > 0 and reason is null group by 1, 2),
            now as (
                select pid, oid from ol where (pid, oid) not in (select pid, oid from last)
                union all
                select pid, oid from last where op <> 'delete'
            )
            select kind, id, cast(cast(amount as bigint) as varchar) as value from ({_STOCK})
            union all
            select 'buyers', id, (
                select string_agg(cust.id || ' ' || fn || ' ' || ln, ',' order by cust.id)
                from (select distinct cid from now join ord on oid = ord.id where pid = product.id) s
                join cust on cid = cust.id)
            from product""",
            ["cust"],
        ),
        "upsert_orderlines": """
            with f as (select l_orderkey as oid, l_partkey as pid, cast(count(*) as integer) as q
                       from lineitem where l_linestatus = 'F' group by 1, 2),
            o as (select l_orderkey as oid, l_partkey as pid,
                         cast(arg_max(l_quantity, l_linenumber * 1000 + l_quantity) as integer) as q
                  from lineitem where l_linestatus = 'O' group by 1, 2)
            select coalesce(o.oid, f.oid) as order_id, coalesce(o.pid, f.pid) as product_id,
                   coalesce(o.q, f.q) as quantity
            from f full join o on f.oid = o.oid and f.pid = o.pid""",
        "dq_pk_orderline": """
            select l_orderkey as order_id, l_partkey as product_id, count(*) as n
            from lineitem group by 1, 2 having count(*) > 1""",
        "dq_pk_city": _with(["clean_city"], "select zip, count(*) as n from clean_city group by 1 having count(*) > 1"),
        "dq_fk_orphans": _with(
            ["raw_line", "raw_order", "cust"],
            """select 'orderline.order_id' as fk, oid as key from raw_line where oid not in (select id from raw_order)
               union all
               select 'order.customer_id', cid from raw_order where cid not in (select id from cust)""",
        ),
        "dq_nulls": _with(
            ["product"],
            """select count(*) filter (where name is null) as name, count(*) filter (where price is null) as "currentPrice",
                      count(*) filter (where qty is null) as "availableQuantity"
               from product""",
        ),
        "dq_lengths": _with(
            ["cust"],
            """select count(*) filter (where length(fn) > 6) as "firstName",
                      count(*) filter (where length(a1) > 8) as address1
               from cust""",
        ),
        "dq_unparsed": _with(
            ["raw_product"],
            """select count(*) filter (where trim(price) <> '' and
                          try_cast(replace(replace(replace(price, '$', ''), ',', ''), '"', '') as decimal(6,2)) is null)
                          as price,
                      count(*) filter (where trim(quantity) <> '' and not regexp_full_match(quantity, '[0-9]+'))
                          as quantity_on_hand
               from raw_product""",
        ),
        "dq_report": _dq_report(),
        "check_ids": _with(
            ["ord", "ol"],
            """
            , l as (select id, row_number() over (order by id) - 1 as position from ord where id in (select oid from ol)),
            r as (select id, row_number() over (order by id) - 1 as position from ord where ds is not null)
            select 'left' as side, id, position from l where id not in (select id from r)
            union all
            select 'right', id, position from r where id not in (select id from l)""",
        ),
        "doc_diff": _with(
            ["product", "cust", "city", "ord", "ol", "sale"],
            """
            , c as (select a1 is null or a2 is not null as same_address, a1 is not null as has_address,
                           id in (select cid from ord) as has_orders
                    from cust join city on cust.zip = city.zip),
            o as (select count(*) as n from ord where id in (select oid from ol)),
            p as (select id in (select pid from sale) as sold from product)
            select 'cust1.json' as dataset, count(*) as common, cast(0 as bigint) as only_left,
                   cast(0 as bigint) as only_right
            from c
            union all
            select 'cust2.json', count(*) filter (where same), count(*) filter (where not same),
                   count(*) filter (where not same)
            from (select has_address and same_address and has_orders as same from c)
            union all
            select 'ord.json', n, 0, 0 from o
            union all
            select 'prod.json', count(*) filter (where sold), count(*) filter (where not sold),
                   count(*) filter (where not sold)
            from p""",
        ),
    }
    loaded = {
        "product": "clean_product", "customer": "clean_customer", "order": "clean_order",
    }
    counts = [f"select '{name}' as table_name, count(*) as n from {source}" for name, source in loaded.items()]
    counts += ["select 'city', count(distinct zip) from clean_city", "select 'orderline', 0", "select 'sales_tax', 0"]
    price_then = """coalesce((select arg_max(f.price, f.seq) from price_feed f where f.pid = now.pid and f.seq <= birth),
                             product.price)"""
    texts |= {
        "csv_products": texts["etl_clean_products"],
        "csv_customers": texts["etl_clean_customers"],
        "csv_orders": texts["etl_clean_orders"],
        "csv_orderlines": texts["etl_orderlines"],
        "csv_sales_tax": _with(
            ["rate"],
            """select rate.zip, substr(r_name, 1, 2) as state, n_name as "taxRegionName", rate as "estimatedCombinedRate"
               from rate join nation on rate.zip = lpad(cast(n_nationkey as varchar), 5, '0')
               join region on n_regionkey = r_regionkey""",
        ),
        "csv_narrow_sales_tax": _with(["rate"], 'select zip, rate as "taxRate" from rate'),
        "csv_counts_without_lines": _with(
            ["clean_product", "clean_city", "clean_customer", "clean_order"], " union all ".join(counts)
        ),
        "etl_products_repeated_ids": texts["etl_clean_products"],
        "sales_tax_repeated_zip": texts["sales_tax"],
        "price_history_stamped": _with(
            ["price_step"],
            f"""select pid as product_id, seq,
                       strftime(case when seq % 2 = 0 then ts else timestamp '{end} 00:00:00' end, '%Y-%m-%d %H:%M:%S') as ts
                from price_step where old <> price""",
        ),
        "doc_orders_dated_orphans": _doc_orders_dated_orphans(),
        "stream_price_documents": texts["doc_price_history"],
        "changed_lines": _walked("line_feed", _NOW + _NOW_LINE.format(price="product.price")),
        "event_lines": _walked("line_feed", _NOW + _NOW_LINE.format(price=price_then), ["price_feed"]),
        "event_prices": texts["price_history"],
        "stream_event_lines": _walked("line_feed", _NOW + _NOW_LINE.format(price=price_then), ["price_feed"]),
        "stream_event_prices": texts["price_history"],
        "changed_purchases": _walked(
            "line_feed",
            _NOW
            + """
            select cust.id as "customer number", fn, ln, (
                select string_agg(product.id || ' ' || name, '|' order by product.id)
                from (select distinct pid from now join ord on oid = ord.id where cid = cust.id) s
                join product on pid = product.id) as products
            from cust""",
            ["cust"],
        ),
        "null_subtotal_keep": _walked(
            "line_feed",
            f"""
            select o.id, case when m.moved is null then o.subtotal else cast(o.subtotal + m.moved as decimal(18,2)) end
                       as subtotal
            from ordt o left join (
                select oid, cast(sum(({_DELTA}) * product.price) as decimal(18,2)) as moved
                from walk join product on walk.pid = product.id where n > 0 and reason is null group by oid
            ) m on m.oid = o.id""",
            ["ordt"],
        ),
        "deletes_or_fail": _with(
            ["ol"],
            """select oid as order_id, pid as product_id, true as accepted, -q as delta from ol
               where (oid, pid) in (select l_orderkey, l_partkey from lineitem where l_returnflag = 'R')""",
        ),
        "compare_exports": _with(
            ["product", "cust", "city", "sale"],
            """
            select 'cust1.json' as dataset, 'compared' as status, count(*) as common, cast(0 as bigint) as only_left,
                   cast(0 as bigint) as only_right
            from cust join city on cust.zip = city.zip
            union all
            select 'prod.json', 'compared', count(*) filter (where sold), count(*) filter (where not sold),
                   count(*) filter (where not sold)
            from (select id in (select pid from sale) as sold from product)
            union all
            select 'ord.json', 'not found', null, null, null""",
        ),
        "same_ids_from_files": _with(
            ["ord", "ol"],
            """select 'itself' as "case", true as same
               union all
               select 'all', not exists (select * from ord where id not in (select oid from ol))""",
        ),
    }
    questions = ("best_product", "unsold_products", "recall", "fraud")
    return texts | {f"mongo_{name}_docs": texts[f"mongo_{name}"] for name in questions}
