"""Streams of order-line and price changes.

A stream decides each event with what Spark's state store holds of its product and appends it, with the outcome, to a
log: Parquet that Spark's file sink writes, each batch once. Batch identity, restart and state are Spark's own; the log
lies beside the checkpoint in one folder, so neither can be used with the other of another stream.

    <root>/log           every event once, with accepted, reason and what it does
    <root>/checkpoint    Spark's

``settled`` applies the accepted events of a log to the tables that the stream started from, as one batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from counterfoil.model import EVENT, LINE_CHANGE, PRICE, PRICE_CHANGE, Pos
from counterfoil.operators import changes as ch
from counterfoil.operators.prices import logged
from counterfoil.sources.snapshots import exists
from counterfoil.streaming.keyed import LATE, LOG, SET_PRICE, ProductState  # noqa: F401

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Events without product need no state; they are spread over so many keys.
SPREAD = 1024


def read_changes(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder of JSON-lines change files as a stream."""
    options = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
    return spark.readStream.schema(schema).options(**options).json(path)


def line_change_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return read_changes(spark, path, LINE_CHANGE, files_per_batch)


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return read_changes(spark, path, EVENT, files_per_batch)


def price_change_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return read_changes(spark, path, PRICE_CHANGE, files_per_batch)


def _as_events(source: DataFrame) -> DataFrame:
    """Line changes, price changes or events, as events."""
    only_prices = "op" not in source.columns
    given = {c: F.col(c) for c in source.columns} | ({"op": F.lit(SET_PRICE)} if only_prices else {})
    return source.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT.fields])


def decide(source: DataFrame, pos: Pos, check_orders: bool = True) -> DataFrame:
    """The stream ``source`` with the outcome of every event (``keyed.LOG``).

    ``pos`` holds the tables as they are before the first event; they must not change while the stream lives. Products,
    lines and orders are looked up per micro-batch; what the stream changed itself is in the state, which knows only
    products that had events. Of rows with one product id the least by price and stock counts.
    """
    line = F.col("op") != SET_PRICE
    moved = (F.col("op") == "update") & (
        F.coalesce(F.col("new_order_id") != F.col("order_id"), F.lit(False))
        | F.coalesce(F.col("new_product_id") != F.col("product_id"), F.lit(False))
    )
    quantity = F.when(line & (F.col("op") != "delete"), ch.clamp_quantity(F.col("quantity"))).cast("int")
    events = _as_events(source).select(
        "op", "seq", "order_id", "product_id", quantity.alias("quantity"), F.coalesce(moved, F.lit(False)).alias("moved"),
        "price", F.when(~line, F.coalesce("ts", F.current_timestamp())).alias("ts"),
    )
    held = pos.lines.select(
        "order_id", "product_id", F.col("quantity").alias("held"), F.col("unitPrice").cast(PRICE).alias("held_price"),
        F.lit(True).alias("has_line"),
    )
    events = events.join(held, ["order_id", "product_id"], "left")
    if check_orders:
        orders = pos.orders.select(F.col("id").alias("order_id"), F.lit(True).alias("known_order")).distinct()
        events = events.join(orders, "order_id", "left")
    else:
        events = events.withColumn("known_order", F.lit(True))
    goods = pos.products.select(
        F.col("id").alias("product_id"), F.col("currentPrice").cast(PRICE).alias("start_price"),
        F.col("availableQuantity").cast("int").alias("start_stock"),
    )
    goods = goods.groupBy("product_id").agg(F.min(F.struct("start_price", "start_stock")).alias("start"))
    goods = goods.select("product_id", "start.*", F.lit(True).alias("known_product"))
    events = events.join(goods, "product_id", "left")
    keyless = F.col("product_id").isNull()
    spread = F.pmod(F.xxhash64("order_id", "seq"), F.lit(SPREAD))
    keyed = events.withColumn("keyless", keyless).withColumn("key", F.coalesce("product_id", spread))
    return keyed.groupBy("keyless", "key").transformWithState(
        ProductState(), T.StructType.fromDDL(LOG), "Append", "None"
    )


def start(source: DataFrame, pos: Pos, root: str, once: bool = False, check_orders: bool = True) -> StreamingQuery:
    """Decide a stream of line changes, price changes or events (``model.EVENT``) into the log at ``root``.

    Line and price changes of one stream share one numbering: a line is inserted at the price of the moment.
    """
    root = root.rstrip("/")
    source.sparkSession.conf.set(_STORE, _ROCKSDB)
    writer = (
        decide(source, pos, check_orders)
        .writeStream.format("parquet")
        .option("path", f"{root}/log")
        .option("checkpointLocation", f"{root}/checkpoint")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def log(spark: SparkSession, root: str) -> DataFrame:
    """All events of finished batches; none before the first."""
    path = f"{root.rstrip('/')}/log"
    if not exists(spark, f"{path}/_spark_metadata"):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(path)


def decisions(entries: DataFrame) -> DataFrame:
    """The line changes of a log."""
    return entries.where(F.col("op").isNull() | (F.col("op") != SET_PRICE))


def rejected(entries: DataFrame) -> DataFrame:
    return entries.where(~F.col("accepted")).select("op", "seq", "order_id", "product_id", "quantity", "price", "reason")


def price_log(entries: DataFrame, log_unchanged: bool = False) -> DataFrame:
    """The price history rows of a log."""
    steps = entries.where((F.col("op") == SET_PRICE) & F.col("accepted"))
    return logged(
        steps.select("product_id", F.col("old_price").alias("oldPrice"), F.col("price").alias("newPrice"), "ts", "seq"),
        log_unchanged,
    )


def settled(pos: Pos, entries: DataFrame, log_unchanged: bool = False) -> tuple[Pos, ch.Touched]:
    """The tables that a stream started from, after all events of its log; and the keys that were touched."""
    after, touched = ch.apply_changes(pos, decisions(entries).where("accepted"))
    sets = entries.where((F.col("op") == SET_PRICE) & F.col("accepted"))
    last = sets.groupBy(F.col("product_id").alias("id")).agg(F.max_by(F.struct("price"), "seq").alias("_last"))
    price = F.when(F.col("_last").isNotNull(), F.col("_last.price")).otherwise(F.col("currentPrice")).cast(PRICE)
    products = after.products.join(last, "id", "left").select(
        *[price.alias(c) if c == "currentPrice" else F.col(c) for c in after.products.columns]
    )
    history = pos.price_history.unionByName(price_log(entries, log_unchanged).select(*pos.price_history.columns))
    return after.with_(products=products, price_history=history), touched
