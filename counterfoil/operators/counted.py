"""Both list views kept by counts: what a refresh costs depends on what changed.

Behind a view stand the pairs (owner, member) with the number of order lines of each, and the finished text of every
block of 65,536 member ids of an owner. Changes of lines are changes of counts. A label enters a text when its count
leaves zero and goes when the count is zero again; only blocks where that happens are put together anew, from
their own pairs. Neither lines nor other pairs are read.

Pairs and texts lie in folders by a hash of (owner, block). A refresh reads the folders it touches and replaces those,
by Spark's dynamic partition overwrite, which puts new files in place when all are written. Rows are written where a shuffle
by (owner, block) has put them; no folder is one task. Every pair remembers the number of the last refresh that changed it and its count
before, so a refresh that failed half way is simply run again: what it had done already is not done twice.
One refresh at a time; readers take the folders as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.functions.text import customer_label, product_label
from counterfoil.model import Pos
from counterfoil.operators.gather import text_parts, text_pieces
from counterfoil.operators.sequence import block_of
from counterfoil.operators.views import bought_pairs
from counterfoil.session import pin

FOLDERS = 256


def _buyer_names(pos: Pos) -> DataFrame:
    return pos.customers.select(F.col("id").alias("member"), customer_label().alias("label"))


def _goods_names(pos: Pos) -> DataFrame:
    return pos.products.select(F.col("id").alias("member"), product_label().alias("label"))


@dataclass(frozen=True)
class View:
    """Whose lists these are, what stands in them, and how it is written."""

    name: str
    owner: str
    member: str
    separator: str
    labels: Callable[[Pos], DataFrame]
    distinct: bool = True


BUYERS = View("product_buyers", "product_id", "customer_id", ",", _buyer_names)
ALL_BUYERS = View("product_buyers_all", "product_id", "customer_id", ",", _buyer_names, distinct=False)
PURCHASES = View("customer_purchases", "customer_id", "product_id", "|", _goods_names)
ALL_PURCHASES = View("customer_purchases_all", "customer_id", "product_id", "|", _goods_names, distinct=False)


def changed_pairs(accepted: DataFrame, orders: DataFrame) -> DataFrame:
    """(product_id, customer_id, change): lines more or fewer of each pair after accepted changes."""
    sign = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    lines = accepted.groupBy("order_id", "product_id").agg(F.sum(sign).alias("change")).where("change <> 0")
    buyers = orders.select(F.col("id").alias("order_id"), "customer_id")
    return lines.join(buyers, "order_id").groupBy("product_id", "customer_id").agg(F.sum("change").alias("change")).where(
        "change <> 0"
    )


def _folder(folders: int) -> Column:
    # The hash that a shuffle by (owner, part) goes by: with a multiple of the folders as partitions, each has rows of one.
    return F.pmod(F.hash("owner", "part"), F.lit(folders)).cast("int").alias("folder")


def _of_view(pairs: DataFrame, view: View, count: str) -> DataFrame:
    return pairs.select(
        F.col(view.owner).alias("owner"), F.col(view.member).alias("member"), block_of(view.member).alias("part"),
        F.col(count).cast("long").alias(count),
    )


class CountedView:
    """A view below ``root``; ``folders`` is fixed when it is created."""

    def __init__(self, spark: SparkSession, root: str, view: View, folders: int = FOLDERS):
        self.spark, self.view, self.folders = spark, view, folders
        self.root = f"{root.rstrip('/')}/{view.name}"

    def create(self, pos: Pos) -> "CountedView":
        """Count all lines once."""
        counted = _of_view(bought_pairs(pos), self.view, "copies")
        rows = counted.select("*", F.lit(0).cast("long").alias("was"), F.lit(-1).cast("long").alias("refresh"), _folder(self.folders))
        self._write(rows.repartition("owner", "part"), "pairs")
        self._write(self._texts(self._read("pairs"), pos), "texts")
        return self

    def _write(self, rows: DataFrame, name: str) -> None:
        """Replace the folders that ``rows``, together by (owner, part), has rows of; these may come from the same folders."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "folder"
        ).parquet(f"{self.root}/{name}")

    def _read(self, name: str, folders: list[int] | None = None) -> DataFrame:
        kept = {"pairs": "member long, part long, copies long, was long, refresh long", "texts": "part long, piece long, text string"}
        rows = self.spark.read.schema(f"owner long, {kept[name]}, folder int").parquet(f"{self.root}/{name}")
        return rows if folders is None else rows.where(F.col("folder").isin(folders))

    def _texts(self, pairs: DataFrame, pos: Pos) -> DataFrame:
        """The finished texts of the blocks of ``pairs``."""
        named, by = pairs.where("copies > 0").select("owner", "member", "copies"), ["owner"]
        if self.view.distinct:
            labelled = named.join(self.view.labels(pos), "member")
            texts = text_parts(labelled, by, "member", "label", self.view.separator).withColumn("piece", F.lit(0).cast("long"))
        else:
            texts = text_pieces(named, by, "member", self.view.labels(pos), "label", self.view.separator, "copies")
        return texts.select("owner", "part", "piece", "text", _folder(self.folders))

    def refresh(self, changes: DataFrame, number: int, pos: Pos) -> None:
        """Apply ``changes`` (``changed_pairs``) as refresh ``number``, which is larger than that of any earlier one.

        ``pos`` is asked for names only.
        """
        given = pin(_of_view(changes, self.view, "change"))
        touched = sorted(r["folder"] for r in given.select(_folder(self.folders)).distinct().collect())
        if not touched:
            return
        kept = ["copies", "was", "refresh"]
        none = F.lit(None).cast("long")
        old = self._read("pairs", touched).select("owner", "part", "member", *kept, none.alias("change"))
        both = old.unionByName(given.select("owner", "part", "member", *[none.alias(c) for c in kept], "change"))
        # A pair has one row of either kind at most.
        pairs = both.repartition("owner", "part").groupBy("owner", "part", "member").agg(
            *[F.max(c).alias(c) for c in (*kept, "change")]
        )
        due = F.col("change").isNotNull() & (F.coalesce("refresh", F.lit(-1)) < number)
        count = F.coalesce("copies", F.lit(0).cast("long"))
        self._write(
            pairs.select(
                "owner", "member", "part",
                F.when(due, count + F.col("change")).otherwise(count).alias("copies"),
                F.when(due, count).otherwise(F.col("was")).alias("was"),
                F.when(due, F.lit(number)).otherwise(F.col("refresh")).cast("long").alias("refresh"),
                _folder(self.folders),
            ),
            "pairs",
        )
        pairs = self._read("pairs", touched)
        now = F.col("refresh") == number
        entered = (F.col("was") > 0) != (F.col("copies") > 0) if self.view.distinct else F.col("was") != F.col("copies")
        blocks = pin(pairs.where(now & entered).select("folder", "owner", "part").distinct())
        anew = self._texts(pairs.join(blocks, ["folder", "owner", "part"], "left_semi").select(*pairs.columns), pos)
        others = self._read("texts", touched).join(blocks, ["folder", "owner", "part"], "left_anti")
        texts = others.select("owner", "part", "piece", "text", "folder").unionByName(anew)
        # A folder whose last text went would not be replaced; an empty text keeps its place.
        marks = blocks.select("owner", "part", F.lit(-1).cast("long").alias("piece"), F.lit(None).cast("string").alias("text"), "folder")
        self._write(texts.unionByName(marks), "texts")

    def texts(self) -> DataFrame:
        """(owner, part, piece, text) of all blocks that have members."""
        return self._read("texts").where("text is not null").drop("folder")

    def lists(self) -> DataFrame:
        """(owner, text): the whole list of each owner in one value."""
        pieces = F.sort_array(F.collect_list(F.struct("part", "piece", "text")))
        joined = F.array_join(F.transform(pieces, lambda p: p["text"]), self.view.separator)
        return self.texts().groupBy("owner").agg(joined.alias("text"))


def buyers_of(view: CountedView, pos: Pos) -> DataFrame:
    """``views.product_buyers`` from the counted view."""
    lists = view.lists().select(F.col("owner").alias("productID"), F.col("text").alias("customers"))
    return pos.products.select(F.col("id").alias("productID"), F.col("name").alias("productName")).join(lists, "productID", "left")


def purchases_of(view: CountedView, pos: Pos) -> DataFrame:
    """``views.customer_purchases`` from the counted view."""
    lists = view.lists().select(F.col("owner").alias("customer number"), F.col("text").alias("products"))
    return pos.customers.select(
        F.col("id").alias("customer number"), F.col("firstName").alias("fn"), F.col("lastName").alias("ln")
    ).join(lists, "customer number", "left")
