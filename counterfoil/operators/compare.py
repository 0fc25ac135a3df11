"""Comparison of two document sets as multisets, and of two id lists by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.functions.canonical import allow_repeated_keys, canonical_columns, canonical_document
from counterfoil.operators.sequence import BLOCK_ROWS, block_of, sum_before
from counterfoil.session import pin
from counterfoil.sources.documents import read_lines

#: Hexadecimal digits of a digest that make its bucket.
BUCKET_DIGITS = 3


def _sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per distinct key how often it occurs left and right, copies folded before the shuffle."""
    both = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return both.groupBy(key).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))


def _tagged(left: DataFrame, right: DataFrame) -> DataFrame:
    """(digest, bucket, sign) of both sides: 1 left, -1 right. ``left`` and ``right`` have a column ``digest``, in hex."""
    sides = [df.select("digest", F.lit(sign).alias("sign")) for df, sign in ((left, 1), (right, -1))]
    bucket = F.conv(F.substring("digest", 1, BUCKET_DIGITS), 16, 10).cast("int")
    return sides[0].unionAll(sides[1]).withColumn("bucket", bucket)


def _bucket_sums(tagged: DataFrame) -> DataFrame:
    """Per bucket how many digests each side has, and whether their order-free sums differ.

    Two sums of 60 bits of each digest, left less right, are nothing exactly if both sides hold the same digests equally
    often, but for one chance in 2^120. A task sends a row per bucket, however many documents it reads.
    """
    def part(place: int) -> Column:
        return F.sum(F.conv(F.substring("digest", place, 15), 16, 10).cast("decimal(38,0)") * F.col("sign"))

    sums = tagged.groupBy("bucket").agg(
        F.count_if(F.col("sign") > 0).alias("n_left"), F.count_if(F.col("sign") < 0).alias("n_right"),
        part(BUCKET_DIGITS + 1).alias("_a"), part(BUCKET_DIGITS + 16).alias("_b"),
    )
    differ = (F.col("n_left") != F.col("n_right")) | (F.col("_a") != 0) | (F.col("_b") != 0)
    return sums.select("bucket", "n_left", "n_right", differ.alias("differ"))


def _open_digests(tagged: DataFrame, sums: DataFrame) -> DataFrame:
    """Per digest of the buckets that differ how often it occurs left and right; of equal sides no row moves."""
    # One row per bucket at most.
    open_ = F.broadcast(sums.where("differ").select("bucket"))
    return tagged.join(open_, "bucket", "left_semi").groupBy("digest").agg(
        F.count_if(F.col("sign") > 0).alias("n_left"), F.count_if(F.col("sign") < 0).alias("n_right")
    )


def dataset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: documents in common, only left, only right. Both inputs have a text column ``doc``.

    Documents are compared by the SHA-256 of their canonical text. Digests fall into 4,096 buckets; buckets whose counts and
    sums are equal are in common as a whole, and only digests of the others are shuffled and counted.
    """
    allow_repeated_keys(left.sparkSession)
    digests = [df.select(F.sha2(canonical_document("doc"), 256).alias("digest")) for df in (left, right)]
    # Written once: parsed documents are not parsed again for the buckets that differ.
    tagged = pin(_tagged(*digests))
    sums = pin(_bucket_sums(tagged))
    zero = F.lit(0).cast("long")
    equal = sums.where("not differ").select(F.col("n_left").alias("n_left"), F.col("n_right"))
    return _summed(equal.unionAll(_open_digests(tagged, sums).select("n_left", "n_right")), zero)


def typed_diff(left: DataFrame, right: DataFrame, apart: bool = False) -> DataFrame:
    """The same for documents that are still columns, without a JSON text or Python in between.

    ``apart``: digests of the left side are written first, so that disks never hold the shuffles of both sides.
    """
    digests = [df.select(F.sha2(canonical_columns(df), 256).alias("digest")) for df in (left, right)]
    if apart:
        digests[0] = pin(digests[0])
    return _summed(_sides(*digests, "digest"), F.lit(0).cast("long"))


def _summed(counts: DataFrame, zero: Column) -> DataFrame:
    return counts.agg(
        F.coalesce(F.sum(F.least("n_left", "n_right")), zero).alias("common"),
        F.coalesce(F.sum(F.greatest(F.col("n_left") - F.col("n_right"), zero)), zero).alias("only_left"),
        F.coalesce(F.sum(F.greatest(F.col("n_right") - F.col("n_left"), zero)), zero).alias("only_right"),
    )


def compare_folders(
    spark: SparkSession, left: str, right: str, names: Sequence[str], skip: Sequence[str] = ("custom.json",)
) -> DataFrame:
    """One report row per file name; a file missing on a side is reported, not an error."""
    report = None
    for name in names:
        if name in skip:
            continue
        a, b = read_lines(spark, f"{left}/{name}"), read_lines(spark, f"{right}/{name}")
        if a is None or b is None:
            row = spark.range(1).select(
                *[F.lit(None).cast("long").alias(c) for c in ("common", "only_left", "only_right")],
                F.lit("not found").alias("status"),
            )
        else:
            row = dataset_diff(a, b).withColumn("status", F.lit("compared"))
        row = row.select(F.lit(name).alias("dataset"), "status", "common", "only_left", "only_right")
        report = row if report is None else report.unionByName(row)
    return report


def ids_of(docs: DataFrame, key: str = "OrderID") -> DataFrame:
    """The non-NULL ids of a document table, sorted."""
    return docs.select(key).where(F.col(key).isNotNull()).orderBy(key)


def id_positions_missing(left: DataFrame, right: DataFrame, key: str = "OrderID") -> DataFrame:
    """Ids of one side that the other lacks, with their zero-based place in their own sorted list.

    Places come from counts per distinct id and block-wise running sums, three levels deep
    because ids may be any whole numbers; so no task sorts or numbers the whole list. Repeated ids give one row per repetition.
    """
    ids = [df.select(F.col(key).cast("long").alias("id")).where(F.col("id").isNotNull()) for df in (left, right)]
    # Written out, since each level of blocks reads it again.
    counts = pin(_sides(*ids, "id"))
    placed = sum_before(counts, [], "id", {"at_left": "n_left", "at_right": "n_right"}, levels=3)
    side = F.when(F.col("n_right") == 0, F.lit("left")).when(F.col("n_left") == 0, F.lit("right"))
    start = F.when(side == "left", F.col("at_left")).otherwise(F.col("at_right"))
    last = start + F.greatest("n_left", "n_right") - 1
    missing = placed.select(side.alias("side"), "id", start.alias("start"), last.alias("last")).where(
        F.col("side").isNotNull()
    )
    # An id repeated very often is spread by blocks of places before its rows are made.
    blocks = missing.withColumn("block", F.explode(F.sequence(block_of("start"), block_of("last"))))
    first = F.greatest("start", F.col("block") * BLOCK_ROWS)
    until = F.least("last", F.col("block") * BLOCK_ROWS + (BLOCK_ROWS - 1))
    return blocks.repartition("id", "block").select("side", "id", F.explode(F.sequence(first, until)).alias("position"))


def same_ids(left: DataFrame, right: DataFrame, key: str = "OrderID") -> DataFrame:
    """One row: whether both sides hold the same ids equally often, told by the sums of 4,096 buckets alone."""
    digests = [
        df.where(F.col(key).isNotNull()).select(F.sha2(F.col(key).cast("string"), 256).alias("digest")) for df in (left, right)
    ]
    unequal = F.count_if("differ")
    return _bucket_sums(_tagged(*digests)).agg((unequal == 0).alias("same"))
