"""Rows that were exploded are sized too low by Spark; they are merged and never broadcast."""

from pyspark.sql import functions as F

from counterfoil.llm import simhash
from counterfoil.session import pin


def classes(spark, n=300):
    """Pairs of fingerprints that differ in two bits."""
    bits = F.xxhash64("id")
    both = F.array(bits, bits.bitwiseXOR(F.lit(5).cast("long")))
    return pin(spark.range(n).select(F.explode(both).alias("bits"), F.col("id").alias("least")))


def joins(df):
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in lines if "Join" in line]


def test_keys_are_merged(spark):
    near = simhash.links(classes(spark))
    assert ["SortMergeJoin" in line for line in joins(near)] == [True]
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    assert [tuple(r) for r in near.agg(F.count("*"), F.max(apart)).collect()] == [(300, 2)]


def test_degrees_are_merged(spark):
    prints = pin(classes(spark).select(F.col("least").alias("doc_id"), "bits"))
    placed = simhash._placed(prints, simhash.MAX_BITS)
    # The outer join with the counted ends of links; the other one is Spark's choice.
    assert ["SortMergeJoin" in line for line in joins(placed) if "LeftOuter" in line] == [True]
    assert [tuple(r) for r in placed.agg(F.count("*"), F.sum("links")).collect()] == [(600, 600)]
