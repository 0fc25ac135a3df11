"""Key, reference, NULL and length checks, and the keyed upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; a NULL in a key counts as a violation."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where((F.col("n") > 1) | has_null)


def fk_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Child rows whose key names no parent; a NULL key is allowed."""
    known = parent.select(F.col(parent_key).alias(key))
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti").select(*child.columns)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: per column the number of NULLs."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """One row: per text column the number of values longer than allowed."""
    return df.agg(*[F.count_if(F.length(c) > limit).alias(c) for c, limit in limits.items()])


def unparsed_counts(raw: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """One row: per raw column how many non-blank texts the given expression could not read."""
    return raw.agg(
        *[F.count_if((F.trim(c) != "") & value.isNull()).alias(c) for c, value in parsed.items()]
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """``target`` with the rows of ``source`` put in, replacing those of equal keys.

    The source's columns, NULLs included, replace the target's; of several source rows
    with one key the last by ``order_col`` counts.
    """
    keys = list(keys)
    values = [c for c in source.columns if c in target.columns and c not in keys]
    newest = source.groupBy(*keys).agg(F.max_by(F.struct(*values), order_col).alias("_new"))
    put = F.col("_new").isNotNull()
    replaced = target.join(newest, keys, "left").select(
        *[
            F.when(put, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )
    # The target is cut down to the source's keys before it is asked what is missing.
    present = target.select(*keys).join(newest.select(*keys), keys, "left_semi")
    added = newest.join(present, keys, "left_anti").select(*keys, *[F.col("_new")[c].alias(c) for c in values])
    return replaced.unionByName(added, allowMissingColumns=True)
