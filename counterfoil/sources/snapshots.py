"""Materialized tables: every refresh is a new version, readers take the newest complete one."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

_DONE = "_SUCCESS"
_VERSION = re.compile(r"version-(\d+)-")


def _path(spark: SparkSession, text: str) -> JavaObject:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, text: str):
    path = _path(spark, text)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, text: str) -> bool:
    path, files = _files(spark, text)
    return files.exists(path)


def touch(spark: SparkSession, text: str) -> None:
    path, files = _files(spark, text)
    files.create(path, True).close()


def subfolders(spark: SparkSession, text: str) -> list[str]:
    path, files = _files(spark, text)
    if not files.exists(path):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory())


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the complete versions, oldest first."""
    return [name for name in _numbered(spark, root) if exists(spark, f"{root}/{name}/{_DONE}")]


def _numbered(spark: SparkSession, root: str) -> list[str]:
    """Folders that are versions, in their order; others are not looked at."""
    return [name for name in subfolders(spark, root) if _VERSION.match(name)]


def materialize(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as the next version below ``root`` and return its path.

    ``partition_by`` splits it into folders by value, for example orders by year, which
    date ranges can then skip. The version being read is never overwritten, and a half-written one, which has no
    success mark, is never read.
    """
    spark = df.sparkSession
    number = max((int(_VERSION.match(name)[1]) for name in _numbered(spark, root)), default=0) + 1
    # Of two refreshes that take one number at once, the one that began later counts.
    path = f"{root}/version-{number:09d}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def latest(spark: SparkSession, root: str) -> DataFrame:
    names = versions(spark, root)
    if not names:
        raise FileNotFoundError(f"no complete version below {root}")
    return spark.read.parquet(f"{root}/{names[-1]}")
