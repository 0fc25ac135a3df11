"""JSON-lines reading and writing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.session import passing_shuffles

# Null fields are written, and times look like "2024-01-05 10:11:12".
JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}


def as_json(df: DataFrame) -> Column:
    """All columns of ``df`` as one JSON text."""
    return F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]), JSON_OPTIONS)


def write_documents(df: DataFrame, path: str, compression: str = "none") -> None:
    """One document per line; an existing path is left alone and reported. ``read_lines`` reads compressed files as well."""
    with passing_shuffles(df.sparkSession):
        df.write.options(**JSON_OPTIONS).json(path, compression=compression)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**JSON_OPTIONS).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """The raw lines as column ``doc``; None when there is no such path."""
    try:
        return spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("doc"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
