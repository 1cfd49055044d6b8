"""Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .listing import require_files


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Files of possibly different columns. A known schema saves opening every footer."""
    if not require_files(spark, path):
        return spark.createDataFrame([], schema or T.StructType([]))
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    return reader.parquet(path)
