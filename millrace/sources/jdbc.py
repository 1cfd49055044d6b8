"""Whole tables and queries over JDBC. The driver jar comes with the session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PAGE_SIZE = 50_000


def jdbc_options(url: str, table: str | None, query: str | None, fetch_size: int = PAGE_SIZE, **more: str) -> dict:
    if (table is None) == (query is None):
        raise ValueError("name a table or give a query")
    named = {"dbtable": table} if table else {"query": query}
    return {"url": url, "fetchsize": str(fetch_size), **named, **more}


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str] = (),
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A table in parallel: by predicates from a table of ranges, or by a column and its bounds.

    Filters, columns and limits applied to the result are pushed to the database.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties={"fetchsize": str(PAGE_SIZE), **options})
    chosen = jdbc_options(url, table, None, **options)
    if partition_column and bounds:
        chosen.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return spark.read.format("jdbc").options(**chosen).load()


def scan_jdbc_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, None, query, **options)).load()
