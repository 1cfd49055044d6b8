"""File writers: datasets, routes, partitions, clustering and export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted
from ..operators.maintenance import strip_lineage

EXPORT_FORMATS = ("csv", "jsonl", "parquet")


def gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together before a partitioned write.

    Without it every task writes a file to every partition it meets. Adaptive execution cuts
    partitions that are too large into several tasks, so one that holds most rows is still
    written by many, and joins small ones.
    """
    return df.hint("rebalance", *[F.col(quoted(c)) for c in columns]) if columns else df


def write_dataset(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    rows_per_file: int | None = None,
    layout: Sequence[str] = (),
    mode: str = "append",
    **settings: str,
) -> None:
    """A directory of files, settings handed through to the writer."""
    writer = gathered(df, layout).write.format("json" if format == "jsonl" else format).mode(mode)
    writer = writer.option("maxRecordsPerFile", rows_per_file or 0).options(**settings)
    if layout:
        writer = writer.partitionBy(*layout)
    writer.save(path)


def route_tables(df: DataFrame, route: str, path: str, format: str = "parquet", mode: str = "append") -> None:
    """One stream into many tables, in one pass.

    Table ``x`` is the directory ``_route=x``. A later batch is added to the tables.
    """
    routed = df.withColumn("_route", F.col(quoted(route)))
    gathered(routed, ["_route"]).write.format(format).mode(mode).partitionBy("_route").save(path)


def day_column(df: DataFrame, column: str) -> tuple[DataFrame, str]:
    """A date or timestamp column partitions by day, any other by its value."""
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        name = f"{column}_day"
        return df.withColumn(name, F.to_date(quoted(column))), name
    return df, column


def write_partitioned(df: DataFrame, column: str, path: str, format: str = "parquet", mode: str = "append") -> None:
    """Partition hint. A later batch is added."""
    frame, by = day_column(df, column)
    gathered(frame, [by]).write.format(format).mode(mode).partitionBy(by).save(path)


def cluster_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with near keys in the same file, sorted, so that Parquet statistics prune.

    The hash of the whole row comes last in the range key: a value holding a large share of the
    rows is cut into several ranges.
    """
    spread = F.xxhash64(*[F.col(quoted(c)) for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)])
    keyed = df.withColumn("__spread", spread)
    keys = [F.col(quoted(c)) for c in columns]
    return keyed.repartitionByRange(*keys, F.col("__spread")).sortWithinPartitions(*keys).drop("__spread")


def write_bucketed(df: DataFrame, name: str, columns: Sequence[str], buckets: int) -> None:
    """Bucketed catalogue table, for joins on the same key without a shuffle."""
    df.write.bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(name)


def union_columns(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, columns in first-seen order, absent ones null."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def export_format(path: str, hint: str | None) -> str:
    if any(c in path for c in "*?["):
        raise ValueError(f"an export path must not hold a glob: {path}")
    format = hint or path.rsplit(".", 1)[-1].lower()
    if format not in EXPORT_FORMATS:
        raise ValueError(f"unknown export format {format!r}; known: {', '.join(EXPORT_FORMATS)}")
    return format


def export(df: DataFrame, path: str, format: str | None = None, others: Sequence[DataFrame] = ()) -> None:
    """CSV, JSON lines or Parquet for other programs, a directory of files. Lineage is left out."""
    format = export_format(path, format)
    frame = union_columns([strip_lineage(f) for f in (df, *others)])
    if format == "csv":
        nested = (T.ArrayType, T.StructType, T.MapType)
        frame = frame.withColumns(
            {f.name: F.to_json(quoted(f.name)) for f in frame.schema.fields if isinstance(f.dataType, nested)}
        )
    writer = frame.write.format("json" if format == "jsonl" else format)
    if format == "csv":
        writer = writer.option("header", True).option("emptyValue", "").option("escape", '"')
    writer.save(path)
