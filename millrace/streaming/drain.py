"""Bounded drains: read a stream up to its end as of now, apply, commit, then move the position."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import maintenance
from ..operators.keys import dedup_by_key
from ..sinks.tables import SnapshotTable

Apply = Callable[[DataFrame, int], None]


def drain(stream: DataFrame, apply: Apply, checkpoint: str) -> None:
    """Run until the end offset seen at the start, slice by slice, then stop.

    The checkpoint moves past a slice after ``apply`` has returned for it. If ``apply`` fails,
    the same slice with the same number comes again on the next run.
    """
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def drain_to_files(stream: DataFrame, path: str, checkpoint: str, *partition_by: str) -> None:
    """Straight into files, which the file sink writes exactly once."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start().awaitTermination()


def merge_into(table: SnapshotTable, key: str, order_by: str | None = None, on_commit=None, parts: int = 0) -> Apply:
    """Upsert each slice by message id, idempotent by slice number.

    A slice is added as files of its own, a few rows or many, and merged level by level (``SnapshotTable.upsert``).
    Of the messages with one id the highest ``order_by`` counts, in whichever slice it came; without it, the
    last slice. A slice that was committed before the checkpoint moved is known by its number in the table's
    head and is not applied again.
    """

    def apply(slice_: DataFrame, number: int) -> None:
        head = table.begin()
        if number > head.get("slice", -1):
            rows = dedup_by_key(slice_, [key], [order_by] if order_by else [])
            table.upsert(rows, key, number, order_by, parts)
        if on_commit:
            on_commit(number)

    return apply


def insert_new(table: SnapshotTable, key: str, on_commit=None) -> Apply:
    """T15 where a redelivered message never differs: only unseen ids are added.

    Files already in the table stay as they are, so a slice writes what it brings; it reads the ids
    of the table.
    """

    def apply(slice_: DataFrame, number: int) -> None:
        load_id = f"slice-{number}"
        if number > table.begin().get("slice", -1):
            rows = dedup_by_key(slice_, [key])
            if table.exists():
                rows = maintenance.drop_right_keys(rows, table.read().select(key), [key], "left_anti")
            table.append(rows, load_id, slice_=number)
        if on_commit:
            on_commit(number)

    return apply


def dedup_stream(stream: DataFrame, key: str, time: str, horizon: str) -> DataFrame:
    """T15 inside the stream: one message per id within the horizon; state is kept that long only."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, horizon)
    return timed.dropDuplicatesWithinWatermark([key])
