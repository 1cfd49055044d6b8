"""Reading a partitioned log by positions that are committed with the rows they stand for.

A log is a frame of messages with a partition (or shard) and a number that grows within it. A position is the last number read
of a partition; all positions of a table are in its head, one for each partition, of which a broker keeps some
thousands at most. Each slice is a filter: nothing is sorted, and no partition, however full, is one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import quoted
from ..operators.keys import drop_right_keys
from ..sinks.tables import SnapshotTable


def numbered(messages: DataFrame, partition: str, number: str) -> DataFrame:
    """The messages with their partition as text and their number as ``__p`` and ``__n``."""
    return messages.withColumns({"__p": F.col(quoted(partition)).cast("string"), "__n": F.col(quoted(number)).cast("decimal(38,0)")})


def positions_at(messages: DataFrame, partition: str, number: str, time: str, at) -> dict[str, str]:
    """Positions from which the first message at or after ``at`` comes next; where there is none, the last message does."""
    late = F.col(quoted(time)) >= F.lit(at).cast(messages.schema[time].dataType)
    starts = numbered(messages, partition, number).groupBy("__p").agg(F.coalesce(F.min(F.when(late, F.col("__n"))), F.max("__n")).alias("first"))
    return {r["__p"]: str(r["first"] - 1) for r in starts.collect()}


def next_slice(
    messages: DataFrame, positions: Mapping[str, str], partition: str, number: str, most: int, parents: Mapping[str, str] = {}
) -> tuple[DataFrame, dict[str, str]]:
    """The next messages of each partition, about ``most`` of them at a time, and the positions after them.

    A partition that came from another by a split (``parents``: child to parent) is read once the other one is.
    """
    spark = messages.sparkSession
    done = spark.createDataFrame([(p, n) for p, n in positions.items()], "partition string, position string")
    done = done.select("partition", F.col("position").cast("decimal(38,0)").alias("position"))
    rows = numbered(messages, partition, number)
    ahead = drop_right_keys(rows, done.withColumnRenamed("partition", "__p"), ["__p"], "left").filter("position IS NULL OR __n > position")
    left = ahead.groupBy("__p").agg(F.count(F.lit(1)).alias("n"), F.max("__n").alias("last"), F.min("__n").alias("first"))
    found = {r["__p"]: r for r in left.collect()}
    waiting = {child for child, parent in parents.items() if parent in found}
    ready = {p: r for p, r in found.items() if p not in waiting}
    ends = {p: r["last"] for p, r in ready.items() if r["n"] <= most}
    large = {p: r for p, r in ready.items() if p not in ends}
    if large:
        shares = sorted({min(1.0, most / r["n"]) for r in large.values()})
        firsts = spark.createDataFrame([(p, str(r["first"])) for p, r in large.items()], "__p string, first string")
        firsts = firsts.select("__p", F.col("first").cast("decimal(38,0)").alias("first"))
        # An approximate place is near enough for the size of a slice; it is brought to one that gets on. Numbers count from the
        # partition's first, as they may be larger than a double tells apart.
        beyond = (F.col("__n") - F.col("first")).cast("double")
        cuts = drop_right_keys(ahead, firsts, ["__p"], "inner").groupBy("__p").agg(
            F.percentile_approx(beyond, F.array(*map(F.lit, shares)), F.lit(10_000)).alias("at")
        )
        for row in cuts.collect():
            r = large[row["__p"]]
            ends[row["__p"]] = min(r["first"] + int(row["at"][shares.index(min(1.0, most / r["n"]))]), r["last"])
    bounds = spark.createDataFrame([(p, str(n)) for p, n in ends.items()], "__p string, `end` string")
    bounds = bounds.select("__p", F.col("end").cast("decimal(38,0)").alias("end"))
    slice_ = drop_right_keys(ahead, bounds, ["__p"], "inner").filter("__n <= `end`").select(*[quoted(c) for c in messages.columns])
    return slice_, {**positions, **{p: str(n) for p, n in ends.items()}}


def drain_log(
    table: SnapshotTable,
    messages: Callable[[], DataFrame],
    partition: str,
    number: str,
    most: int,
    start: Mapping[str, str] | None = None,
    parents: Mapping[str, str] = {},
    slices: int | None = None,
) -> int:
    """Read a log from the table's positions (at first from ``start``) to its end, slice by slice; the number of slices.

    Rows and positions of a slice are one commit, so a drain that dies goes on after its last slice. ``slices`` ends it early.
    """
    count = 0
    while slices is None or count < slices:
        head = table.begin()
        positions = head.get("positions")
        rows, after = next_slice(messages(), (start or {}) if positions is None else positions, partition, number, most, parents)
        if after == (positions if positions is not None else dict(start or {})):
            break
        table.append(rows, f"slice-{head['version'] + 1}", positions=after)
        count += 1
    return count
