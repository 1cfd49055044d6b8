"""Incremental reads: cursors, closed boundaries, intervals and file times."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_columns, quoted, row_hash
from .keys import drop_right_keys, match_many, sortable

EPOCH = dt.datetime(1970, 1, 1)
# Bounds a custom query gets when the interval is open.
LOWEST_TIME = dt.datetime(1, 1, 1)
HIGHEST_TIME = dt.datetime(9999, 12, 31, 23, 59, 59, 999999)

# How each kind of source reads its interval.
SOURCE_BOUNDS = {
    "sql": "[]",
    "dynamodb": "[]",
    "mongodb": "[)",
    "elasticsearch": "[)",
    "couchbase": "[)",
    "quickbooks": "[)",
    "pinterest": "(]",
    "salesforce": "()",
}


def literal_of(df: DataFrame, column: str, value) -> Column:
    """The bound in the type of the cursor column, so the comparison reaches the scan."""
    if column not in df.columns:
        raise ValueError(f"no cursor column {column!r} in: {', '.join(df.columns)}")
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType) and isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value).cast(kind)


def interval_condition(df: DataFrame, column: str, start=None, end=None, bounds: str = "[]") -> Column:
    """Whether a row is inside the interval; ``bounds`` says which ends belong to it."""
    if bounds not in ("[]", "[)", "(]", "()"):
        raise ValueError(f"bounds must be one of [] [) (] (), got {bounds!r}")
    cursor, inside = F.col(quoted(column)), F.lit(True)
    if start is not None:
        low = literal_of(df, column, start)
        inside = inside & (cursor >= low if bounds[0] == "[" else cursor > low)
    if end is not None:
        high = literal_of(df, column, end)
        inside = inside & (cursor <= high if bounds[1] == "]" else cursor < high)
    return inside


def interval_filter(df: DataFrame, column: str, start=None, end=None, bounds: str = "[]") -> DataFrame:
    """Rows inside the interval."""
    return df.filter(interval_condition(df, column, start, end, bounds))


def with_cursor(df: DataFrame, column: str) -> DataFrame:
    """A row without a cursor value ends the load: it is on no side of any position, so it would be loaded by
    some runs and not by others."""
    cursor = F.col(quoted(column))
    missing = F.raise_error(F.lit(f"a row has no value in the cursor column {column}")).cast(df.schema[column].dataType)
    return df.withColumn(column, F.coalesce(cursor, missing))


def read_incremental(
    df: DataFrame, column: str, last=None, order: str = "asc", reducer: str = "max"
) -> DataFrame:
    """Rows at or beyond the last value.

    With ``max`` and ascending order, or ``min`` and descending order, later means beyond the
    last value in reading direction; otherwise the read goes back from it.
    """
    if order not in ("asc", "desc") or reducer not in ("max", "min"):
        raise ValueError("order is asc or desc, reducer is max or min")
    if last is None:
        return df
    bound = literal_of(df, column, last)
    cursor = F.col(quoted(column))
    return df.filter(cursor >= bound if reducer == "max" else cursor <= bound)


def next_value(df: DataFrame, column: str, reducer: str = "max") -> DataFrame:
    """One row: the position after reading ``df``."""
    fold = F.max if reducer == "max" else F.min
    return df.agg(fold(quoted(column)).alias("last_value"))


def key_hash(df: DataFrame, primary_key: Sequence[str]) -> Column:
    return hash_columns(primary_key) if primary_key else row_hash(df)


def key_hashes(df: DataFrame, column: str, at, primary_key: Sequence[str] = ()) -> DataFrame:
    """The hashes to remember: of the rows holding the highest cursor value, no others."""
    edge = df.filter(F.col(quoted(column)) == literal_of(df, column, at))
    return edge.select(key_hash(df, primary_key).alias("key_hash")).distinct()


def read_after(
    df: DataFrame, column: str, last: Column, seen: DataFrame, primary_key: Sequence[str] = ()
) -> DataFrame:
    """Rows at or after ``last``, leaving out those at ``last`` that were read before.

    Only boundary rows are hashed and joined; both filters reach the scan. Exact copies at the
    boundary share a hash, so the anti join is spread for the one that may be many.
    """
    cursor = F.col(quoted(column))
    later = df.filter(cursor > last)
    edge = df.filter(cursor == last).withColumn("key_hash", key_hash(df, primary_key))
    unseen = match_many(edge, seen, ["key_hash"], "left_anti").drop("key_hash")
    return later.unionByName(unseen)


# Keys that are put in order at once, once the place of the last row is known that closely.
FEW = 10_000


def lowest(df: DataFrame, n: int, column: str | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by cursor and then by ``tiebreak``, as a filter.

    The key of row ``n`` is found by counts: the rows are counted by ranges of the key, the one range that row lies in
    is counted by ranges again, until few keys are left. No task sorts or gets all of the ``n`` rows, however large ``n`` is.
    Of rows equal in all of these columns it takes as many as belong to the ``n``.
    """
    if not column:
        return df.limit(n)
    keys = [column, *[c for c in tiebreak if c != column and isinstance(df.schema[c].dataType, T.AtomicType) and sortable(df.schema[c].dataType)]]
    if n <= 0:
        return df.filter(F.lit(False))
    key = F.struct(*[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(keys)])
    spread = [F.col(f"key.k{i}") for i in range(len(keys))]
    within, rest = df.select(key.alias("key")), n
    total = within.count()
    if total <= n:
        return df
    while total > FEW:
        cut = min(200, 2 + total // FEW)
        ranges = within.repartitionByRange(cut, *spread).groupBy(F.spark_partition_id().alias("range"))
        found = ranges.agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
        before = 0
        # One row a range, in the order of the ranges; sampling may cut them differently each time, which the counts tell.
        for row in sorted(found.collect(), key=lambda r: r["range"]):
            if before + row["n"] >= rest:
                break
            before += row["n"]
        rest -= before
        if row["low"] == row["high"]:
            return _up_to(df, keys, row["low"], rest)
        if rest == row["n"]:
            return df.filter(~_beyond(df, keys, row["high"]))
        within = within.filter(~_beyond_key(within, row["high"]) & ~_before_key(within, row["low"]))
        if row["n"] == total:
            # A key with nearly all rows may leave one range: its rows are counted by themselves.
            below = within.filter(_before_key(within, row["high"]))
            rest_below = below.count()
            if rest > rest_below:
                return _up_to(df, keys, row["high"], rest - rest_below)
            within, total = below, rest_below
        else:
            total = row["n"]
    few = [r["key"] for r in within.sort(*spread).collect()]
    last = few[rest - 1]
    return _up_to(df, keys, last, rest - sum(1 for k in few[: rest - 1] if k != last))


def _up_to(df: DataFrame, keys: Sequence[str], last, more: int) -> DataFrame:
    """Rows before the key ``last``, and ``more`` of those that have it."""
    here = df.filter(~_beyond(df, keys, last) & ~_before(df, keys, last))
    if here.count() > more:
        return df.filter(_before(df, keys, last)).unionByName(here.limit(more))
    return df.filter(~_beyond(df, keys, last))


def _compared(parts: Sequence[tuple[Column, T.DataType]], values: Sequence, later: bool) -> Column:
    """Whether a row's key comes after (or before) ``values``, part by part; nulls come first."""
    out = F.lit(False)
    for (part, kind), value in reversed(list(zip(parts, values))):
        if value is None:
            beyond = part.isNotNull() if later else F.lit(False)
        else:
            bound = F.lit(value).cast(kind)
            beyond = F.coalesce(part > bound, F.lit(False)) if later else part.isNull() | F.coalesce(part < bound, F.lit(False))
        out = beyond | (part.eqNullSafe(F.lit(value).cast(kind)) & out)
    return out


def _beyond(df: DataFrame, keys: Sequence[str], values) -> Column:
    return _compared([(F.col(quoted(k)), df.schema[k].dataType) for k in keys], values, True)


def _before(df: DataFrame, keys: Sequence[str], values) -> Column:
    return _compared([(F.col(quoted(k)), df.schema[k].dataType) for k in keys], values, False)


def _beyond_key(within: DataFrame, values) -> Column:
    return _compared([(F.col(f"key.{f.name}"), f.dataType) for f in within.schema["key"].dataType], values, True)


def _before_key(within: DataFrame, values) -> Column:
    return _compared([(F.col(f"key.{f.name}"), f.dataType) for f in within.schema["key"].dataType], values, False)


def custom_query(spark, query: str, start=None, end=None, limit: int | None = None, **views: DataFrame) -> DataFrame:
    """A query over registered views with ``:interval_start`` and ``:interval_end`` bound.

    An open end becomes the lowest or highest time. Values are bound, never put into the text.
    """
    if limit is not None:
        raise ValueError("a limit belongs into the custom query itself")
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    args = {"interval_start": start or LOWEST_TIME, "interval_end": end or HIGHEST_TIME}
    # Literals without a zone, like the columns they meet, so that the comparison is pushed down.
    typed = {k: F.expr(f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'") for k, v in args.items() if f":{k}" in query}
    return spark.sql(query.removeprefix("query:"), args=typed)


def map_cursor(df: DataFrame, shard: str, sequence: str) -> DataFrame:
    """Highest sequence per shard, as one map. Sequences compare as numbers.

    The map has one entry per shard, which is bounded by the stream's shard count.
    """
    per_shard = df.groupBy(F.col(quoted(shard)).alias("shard")).agg(
        F.max(F.col(quoted(sequence)).cast("decimal(38,0)")).cast("string").alias("seq")
    )
    return per_shard.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("shard", "seq")))).alias("positions")
    )


def typed_csv_cursor(df: DataFrame, column: str, start, kind: str) -> DataFrame:
    """Text rows at or after ``start``, compared in the cursor's own type.

    A cursor that does not parse stays in, so that no row is lost to a bad cell.
    """
    if column not in df.columns:
        raise ValueError(f"no cursor column {column!r}")
    value = F.col(quoted(column)).try_cast(kind)
    return df.filter((value >= F.lit(start).cast(kind)) | value.isNull())


def unvisited(parts: DataFrame, visited: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of a source not fetched before."""
    return drop_right_keys(parts, visited.select(*keys).distinct(), keys, "left_anti")


def lookback(df: DataFrame, column: str, last, days: int = 30) -> DataFrame:
    """Read again from some days before the position, for late corrections."""
    start = literal_of(df, column, last) - F.expr(f"INTERVAL {int(days)} DAYS")
    return df.filter(F.col(quoted(column)) >= start)


def derived_cursor(df: DataFrame, column: str, suffix: str = "_datetime") -> DataFrame:
    """The cursor is the latest of all date-time fields where it is missing itself."""
    sources = [F.col(quoted(c)) for c in df.columns if c.endswith(suffix) and c != column]
    if not sources:
        raise ValueError(f"no column ends with {suffix}")
    latest = F.greatest(*sources) if len(sources) > 1 else sources[0]
    return df.withColumn(column, F.coalesce(F.col(quoted(column)), latest) if column in df.columns else latest)


def compound_cursor(df: DataFrame, id_column: str, time_column: str) -> DataFrame:
    """One row with the id and time of the last row; time orders, the id settles ties."""
    pair = F.struct(F.col(quoted(time_column)).alias("at"), F.col(quoted(id_column)).alias("id"))
    return df.agg(F.max(pair).alias("last")).select(
        F.col("last.id").alias("last_id"), F.col("last.at").alias("last_at")
    )


def cursor_fallback(df: DataFrame, column: str, fallbacks: Sequence[str] = ()) -> DataFrame:
    """A missing or unreadable cursor becomes the epoch, so a filter never loses the row."""
    tries = [F.col(quoted(c)).try_cast("timestamp_ntz") for c in (column, *fallbacks)]
    return df.withColumn(column, F.coalesce(*tries, F.lit(EPOCH).cast("timestamp_ntz")))


def new_files(listing: DataFrame, last_time, seen: DataFrame | None) -> DataFrame:
    """Files changed after the last time, and files at that time not seen yet."""
    if last_time is None:
        return listing
    last = F.lit(last_time).cast("timestamp")
    edge = listing.filter(F.col("modification_date") == last)
    if seen is not None:
        edge = drop_right_keys(edge, seen.select("file_url").distinct(), ["file_url"], "left_anti")
    return listing.filter(F.col("modification_date") > last).unionByName(edge)
