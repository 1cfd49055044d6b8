"""Tables of ranges that cut a pull into parallel pieces."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Years that part sparse, medium and dense history.
MEDIUM_FROM = dt.datetime(2015, 1, 1)
DENSE_FROM = dt.datetime(2020, 1, 1)


def equal_chunks(bounds: DataFrame, n: int) -> DataFrame:
    """Cut each ``[start_ts, end_ts)`` in whole seconds into at most ``n`` equal parts."""
    step = F.ceil((F.col("end_ts") - F.col("start_ts")) / F.lit(n)).cast("long")
    starts = F.sequence(F.col("start_ts"), F.col("end_ts") - 1, F.col("step"))
    return (
        bounds.filter("start_ts < end_ts")
        .withColumn("step", step)
        .select("step", "end_ts", F.explode(starts).alias("chunk_start"))
        .select("chunk_start", F.least(F.col("chunk_start") + F.col("step"), "end_ts").alias("chunk_end"))
    )


def by_step(bounds: DataFrame, step: str) -> DataFrame:
    """Ranges of one ``step`` from ``start_at``, the last one capped at ``end_at``."""
    starts = F.sequence(F.col("start_at"), F.col("end_at"), F.expr(f"INTERVAL {step}"))
    return (
        bounds.select("end_at", F.explode(starts).alias("chunk_start"))
        .filter("chunk_start < end_at")
        .select("chunk_start", F.least(F.col("chunk_start") + F.expr(f"INTERVAL {step}"), "end_at").alias("chunk_end"))
    )


def hourly_aligned(bounds: DataFrame) -> DataFrame:
    """Ranges that end on full hours."""
    hours = F.sequence(F.date_trunc("hour", "start_at"), F.col("end_at"), F.expr("INTERVAL 1 HOUR"))
    return (
        bounds.select("start_at", "end_at", F.explode(hours).alias("hour"))
        .filter("hour < end_at")
        .select(
            F.greatest("hour", "start_at").cast("timestamp_ntz").alias("chunk_start"),
            F.least(F.col("hour") + F.expr("INTERVAL 1 HOUR"), "end_at").cast("timestamp_ntz").alias("chunk_end"),
        )
    )


def daily_or_hourly(bounds: DataFrame) -> DataFrame:
    """Daily ranges; hourly ones where the whole interval is shorter than two days."""
    short = F.expr("end_at - start_at < INTERVAL 2 DAYS")
    return by_step(bounds.filter(short), "1 HOUR").unionByName(by_step(bounds.filter(~short), "1 DAY"))


def gap_by_day(bounds: DataFrame, days: int) -> DataFrame:
    """Closed ranges of ``days``; the next starts one day after the last ended."""
    starts = F.sequence(F.col("start_at"), F.col("end_at"), F.expr(f"INTERVAL {int(days) + 1} DAYS"))
    return bounds.select("end_at", F.explode(starts).alias("chunk_start")).select(
        "chunk_start", F.least(F.col("chunk_start") + F.expr(f"INTERVAL {int(days)} DAYS"), "end_at").alias("chunk_end")
    )


def month_aligned(bounds: DataFrame) -> DataFrame:
    """From the start, then from the first of each month, to the last day of the month."""
    months = F.sequence(F.trunc("start_at", "month"), F.to_date("end_at"), F.expr("INTERVAL 1 MONTH"))
    return (
        bounds.select("start_at", "end_at", F.explode(months).alias("month"))
        .select(
            F.greatest(F.col("month").cast("timestamp_ntz"), "start_at").alias("chunk_start"),
            F.least(F.last_day("month").cast("timestamp_ntz"), "end_at").alias("chunk_end"),
            "end_at",
        )
        .filter("chunk_start < end_at")
        .drop("end_at")
    )


def calendar_ranges(bounds: DataFrame, months: int) -> DataFrame:
    """Closed date ranges of some months (6 for daily reports, 24 for coarser ones), a day apart, from ``start_at`` to ``end_at``.

    Each range starts the day after the one before ended, so they are stepped within the row of their bounds.
    """
    start, end = F.to_date("start_at"), F.to_date("end_at")
    wrong = F.raise_error(F.lit("start must not lie after end")).cast("date")
    known = bounds.select(F.when(start <= end, start).otherwise(wrong).alias("start"), end.alias("end"))

    def from_(first: Column) -> Column:
        return F.struct(first.alias("chunk_start"), F.least(F.add_months(first, months), F.col("end")).alias("chunk_end"))

    # More steps than there are ranges; those beyond the end add nothing.
    steps = F.sequence(F.lit(1), F.floor(F.months_between("end", "start") / months).cast("int") + 1)

    def stepped(done: Column, step: Column) -> Column:
        following = F.date_add(F.element_at(done, -1)["chunk_end"], 1)
        return F.when(following <= F.col("end"), F.concat(done, F.array(from_(following)))).otherwise(done)

    ranges = F.aggregate(steps, F.array(from_(F.col("start"))), stepped)
    return known.select(F.explode(ranges).alias("r")).select("r.*")


def adaptive_chunks(bounds: DataFrame, workers: int) -> DataFrame:
    """Large ranges for old, sparse years, half years for the middle, days for the dense rest."""

    def between(low: dt.datetime | None, high: dt.datetime | None) -> DataFrame:
        start, end = F.col("start_at"), F.col("end_at")
        if low:
            start = F.greatest(start, F.lit(low).cast("timestamp_ntz"))
        if high:
            end = F.least(end, F.lit(high).cast("timestamp_ntz"))
        return bounds.select(start.alias("start_at"), end.alias("end_at")).filter("start_at < end_at")

    def seconds(df: DataFrame) -> DataFrame:
        second = "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {})"
        return df.selectExpr(f"{second.format('start_at')} start_ts", f"{second.format('end_at')} end_ts")

    def times(df: DataFrame) -> DataFrame:
        at = "CAST(timestamp_seconds({}) AS TIMESTAMP_NTZ)"
        return df.selectExpr(f"{at.format('chunk_start')} chunk_start", f"{at.format('chunk_end')} chunk_end")

    old = times(equal_chunks(seconds(between(None, MEDIUM_FROM)), min(3, workers)))
    halves = F.least(
        F.lit(workers),
        F.greatest(F.lit(2), F.floor((F.col("end_ts") - F.col("start_ts")) / F.lit(365 * 86400) * 2).cast("int")),
    )
    middle = seconds(between(MEDIUM_FROM, DENSE_FROM)).withColumn("n", halves)
    step = F.ceil((F.col("end_ts") - F.col("start_ts")) / F.col("n")).cast("long")
    middle = (
        middle.withColumn("step", step)
        .select("step", "end_ts", F.explode(F.sequence(F.col("start_ts"), F.col("end_ts") - 1, F.col("step"))).alias("chunk_start"))
        .select("chunk_start", F.least(F.col("chunk_start") + F.col("step"), "end_ts").alias("chunk_end"))
    )
    dense = by_step(between(DENSE_FROM, None), "1 DAY")
    return old.unionByName(times(middle)).unionByName(dense)


def key_ranges(df: DataFrame, column: str, n: int) -> DataFrame:
    """``n`` equal key ranges ``[low, high)`` over a numeric column, in place of skip/limit pages."""
    ends = df.agg(F.min(column).alias("low"), (F.max(column) + 1).alias("high")).filter("low IS NOT NULL")
    step = F.ceil((F.col("high") - F.col("low")) / F.lit(n)).cast("long")
    return (
        ends.withColumn("step", step)
        .select("step", "high", F.explode(F.sequence(F.col("low"), F.col("high") - 1, F.col("step"))).alias("range_low"))
        .select("range_low", F.least(F.col("range_low") + F.col("step"), "high").alias("range_high"))
    )


def jdbc_predicates(ranges: DataFrame, column: str) -> list[str]:
    """Predicates for a partitioned JDBC read. Ranges number as many as tasks, so they are collected."""
    return [
        f"{column} >= '{r.chunk_start}' AND {column} < '{r.chunk_end}'"
        for r in ranges.orderBy("chunk_start").collect()
    ]
