"""Incremental reads on events, orders and lineitem."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import cursors as C
from ..operators import maintenance as M
from ..operators import normalize as N
from ..operators import ranges as R
from ..plans.load import run_load
from ..plans.request import LoadRequest
from ..session import scratch_path
from ..sinks.tables import SnapshotTable
from ..sources import listing
from ..sources.filescan import FileScan
from .common import register, table

MID = dt.datetime(2024, 1, 15)
FROM, TO = dt.datetime(1996, 1, 1), dt.datetime(1998, 1, 1)
FROM_SQL, TO_SQL = "TIMESTAMP '1996-01-01 00:00:00'", "TIMESTAMP '1998-01-01 00:00:00'"


@register(
    "I01_read_incremental",
    """SELECT * FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders
  WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')""",
)
def read_incremental(spark, sf):
    """Second run: everything from the last value of the first run on."""
    orders = table(spark, sf, "orders")
    last = C.next_value(orders.filter(F.col("o_orderdate") < F.lit(TO)), "o_orderdate").first()["last_value"]
    return C.read_incremental(orders, "o_orderdate", last)


@register(
    "I02_boundary_dedup",
    """WITH m AS (SELECT max(l_shipdate) AS last FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-06-15 00:00:00')
SELECT * FROM lineitem, m WHERE l_shipdate > last
   OR (l_shipdate = last AND l_returnflag <> 'R')""",
)
def boundary_dedup(spark, sf):
    """The first run saw the returned lines of the last day only; the others of that day are new."""
    lines = table(spark, sf, "lineitem")
    last = C.next_value(lines.filter("l_shipdate <= TIMESTAMP_NTZ '1998-06-15 00:00:00'"), "l_shipdate").first()[0]
    first_run = lines.filter((F.col("l_shipdate") < F.lit(last)) | (F.col("l_returnflag") == "R"))
    seen = C.key_hashes(first_run, "l_shipdate", last)
    bound = C.literal_of(lines, "l_shipdate", last)
    return C.read_after(lines, "l_shipdate", bound, seen).withColumn("last", bound)


@register("I03_interval_closed", f"SELECT * FROM orders WHERE o_orderdate BETWEEN {FROM_SQL} AND {TO_SQL}")
def interval_closed(spark, sf):
    return C.interval_filter(table(spark, sf, "orders"), "o_orderdate", FROM, TO, C.SOURCE_BOUNDS["sql"])


@register(
    "I03_interval_half_open", f"SELECT * FROM orders WHERE o_orderdate >= {FROM_SQL} AND o_orderdate < {TO_SQL}"
)
def interval_half_open(spark, sf):
    return C.interval_filter(table(spark, sf, "orders"), "o_orderdate", FROM, TO, C.SOURCE_BOUNDS["mongodb"])


@register(
    "I03_interval_open_closed", f"SELECT * FROM orders WHERE o_orderdate > {FROM_SQL} AND o_orderdate <= {TO_SQL}"
)
def interval_open_closed(spark, sf):
    return C.interval_filter(table(spark, sf, "orders"), "o_orderdate", FROM, TO, C.SOURCE_BOUNDS["pinterest"])


@register("I03_interval_after", f"SELECT * FROM orders WHERE o_orderdate > {FROM_SQL}")
def interval_after(spark, sf):
    return C.interval_filter(table(spark, sf, "orders"), "o_orderdate", FROM, None, C.SOURCE_BOUNDS["salesforce"])


@register(
    "I04_coerce_bounds",
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'",
)
def coerce_bounds(spark, sf):
    """Bounds with a time of day against a date column: they become dates, the last day is whole."""
    events = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))
    return C.interval_filter(events, "day", dt.datetime(2024, 1, 10, 8), dt.datetime(2024, 1, 15, 1), "[]")


@register(
    "I05_custom_query",
    f"""SELECT o_orderkey, o_orderdate, l_linenumber, l_extendedprice FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderdate BETWEEN {FROM_SQL} AND {TO_SQL}""",
)
def custom_query(spark, sf):
    return C.custom_query(
        spark,
        """query:SELECT o_orderkey, o_orderdate, l_linenumber, l_extendedprice
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE o_orderdate BETWEEN :interval_start AND :interval_end""",
        FROM,
        TO,
        orders=table(spark, sf, "orders"),
        lineitem=table(spark, sf, "lineitem"),
    )


@register("I06_sql_limit", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def sql_limit(spark, sf):
    return C.lowest(table(spark, sf, "orders"), 100, "o_orderdate", ["o_orderkey"])


@register("I08_exclude_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def exclude_columns(spark, sf):
    return N.exclude_columns(table(spark, sf, "customer"), " c_name, c_acctbal ")


@register("I09_file_incremental", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def file_incremental(spark, sf):
    """Two drops of files into one folder; each run reads the files it has not read."""
    events = table(spark, sf, "events")
    folder = scratch_path(spark, "drops")
    half = F.col("ts") <= F.lit(MID)
    events.filter(half).write.parquet(folder)
    first = listing.list_files(spark, folder, "*.parquet")
    state = listing.file_state(first)
    part_one = spark.read.schema(events.schema).parquet(*listing.paths(first))
    events.filter(~half).write.mode("append").parquet(folder)
    fresh = C.new_files(listing.list_files(spark, folder, "*.parquet"), state["last"], state["seen"])
    part_two = spark.read.schema(events.schema).parquet(*listing.paths(fresh))
    return M.append(part_one, part_two)


@register(
    "I10_map_cursor",
    """SELECT event_type AS shard, CAST(max(event_id) AS VARCHAR) AS seq FROM events GROUP BY 1""",
)
def map_cursor(spark, sf):
    positions = C.map_cursor(table(spark, sf, "events"), "event_type", "event_id")
    return positions.select(F.explode("positions").alias("shard", "seq"))


@register(
    "I11_ordered_cursor",
    f"SELECT 'back' AS way, o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= {FROM_SQL} UNION ALL "
    f"SELECT 'on', o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= {TO_SQL}",
)
def ordered_cursor(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    back = C.read_incremental(orders, "o_orderdate", FROM, "desc", "min")
    on = C.read_incremental(orders, "o_orderdate", TO, "asc", "max")
    return back.select(F.lit("back").alias("way"), "*").union(on.select(F.lit("on").alias("way"), "*"))


@register(
    "I12_typed_csv_cursor",
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey FROM lineitem WHERE l_partkey >= 900",
)
def typed_csv_cursor(spark, sf):
    """Text cells compared as numbers: 1000 lies beyond 900, which text order gets wrong."""
    path = scratch_path(spark, "csv-cursor")
    table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").write.csv(path, header=True)
    rows = spark.read.csv(path, header=True, schema="l_orderkey string, l_partkey string")
    return C.typed_csv_cursor(rows, "l_partkey", 900, "bigint")


@register(
    "I13_visited_keys",
    """SELECT strftime(ts, '%Y-%m-%d') AS part, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1""",
)
def visited_keys(spark, sf):
    events = table(spark, sf, "events").withColumn("part", F.date_format("ts", "yyyy-MM-dd"))
    parts = events.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    visited = events.filter(F.col("ts") < F.lit(MID)).select("part")
    return C.unvisited(parts, visited, ["part"])


@register(
    "I14_lookback",
    """SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
  CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-10' THEN value * 2 ELSE value END AS value FROM events""",
)
def lookback_reload(spark, sf):
    """The last ten days before the position are read again, corrected, and replace their days."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"), "value")
    stored = events.filter("day <= DATE '2024-01-20'")
    corrected = C.lookback(events, "day", dt.date(2024, 1, 20), 10).withColumn("value", F.col("value") * 2)
    corrected = corrected.withColumn("day", F.to_date("day"))
    return M.delete_insert(stored, corrected, "day")


@register(
    "I15_derived_cursor",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN l_shipdate
  ELSE greatest(l_shipdate + INTERVAL 3 DAYS, o_orderdate) END AS updated
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def derived_cursor(spark, sf):
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey")
    ).select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("updated"),
        (F.col("l_shipdate") + F.expr("INTERVAL 3 DAYS")).alias("sent_datetime"),
        F.col("o_orderdate").alias("opened_datetime"),
    )
    return C.derived_cursor(lines, "updated").select("l_orderkey", "l_linenumber", "updated")


def event_bounds(spark, sf):
    return table(spark, sf, "events").agg(F.min("ts").alias("start_at"), F.max("ts").alias("end_at"))


def order_bounds(spark, sf):
    return table(spark, sf, "orders").agg(F.min("o_orderdate").alias("start_at"), F.max("o_orderdate").alias("end_at"))


@register(
    "I16_range_equal",
    """WITH b AS (SELECT min(o_orderkey) AS s, max(o_orderkey) AS e FROM orders),
c AS (SELECT s, e, CAST(ceil((e - s) / 7.0) AS BIGINT) AS step FROM b)
SELECT s + i * step AS chunk_start, least(s + (i + 1) * step, e) AS chunk_end FROM c, range(0, 7) r(i) WHERE s + i * step < e""",
)
def range_equal(spark, sf):
    bounds = table(spark, sf, "orders").agg(F.min("o_orderkey").alias("start_ts"), F.max("o_orderkey").alias("end_ts"))
    return R.equal_chunks(bounds, 7)


@register(
    "I16_range_hourly",
    """WITH b AS (SELECT min(ts) AS s, max(ts) AS e FROM events),
h AS (SELECT s, e, unnest(generate_series(date_trunc('hour', s), e, INTERVAL 1 HOUR)) AS hour FROM b)
SELECT greatest(hour, s) AS chunk_start, least(hour + INTERVAL 1 HOUR, e) AS chunk_end FROM h WHERE hour < e""",
)
def range_hourly(spark, sf):
    return R.hourly_aligned(event_bounds(spark, sf))


@register(
    "I16_range_daily",
    """WITH b AS (SELECT min(ts) AS s, max(ts) AS e FROM events),
h AS (SELECT s, e, unnest(generate_series(s, e, INTERVAL 1 DAY)) AS t FROM b)
SELECT t AS chunk_start, least(t + INTERVAL 1 DAY, e) AS chunk_end FROM h WHERE t < e""",
)
def range_daily(spark, sf):
    return R.daily_or_hourly(event_bounds(spark, sf))


@register(
    "I16_range_gap",
    """WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
h AS (SELECT e, unnest(generate_series(s, e, INTERVAL 31 DAY)) AS t FROM b)
SELECT t AS chunk_start, least(t + INTERVAL 30 DAY, e) AS chunk_end FROM h""",
)
def range_gap(spark, sf):
    return R.gap_by_day(order_bounds(spark, sf), 30)


@register(
    "I16_range_month",
    """WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
h AS (SELECT s, e, unnest(generate_series(date_trunc('month', s)::TIMESTAMP, e, INTERVAL 1 MONTH)) AS m FROM b)
SELECT greatest(m, s) AS chunk_start, least(CAST(last_day(m) AS TIMESTAMP), e) AS chunk_end FROM h WHERE greatest(m, s) < e""",
)
def range_month(spark, sf):
    return R.month_aligned(order_bounds(spark, sf))


@register(
    "I16_range_adaptive",
    """WITH b AS (SELECT min(o_orderdate) + INTERVAL 19 YEAR AS s, max(o_orderdate) + INTERVAL 19 YEAR AS e FROM orders),
mid AS (SELECT epoch(s)::BIGINT AS s, epoch(least(e, TIMESTAMP '2015-01-01'))::BIGINT AS e, 3 AS n FROM b
  UNION ALL SELECT epoch(greatest(s, TIMESTAMP '2015-01-01'))::BIGINT, epoch(least(e, TIMESTAMP '2020-01-01'))::BIGINT,
    least(8, greatest(2, CAST(floor((epoch(least(e, TIMESTAMP '2020-01-01'))
      - epoch(greatest(s, TIMESTAMP '2015-01-01'))) / (365 * 86400) * 2) AS INT))) FROM b),
st AS (SELECT *, CAST(ceil((e - s) / CAST(n AS DOUBLE)) AS BIGINT) AS step FROM mid WHERE s < e),
cut AS (SELECT s + i * step AS a, least(s + (i + 1) * step, e) AS z FROM st, range(0, 8) r(i)
  WHERE i < n AND s + i * step < e),
d AS (SELECT e, unnest(generate_series(greatest(s, TIMESTAMP '2020-01-01'), e, INTERVAL 1 DAY)) AS t FROM b)
SELECT make_timestamp(a * 1000000) AS chunk_start, make_timestamp(z * 1000000) AS chunk_end FROM cut
UNION ALL SELECT t, least(t + INTERVAL 1 DAY, e) FROM d WHERE t < e""",
)
def range_adaptive(spark, sf):
    """Order dates moved by 19 years, so that they cross the sparse, medium and dense spans."""
    year = F.expr("INTERVAL 19 YEARS")
    moved = order_bounds(spark, sf).select((F.col("start_at") + year).alias("start_at"), (F.col("end_at") + year).alias("end_at"))
    return R.adaptive_chunks(moved, 8)


@register(
    "I16_range_calendar",
    """WITH RECURSIVE b AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
r AS (SELECT s AS chunk_start, least(CAST(s + INTERVAL 6 MONTH AS DATE), e) AS chunk_end, e FROM b
  UNION ALL SELECT CAST(chunk_end + INTERVAL 1 DAY AS DATE),
    least(CAST(chunk_end + INTERVAL 1 DAY + INTERVAL 6 MONTH AS DATE), e), e FROM r WHERE chunk_end < e)
SELECT chunk_start, chunk_end FROM r""",
)
def range_calendar(spark, sf):
    return R.calendar_ranges(order_bounds(spark, sf), 6)


@register(
    "I17_offset_partitions",
    """WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) + 1 AS hi FROM lineitem),
s AS (SELECT lo, hi, CAST(ceil((hi - lo) / 16.0) AS BIGINT) AS step FROM b),
r AS (SELECT lo + i * step AS range_low, least(lo + (i + 1) * step, hi) AS range_high FROM s, range(0, 16) t(i) WHERE lo + i * step < hi)
SELECT range_low, range_high, count(l_orderkey) AS n FROM r LEFT JOIN lineitem
  ON l_orderkey >= range_low AND l_orderkey < range_high GROUP BY 1, 2""",
)
def key_ranges(spark, sf):
    """The ranges, and how many rows a pull of each would bring."""
    lines = table(spark, sf, "lineitem")
    ranges = R.key_ranges(lines, "l_orderkey", 16)
    # The ranges are equally wide, so a key tells the beginning of its own; one row gives the rule.
    rule = ranges.agg(F.min("range_low").alias("low"), F.max(F.col("range_high") - F.col("range_low")).alias("step")).first()
    begin = F.floor((F.col("l_orderkey") - rule["low"]) / rule["step"]) * rule["step"] + rule["low"]
    counted = lines.groupBy(begin.cast("long").alias("range_low")).agg(F.count("l_orderkey").alias("n"))
    return ranges.join(counted, "range_low", "left").fillna(0, ["n"]).select("range_low", "range_high", "n")


@register(
    "I18_compound_cursor",
    """SELECT l_orderkey AS last_id, l_shipdate AS last_at FROM lineitem ORDER BY l_shipdate DESC, l_orderkey DESC LIMIT 1""",
)
def compound_cursor(spark, sf):
    return C.compound_cursor(table(spark, sf, "lineitem"), "l_orderkey", "l_shipdate")


@register(
    "R23_client_interval_filter",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-25 00:00:00'",
)
def client_interval_filter(spark, sf):
    return C.interval_filter(table(spark, sf, "events"), "ts", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 25), "[]")


@register(
    "R35_cursor_fallback",
    """SELECT doc_id, CASE WHEN quality = 1 THEN TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 MINUTE
  WHEN quality = 0 THEN TIMESTAMP '2023-01-01 00:00:00' ELSE TIMESTAMP '1970-01-01 00:00:00' END AS updated
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def cursor_fallback(spark, sf):
    """Good documents carry a time, bad ones an unreadable one with a fallback, the rest nothing."""
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    minute = "date_format(TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, doc_id), 'yyyy-MM-dd HH:mm:ss')"
    raw = docs.selectExpr(
        "doc_id",
        f"CASE WHEN quality = 1 THEN {minute} WHEN quality = 0 THEN 'soon' END AS updated",
        "CASE WHEN quality = 0 THEN '2023-01-01' END AS inserted",
    )
    return C.cursor_fallback(raw, "updated", ["inserted"]).select("doc_id", "updated")


@register("I09_load_twice", "SELECT * FROM events")
def load_files_twice(spark, sf):
    """Folders of files loaded again and again, each with a position of its own, and files that come later."""
    events = table(spark, sf, "events")
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "landed")
    request = LoadRequest(source="events", target=target, source_kind="files", file_incremental=True)

    def arrive(folder, rows):
        rows.write.mode("append").parquet(f"{root}/{folder}")

    def load(folder):
        scan = FileScan(
            spark=spark, root=f"{root}/{folder}", pattern="*.parquet",
            read=lambda found: spark.read.schema(events.schema).parquet(*found),
        )
        run_load(scan, request)

    day = F.dayofmonth("ts")
    arrive("early", events.filter(day < 10).repartitionByRange(3, "event_id"))
    arrive("late", events.filter(day > 20).repartitionByRange(2, "event_id"))
    for folder in ("early", "early", "late", "early", "late"):
        load(folder)
    arrive("early", events.filter((day >= 10) & (day <= 20)))
    load("early")
    load("early")
    return SnapshotTable(spark, target).data()
