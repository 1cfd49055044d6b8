"""Table maintenance on orders, lineitem, customer and events.

Batches are carved by date from whole tables: the target holds the past, the batch reaches back
over the cut, as a second incremental run does.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from ..operators import maintenance as M
from ..operators import normalize as N
from ..operators.keys import dedup_by_key
from ..plans.load import run_load
from ..plans.request import LoadRequest
from ..session import scratch_path, stage
from ..sinks import files as sink
from ..sinks.documents import DocumentStore
from ..sinks.tables import SnapshotTable, TableGroup
from .common import register, table

PAST = "o_orderdate <= TIMESTAMP_NTZ '2000-12-31 00:00:00'"
RECENT = "o_orderdate > TIMESTAMP_NTZ '2000-12-01 00:00:00'"

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
ORDER_BATCHES = """
past AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-12-31 00:00:00'),
recent AS (SELECT * REPLACE (o_totalprice * 1.1 AS o_totalprice) FROM orders
           WHERE o_orderdate > TIMESTAMP '2000-12-01 00:00:00')"""

MERGED_ORDERS = f"""WITH {ORDER_BATCHES}
SELECT * FROM past p WHERE NOT EXISTS (SELECT 1 FROM recent r WHERE r.o_orderkey = p.o_orderkey)
UNION ALL SELECT * FROM recent"""


def order_batches(spark, sf):
    orders = table(spark, sf, "orders")
    recent = orders.filter(RECENT).withColumn("o_totalprice", F.col("o_totalprice") * F.lit(1.1))
    return orders.filter(PAST), recent


@register("W03_load_merge", MERGED_ORDERS)
def load_merge(spark, sf):
    past, recent = order_batches(spark, sf)
    return M.merge(past, recent, ["o_orderkey"], ["o_orderdate"])


@register(
    "W01_load_replace",
    "SELECT * REPLACE (o_totalprice * 1.1 AS o_totalprice) FROM orders",
)
def load_replace(spark, sf):
    orders = table(spark, sf, "orders")
    target = SnapshotTable(spark, scratch_path(spark, "replace"))
    target.replace(orders, "first")
    # The second load reads the table it replaces.
    target.replace(target.read().withColumn("o_totalprice", F.col("o_totalprice") * F.lit(1.1)), "second")
    return target.read()


@register("W02_load_append", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def load_append(spark, sf):
    """Two runs with a cursor: the second sees the boundary rows again and adds none of them."""
    events = table(spark, sf, "events")
    path = scratch_path(spark, "append")
    request = LoadRequest(
        source="events", target=path, strategy="append", incremental_key="ts", primary_key=["event_id"]
    )
    run_load(events.filter("ts <= TIMESTAMP_NTZ '2024-01-15 00:00:00'"), request, "first")
    run_load(events, request, "second")
    run_load(events, request, "third")
    return M.strip_lineage(SnapshotTable(spark, path).read())


@register("W02_underscore_identity", "SELECT event_id AS _id, ts, user_id, event_type, value, props FROM events")
def underscore_identity(spark, sf):
    """Without a key the data tells rows apart, columns with a leading underscore too."""
    events = table(spark, sf, "events").withColumnRenamed("event_id", "_id")
    path = scratch_path(spark, "identity")
    request = LoadRequest(source="events", target=path, strategy="append", incremental_key="ts")
    last = events.filter("ts <= TIMESTAMP_NTZ '2024-01-15 00:00:00'").agg(F.max("ts")).first()[0]
    # The first run has half of the rows at its last time only.
    run_load(events.filter((F.col("ts") < F.lit(last)) | (F.col("ts") == F.lit(last)) & (F.col("_id") % 2 == 0)), request, "first")
    run_load(events, request, "second")
    return SnapshotTable(spark, path).data()


@register("W01_replace_with_cursor", "SELECT * FROM events")
def replace_with_cursor(spark, sf):
    """A replacement takes the whole source, however far an earlier one came."""
    events = table(spark, sf, "events")
    path = scratch_path(spark, "replace-cursor")
    request = LoadRequest(source="events", target=path, strategy="replace", incremental_key="ts")
    run_load(events, request, "first")
    run_load(events, request, "second")
    return SnapshotTable(spark, path).data()


@register("I06_limit_progress", "SELECT * FROM events")
def limit_progress(spark, sf):
    """Limited loads, one after the other, reach every row, also where many share a time."""
    events = table(spark, sf, "events").withColumn("ts", F.date_trunc("month", "ts").cast("timestamp_ntz"))
    path = scratch_path(spark, "limits")
    n = events.count()
    request = LoadRequest(
        source="events", target=path, strategy="append", incremental_key="ts", primary_key=["event_id"], limit=n // 3 + 1
    )
    for i in range(4):
        run_load(events, request, f"run-{i}")
    loaded = SnapshotTable(spark, path).data().drop("ts")
    return loaded.join(table(spark, sf, "events").select("event_id", "ts"), "event_id").select(table(spark, sf, "events").columns)


@register(
    "W03_bucket_widen",
    f"""WITH m AS ({MERGED_ORDERS}) SELECT * REPLACE (CAST(CASE WHEN o_orderdate > TIMESTAMP '2000-12-01 00:00:00'
  THEN o_custkey + 0.5 ELSE o_custkey END AS DECIMAL(12, 1)) AS o_custkey) FROM m""",
)
def bucket_widen(spark, sf):
    """An upsert into buckets whose batch widens a column: files that cannot be read so are written again."""
    past, recent = order_batches(spark, sf)
    past = past.withColumn("o_custkey", F.col("o_custkey").cast("int"))
    path = scratch_path(spark, "bucket-widen")
    request = LoadRequest(source="orders", target=path, strategy="merge", primary_key=["o_orderkey"], buckets=8)
    run_load(past, request, "first")
    half = (F.col("o_custkey") + F.expr("0.5")).cast("decimal(12,1)")
    run_load(recent.withColumn("o_custkey", half), request, "second")
    return SnapshotTable(spark, path).data()


@register(
    "W04_load_delete_insert",
    """WITH past AS (SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-06-30 00:00:00'),
recent AS (SELECT * REPLACE (l_extendedprice * 1.1 AS l_extendedprice) FROM lineitem
           WHERE l_shipdate > TIMESTAMP '2000-06-01 00:00:00')
SELECT * FROM past p WHERE NOT EXISTS (SELECT 1 FROM recent r WHERE r.l_shipdate = p.l_shipdate)
UNION ALL SELECT * FROM recent""",
)
def load_delete_insert(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    past = lineitem.filter("l_shipdate <= TIMESTAMP_NTZ '2000-06-30 00:00:00'")
    recent = lineitem.filter("l_shipdate > TIMESTAMP_NTZ '2000-06-01 00:00:00'")
    recent = recent.withColumn("l_extendedprice", F.col("l_extendedprice") * F.lit(1.1))
    return M.delete_insert(past, recent, "l_shipdate")


DEDUPED_LINES = """SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_discount DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
    l_linestatus DESC NULLS LAST, l_partkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
    l_returnflag DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_tax DESC NULLS LAST) = 1"""


@register(
    "W05_load_merge_two_keys",
    f"""WITH past AS (SELECT * FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-06-30 00:00:00'),
recent AS (SELECT * REPLACE (l_extendedprice * 1.1 AS l_extendedprice) FROM lineitem
           WHERE l_shipdate > TIMESTAMP '2000-06-01 00:00:00'),
fresh AS ({DEDUPED_LINES.format(source="recent")})
SELECT * FROM past p
WHERE NOT EXISTS (SELECT 1 FROM recent r WHERE r.l_shipdate = p.l_shipdate)
  AND NOT EXISTS (SELECT 1 FROM fresh f WHERE f.l_orderkey = p.l_orderkey AND f.l_linenumber = p.l_linenumber)
UNION ALL SELECT * FROM fresh""",
)
def load_merge_two_keys(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    past = lineitem.filter("l_shipdate <= TIMESTAMP_NTZ '2000-06-30 00:00:00'")
    recent = lineitem.filter("l_shipdate > TIMESTAMP_NTZ '2000-06-01 00:00:00'")
    recent = recent.withColumn("l_extendedprice", F.col("l_extendedprice") * F.lit(1.1))
    return M.merge_two_keys(past, recent, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_shipdate"])


T1, T2, T3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))


def customer_snapshots(spark, sf):
    """The customers, then some gone and some changed, then the customers again."""
    customer = table(spark, sf, "customer")
    changed = F.col("c_mktsegment") == "BUILDING"
    second = customer.filter("NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 0)").withColumn(
        "c_acctbal", F.when(changed, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    )
    return customer, second, customer


HISTORY = """WITH marked AS (SELECT *, coalesce(c_mktsegment = 'MACHINERY' AND c_acctbal < 0, false) AS gone,
                       coalesce(c_mktsegment = 'BUILDING', false) AS changed FROM customer),
t AS (SELECT TIMESTAMP '2024-01-01 00:00:00' AS t1, TIMESTAMP '2024-02-01 00:00:00' AS t2,
             TIMESTAMP '2024-03-01 00:00:00' AS t3, CAST(NULL AS TIMESTAMP) AS none)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, t1 AS _valid_from,
       CASE WHEN gone OR changed THEN t2 END AS _valid_to FROM marked, t
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment, t2, t3 FROM marked, t WHERE changed
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, t3, none FROM marked, t
          WHERE gone OR changed"""


@register("W06_load_scd2", HISTORY)
def load_scd2(spark, sf):
    """Three snapshots: some rows go and come back, some change and change back."""
    first, second, third = customer_snapshots(spark, sf)
    history = stage(M.scd2(M.scd2(None, first, T1), second, T2), "history")
    return M.scd2(history, third, T3)


@register("W06_history_load", HISTORY)
def history_load(spark, sf):
    """The same as loads of a table, closed records in folders that are not written again."""
    path = scratch_path(spark, "history")
    request = LoadRequest(source="customer", target=path, strategy="scd2")
    for frame, at in zip(customer_snapshots(spark, sf), (T1, T2, T3)):
        run_load(frame, request, f"at-{at:%Y-%m-%d}", load_time=at)
    return SnapshotTable(spark, path).read()


@register("W06_underscore_columns", HISTORY.replace("SELECT c_custkey,", "SELECT c_custkey AS _id,"))
def underscore_columns(spark, sf):
    """A history of rows whose id begins with an underscore, as ids of documents do."""
    path = scratch_path(spark, "underscore")
    request = LoadRequest(source="customer", target=path, strategy="scd2")
    for frame, at in zip(customer_snapshots(spark, sf), (T1, T2, T3)):
        run_load(frame.withColumnRenamed("c_custkey", "_id"), request, f"at-{at:%Y-%m-%d}", load_time=at)
    return SnapshotTable(spark, path).read()


@register("W08_full_refresh", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def full_refresh(spark, sf):
    """A refresh forgets the cursor: rows older than it are loaded too, and old data is gone."""
    events = table(spark, sf, "events")
    path = scratch_path(spark, "refresh")
    request = LoadRequest(
        source="events", target=path, strategy="append", incremental_key="ts", primary_key=["event_id"]
    )
    run_load(events.filter("ts >= TIMESTAMP_NTZ '2024-01-15 00:00:00'"), request, "first")
    run_load(events, request, "second", full_refresh=True)
    return M.strip_lineage(SnapshotTable(spark, path).read())


@register("W09_dedup_by_key", DEDUPED_LINES.format(source="lineitem"))
def dedup_latest(spark, sf):
    return dedup_by_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register(
    "W10_stamp_lineage",
    """SELECT o_orderkey, 'load-1' AS _load_id, sha256('{"o_orderkey":' || o_orderkey || '}') AS _row_id
FROM orders""",
)
def stamp_lineage(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return M.stamp_lineage(orders, "load-1", key=["o_orderkey"])


@register(
    "W11_route_tables",
    "SELECT event_type AS route, count(*) AS n, min(event_id) AS first_id, max(ts) AS last_ts FROM events GROUP BY 1",
)
def route_tables(spark, sf):
    path = scratch_path(spark, "routes")
    sink.route_tables(table(spark, sf, "events"), "event_type", path)
    routed = spark.read.parquet(path)
    return routed.groupBy(F.col("_route").alias("route")).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("ts").alias("last_ts")
    )


@register("W11_route_load", "SELECT *, event_type AS route FROM events")
def route_load(spark, sf):
    """Two loads into a table per event type, and between them one that dies after the first table's head."""
    events = table(spark, sf, "events")
    path = scratch_path(spark, "routed")
    request = LoadRequest(source="events", target=path, strategy="append", multiple_tables=True, route="event_type", primary_key=["event_id"])
    early = F.col("ts") <= F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    run_load(events.filter(early), request, "first")
    group = TableGroup(spark, path)
    broken = group.begin(group.names()[:1])[0]
    broken.append(broken.read(), "broken")
    run_load(events.filter(~early), request, "second")
    out = None
    for name in group.names():
        rows = group.table(name).data().withColumn("route", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@register(
    "W12_partition_by",
    """SELECT CAST(ts AS DATE) AS ts_day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1""",
)
def partition_by(spark, sf):
    path = scratch_path(spark, "by-day")
    sink.write_partitioned(table(spark, sf, "events"), "ts", path)
    return spark.read.parquet(path).groupBy("ts_day").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")
    )


@register("W13_cluster_by", "SELECT * FROM lineitem")
def cluster_by(spark, sf):
    path = scratch_path(spark, "clustered")
    sink.cluster_by(table(spark, sf, "lineitem"), ["l_shipdate", "l_orderkey"]).write.parquet(path)
    return spark.read.parquet(path)


@register(
    "W14_export_union",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def export_union(spark, sf):
    """Two frames with different columns into CSV, columns in first-seen order."""
    customers = table(spark, sf, "customer").selectExpr("c_custkey id", "c_name name", "c_mktsegment segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_suppkey id", "s_name name", "s_acctbal balance")
    path = scratch_path(spark, "export")
    sink.export(M.stamp_lineage(customers, "x"), path, "csv", others=[suppliers])
    return spark.read.csv(path, header=True, schema="id long, name string, segment string, balance double")


@register("W15_write_dataset", "SELECT *, year(o_orderdate) AS o_year FROM orders")
def write_dataset(spark, sf):
    path = scratch_path(spark, "dataset")
    orders = table(spark, sf, "orders").withColumn("o_year", F.year("o_orderdate").cast("long"))
    sink.write_dataset(orders, path, "parquet", rows_per_file=100_000, layout=["o_year"])
    return spark.read.parquet(path).withColumn("o_year", F.col("o_year").cast("long"))


@register(
    "W16_apply_column_types",
    """SELECT p_partkey, TRY_CAST(p_name AS BIGINT) AS p_name, p_name AS p_name__v_text,
  CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS DECIMAL(18, 2)) AS p_retailprice FROM part""",
)
def apply_column_types(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return N.apply_column_types(part, "p_name:bigint,p_size:text,p_retailprice:decimal(18,2)")


@register(
    "W17_bigdecimal",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DECIMAL(38, 18)) AS l_quantity FROM lineitem",
)
def bigdecimal(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return N.apply_column_types(lines, "l_quantity:bigdecimal")


@register(
    "W18_normalize_names",
    """SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS account_balance_usd FROM customer""",
)
def normalize_names(spark, sf):
    raw = table(spark, sf, "customer").selectExpr(
        "c_custkey as `Customer Key`", "c_name as customerName", "c_acctbal as `Account-Balance (USD)`"
    )
    return N.normalize_names(raw)


def nested_documents(spark, sf, with_words=False):
    """Documents with their lines as objects, and if asked each line's words as objects, as files."""
    docs = table(spark, sf, "documents")
    words = "transform(split(line, ' '), w -> named_struct('word', w))"
    line = f"named_struct('line', line, 'words', {words})" if with_words else "named_struct('line', line)"
    lines = f"transform(split(text, '\\n'), line -> {line})"
    return stage(docs.selectExpr("doc_id", "lang", f"{lines} AS lines"), "nested")


@register(
    "W19_shred_nested",
    """WITH d AS (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents)
SELECT sha256('{"doc_id":' || doc_id || '}') AS _parent_id, lang,
  unnest(range(len(lines))) AS _list_idx, unnest(lines) AS line FROM d""",
)
def shred_nested(spark, sf):
    """Child table of the lines, joined back to its parent by the generated id."""
    tables = N.shred_nested(nested_documents(spark, sf), "documents", key=["doc_id"], levels=1)
    parent = tables["documents"].select(F.col("_row_id").alias("_parent_id"), "lang")
    child = tables["documents__lines"].select("_parent_id", F.col("_list_idx").cast("long"), "line")
    return child.join(parent, "_parent_id")


@register(
    "W19_nested_merge",
    """WITH d AS (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents WHERE doc_id IS NOT NULL)
SELECT doc_id, CASE WHEN lang = 'en' THEN 'new' ELSE 'old' END AS edition, unnest(range(len(kept))) AS list_idx, unnest(kept) AS line
FROM (SELECT doc_id, lang, CASE WHEN lang = 'en' THEN lines[1:1] ELSE lines END AS kept FROM d)""",
)
def nested_merge(spark, sf):
    """Documents with their lines as a child table; those of one language come again with their first line only."""
    docs = table(spark, sf, "documents").selectExpr("doc_id", "lang", "'old' AS edition", "split(text, '\\n') AS lines")
    path = scratch_path(spark, "records")
    request = LoadRequest(source="documents", target=path, strategy="merge", primary_key=["doc_id"], nesting=1)
    docs = docs.filter("doc_id IS NOT NULL")
    run_load(docs, request, "first")
    again = docs.filter("lang = 'en'").withColumns({"lines": F.slice("lines", 1, 1), "edition": F.lit("new")})
    run_load(again, request, "second")
    group = TableGroup(spark, path)
    roots = group.table("documents").read().select(F.col("_row_id").alias("_root_id"), "doc_id", "edition")
    lines = group.table("documents__lines").read().select("_root_id", F.col("_list_idx").cast("long").alias("list_idx"), F.col("value").alias("line"))
    return lines.join(roots, "_root_id").drop("_root_id")


@register(
    "W19_shred_two_levels",
    """WITH d AS (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, lang, unnest(range(len(lines))) AS line_no, unnest(lines) AS line FROM d),
w AS (SELECT doc_id, lang, line_no, unnest(string_split(line, ' ')) AS word FROM l)
SELECT lang, line_no, count(*) AS words, sum(length(word))::BIGINT AS letters FROM w GROUP BY 1, 2""",
)
def shred_two_levels(spark, sf):
    """Words below lines below documents, linked upwards by id."""
    tables = N.shred_nested(nested_documents(spark, sf, with_words=True), "documents", key=["doc_id"], levels=2)
    words = tables["documents__lines__words"].select(F.col("_parent_id").alias("line_id"), "word")
    per_line = words.groupBy("line_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("word")).alias("k"))
    lines = tables["documents__lines"].select(
        F.col("_row_id").alias("line_id"), F.col("_parent_id").alias("doc"), F.col("_list_idx").cast("long").alias("line_no")
    )
    docs = tables["documents"].select(F.col("_row_id").alias("doc"), "lang")
    return per_line.join(lines, "line_id").join(docs, "doc").groupBy("lang", "line_no").agg(
        F.sum("n").alias("words"), F.sum("k").alias("letters")
    )


@register(
    "W20_keep_as_json",
    """SELECT page_id, '["' || array_to_string(string_split(url, '/'), '","') || '"]' AS parts FROM pages""",
)
def keep_as_json(spark, sf):
    return N.keep_as_json(table(spark, sf, "pages").select("page_id", F.split("url", "/").alias("parts")))


@register(
    "W21_evolve_schema",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS amount, CAST(NULL AS VARCHAR) AS amount__v_text,
  CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, NULL, CASE WHEN c_acctbal < 0 THEN 'owed' ELSE 'paid' END, c_mktsegment FROM customer""",
)
def evolve_schema(spark, sf):
    """The batch brings a new column, a missing one, and text where the table holds numbers."""
    target = table(spark, sf, "supplier").selectExpr("s_suppkey id", "s_name name", "s_acctbal amount")
    batch = table(spark, sf, "customer").selectExpr(
        "c_custkey id", "c_name name", "if(c_acctbal < 0, 'owed', 'paid') amount", "c_mktsegment segment"
    )
    return N.evolve(target, batch)


@register(
    "W21_widen_exact",
    """SELECT o_orderkey, CAST(CASE WHEN past THEN o_custkey ELSE o_totalprice END AS DECIMAL(12, 2)) AS whole_or_part,
  CASE WHEN past THEN o_custkey END AS whole, CASE WHEN NOT past THEN o_totalprice END AS whole__v_double,
  CAST(CASE WHEN past THEN o_custkey % 90 + 0.25 ELSE o_custkey + 1000000 END AS DECIMAL(12, 2)) AS part FROM (
    SELECT *, o_orderdate <= TIMESTAMP '2000-12-31 00:00:00' AS past FROM orders)""",
)
def widen_exact(spark, sf):
    """Whole numbers meet fractions: digits are added, and what no type holds exactly gets a column of its own."""
    orders = table(spark, sf, "orders")
    past = orders.filter(PAST).selectExpr(
        "o_orderkey", "CAST(o_custkey AS INT) whole_or_part", "o_custkey whole", "CAST(o_custkey % 90 + 0.25 AS DECIMAL(4, 2)) part"
    )
    recent = orders.filter(f"NOT ({PAST})").selectExpr(
        "o_orderkey", "CAST(o_totalprice AS DECIMAL(12, 2)) whole_or_part", "o_totalprice whole", "CAST(o_custkey + 1000000 AS INT) part"
    )
    return N.evolve(past, recent)


@register(
    "W22_loads_log",
    """SELECT row_number() OVER (ORDER BY r_regionkey, month) AS version, 'load-' || r_regionkey || '-' || month AS load_id,
  CASE WHEN month = 1 THEN CAST((SELECT count(*) FROM region) AS BIGINT) ELSE 0 END AS rows
FROM region, (SELECT unnest(range(1, 31)) AS month)""",
)
def loads_log(spark, sf):
    """150 loads, most of which bring nothing, and expiries among them: the log has them all, each with its rows."""
    region = table(spark, sf, "region")
    target = SnapshotTable(spark, scratch_path(spark, "log"))
    keys = sorted(r[0] for r in region.select("r_regionkey").collect())
    for key in keys:
        target.replace(region, f"load-{key}-1")
        for month in range(2, 31):
            target.commit(f"load-{key}-{month}", target.head()["dirs"], region.schema, loaded=0)
        target.expire(hours=-1)
    return target.loads().select("version", "load_id", "rows")


@register("W22_commit_then_ack", MERGED_ORDERS)
def commit_then_ack(spark, sf):
    """The position moves after the swap only: a load that dies before is repeated without harm."""
    past, recent = order_batches(spark, sf)
    path = scratch_path(spark, "commit")
    request = LoadRequest(source="orders", target=path, strategy="merge", primary_key=["o_orderkey"])
    run_load(past, request, "first")
    seen = []
    run_load(recent, request, "second", on_commit=seen.append)
    run_load(recent, request, "second-again", on_commit=seen.append)
    assert seen == ["second", "second-again"]
    return M.strip_lineage(SnapshotTable(spark, path).read())


@register(
    "W24_upsert_documents",
    """SELECT CAST(doc_id AS VARCHAR) AS _id, doc_id, lang, source, n_chars + CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS n_chars, text
FROM documents""",
)
def upsert_documents(spark, sf):
    """A collection replaced twice, then upserted: documents of one language change, those of another are new, the rest stay."""
    docs = table(spark, sf, "documents")
    path = scratch_path(spark, "collection")
    request = LoadRequest(source="documents", target=path, sink_kind="documents", strategy="replace", primary_key=["doc_id"])
    run_load(docs.withColumn("text", F.lit("gone")), request, "first")
    run_load(docs.filter("lang <> 'fr' OR lang IS NULL"), request, "second")
    upsert = dataclasses.replace(request, strategy="merge")
    changed = docs.withColumn("n_chars", F.col("n_chars") + F.when(F.col("lang") == "en", 1).otherwise(0))
    run_load(changed.filter("lang IN ('en', 'fr')"), upsert, "third")
    fields = "_id string, doc_id long, lang string, source string, n_chars long, text string"
    return DocumentStore(spark, path).read(fields)
