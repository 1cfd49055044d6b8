"""Record shaping. Nested and untidy records are made of whole tables, row by row, then shaped back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import maintenance as M
from ..operators import shaping as S
from ..session import scratch_path
from .common import register, table


@register(
    "R01_flatten_struct",
    "SELECT c_custkey AS id, c_name AS who_name, c_nationkey AS who_at_nation, c_acctbal AS money_balance FROM customer",
)
def flatten_struct(spark, sf):
    nested = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id",
        "named_struct('name', c_name, 'at', named_struct('nation', c_nationkey)) AS who",
        "named_struct('balance', c_acctbal) AS money",
    )
    return S.flatten_struct(nested)


@register("R01_lift", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def lift(spark, sf):
    nested = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "named_struct('name', c_name, 'segment', c_mktsegment) AS attributes"
    )
    return S.lift(nested, "attributes")


@register(
    "R02_collapse_refs",
    """SELECT l_orderkey, l_partkey AS part_id, array_to_string([l_suppkey, l_partkey], ',') AS keys, l_quantity FROM lineitem""",
)
def collapse_refs(spark, sf):
    nested = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "named_struct('id', l_partkey, 'flag', l_returnflag) AS part",
        "array(named_struct('id', l_suppkey), named_struct('id', l_partkey)) AS keys", "l_quantity",
    )
    return S.join_lists(S.collapse_refs(nested))


@register(
    "R03_unwrap_nodes",
    """SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS lines_total_count,
  array_to_string(string_split(text, chr(10)), '|') AS lines FROM documents""",
)
def unwrap_nodes(spark, sf):
    """Lines as a connection, the words of each line as a connection inside it."""
    line = "named_struct('words', named_struct('nodes', split(l, ' ')))"
    nested = table(spark, sf, "documents").selectExpr(
        "doc_id",
        f"named_struct('nodes', transform(split(text, '\\\\n'), l -> {line}), "
        "'totalCount', CAST(size(split(text, '\\\\n')) AS BIGINT)) AS lines",
    )
    plain = S.unwrap_nodes(nested)
    joined = F.transform("lines", lambda x: F.array_join(x["words"], " "))
    return plain.withColumn("lines", F.array_join(joined, "|"))


BAG = """array(named_struct('label', 'Full Name', 'value', c_name, 'type', 'text'),
  named_struct('label', 'Segment', 'value', c_mktsegment, 'type', 'text'),
  named_struct('label', 'Home Nation', 'value', CAST(c_nationkey AS STRING), 'type', 'text'))"""


@register(
    "R04_pivot_label_bag",
    """SELECT c_custkey, c_name AS full_name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS home_nation,
  CAST(NULL AS VARCHAR) AS __other FROM customer""",
)
def pivot_label_bag(spark, sf):
    bags = table(spark, sf, "customer").selectExpr("c_custkey", f"{BAG} AS attributes")
    labels = ("Full Name", "Segment", "Home Nation")
    return S.pivot_label_bag(bags, "attributes", {k: S.label_name(None, k) for k in labels})


@register(
    "R04_open_label_bag",
    """SELECT c_custkey, 'first' AS run, c_name AS full_name, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS VARCHAR) AS home_nation,
  '[{"label":"Segment","value":"' || c_mktsegment || '","type":"text"},{"label":"Home Nation","value":"' || c_nationkey || '","type":"text"}]' AS __other
FROM customer
UNION ALL SELECT c_custkey, 'second', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR), NULL FROM customer""",
)
def open_label_bag(spark, sf):
    """A first run that knows one label keeps the others whole; the second has columns for all it found."""
    bags = table(spark, sf, "customer").selectExpr("c_custkey", f"{BAG} AS attributes")
    known = spark.createDataFrame([("label", "Full Name", "full_name")], "field string, code string, label string")
    first = S.pivot_label_bag(bags, "attributes", S.names_of(known)).withColumn("run", F.lit("first"))
    second = S.pivot_label_bag(bags, "attributes", S.names_of(S.found_labels(bags, "attributes", known)))
    return first.unionByName(second.withColumn("run", F.lit("second")), allowMissingColumns=True)


@register(
    "R05_map_codes",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE o_orderstatus END AS kept,
  CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS nulled,
  CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE o_orderstatus END || ',' || o_orderpriority AS listed
FROM orders""",
)
def map_codes(spark, sf):
    labels = {"O": "open", "F": "filled"}
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderstatus AS kept", "o_orderstatus AS nulled", "array(o_orderstatus, o_orderpriority) AS listed"
    )
    out = S.map_codes(S.map_codes(raw, "kept", labels), "nulled", labels, "null")
    return S.join_lists(S.map_codes(out, "listed", labels))


@register(
    "R05_map_codes_table",
    """SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS customer FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey""",
)
def map_codes_table(spark, sf):
    """Labels of customers in credit; the others keep their number."""
    labels = table(spark, sf, "customer").filter("c_acctbal > 0").selectExpr("CAST(c_custkey AS STRING) code", "c_name label")
    raw = table(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_custkey AS STRING) customer")
    return S.map_codes_from(raw, "customer", labels)


@register(
    "R06_stable_dictionary",
    """WITH old AS (SELECT p_brand AS field, p_type AS code, min(p_name) AS label FROM part WHERE p_size <= 25 GROUP BY 1, 2),
new AS (SELECT p_brand AS field, p_type AS code, max(p_name) AS label FROM part GROUP BY 1, 2)
SELECT field, code, coalesce(old.label, new.label) AS label FROM old FULL JOIN new USING (field, code)""",
)
def stable_dictionary(spark, sf):
    """First run knows the small parts, the second all of them under other names."""
    part = table(spark, sf, "part").select(F.col("p_brand").alias("field"), F.col("p_type").alias("code"), "p_name", "p_size")
    old = part.filter("p_size <= 25").groupBy("field", "code").agg(F.min("p_name").alias("label"))
    return S.stable_dictionary(old, part.groupBy("field", "code").agg(F.max("p_name").alias("label")))


@register(
    "R07_explode_history",
    """SELECT o_orderkey, 'status' AS property, o_orderstatus AS value, o_orderdate AS at FROM orders
UNION ALL SELECT o_orderkey, 'status', 'P', o_orderdate - INTERVAL 1 DAY FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, 'priority', o_orderpriority, o_orderdate FROM orders""",
)
def explode_history(spark, sf):
    """Status with one change or two, priority with one, and a property without changes."""
    change = "named_struct('value', {}, 'at', {})"
    last = change.format("o_orderstatus", "o_orderdate")
    before = change.format("'P'", "o_orderdate - INTERVAL 1 DAY")
    priority = change.format("o_orderpriority", "o_orderdate")
    none = f"filter(array({priority}), x -> false)"
    nested = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"map('status', IF(o_orderstatus <> 'P', array({before}, {last}), array({last})), "
        f"'priority', array({priority}), 'none', {none}) AS history",
    )
    return S.explode_history(nested, ["o_orderkey"], "history")


@register(
    "R08_unnest_series",
    """WITH l AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents)
SELECT doc_id, source, 'lines' AS period, unnest(range(len(lines))) AS step_index, unnest(lines) AS line,
  length(unnest(lines))::INT AS n FROM l""",
)
def unnest_series(spark, sf):
    nested = table(spark, sf, "documents").selectExpr(
        "doc_id", "source", "transform(split(text, '\\\\n'), l -> named_struct('line', l, 'n', length(l))) AS series"
    )
    return S.unnest_series(nested, ["doc_id", "source"], "series", "lines")


@register(
    "R08_unnest_breakdown",
    """WITH l AS (SELECT doc_id, n_chars, text, list_filter(string_split(text, chr(10)), lambda x: length(x) > 400) AS long FROM documents)
SELECT doc_id, 'line' AS kind, unnest(long) AS body FROM l
UNION ALL SELECT doc_id, 'whole', text FROM l WHERE len(long) = 0""",
)
def unnest_breakdown(spark, sf):
    """Documents broken down into their long lines, or whole where they have none."""
    nested = table(spark, sf, "documents").selectExpr(
        "doc_id", "named_struct('kind', 'whole', 'body', text) AS own",
        "transform(filter(split(text, '\\\\n'), l -> length(l) > 400), l -> named_struct('kind', 'line', 'body', l)) AS parts",
    )
    return S.unnest_breakdown(nested, ["doc_id"], F.col("own"), "parts")


@register(
    "R09_map_to_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, 'extendedprice' AS name, CAST(1.0 AS DOUBLE) AS rate FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'tax', l_tax FROM lineitem""",
)
def map_to_rows(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    rates = table(spark, sf, "lineitem").selectExpr(*keys, "map('discount', l_discount, 'tax', l_tax) AS rates")
    return S.map_to_rows(rates, keys, "rates", ("name", "rate"), F.lit("extendedprice"))


@register(
    "R09_wide_to_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, 'l_discount' AS name, l_discount AS rate FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', l_tax FROM lineitem""",
)
def wide_to_rows(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    wide = table(spark, sf, "lineitem").select(*keys, "l_discount", "l_tax")
    return S.wide_to_rows(wide, keys, ["l_discount", "l_tax"], ("name", "rate"))


@register(
    "R10_rollup_nested",
    """WITH l AS (SELECT doc_id, lang, source, string_split(text, chr(10)) AS lines FROM documents),
x AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM l),
s AS (SELECT doc_id, sum(length(line)) AS chars, sum(len(string_split(line, ' '))) AS words,
  sum(CASE WHEN length(line) > 100 THEN length(line) ELSE 0 END) AS cents,
  string_agg(CASE WHEN length(line) > 100 THEN 'long' ELSE 'short' END, ',' ORDER BY i) FILTER (line <> '') AS models
  FROM x GROUP BY 1)
SELECT doc_id, chars::BIGINT AS total_input_tokens, words::BIGINT AS total_output_tokens,
  0::BIGINT AS total_cache_read_tokens, 0::BIGINT AS total_cache_creation_tokens,
  cents::BIGINT AS total_estimated_cost_cents, models AS models_used,
  CASE WHEN lang = 'en' THEN 'user_actor' ELSE 'api_actor' END AS actor_type,
  CASE WHEN lang = 'en' THEN source || '@example.com' ELSE lang || '-key' END AS actor_id
FROM s JOIN documents USING (doc_id)""",
)
def rollup_nested(spark, sf):
    """Lines as usage entries: characters in, words out, cost in dollars for long lines."""
    entry = """named_struct('model', CASE WHEN l = '' THEN '' WHEN length(l) > 100 THEN 'long' ELSE 'short' END,
      'tokens', named_struct('input', length(l), 'output', size(split(l, ' '))),
      'estimated_cost', named_struct('currency', IF(length(l) > 100, 'USD', 'EUR'), 'amount', length(l)))"""
    actor = """named_struct('type', IF(lang = 'en', 'user_actor', 'api_actor'),
      'email_address', concat(source, '@example.com'), 'api_key_name', concat(lang, '-key'))"""
    nested = table(spark, sf, "documents").selectExpr(
        "doc_id", f"transform(split(text, '\\\\n'), l -> {entry}) AS model_breakdown", f"{actor} AS actor"
    )
    return S.rollup_nested(nested)


@register(
    "R11_join_lists",
    "SELECT doc_id, array_to_string(string_split(text, ' '), ',') AS words FROM documents",
)
def join_lists(spark, sf):
    return S.join_lists(table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words")))


@register(
    "R12_fill_missing_keys",
    """SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), 'no_quality') AS quality,
  CASE WHEN trim(source) = '' OR source IS NULL THEN '-' ELSE trim(source) END AS source, 'no_campaign_id' AS campaign_id
FROM documents d LEFT JOIN labels USING (doc_id)""",
)
def fill_missing_keys(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    raw = docs.select("doc_id", "quality", "source")
    return S.fill_missing_keys(raw, {"quality": "no_quality", "source": "-", "campaign_id": "no_campaign_id"})


@register(
    "R13_type_report",
    """SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS date, date_trunc('hour', ts) AS "dateHour",
  date_trunc('minute', ts) AS "dateHourMinute", user_id AS users, value AS score, event_type AS label FROM events""",
)
def type_report(spark, sf):
    text = table(spark, sf, "events").selectExpr(
        "event_id", "date_format(ts, 'yyyyMMdd') AS date", "date_format(ts, 'yyyyMMddHH') AS dateHour",
        "date_format(ts, 'yyyyMMddHHmm') AS dateHourMinute", "CAST(user_id AS STRING) AS users",
        "CAST(value AS STRING) AS score", "event_type AS label",
    )
    return S.type_report(text, {"users": "int", "score": "float", "label": "string"})


@register(
    "R14_epoch_to_time",
    """SELECT event_id, date_trunc('second', ts) AS s, date_trunc('milliseconds', ts) AS ms,
  CASE WHEN event_type = 'click' THEN date_trunc('milliseconds', ts) ELSE date_trunc('second', ts) END AS mixed,
  strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso FROM events""",
)
def epoch_to_time(spark, sf):
    micros = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"
    raw = table(spark, sf, "events").selectExpr(
        "event_id", f"{micros} div 1000000 AS s", f"{micros} div 1000 AS ms",
        f"IF(event_type = 'click', {micros} div 1000, {micros} div 1000000) AS mixed", f"{micros} div 1000 AS iso",
    )
    out = S.epoch_to_time(S.epoch_to_time(raw, ["s"], "s"), ["ms"], "ms")
    return S.epoch_to_time(S.epoch_to_time(out, ["mixed"]), ["iso"], "ms", as_text=True)


REPAIRED = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1970-01-01 00:00:00'
  WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderdate END AS opened,
  CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT' THEN 'soon' END AS opened__v_text FROM orders"""


@register("R15_repair_dates", REPAIRED)
def repair_dates(spark, sf):
    """Zero dates, blanks, words, and four ways to write a date."""
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderstatus = 'P' THEN '0000-00-00 00:00:00' WHEN o_orderpriority = '5-LOW' THEN 'null'
        WHEN o_orderpriority = '1-URGENT' THEN 'soon' WHEN o_orderpriority = '2-HIGH' THEN date_format(o_orderdate, 'yyyy/MM/dd')
        WHEN o_orderpriority = '3-MEDIUM' THEN date_format(o_orderdate, 'yyyy/MM/dd HH:mm:ss')
        WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, 'yyyy-MM-dd')
        ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END AS opened""",
    )
    return S.repair_dates(raw, ["opened"])


@register(
    "R16_scale_micros",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_extendedprice * 1000000) AS BIGINT) / 1000000 AS spend FROM lineitem",
)
def scale_micros(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "CAST(round(l_extendedprice * 1000000) AS BIGINT) AS spend"
    )
    return S.scale_micros(raw, ["spend"])


@register(
    "R17_conform_record",
    """SELECT o_orderkey AS id, round_even(o_totalprice / 7, 4) AS share, NULLIF(o_orderstatus, 'P') AS status,
  '["' || o_orderpriority || '"]' AS tags FROM orders""",
)
def conform_record(spark, sf):
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "o_totalprice / 7 AS share", "IF(o_orderstatus = 'P', '', o_orderstatus) AS status",
        "o_orderpriority AS tags", "o_custkey AS unasked",
    )
    out = S.conform_record(raw, {"share": "float", "status": "text", "tags": "json"})
    return out.withColumn("tags", F.to_json("tags"))


@register(
    "R18_report_period",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate + INTERVAL 6 DAY AS DATE) AS end_date,
  CASE WHEN o_orderstatus = 'P' THEN '["' || o_orderpriority || '","P"]' ELSE o_orderpriority END AS campaign FROM orders""",
)
def report_period(spark, sf):
    part = "named_struct('year', year({0}), 'month', month({0}), 'day', day({0}))"
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"named_struct('start', {part.format('o_orderdate')}, 'end', {part.format('(o_orderdate + INTERVAL 6 DAYS)')}) AS dateRange",
        "IF(o_orderstatus = 'P', array(o_orderpriority, 'P'), array(o_orderpriority)) AS pivotValues",
    )
    return S.report_period(raw, "campaign", daily=False)


@register(
    "R19_group_flow",
    """SELECT event_type AS entity, ts AS timestamp, '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS payload FROM events""",
)
def group_flow(spark, sf):
    """The mixed stream is routed to a table per entity and read back from all of them."""
    from ..sinks.files import route_tables

    flow = S.group_flow(table(spark, sf, "events").select("event_type", "ts", "event_id", "user_id"), "event_type", "ts")
    path = scratch_path(spark, "flow")
    route_tables(flow, "entity", path)
    return spark.read.parquet(path).drop("_route")


@register(
    "R20_standardize_headers",
    """SELECT l_orderkey AS order_key, l_quantity AS ad_quantity, l_tax AS ecpi, CAST(NULL AS DOUBLE) AS roi FROM lineitem""",
)
def standardize_headers(spark, sf):
    raw = table(spark, sf, "lineitem").selectExpr("l_orderkey AS `Order Key`", "l_quantity AS `Ad Quantity`", "l_tax AS `eCP-I`")
    return S.standardize_headers(raw, {"ecpi": "double", "roi": "double"})


@register(
    "R21_fan_out",
    """SELECT l.*, o_custkey AS parent_o_custkey, o_orderdate AS parent_o_orderdate FROM lineitem l JOIN orders ON o_orderkey = l_orderkey""",
)
def fan_out(spark, sf):
    return M.fan_out(
        table(spark, sf, "orders"), table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey", ["o_custkey", "o_orderdate"]
    )


@register(
    "R22_explode_changelog",
    """SELECT o_orderkey, o_orderdate AS created, 'status' AS field, 'P' AS "from", o_orderstatus AS "to" FROM orders
UNION ALL SELECT o_orderkey, o_orderdate, 'priority', NULL, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY, 'priority', o_orderpriority, 'done' FROM orders""",
)
def explode_changelog(spark, sf):
    item = "named_struct('field', {}, 'from', {}, 'to', {})"
    status = item.format("'status'", "'P'", "o_orderstatus")
    opened = item.format("'priority'", "CAST(NULL AS STRING)", "o_orderpriority")
    done = item.format("'priority'", "o_orderpriority", "'done'")
    nested = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        f"array(named_struct('created', o_orderdate, 'items', array({status}, {opened})), "
        f"named_struct('created', o_orderdate + INTERVAL 1 DAY, 'items', array({done}))) AS histories",
    )
    return S.explode_changelog(nested, "o_orderkey")


@register(
    "R24_drop_compound_fields",
    """SELECT s_suppkey AS "Id", s_name AS "Name", s_name AS "FirstName", s_nationkey AS "BillingNation" FROM supplier""",
)
def drop_compound_fields(spark, sf):
    raw = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS Id", "s_name AS Name", "s_name AS FirstName", "s_nationkey AS BillingNation",
        "named_struct('nation', s_nationkey) AS BillingAddress", "named_struct('type', 'Account') AS attributes",
    )
    return S.drop_compound_fields(raw, {"BillingAddress": ["BillingNation"], "Name": ["FirstName"]})


@register(
    "R25_stamp_constants",
    "SELECT s_suppkey, DATE '2024-05-01' AS report_date, 'supplier' AS type FROM supplier",
)
def stamp_constants(spark, sf):
    return S.stamp_constants(table(spark, sf, "supplier").select("s_suppkey"), report_date=dt.date(2024, 5, 1), type="supplier")


@register(
    "R26_flatten_contact",
    """SELECT c_custkey AS id, n_name AS location_country, CAST(NULL AS VARCHAR) AS location_region, c_mktsegment AS location_city,
  CASE WHEN c_acctbal > 0 THEN 'acme,' || c_nationkey ELSE 'acme' END AS company_ids,
  CAST(2 AS BIGINT) AS companies_count, '{}' AS custom_attributes
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def flatten_contact(spark, sf):
    """A second company without an id counts, but has no id to list."""
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    raw = joined.selectExpr(
        "c_custkey AS id", "named_struct('country', n_name, 'city', c_mktsegment) AS location",
        "named_struct('data', array(named_struct('id', 'acme'), named_struct('id', IF(c_acctbal > 0, CAST(c_nationkey AS STRING), NULL)))) AS companies",
    )
    out = S.join_lists(S.flatten_contact(raw))
    return out.withColumn("custom_attributes", F.to_json("custom_attributes"))


@register(
    "R27_extract_paths",
    """SELECT l_orderkey AS line_order, l_partkey AS line_part_id, l_returnflag AS line_type, CAST(NULL AS VARCHAR) AS line_none FROM lineitem""",
)
def extract_paths(spark, sf):
    nested = table(spark, sf, "lineitem").selectExpr(
        "named_struct('order', l_orderkey, 'part', named_struct('id', l_partkey), 'type_', l_returnflag) AS line"
    )
    return S.extract_paths(nested, ["line.order", "line.part.id", "line.type", "line.none"])


@register("R27_extract_json_paths", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def extract_json_paths(spark, sf):
    return S.extract_json_paths(table(spark, sf, "events").select("event_id", "props"), "props", {"k": "$.k"}).drop("props")


@register(
    "R29_parse_time_fields",
    """SELECT event_id, ts AS created_at, CAST(ts AS VARCHAR) AS note, ts - INTERVAL 1 HOUR AS inner_at,
  date_trunc('second', ts) AS first_at FROM events""",
)
def parse_time_fields(spark, sf):
    """Times at the top, in an object and in a list of objects; the same text elsewhere stays text."""
    text = "CAST({} AS STRING)"
    nested = table(spark, sf, "events").selectExpr(
        "event_id", f"{text.format('ts')} AS created_at", f"{text.format('ts')} AS note",
        f"named_struct('updated_at', {text.format('ts - INTERVAL 1 HOUR')}) AS inner",
        """array(named_struct('created_at', concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z'))) AS list""",
    )
    parsed = S.parse_time_fields(nested, ["created_at", "updated_at"])
    return parsed.selectExpr("event_id", "created_at", "note", "inner.updated_at AS inner_at", "list[0].created_at AS first_at")


@register(
    "R30_cohort_available",
    """SELECT event_id, CAST(ts AS DATE) AS day,
  CASE WHEN DATE '2024-01-31' - CAST(ts AS DATE) > 1 THEN value END AS cohort_day_1,
  CASE WHEN DATE '2024-01-31' - CAST(ts AS DATE) > 7 THEN value END AS cohort_day_7 FROM events""",
)
def cohort_available(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", "to_date(ts) AS day", "value AS cohort_day_1", "value AS cohort_day_7")
    return S.cohort_available(raw, "day", dt.date(2024, 1, 31))


@register(
    "R31_partition_date", "SELECT event_id, CAST(ts AS DATE) AS partition_dt, 'android' AS platform FROM events"
)
def partition_date(spark, sf):
    raw = table(spark, sf, "events").selectExpr(
        "event_id", "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) div 1000 AS ended_at"
    )
    return S.partition_date(raw, "ended_at", "android", "ms").drop("ended_at")


@register(
    "R32_lift_properties",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id AS distinct_id, event_type AS city,
  '{"city":"plain"}' AS __other FROM events""",
)
def lift_properties(spark, sf):
    """Properties with and without a dollar sign; the one with it wins."""
    props = """to_json(map('k', get_json_object(props, '$.k'), '$distinct_id', CAST(user_id AS STRING),
      '$city', event_type, 'city', 'plain'))"""
    raw = table(spark, sf, "events").selectExpr("event_id", f"{props} AS properties")
    return S.lift_properties(raw, "properties", {"k": "bigint", "distinct_id": "bigint", "city": "string"})


@register(
    "R32_open_properties",
    """SELECT event_id, CASE event_type WHEN 'view' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
  event_type AS city, CASE event_type WHEN 'view' THEN '{"k":"many"}' END AS __other FROM events""",
)
def open_properties(spark, sf):
    """Properties found in the data; of one, some values are not of its type."""
    props = """to_json(map('k', IF(event_type = 'view', 'many', get_json_object(props, '$.k')), '$city', event_type))"""
    raw = table(spark, sf, "events").selectExpr("event_id", f"{props} AS properties")
    names = S.names_of(S.found_properties(raw, "properties"), "property")
    return S.lift_properties(raw, "properties", {n: "bigint" if n == "k" else "string" for n in names})


@register(
    "R33_map_values_to_rows",
    """SELECT event_id AS id, ts AS at, value FROM events
UNION ALL SELECT event_id, NULL, value * 2 FROM events""",
)
def map_values_to_rows(spark, sf):
    entry = "named_struct('id', event_id, 'at', {}, 'value', {})"
    nested = table(spark, sf, "events").selectExpr(
        f"map('a', {entry.format('CAST(ts AS STRING)', 'value')}, 'b', {entry.format(repr(' '), 'value * 2')}) AS orders"
    )
    return S.map_values_to_rows(nested, "orders", ["at"])


@register(
    "R34_link_rows",
    """SELECT DISTINCT 'part' AS kind, l_orderkey, l_partkey AS other_id FROM lineitem
UNION ALL SELECT DISTINCT 'supplier', l_orderkey, l_suppkey FROM lineitem""",
)
def link_rows(spark, sf):
    """Links stated twice, as both sides of an association often do."""
    raw = table(spark, sf, "lineitem").selectExpr("l_orderkey", "array(l_partkey, l_partkey) AS parts", "array(l_suppkey) AS suppliers")
    return S.link_table(raw, "l_orderkey", {"part": "parts", "supplier": "suppliers"})


@register(
    "R36_promote_key", "SELECT o_orderkey AS id, o_orderdate AS lastupdatedtime, o_totalprice AS \"Total\" FROM orders"
)
def promote_key(spark, sf):
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS Id", "named_struct('LastUpdatedTime', o_orderdate) AS MetaData", "o_totalprice AS Total"
    )
    return S.promote_key(raw, {"Id": "id", "MetaData.LastUpdatedTime": "lastupdatedtime"}, drop=["MetaData"])


@register(
    "R10_usage_records",
    """SELECT CAST(o_orderdate AS VARCHAR) AS bucket, '' AS api_key_id, o_orderpriority AS workspace_id, '' AS model, '' AS service_tier,
  '' AS context_window, CAST(o_custkey AS BIGINT) AS uncached_input_tokens, 0 AS cached_input_tokens, 0 AS cache_creation_tokens,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END AS output_tokens, 0 AS web_search_usage, 0 AS code_execution_usage FROM orders""",
)
def usage_records(spark, sf):
    """Counts below objects of which some are missing."""
    raw = table(spark, sf, "orders").selectExpr(
        "CAST(o_orderdate AS STRING) AS bucket", "o_orderpriority AS workspace_id",
        "named_struct('uncached_input_tokens', o_custkey, 'output_tokens', IF(o_orderstatus = 'P', null, o_orderkey)) AS tokens",
    )
    return S.lift_fields(raw, S.USAGE_FIELDS, only=True)


@register(
    "R10_activity_records",
    """SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS num_sessions, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_orderkey END AS lines_added,
  0 AS lines_removed, o_custkey AS edit_accepted, 0::BIGINT AS edit_rejected, 0::BIGINT AS write_accepted, o_orderkey AS write_rejected FROM orders""",
)
def activity_records(spark, sf):
    """Core metrics two levels down, and the accepted and rejected actions of each tool."""
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "named_struct('num_sessions', o_custkey, 'lines_of_code', named_struct('added', IF(o_orderstatus = 'O', null, o_orderkey))) AS core_metrics",
        "named_struct('edit', named_struct('accepted', o_custkey), 'write', named_struct('rejected', o_orderkey, 'accepted', CAST(null AS BIGINT))) AS tool_actions",
    )
    return S.spread_actions(S.lift_fields(raw, S.ACTIVITY_FIELDS, drop=["core_metrics"]), "tool_actions")


@register(
    "R26_conversations",
    """SELECT c_custkey, c_name AS first_contact_reply_at, CAST(NULL AS VARCHAR) AS first_admin_reply_at, CAST(NULL AS VARCHAR) AS last_contact_reply_at,
  CAST(NULL AS VARCHAR) AS last_admin_reply_at, CAST(NULL AS VARCHAR) AS median_admin_reply_time, c_acctbal AS mean_admin_reply_time,
  CASE WHEN c_nationkey = 1 THEN 0 ELSE c_nationkey END AS conversation_parts_count, CAST(c_custkey AS VARCHAR) AS plan_id, c_mktsegment AS plan_name FROM customer""",
)
def conversations(spark, sf):
    """Statistics, the number of parts and a plan, out of their objects."""
    raw = table(spark, sf, "customer").selectExpr(
        "c_custkey", "named_struct('first_contact_reply_at', c_name, 'mean_admin_reply_time', c_acctbal) AS statistics",
        "named_struct('total_count', IF(c_nationkey = 1, null, c_nationkey)) AS conversation_parts",
        "named_struct('id', CAST(c_custkey AS STRING), 'name', c_mktsegment) AS plan",
    )
    lifted = S.lift_fields(raw, S.CONVERSATION_FIELDS, drop=["statistics", "conversation_parts"])
    return S.lift_fields(lifted, S.PLAN_FIELDS, drop=["plan"])
