"""Format scans. The given tables are written out in each format, whole, and read back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.normalize import apply_column_types
from ..session import scratch_path
from ..sources import columnar, delimited, documents, extended, grids, jsonfiles, listing, markup, repair
from .common import register, table


def bracketed(lines: DataFrame, first: str, between: str, last: str) -> DataFrame:
    """Lines of each partition with something before, between and after them."""

    def wrap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [first]})
        opened = False
        for batch in batches:
            values = batch["value"].tolist()
            if values:
                head = values[0] if not opened else between + values[0]
                opened = True
                yield pd.DataFrame({"value": [head, *[between + v for v in values[1:]]]})
        yield pd.DataFrame({"value": [last]})

    return lines.mapInPandas(wrap, "value string")




@register(
    "S01_scan_csv",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def scan_csv(spark, sf):
    """Two kinds of files in one folder, their shared columns in different places."""
    path = scratch_path(spark, "csv")
    customers = table(spark, sf, "customer").selectExpr("c_custkey id", "c_name name", "c_mktsegment segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_acctbal balance", "s_name name", "s_suppkey id")
    customers.write.csv(path, header=True)
    suppliers.write.mode("append").csv(path, header=True)
    rows = delimited.scan_csv(spark, path)
    return apply_column_types(rows, {"id": "bigint", "balance": "double"}, on_unfit="raise")


@register(
    "S02_scan_csv_headless",
    """SELECT CAST(l_orderkey AS VARCHAR) AS unknown_col_0, l_returnflag AS unknown_col_1, CAST(l_linenumber AS VARCHAR) AS unknown_col_2
FROM lineitem""",
)
def scan_csv_headless(spark, sf):
    path = scratch_path(spark, "headless")
    table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber").write.csv(path)
    return delimited.scan_csv_headless(spark, path)


@register("S03_scan_csv_sniffed", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def scan_csv_sniffed(spark, sf):
    path = scratch_path(spark, "sniffed")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    orders.write.csv(path, header=True, sep=";")
    return delimited.scan_csv_sniffed(spark, path).withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@register(
    "S04_clean_csv_rows",
    """SELECT CAST(doc_id AS VARCHAR) AS id, lang, CAST(quality AS VARCHAR) AS quality FROM documents JOIN labels USING (doc_id)""",
)
def clean_csv_rows(spark, sf):
    """Documents without labels leave rows of blanks, which go."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    has = F.col("quality").isNotNull()
    raw = docs.select(
        F.when(has, F.col("doc_id").cast("string")).otherwise("  ").alias("id"),
        F.when(has, F.col("lang")).otherwise("").alias("lang"),
        F.col("quality").cast("string").alias("quality"),
    )
    return delimited.clean_csv_rows(raw)


@register(
    "S05_scan_json",
    """SELECT 'lines' AS shape, event_id AS id, event_type AS kind FROM events
UNION ALL SELECT 'array', o_orderkey, o_orderstatus FROM orders
UNION ALL SELECT 'object', r_regionkey, r_name FROM region""",
)
def scan_json(spark, sf):
    """Lines, arrays and one object per file, all with the same ending."""
    path = scratch_path(spark, "json")
    shapes = {
        "lines": table(spark, sf, "events").selectExpr("'lines' shape", "event_id id", "event_type kind"),
        "array": table(spark, sf, "orders").selectExpr("'array' shape", "o_orderkey id", "o_orderstatus kind"),
        "object": table(spark, sf, "region").selectExpr("'object' shape", "CAST(r_regionkey AS BIGINT) id", "r_name kind"),
    }
    shapes["lines"].write.json(path)
    text = F.to_json(F.struct("shape", "id", "kind")).alias("value")
    bracketed(shapes["array"].select(text), "[", ",", "]").write.mode("append").text(path)
    # One object in each file, over several lines.
    pretty = F.concat(F.lit("{\n"), F.expr("substr(value, 2)")).alias("value")
    single = shapes["object"].select(text).select(pretty)
    single.repartitionByRange(64, "value").write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return jsonfiles.scan_json(spark, path, "shape string, id long, kind string")


@register("S06_scan_jsonl", "SELECT event_id, user_id, event_type, value FROM events")
def scan_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "value").write.json(path)
    return jsonfiles.scan_jsonl(spark, path, "event_id long, user_id long, event_type string, value double")


@register(
    "S07_scan_parquet",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def scan_parquet(spark, sf):
    path = scratch_path(spark, "parquet")
    table(spark, sf, "customer").selectExpr("c_custkey id", "c_name name", "c_mktsegment segment").write.parquet(path)
    table(spark, sf, "supplier").selectExpr("s_suppkey id", "s_name name", "s_acctbal balance").write.mode("append").parquet(path)
    return columnar.scan_parquet(spark, path).select("id", "name", "segment", "balance")


@register(
    "S08_scan_xml",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS note,
  o_orderpriority || '+' || CAST(o_custkey AS VARCHAR) AS tags FROM orders""",
)
def scan_xml(spark, sf):
    """Attributes, repeated tags, empty elements, a namespace prefix and text with spaces around."""
    path = scratch_path(spark, "xml")
    line = """concat('<x:order id="', o_orderkey, '"><status> ', o_orderstatus, ' </status><note>',
      IF(o_orderstatus = 'P', '', o_orderpriority), '</note><tag>', o_orderpriority, '</tag><tag>', o_custkey, '</tag></x:order>') AS value"""
    orders = table(spark, sf, "orders").selectExpr(line)
    bracketed(orders, '<orders xmlns:x="http://example.com/x">', "", "</orders>").write.text(path)
    rows = markup.scan_xml(spark, path, "order", "`@id` string, status string, note string, tag array<string>")
    return rows.select(F.col("@id").alias("id"), "status", "note", F.array_join("tag", "+").alias("tags"))


@register(
    "S10_grid_to_table",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "Order", CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS col_2,
  CAST(o_orderdate AS DATE) AS "Day", o_orderdate + INTERVAL 12 HOUR AS "Noon" FROM orders""",
)
def grid_to_table(spark, sf):
    """A blank row on top, a blank column at the left, a column without a header, day numbers as dates."""
    day = "datediff(o_orderdate, DATE '1970-01-01') + 25569"
    orders = table(spark, sf, "orders")
    body = orders.selectExpr(
        "o_orderkey + 2 AS row_no",
        f"array('', CAST(o_orderkey AS STRING), IF(o_orderstatus = 'P', '', o_orderstatus), CAST({day} AS STRING), CAST({day} + 0.5 AS STRING), 'beyond') AS cells",
    )
    head = spark.createDataFrame(
        [(0, ["", ""]), (1, ["", "Order", None, "Day", "Noon"])], "row_no long, cells array<string>"
    )
    return grids.grid_to_table(head.unionByName(body), [None, None, "DATE", "DATE_TIME"])


@register(
    "S10_sheet_rows",
    """SELECT event_id AS _row_id, event_type AS "Kind", CAST(ts AS DATE) AS "Day", user_id > 75 AS "Late" FROM events""",
)
def sheet_rows(spark, sf):
    grid = table(spark, sf, "events").selectExpr(
        "event_id AS row_no", "array(event_type, date_format(ts, 'yyyy-MM-dd'), CAST(user_id > 75 AS STRING)) AS cells"
    )
    return grids.sheet_rows(grid, ["Kind", "Day", "Late"], {"Day": "DATE", "Late": "CHECKBOX", "Kind": "TEXT_NUMBER"})


@register(
    "S11_list_files",
    """SELECT 'o_orderpriority=' || o_orderpriority AS folder, 'application/vnd.apache.parquet' AS mime_type, true AS sized
FROM orders GROUP BY 1""",
)
def list_files(spark, sf):
    """Folders of the files of a partitioned dataset, found by a recursive glob."""
    path = scratch_path(spark, "listed")
    table(spark, sf, "orders").write.partitionBy("o_orderpriority").parquet(path)
    files = listing.list_files(spark, path, "*.parquet", recursive=True)
    folder = F.regexp_extract(F.url_decode("relative_path"), "^([^/]+)/", 1).alias("folder")
    return files.select(folder, "mime_type", (F.col("size_in_bytes") > 0).alias("sized")).distinct()


@register(
    "S15_repair_source_types",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1970-01-01 00:00:00' ELSE o_orderdate END AS created,
  '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS flags, o_custkey AS customer FROM orders""",
)
def repair_source_types(spark, sf):
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "IF(o_orderstatus = 'P', '0000-00-00 00:00:00', CAST(o_orderdate AS STRING)) AS created",
        "concat(o_orderstatus, ',', o_orderpriority) AS flags", "to_json(named_struct('customer', o_custkey)) AS extra",
    )
    fixed = repair.repair_source_types(raw, dates=["created"], sets=["flags"], json=["extra"])
    return fixed.select(
        "o_orderkey", "created", F.to_json("flags").alias("flags"),
        F.variant_get("extra", "$.customer", "bigint").alias("customer"),
    )


@register(
    "S17_find_documents",
    """SELECT doc_id, lang, n_chars FROM documents WHERE lang IN ('en', 'fr') AND n_chars >= 100 AND doc_id >= 10
ORDER BY n_chars DESC, doc_id LIMIT 50""",
)
def find_documents(spark, sf):
    return documents.find_documents(
        table(spark, sf, "documents"),
        filter={"lang": {"in": ["en", "fr"]}, "n_chars": {"gte": 100}},
        cursor={"doc_id": {"gte": 10}},
        include=["lang", "n_chars"],
        sort=[("n_chars", "desc"), ("doc_id", "asc")],
        limit=50,
        primary_key="doc_id",
    )


@register(
    "S18_normalize_extended_json",
    """SELECT CAST(o_orderkey AS VARCHAR) AS _id, CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE o_orderdate END AS at,
  CAST(o_totalprice AS DECIMAL(18, 2)) AS price, o_custkey AS customer_key, o_orderpriority AS pattern, to_base64(encode(o_orderstatus)) AS raw
FROM orders""",
)
def normalize_extended_json(spark, sf):
    """Wrapped ids, dates in two forms, decimals, a nested long, a pattern and binary data."""
    raw = table(spark, sf, "orders").selectExpr(
        """concat('{"_id":{"$oid":"', o_orderkey, '"},"at":', IF(o_orderstatus = 'P',
          concat('{"$date":{"$numberLong":"', unix_millis(CAST(o_orderdate AS TIMESTAMP)), '"}}'),
          concat('{"$date":"', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '"}')),
          ',"price":{"$numberDecimal":"', CAST(o_totalprice AS DECIMAL(18,2)), '"},"customer":{"key":{"$numberLong":"', o_custkey,
          '"}},"pattern":{"$regularExpression":{"pattern":"', o_orderpriority, '","options":"i"}},"raw":{"$binary":{"base64":"',
          base64(CAST(o_orderstatus AS BINARY)), '","subType":"00"}}}') AS value"""
    )
    return jsonfiles.normalize_extended_json(
        raw, "value",
        {"_id": "text", "at": "timestamp", "price": "decimal(18,2)", "customer.key": "bigint", "pattern": "regex", "raw": "binary"},
    )


@register(
    "S18_plain_documents",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '{"_id":"' || o_orderkey || '","items":[{"n":' || o_custkey ||
  ',"at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z","ref":{"$ref":"customer","$id":"' || o_custkey ||
  '"}},{"$minKey":1},{"$code":"f()","$scope":{"x":"' || o_orderpriority || '"}}]}' END AS doc,
  CASE WHEN o_orderstatus = 'P' THEN 'broken ' || o_orderkey END AS __v_text FROM orders""",
)
def plain_documents(spark, sf):
    """Wrapped values in lists and objects below each other, references, keys and code with a scope; and text that is no JSON."""
    raw = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """IF(o_orderstatus = 'P', concat('broken ', o_orderkey), concat('{"_id":{"$oid":"', o_orderkey, '"},"items":[{"n":{"$numberLong":"',
          o_custkey, '"},"at":{"$date":{"$numberLong":"', unix_millis(CAST(o_orderdate AS TIMESTAMP)),
          '"}},"ref":{"$ref":"customer","$id":{"$oid":"', o_custkey, '"}}},{"$minKey":1},{"$code":"f()","$scope":{"x":{"$symbol":"',
          o_orderpriority, '"}}}]}')) AS doc""",
    )
    return extended.plain_documents(raw, "doc")


@register(
    "R27_update_paths",
    """SELECT event_id, '{"k":' || CAST(json_extract_string(props, '$.k') AS BIGINT) || ',"list":[{"a":1,"seen":true},{"a":2,"seen":true}],"new":{"deep":"x"}}' AS doc
FROM events""",
)
def update_paths(spark, sf):
    """Values set in all entries of a list and below names that are not there, and others dropped."""
    raw = table(spark, sf, "events").selectExpr(
        "event_id", """concat('{"k":', get_json_object(props, '$.k'), ',"gone":{"x":1},"list":[{"a":1,"b":[1]},{"a":2}]}') AS doc"""
    )
    return extended.update_paths(raw, "doc", {"$.list[*].seen": True, "$.new.deep": "x"}, drop=["$.gone", "list[*].b"])


@register(
    "R28_stamped_reports",
    """SELECT CAST(ts AS DATE) AS processing_date, CAST(event_id AS VARCHAR) AS event_id, event_type FROM events""",
)
def stamped_reports(spark, sf):
    """A packed TSV file per day, the day in its folder's name."""
    path = scratch_path(spark, "reports")
    rows = table(spark, sf, "events").selectExpr("event_id", "event_type", "to_date(ts) AS day")
    rows.write.partitionBy("day").csv(path, header=True, sep="\t", compression="gzip")
    return delimited.scan_stamped_reports(spark, f"{path}/*", ["event_id", "event_type"])
