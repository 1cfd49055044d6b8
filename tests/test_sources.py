"""Readers on small files written by hand: odd shapes, broken ones, and empty ones."""

import datetime as dt
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import cursors as C
from millrace.operators import maintenance as M
from millrace.session import scratch_path
from millrace.sinks import documents as doc_sink
from millrace.sinks import files as sink
from millrace.sinks import jdbc as jdbc_sink
from millrace.sources import delimited, documents, extended, grids, jdbc, jsonfiles, listing, markup, repair
from millrace.sources.columnar import scan_parquet


@pytest.fixture
def put(tmp_path):
    def write(name, content):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(tmp_path)

    return write


def test_csv_headers_differ(spark, put, rows):
    put("one.csv", "a,b\n1,2\n")
    folder = put("two.csv", "b,c\n3,4\n")
    put("empty.csv", "")
    assert rows(delimited.scan_csv(spark, folder + "/*.csv"), "a", "b", "c") == [("1", "2", None), (None, "3", "4")]


def test_csv_quoted_header_and_bom(spark, put, rows):
    folder = put("q.csv", "﻿\"a,1\",b\nx,y\n".encode("utf-8"))
    frame = delimited.scan_csv(spark, folder + "/q.csv")
    assert frame.columns == ["a,1", "b"] and rows(frame) == [("x", "y")]


def test_headless_names(spark, put, rows):
    put("a-empty.csv", "")
    assert len(delimited.scan_csv_headless(spark, put("h.csv", "1,x\n2,y\n")).columns) == 2
    folder = put("h.csv", "1,x\n2,y\n")
    assert delimited.scan_csv_headless(spark, folder + "/h.csv").columns == ["unknown_col_0", "unknown_col_1"]
    named = delimited.scan_csv_headless(spark, folder + "/h.csv", ["id", "kind"])
    assert rows(named) == [("1", "x"), ("2", "y")]


def test_sniffed(spark, put, rows):
    folder = put("s.csv", "a;b\n1;x\n2;y\n")
    frame = delimited.scan_csv_sniffed(spark, folder + "/s.csv")
    assert frame.schema["a"].dataType == T.IntegerType() and rows(frame) == [(1, "x"), (2, "y")]


def test_blank_rows(spark, rows):
    frame = spark.createDataFrame([("1", " "), (" ", None), ("", "x")], "a string, b string")
    assert rows(delimited.clean_csv_rows(frame)) == [("1", None), (None, "x")]


@pytest.mark.parametrize(
    "content",
    [
        '{"a":1}\n{"a":2}\n', '\n{"a":1}\n\n{"a":2}\n', '[{"a":1},{"a":2}]', '[\n{"a":1},\n{"a":2}\n]', '[{"a":1}\n,{"a":2}]\n',
    ],
)
def test_json_shapes(spark, put, rows, content):
    folder = put("x.json", content)
    assert rows(jsonfiles.scan_json(spark, folder + "/x.json", "a long")) == [(1,), (2,)]


def test_json_object_bom_and_mixture(spark, put, rows):
    put("a.json", "﻿{\n\"a\": 1\n}".encode("utf-8"))
    put("b.json", '{"a":2,"b":"x"}\n{"a":3}')
    folder = put("c.json", "[]")
    assert rows(jsonfiles.scan_json(spark, folder), "a", "b") == [(1, None), (2, "x"), (3, None)]


def test_bom_before_lines(spark, put, rows):
    folder = put("a.json", "﻿{\"a\": 1}\n{\"a\": 2}".encode("utf-8"))
    assert rows(jsonfiles.scan_json(spark, folder, "a long")) == [(1,), (2,)]


def test_broken_json_ends_the_load(spark, put):
    folder = put("x.jsonl", '{"a":1}\n{"a":\n')
    with pytest.raises(Exception):
        jsonfiles.scan_json(spark, folder, "a long").collect()
    with pytest.raises(Exception):
        jsonfiles.scan_jsonl(spark, folder, "a long").collect()


def test_blank_line_in_strict_lines(spark, put):
    folder = put("x.jsonl", '{"a":1}\n\n{"a":2}\n')
    with pytest.raises(Exception, match="blank line"):
        jsonfiles.scan_jsonl(spark, folder, "a long").collect()


def test_missing_path_and_empty_glob(spark, put):
    folder = put("x.csv", "a\n1\n")
    with pytest.raises(FileNotFoundError):
        delimited.scan_csv(spark, folder + "/y.csv")
    assert delimited.scan_csv(spark, folder + "/y*.csv").count() == 0
    assert scan_parquet(spark, folder + "/*.parquet").count() == 0
    assert jsonfiles.scan_json(spark, folder + "/*.json").count() == 0


def test_xml(spark, put):
    folder = put(
        "x.xml",
        """<?xml version="1.0"?><n:items xmlns:n="http://example.com/n">
        <n:item id="1"> lead <name> A </name><tag>x</tag><tag>y</tag><empty/></n:item>
        <n:item id="2"><name>B</name><tag>z</tag><empty>  </empty></n:item></n:items>""",
    )
    got = markup.scan_xml(spark, folder, "item", "`@id` string, name string, tag array<string>, empty string, `#text` string")
    assert [tuple(r) for r in got.orderBy("@id").collect()] == [
        ("1", "A", ["x", "y"], None, "lead"), ("2", "B", ["z"], None, None),
    ]
    with pytest.raises(ValueError):
        markup.scan_xml(spark, folder, "")


def test_xml_nested_row_tags(spark, put):
    folder = put("n.xml", "<r><item><k>outer</k><item><k>inner</k></item></item><item><k>next</k></item></r>")
    got = markup.scan_xml(spark, folder, "item", "k string, item struct<k: string>")
    assert sorted(tuple(r) for r in got.selectExpr("k", "item.k AS inner").collect()) == [("next", None), ("outer", "inner")]


def test_grid(spark, rows):
    grid = spark.createDataFrame(
        [
            (0, []), (1, ["", "Id", None, "When"]), (2, ["", "1", "", "45292"]), (3, ["", "", "", ""]),
            (4, ["", "2", "x", "soon", "beyond"]), (5, ["", "3"]),
        ],
        "row_no long, cells array<string>",
    )
    table = grids.grid_to_table(grid, [None, None, "DATE"])
    assert table.columns == ["Id", "col_2", "When"]
    assert rows(table) == [("1", None, dt.date(2024, 1, 1)), ("2", "x", None), ("3", None, None)]
    clash = spark.createDataFrame([(0, ["A b", "a_B"]), (1, ["1", "2"])], grid.schema)
    with pytest.raises(ValueError):
        grids.grid_to_table(clash)


def test_file_cursor(spark, put, tmp_path, rows):
    for name in ("a.csv", "b.csv"):
        put(name, "x\n1\n")
        os.utime(tmp_path / name, (1_700_000_000, 1_700_000_000))

    def names(frame):
        return [r[0] for r in rows(frame, "file_name")]

    first = listing.list_files(spark, str(tmp_path), "*.csv")
    assert names(C.new_files(first, None, None)) == ["a.csv", "b.csv"]
    state = listing.file_state(first)
    for name, at in (("c.csv", 1_700_000_000), ("d.csv", 1_700_000_500), ("old.csv", 1_600_000_000)):
        put(name, "x\n2\n")
        os.utime(tmp_path / name, (at, at))
    second = listing.list_files(spark, str(tmp_path), "*.csv")
    assert names(C.new_files(second, state["last"], state["seen"])) == ["c.csv", "d.csv"]


def test_file_cursor_key_leaves_credentials_out():
    key = listing.cursor_key("ns", "s3://user:secret@bucket", "*.csv")
    assert key == listing.cursor_key("ns", "s3://bucket", "*.csv") != listing.cursor_key("ns", "s3://other", "*.csv")


def test_listing_reads_no_content(spark, put):
    folder = put("a.csv", "x\n1\n")
    plan = listing.list_files(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_repair(spark):
    raw = spark.createDataFrame([("0000-00-00 00:00:00", "a,b"), ("2024-01-02 03:04:05", ""), (None, None)], "at string, tags string")
    got = repair.repair_source_types(raw, dates=["at"], sets=["tags"]).collect()
    assert [(r["at"], r["tags"]) for r in got] == [
        (dt.datetime(1970, 1, 1), ["a", "b"]), (dt.datetime(2024, 1, 2, 3, 4, 5), []), (None, None),
    ]
    assert repair.repair_source_types(raw, dates=["at"], zero_date="null").first()["at"] is None
    odd = spark.createDataFrame([("no date", "{"), ("2024-01-02", "[1]"), ("0000-00-00", None)], "at string, doc string")
    got = repair.repair_source_types(odd, dates=["at"], json=["doc"]).collect()
    assert [(r["at__v_text"], r["doc__v_text"]) for r in got] == [("no date", "{"), (None, None), (None, None)]


def test_documents(spark, rows):
    frame = spark.createDataFrame([(i, i % 2, "x") for i in range(6)], "_id int, odd int, note string")
    assert documents.find_documents(frame, exclude=["_id", "note"]).columns == ["_id", "odd"]
    assert rows(documents.find_documents(frame, {"odd": {"eq": 1}}, sort=[("_id", "desc")], limit=2), "_id") == [(3,), (5,)]
    with pytest.raises(ValueError):
        documents.find_documents(frame, include=["odd"], exclude=["note"])
    with pytest.raises(ValueError):
        documents.find_documents(frame, {"_id": {"gte": 1}}, {"_id": {"gte": 2}})
    both = documents.find_documents(frame, {"_id": {"lt": 4}}, {"_id": {"gte": 2}})
    assert rows(both, "_id") == [(2,), (3,)]


def test_extended_json(spark):
    text = '{"_id":{"$oid":"abc"},"t":{"$timestamp":{"t":10,"i":1}},"n":5,"d":{"$date":"2024-01-01T00:00:00Z"},"r":{"$regex":"^a"}}'
    frame = spark.createDataFrame([(text,), ('{"_id":7}',)], "doc string")
    kinds = {"_id": "text", "t": "timestamp", "n": "bigint", "d": "timestamp", "r": "regex"}
    got = jsonfiles.normalize_extended_json(frame, "doc", kinds).collect()
    assert tuple(got[0]) == ("abc", dt.datetime(1970, 1, 1, 0, 0, 10), 5, dt.datetime(2024, 1, 1), "^a")
    assert tuple(got[1]) == ("7", None, None, None, None)


EXTENDED = [
    ('{"$oid":"a1"}', "a1"), ('{"$numberDecimal":"1.50"}', "1.50"), ('{"$numberLong":"5000000000"}', 5000000000),
    ('{"$numberInt":"7"}', 7), ('{"$numberDouble":"1.5"}', 1.5), ('{"$numberDouble":"NaN"}', "NaN"),
    ('{"$date":"2024-01-02T00:00:00Z"}', "2024-01-02T00:00:00Z"), ('{"$date":{"$numberLong":"-1"}}', "1969-12-31T23:59:59.999Z"),
    ('{"$date":1000}', "1970-01-01T00:00:01.000Z"), ('{"$timestamp":{"t":10,"i":1}}', "1970-01-01T00:00:10.000Z"),
    ('{"$binary":{"base64":"AAE=","subType":"00"}}', "AAE="), ('{"$binary":"AAE=","$type":"00"}', "AAE="),
    ('{"$regularExpression":{"pattern":"(?<x>a)","options":"i"}}', "(?<x>a)"), ('{"$regex":"^a","$options":"i"}', "^a"),
    ('{"$ref":"c","$id":{"$oid":"9"},"$db":"d"}', {"$ref": "c", "$id": "9", "$db": "d"}),
    ('{"$minKey":1}', {"$minKey": 1}), ('{"$maxKey":1}', {"$maxKey": 1}), ('{"$code":"f()"}', "f()"),
    ('{"$code":"f()","$scope":{"i":{"$oid":"1"}}}', {"$code": "f()", "$scope": {"i": "1"}}), ('{"$undefined":true}', None),
    ('{"a":[{"$oid":"1"},[{"b":{"$symbol":"s"}}]]}', {"a": ["1", [{"b": "s"}]]}), ('{"$oid":"1","more":2}', {"$oid": "1", "more": 2}),
    ("5", 5), ('"x"', "x"), ("null", None), ("[]", []),
]


def test_wrapped_values_at_any_depth(spark):
    import json

    texts = [(i, t) for i, (t, _) in enumerate(EXTENDED)] + [(100, "broken {"), (101, None), (102, '{"a":' * 3000 + "1" + "}" * 3000)]
    got = {r.i: r for r in extended.plain_documents(spark.createDataFrame(texts, "i int, doc string"), "doc").collect()}
    for i, (_, want) in enumerate(EXTENDED):
        assert json.loads(got[i].doc) == want and got[i]["__v_text"] is None
    assert (got[100].doc, got[100]["__v_text"]) == (None, "broken {")
    assert (got[101].doc, got[101]["__v_text"]) == (None, None)
    # Nothing is lost of a document deeper than the reader goes.
    assert (got[102].doc or got[102]["__v_text"]).count("{") == 3000


@pytest.mark.parametrize(
    ("document", "values", "drop", "want"),
    [
        ({"a": 1}, {"$.a": 2}, [], {"a": 2}),
        ({"a": 1}, {"b.c": [1]}, [], {"a": 1, "b": {"c": [1]}}),
        ({"l": [{"x": 1}, {"x": 2}, 3]}, {"$.l[*].x": 0}, [], {"l": [{"x": 0}, {"x": 0}, 3]}),
        ({"l": [1, 2, 3]}, {"l[-1]": 9, "l[5]": 7}, [], {"l": [1, 2, 9]}),
        ({"m": {"p": {"v": 1}, "q": {}}}, {"m.*.v": 5}, [], {"m": {"p": {"v": 5}, "q": {"v": 5}}}),
        ({"a": {"b": 1, "c": 2}, "l": [1, 2]}, {}, ["a.b", "l[0]", "none.x"], {"a": {"c": 2}, "l": [2]}),
        ({"a b": {"c.d": 1}}, {"$['a b']['c.d']": 2}, [], {"a b": {"c.d": 2}}),
        ({"l": [{"x": 1, "y": 2}]}, {}, ["l[*].x", "l[*].z"], {"l": [{"y": 2}]}),
        ({"a": None}, {"a.b": 1}, [], {"a": {"b": 1}}),
    ],
)
def test_updates_by_path(spark, document, values, drop, want):
    import json

    frame = spark.createDataFrame([(json.dumps(document),)], "doc string")
    assert json.loads(extended.update_paths(frame, "doc", values, drop).first().doc) == want


def test_paths_and_documents_that_are_none(spark):
    with pytest.raises(ValueError):
        extended.steps_of("$.a[?(@.x)]")
    with pytest.raises(Exception, match="no JSON"):
        extended.update_paths(spark.createDataFrame([("{",)], "doc string"), "doc", {"a": 1}).collect()


def test_document_keys(spark):
    frame = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    shaped = doc_sink.shape_documents(M.stamp_lineage(frame, "x"))
    ids = [r["_id"] for r in shaped.collect()]
    assert ids[0] == "1" and len(ids[1]) == 36 and "_load_id" not in shaped.columns
    with pytest.raises(Exception, match="without a key"):
        doc_sink.shape_documents(frame, ["id"]).collect()


# Tasks cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Folder:
    """A database of files: what is staged, and collections of which the highest number counts."""

    def __init__(self, path, poison=None):
        self.path, self.poison = path, poison

    def _put(self, folder, documents):
        import json
        import os
        import uuid

        if any(d["_id"] == self.poison for d in documents):
            raise ConnectionError("refused")
        os.makedirs(f"{self.path}/{folder}", exist_ok=True)
        with open(f"{self.path}/{folder}/{uuid.uuid4()}", "w") as file:
            file.write(json.dumps(documents))

    def stage(self, run, documents):
        self._put(f"staged-{run}", documents)

    def upsert(self, documents):
        self._put("live", documents)

    def swap(self, run):
        import os

        if os.path.exists(f"{self.path}/live"):
            os.rename(f"{self.path}/live", f"{self.path}/old-{run}")
        os.rename(f"{self.path}/staged-{run}", f"{self.path}/live")

    def discard(self, run):
        import shutil

        shutil.rmtree(f"{self.path}/staged-{run}", ignore_errors=True)

    def batches(self, folder="live"):
        import json
        from pathlib import Path

        return [json.loads(f.read_text()) for f in Path(f"{self.path}/{folder}").iterdir()]


def test_documents_go_out_in_batches(spark, tmp_path):
    client = Folder(str(tmp_path))
    frame = spark.range(25).selectExpr("CAST(id AS STRING) AS _id", "named_struct('n', id, 'none', CAST(null AS INT)) AS v")
    doc_sink.write_documents(frame.coalesce(1), client, batch_size=10)
    assert sorted(map(len, client.batches())) == [5, 10, 10]
    assert {"_id": "7", "v": {"n": 7, "none": None}} in [d for b in client.batches() for d in b]


def test_a_collection_is_replaced_once_or_not_at_all(spark, tmp_path):
    path = str(tmp_path)
    frame = spark.range(0, 20, 1, 4).selectExpr("CAST(id AS STRING) AS _id")
    doc_sink.write_documents(frame, Folder(path), replace=True)
    assert sum(map(len, Folder(path).batches())) == 20
    with pytest.raises(Exception, match="refused"):
        doc_sink.write_documents(frame.filter("_id <> '3'"), Folder(path, poison="13"), replace=True)
    assert sum(map(len, Folder(path).batches())) == 20
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("staged")]
    doc_sink.write_documents(frame.filter("_id < '2'"), Folder(path), replace=True)
    assert {d["_id"] for b in Folder(path).batches() for d in b} == {"0", "1", *(f"1{i}" for i in range(10))}


def test_a_collection_of_documents(spark):
    store = doc_sink.DocumentStore(spark, scratch_path(spark, "collection"))

    def put(rows, **options):
        store.write(spark.createDataFrame(rows, "_id string, v int"), "x", **options)

    put([("a", 1), ("b", 1), ("b", 1)], replace=True, parts=2)
    put([("b", 2), ("c", 2)])
    put([("b", 2), ("c", 2)])
    assert sorted(map(tuple, store.read("_id string, v int").collect())) == [("a", 1), ("b", 2), ("c", 2)]
    store.write(spark.createDataFrame([("b", "text", 1.5)], "_id string, v string, w double"), "x")
    assert store.read().filter("_id = 'b'").first().document == '{"_id":"b","v":"text","w":1.5}'
    broken = spark.createDataFrame([("z", 1)], "_id string, v int").withColumn("v", F.raise_error(F.lit("died")).cast("int"))
    with pytest.raises(Exception, match="died"):
        store.write(broken, "x", replace=True)
    assert store.read().count() == 3
    put([("q", 1)], replace=True)
    assert [tuple(r) for r in store.read("_id string, v int").collect()] == [("q", 1)]


def test_export(spark, tmp_path):
    one = M.stamp_lineage(spark.createDataFrame([(1, ["x"])], "a int, tags array<string>"), "l")
    two = spark.createDataFrame([(2, "b")], "a int, b string")
    sink.export(one, str(tmp_path / "out"), "csv", [two])
    parts = [p.read_text().splitlines() for p in (tmp_path / "out").iterdir() if p.suffix == ".csv"]
    assert {header for header, *_ in parts} == {"a,tags,b"}
    assert sorted(line for _, *lines in parts for line in lines) == ['1,"[""x""]",', "2,,b"]
    for path, hint in (("x/*.csv", None), ("x.avro", None), ("x.csv", "xls")):
        with pytest.raises(ValueError):
            sink.export(one, path, hint)


def test_jdbc_options():
    chosen = jdbc.jdbc_options("jdbc:x", "s.t", None)
    assert chosen == {"url": "jdbc:x", "fetchsize": "50000", "dbtable": "s.t"}
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", None, None)
    assert jdbc_sink.split_table("a.b.c") == ("a", "b.c")
    assert jdbc_sink.split_table("t", "sqlite") == ("main", "t")
    with pytest.raises(ValueError):
        jdbc_sink.split_table("t", "postgresql")


def test_jdbc_staging():
    assert jdbc_sink.finish_statements("s.t", "s.t__staging", ["a", 'b"c'], replace=True) == [
        "DELETE FROM s.t", 'INSERT INTO s.t ("a", "b""c") SELECT "a", "b""c" FROM s.t__staging',
    ]
    assert len(jdbc_sink.finish_statements("s.t", "x", ["a"], replace=False)) == 1


def test_jdbc_reaches_the_driver(spark):
    """Without a driver the reads and writes get as far as asking for one."""
    url = "jdbc:nosuch://host/db"
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.scan_jdbc(spark, url, "s.t", partition_column="id", bounds=(0, 100), partitions=4)
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.scan_jdbc(spark, url, "s.t", predicates=["id < 5", "id >= 5"])
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc.scan_jdbc_query(spark, url, "SELECT 1")
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc_sink.write_jdbc(spark.range(1), url, "s.t")


def test_csv_at_any_depth_width_and_dialect(spark, tmp_path, rows):
    for name, content in (("a.csv", "x,y\n1,2\n"), ("in/b.csv", "x;y\n3;4\n"), ("in/deep/c.csv", "y\tx\n6\t5\n")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    for path in (str(tmp_path), f"{tmp_path}/**/*.csv"):
        assert rows(delimited.scan_csv_sniffed(spark, path), "x", "y") == [(1, 2), (3, 4), (5, 6)]
    assert delimited.scan_csv(spark, f"{tmp_path}/in").count() == 2
    (tmp_path / "in" / "wide").mkdir()
    (tmp_path / "in" / "wide" / "w.csv").write_text('1,2\n3,"a,b",5\n')
    got = delimited.scan_csv_headless(spark, f"{tmp_path}/in/wide")
    assert rows(got) == [("1", "2", None), ("3", "a,b", "5")]


def test_json_records_beyond_the_first(spark, put, tmp_path, rows):
    put("lists.json", '[{"a":1},{"a":2}]\n[{"a":3}]\n')
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.json").write_text('{\n"a": 4\n}\n')
    assert rows(jsonfiles.scan_json(spark, str(tmp_path), "a int")) == [(1,), (2,), (3,), (4,)]
    (tmp_path / "in" / "two.json").write_text('{\n"a": 4\n}\n{\n"a": 5\n}\n')
    with pytest.raises(Exception, match="after the first JSON document"):
        jsonfiles.scan_json(spark, str(tmp_path), "a int").collect()


def test_the_look_at_first_lines_reads_no_more(spark, put):
    """A task of its own for each file, which ends with the first line: what comes later is not looked at."""
    put("a.csv", "\n \na,b\n" + "1,2\n" * 200_000)
    folder = put("b.csv", "a,b\n1,2\n")
    seen = listing.first_shapes(spark, folder, lambda line: line)
    assert [[f.rsplit("/", 1)[-1] for f in files] for files in seen.values()] == [["a.csv", "b.csv"]]
    assert list(seen) == ["a,b"]


def test_a_large_json_list_is_read_bit_by_bit(spark, put, monkeypatch):
    """No task gets or hands on a text that grows with the file."""
    put("a.json", "[\n" + ",\n".join(f'{{"a":{i},"s":"{"x" * 40}"}}' for i in range(20_000)) + "\n]\n")
    folder = put("b.json", '{\n"a": 20000\n}\n')
    frame = type(spark.range(0))
    plain = frame.mapInArrow

    def bounded(batches):
        for batch in batches:
            longest = max((len(v or "") for v in batch.column("value").to_pylist()), default=0)
            if longest > 1 << 17:
                raise MemoryError(f"a text of {longest} characters")
            yield batch

    def watched(df, task, kind, *rest):
        got = plain(plain(df, bounded, df.schema), task, kind, *rest)
        return plain(got, bounded, kind) if got.columns == ["value"] else got

    monkeypatch.setattr(frame, "mapInArrow", watched)
    got = jsonfiles.scan_json(spark, folder, "a long, s string").selectExpr("count(*)", "sum(a)", "sum(length(s))")
    assert tuple(got.first()) == (20_001, 20_000 * 20_001 // 2, 800_000)


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
@pytest.mark.parametrize(
    "document",
    [
        '\ufeff\n[{\n"a": 1,\n"s": "}, {"\n}, {\n"a": [2,\n{"b": "\\"]"}]\n}\n,\nnull,\n[3\n]\n]\n\n', "[\n]", "[]", "7",
        '{\n"a":\n[1,\n2],\n\n"s": "["\n}\n \n', '[\n{"a":1}, {"a":2},\n{"a":3}, {\n"a":\n4}]', '[\n[]\n,[\n\n]]',
    ],
)
def test_records_of_a_document_in_pieces(document, size):
    """Texts of some lines each give the records that the whole gives, wherever lines end."""
    import json

    lines = document.splitlines(keepends=True)
    texts = ["".join(lines[i : i + size]) + "\n" for i in range(0, len(lines), size)]
    want = json.loads(document.lstrip("\ufeff"))
    got = [json.loads(part) for lists in jsonfiles.records_of("f", iter(texts)) for part in lists]
    assert (sum(got, []) if isinstance(want, list) else got) == (want if isinstance(want, list) else [want])


@pytest.mark.parametrize("size", [1, 1000])
@pytest.mark.parametrize(
    ("document", "message"),
    [
        ('[\n{"a":1},\n{"a":2}\n', "ends within"), ('{\n"a":1\n', "ends within"), ('[\n{"a":1},\n', "ends within"), ('[\n{"a":1\n,', "ends within"),
        ('[\n{"a":1}\n{"a":2}\n]', "no comma"), ('[\n{"a":1},\n]', "Expecting value"), ('[\n,\n]', "Expecting value"),
        ('[\n{"a":"x\ny"}\n]', "control character"), ('[\n{"a":tru}\n]', "Expecting value"), ('[\n]\n]', "after the first"), ('{\n}\n{', "after the first"),
    ],
)
def test_a_broken_document_ends_the_load(document, message, size):
    lines = document.splitlines(keepends=True)
    texts = ["".join(lines[i : i + size]) + "\n" for i in range(0, len(lines), size)]
    with pytest.raises(ValueError, match=f"f: .*{message}"):
        list(jsonfiles.records_of("f", iter(texts)))


def test_first_lines_where_settings_do_not_hold(spark, put, rows, monkeypatch):
    """A session may keep its own sizes of parts: then tasks get parts of files, or several files."""
    put("a.json", "[\n" + ",\n".join(f'{{"a":{i}}}' for i in range(3_000)) + "\n]\n")
    put("b.json", " \n" * 3_000 + "".join(f'{{"a":{i}}}\n' for i in range(3_000, 4_000)))
    for i in range(4_000, 4_010):
        folder = put(f"{i}.json", f'{{\n"a": {i}\n}}\n')
    kind, plain = type(spark.conf), type(spark.conf).set
    for sizes in ({"maxPartitionBytes": "2000", "openCostInBytes": "1"}, {"maxPartitionNum": "2"}):
        settings = {f"spark.sql.files.{key}": value for key, value in sizes.items()}
        before = {key: spark.conf.get(key, None) for key in settings}
        for key, value in settings.items():
            spark.conf.set(key, value)
        monkeypatch.setattr(kind, "set", lambda self, key, value: None if key in settings else plain(self, key, value))
        try:
            got = rows(jsonfiles.scan_json(spark, folder, "a long"))
        finally:
            monkeypatch.undo()
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        assert sorted(got) == [(i,) for i in range(4_010)]
