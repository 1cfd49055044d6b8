"""Shaping, typing and nesting on small records."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import cursors as C
from millrace.operators import normalize as N
from millrace.operators import ranges as R
from millrace.operators import shaping as S


def one(spark, expression, schema=None):
    return spark.sql(f"SELECT {expression}")


def test_flatten_and_lift_refuse_clashes(spark):
    nested = one(spark, "1 AS id, named_struct('b', named_struct('c', 2)) AS a")
    assert S.flatten_struct(nested).columns == ["id", "a_b_c"]
    with pytest.raises(ValueError):
        S.lift(one(spark, "1 AS id, named_struct('id', 2) AS a"), "a")
    with pytest.raises(ValueError):
        S.flatten_struct(one(spark, "1 AS a_b, named_struct('b', 2) AS a"))


def test_collapse_refs(spark):
    frame = one(spark, "named_struct('id', 1, 'x', 2) AS a, named_struct('id', 3) AS b")
    assert S.collapse_refs(frame).columns == ["a_id", "b_id"]
    assert S.collapse_refs(frame, sole_key=True).columns == ["a", "b_id"]


def test_unwrap_keeps_null(spark):
    frame = one(spark, "CAST(NULL AS struct<nodes: array<struct<x: int>>>) AS a, named_struct('nodes', array(1)) AS b")
    assert tuple(S.unwrap_nodes(frame).first()) == (None, [1])


def test_label_bag_types_dates(spark):
    frame = one(spark, "array(named_struct('label','Hire Date','value','2024-01-02T00:00:00Z','type','date')) AS bag")
    got = S.pivot_label_bag(frame, "bag", {"Hire Date": "hire_date", "None": "none"}, dates=["Hire Date"]).first()
    assert tuple(got) == (dt.datetime(2024, 1, 2), None, None)
    assert S.label_name("dynamic_1", "x") == "dynamic_1"


@pytest.mark.parametrize("large", [False, True])
def test_codes_from_a_table(spark, rows, request, large):
    if large:
        request.getfixturevalue("no_broadcast")
    codes = spark.createDataFrame([("1", "one")], "code string, label string")
    frame = spark.createDataFrame([("1",), ("2",), (None,)], "c string")
    assert rows(S.map_codes_from(frame, "c", codes)) == [("2",), ("one",), (None,)]
    assert rows(S.map_codes_from(frame, "c", codes, "null")) == [("one",), (None,), (None,)]


def test_dictionary_keeps_old_labels(spark, rows):
    schema = "field string, code string, label string"
    old = spark.createDataFrame([("f", "1", "old")], schema)
    new = spark.createDataFrame([("f", "1", "renamed"), ("f", "2", "new")], schema)
    assert rows(S.stable_dictionary(old, new)) == [("f", "1", "old"), ("f", "2", "new")]
    assert S.stable_dictionary(None, new) is new


def test_rollup_without_models(spark):
    kind = "array<struct<model: string, tokens: struct<input: int, output: int>, estimated_cost: struct<currency: string, amount: int>>>"
    frame = one(spark, f"1 AS id, CAST(NULL AS {kind}) AS model_breakdown")
    got = S.rollup_nested(frame, actor=None).first()
    assert got.total_input_tokens == 0 and got.models_used is None and got.total_cache_read_tokens == 0


def test_period_by_day(spark):
    frame = one(spark, "named_struct('start', named_struct('year', 2024, 'month', 2, 'day', 29)) AS dateRange, array('x') AS pivotValues")
    assert S.report_period(frame, "p", daily=True).first().asDict() == {"p": "x", "date": dt.date(2024, 2, 29)}


def test_repair_reports_what_is_left(spark, rows):
    frame = spark.createDataFrame([("0000-00-00",), ("2024-13-01",), ("2024/01/02",), ("0",), (None,)], "d string")
    assert rows(S.repair_dates(frame, ["d"]), "d", "d__v_text") == [
        (dt.datetime(1970, 1, 1), None), (dt.datetime(2024, 1, 2), None), (None, "2024-13-01"), (None, None), (None, None),
    ]


@pytest.mark.parametrize(
    ("value", "unit", "expected"),
    [
        (1_700_000_000, "auto", dt.datetime(2023, 11, 14, 22, 13, 20)),
        (1_700_000_000_500, "auto", dt.datetime(2023, 11, 14, 22, 13, 20, 500000)),
        (1.5, "s", dt.datetime(1970, 1, 1, 0, 0, 1, 500000)),
        (0, "ms", dt.datetime(1970, 1, 1)),
    ],
)
def test_epochs(spark, value, unit, expected):
    frame = spark.createDataFrame([(float(value),)], "t double")
    assert S.epoch_to_time(frame, ["t"], unit).first().t == expected


def test_blank_key_parts(spark):
    frame = spark.createDataFrame([("", None)], "a string, b int")
    assert S.fill_missing_keys(frame, {"a": "-", "b": "no_b", "c": "no_c"}).first().asDict() == {"a": "-", "b": "no_b", "c": "no_c"}


def test_profile_properties(spark):
    frame = spark.createDataFrame([("d1", '{"$email":"e","plain":"p"}')], "`$distinct_id` string, props string")
    got = S.lift_properties(frame.withColumn("distinct_id", F.lit(None).cast("string")), "props", {"email": "string", "plain": "string"}, profile=True)
    assert got.first().asDict() == {"$distinct_id": "d1", "distinct_id": "d1", "email": "e", "plain": None, "__other": None}


def test_compounds(spark):
    frame = one(spark, "1 AS Id, 'n' AS Name, 'f' AS FirstName, 'c' AS City, 'a' AS Address, 'z' AS Alone, 1 AS attributes")
    got = S.drop_compound_fields(frame, {"Name": ["FirstName"], "Address": ["City"], "Alone": ["Missing"]})
    assert got.columns == ["Id", "Name", "FirstName", "City", "Alone"]


def test_cohorts(spark):
    frame = one(spark, "DATE '2024-01-01' AS day, 1 AS cohort_day_7, 2 AS cohort_day_8")
    assert tuple(S.cohort_available(frame, "day", dt.date(2024, 1, 9)).first())[1:] == (1, None)


def test_promoted_names_must_not_meet(spark):
    with pytest.raises(ValueError):
        S.promote_key(one(spark, "1 AS Id, 2 AS key"), {"key": "id"})


# ---- types, names, nesting


def test_column_hints():
    assert N.parse_columns("a:bigint, b:decimal(10,2),c:text") == {"a": "bigint", "b": "decimal(10,2)", "c": "string"}
    for bad in ("a", "a:", ":text", "a:varchar"):
        with pytest.raises(ValueError):
            N.parse_columns(bad)


def test_unfit_values(spark, rows):
    frame = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    assert rows(N.apply_column_types(frame, "v:bigint")) == [(1, None), (None, "x"), (None, None)]
    with pytest.raises(Exception, match="does not fit"):
        N.apply_column_types(frame, "v:bigint", on_unfit="raise").collect()


def test_bigdecimal_overflow_raises(spark):
    frame = spark.createDataFrame([(1e30,)], "v double")
    with pytest.raises(Exception, match="does not fit"):
        N.apply_column_types(frame, "v:bigdecimal").collect()


@pytest.mark.parametrize(
    ("name", "expected"),
    [("Customer Key", "customer_key"), ("customerName", "customer_name"), ("HTTPCode", "http_code"), ("a-b (C)", "a_b_c"), ("1st", "_1st")],
)
def test_snake_case(name, expected):
    assert N.snake_case(name) == expected


def test_names_must_not_meet(spark):
    with pytest.raises(ValueError):
        N.normalize_names(one(spark, "1 AS `a b`, 2 AS `a-b`"))
    assert N.normalize_names(one(spark, "1 AS `A b`"), "direct").columns == ["A b"]


lines = st.lists(st.tuples(st.integers(0, 9), st.lists(st.integers(0, 9), max_size=3)), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(documents=st.lists(lines, min_size=1, max_size=5))
def test_shredding_can_be_undone(spark, documents):
    schema = "id int, head struct<n: int>, lines array<struct<q: int, parts array<struct<p: int>>>>".replace("parts array", "parts: array")
    data = [(i, (i,), [(q, [(p,) for p in parts]) for q, parts in doc]) for i, doc in enumerate(documents)]
    tables = N.shred_nested(spark.createDataFrame(data, schema), "d", key=["id"], levels=2)
    parents = {r["_row_id"]: r for r in tables["d"].collect()}
    back = {r["id"]: {} for r in parents.values()}
    line_of = {}
    for r in tables.get("d__lines").collect():
        line_of[r["_row_id"]] = (parents[r["_parent_id"]]["id"], r["_list_idx"])
        back[parents[r["_parent_id"]]["id"]][r["_list_idx"]] = (r["q"], {})
    for r in tables["d__lines__parts"].collect():
        owner, place = line_of[r["_parent_id"]]
        back[owner][place][1][r["_list_idx"]] = r["p"]
    rebuilt = [
        [(q, [parts[j] for j in sorted(parts)]) for q, parts in (back[i][k] for k in sorted(back[i]))] for i in range(len(documents))
    ]
    assert rebuilt == documents
    assert tables["d"].columns == ["id", "head__n", "_row_id"]


def test_last_level_is_json(spark):
    frame = one(spark, "1 AS id, array(named_struct('x', array(named_struct('y', 2)))) AS a")
    tables = N.shred_nested(frame, "t", levels=1)
    assert tables["t__a"].first().x == '[{"y":2}]'
    assert N.shred_nested(frame, "t", levels=0)["t"].first().a == '[{"x":[{"y":2}]}]'


def test_equal_parents_keep_their_own_children(spark):
    frame = one(spark, "'x' AS a, array(1, 2) AS n").union(one(spark, "'x' AS a, array(1, 2) AS n"))
    tables = N.shred_nested(frame, "t", levels=1)
    parents, children = tables["t"].alias("p"), tables["t__n"].alias("c")
    assert parents.select("_row_id").distinct().count() == 2
    joined = parents.join(children, F.col("p._row_id") == F.col("c._parent_id"))
    assert sorted((r._list_idx, r.value) for r in joined.collect()) == [(0, 1), (0, 1), (1, 2), (1, 2)]


def test_children_know_their_root(spark):
    frame = one(spark, "1 AS id, array(named_struct('x', array(array(7, 8)))) AS a")
    tables = N.shred_nested(frame, "t", key=["id"], levels=3)
    root = tables["t"].first()["_row_id"]
    assert set(tables) == {"t", "t__a", "t__a__x", "t__a__x__value"}
    assert {r["_root_id"] for n in tables if n != "t" for r in tables[n].collect()} == {root}
    assert [r.value for r in tables["t__a__x__value"].collect()] == [7, 8]


def nested_tables(spark, path):
    from millrace.sinks.tables import TableGroup

    group = TableGroup(spark, path)
    root = {r["_row_id"]: r.id for r in group.table("t").read().collect()}
    out = {}
    for name in group.names():
        if name != "t":
            out[name] = sorted((root[r["_root_id"]], r["_list_idx"], r["value"]) for r in group.table(name).read().collect())
    return sorted(root.values()), out


def test_nested_records_are_merged_whole(spark):
    from millrace.plans.load import run_load
    from millrace.plans.request import LoadRequest
    from millrace.session import scratch_path

    path = scratch_path(spark, "nested")
    request = LoadRequest(source="db.t", target=path, strategy="merge", primary_key=["id"], nesting=1, buckets=4, incremental_key="at")
    schema = "id int, at int, n array<int>, s array<string>"
    run_load(spark.createDataFrame([(1, 1, [10, 11], ["a"]), (2, 1, [20], []), (3, 1, None, ["c"])], schema), request, "one")
    run_load(spark.createDataFrame([(1, 2, [12], []), (4, 2, [40], None), (2, 0, [99], ["old"])], schema), request, "two")
    ids, children = nested_tables(spark, path)
    assert ids == [1, 2, 3, 4]
    assert children == {"t__n": [(1, 0, 12), (2, 0, 20), (4, 0, 40)], "t__s": [(3, 0, "c")]}
    # Types widen, a kind of list comes in, and one without rows in the batch gives way too.
    run_load(spark.createDataFrame([(3, 3, [5_000_000_000], [1.5])], "id int, at int, n array<bigint>, f array<double>"), request, "three")
    ids, children = nested_tables(spark, path)
    assert children["t__n"] == [(1, 0, 12), (2, 0, 20), (3, 0, 5_000_000_000), (4, 0, 40)]
    assert children["t__f"] == [(3, 0, 1.5)] and "t__s" not in children
    replace = LoadRequest(source="db.t", target=path, strategy="replace", primary_key=["id"], nesting=1)
    run_load(spark.createDataFrame([(9, 1, [1])], "id int, at int, n array<int>"), replace, "four")
    ids, children = nested_tables(spark, path)
    assert ids == [9] and children == {"t__n": [(9, 0, 1)]}


def test_labels_without_a_column_are_kept(spark):
    bag = "array(named_struct('label', 'A', 'value', '1'), named_struct('label', 'A', 'value', '2'), named_struct('label', 'D', 'value', 'no time'), named_struct('label', CAST(null AS STRING), 'value', 'x'))"
    frame = one(spark, f"1 AS id, {bag} AS bag").union(one(spark, f"2 AS id, filter({bag}, x -> false) AS bag"))
    got = {r.id: r for r in S.pivot_label_bag(frame, "bag", {"A": "a", "D": "d"}, dates=["D"]).collect()}
    assert (got[1].a, got[1].d, got[2].a, got[2]["__other"]) == ("1", None, None, None)
    assert got[1]["__other"] == '[{"label":"A","value":"2"},{"label":"D","value":"no time"},{"value":"x"}]'
    known = spark.createDataFrame([("label", "A", "first_name")], "field string, code string, label string")
    assert S.names_of(S.found_labels(frame, "bag", known)) == {"A": "first_name", "D": "d"}


def test_properties_without_a_column_are_kept(spark):
    frame = spark.createDataFrame([('{"a":"1","$b":"x","b":"y","c":null}',), ('{"a":"one"}',), ("broken",), (None,)], "p string")
    got = S.lift_properties(frame, "p", {"a": "int", "b": "string"}).collect()
    assert [(r.a, r.b) for r in got] == [(1, "x"), (None, None), (None, None), (None, None)]
    assert [r["__other"] for r in got] == ['{"b":"y"}', '{"a":"one"}', "broken", None] or [r["__other"] for r in got] == ['{"b":"y","c":null}', '{"a":"one"}', "broken", None]


def test_sibling_records(spark):
    cost = one(spark, "CAST(null AS STRING) AS bucket, 'w' AS workspace_id, 5 AS amount_cents, 'x' AS more")
    assert S.lift_fields(cost, S.COST_FIELDS, only=True).first().asDict() == {"bucket": "", "workspace_id": "w", "description": "", "amount_cents": 5}
    assert S.lift_fields(cost, S.PLAN_FIELDS).first().asDict()["plan_id"] is None
    with pytest.raises(ValueError):
        S.spread_actions(one(spark, "1 AS a_accepted, named_struct('a', named_struct('accepted', 1)) AS t"), "t")


def test_widening(spark, rows):
    small = spark.createDataFrame([(1, 1.5)], "a int, b float")
    large = spark.createDataFrame([(2, 5_000_000_000)], "a bigint, b bigint")
    out = N.evolve(small, large)
    # No number type holds every float and every bigint exactly.
    assert dict(out.dtypes) == {"a": "bigint", "b": "float", "b__v_bigint": "bigint"}
    text = N.evolve(spark.createDataFrame([("x",)], "a string"), spark.createDataFrame([(2,)], "a int"))
    assert rows(text) == [("2",), ("x",)]


# ---- cursors and ranges


def test_bounds(spark, rows):
    frame = spark.createDataFrame([(i,) for i in range(5)], "c int")
    for bounds, expected in {"[]": [1, 2, 3], "[)": [1, 2], "(]": [2, 3], "()": [2]}.items():
        assert [r[0] for r in rows(C.interval_filter(frame, "c", 1, 3, bounds))] == expected
    with pytest.raises(ValueError):
        C.interval_filter(frame, "c", 1, 3, "[[")
    with pytest.raises(ValueError):
        C.interval_filter(frame, "missing", 1)


def test_cursor_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "timestamp_ntz '2024-01-01 00:00:00' AS at").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    plan = C.read_incremental(frame, "at", dt.datetime(2024, 1, 1)).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "ReadSchema: struct<id:bigint,at:timestamp_ntz>" in plan


def test_custom_query_bounds(spark):
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "at timestamp_ntz")
    query = "query:SELECT * FROM t WHERE at >= :interval_start AND at <= :interval_end"
    assert C.custom_query(spark, query, t=frame).count() == 1
    assert C.custom_query(spark, query, start=dt.datetime(2024, 1, 2), t=frame).count() == 0
    with pytest.raises(ValueError):
        C.custom_query(spark, query, limit=3, t=frame)




def test_calendar(spark, rows):
    def ranges(start, end, months):
        return rows(R.calendar_ranges(one(spark, f"DATE '{start}' AS start_at, DATE '{end}' AS end_at"), months))

    day = dt.date
    assert ranges("2023-01-01", "2024-03-01", 6) == [
        (day(2023, 1, 1), day(2023, 7, 1)), (day(2023, 7, 2), day(2024, 1, 2)), (day(2024, 1, 3), day(2024, 3, 1)),
    ]
    assert ranges("2024-08-31", "2025-03-01", 6) == [(day(2024, 8, 31), day(2025, 2, 28)), (day(2025, 3, 1), day(2025, 3, 1))]
    assert ranges("2024-02-29", "2024-02-29", 24) == [(day(2024, 2, 29), day(2024, 2, 29))]
    many = ranges("2000-01-01", "2024-01-01", 1)
    assert many[0][0] == day(2000, 1, 1) and many[-1][1] == day(2024, 1, 1)
    assert all(b[0] - a[1] == dt.timedelta(days=1) for a, b in zip(many, many[1:]))
    with pytest.raises(Exception, match="after end"):
        ranges("2024-01-02", "2024-01-01", 6)


def test_short_interval_is_hourly(spark):
    bounds = one(spark, "TIMESTAMP_NTZ '2024-01-01 00:30:00' AS start_at, TIMESTAMP_NTZ '2024-01-01 03:00:00' AS end_at")
    assert R.daily_or_hourly(bounds).count() == 3
    assert R.hourly_aligned(bounds).count() == 3
    predicates = R.jdbc_predicates(R.hourly_aligned(bounds), "at")
    assert predicates[0] == "at >= '2024-01-01 00:30:00' AND at < '2024-01-01 01:00:00'"


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(start=st.integers(0, 50), length=st.integers(0, 50), n=st.integers(1, 9))
def test_equal_chunks_tile_the_interval(spark, rows, start, length, n):
    bounds = spark.createDataFrame([(start, start + length)], "start_ts long, end_ts long")
    chunks = rows(R.equal_chunks(bounds, n))
    chunks.sort()
    assert len(chunks) <= n
    covered = [x for a, b in chunks for x in range(a, b)]
    assert covered == list(range(start, start + length))


def test_map_cursor_compares_numbers(spark):
    frame = spark.createDataFrame([("s", "9"), ("s", "10"), ("t", "1")], "shard string, seq string")
    assert C.map_cursor(frame, "shard", "seq").first().positions == {"s": "10", "t": "1"}
