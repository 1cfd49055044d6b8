"""Golden loads, the laws they follow, and the paths taken for large or lopsided sides."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import maintenance as M
from millrace.operators.keys import dedup_by_key, match_many, without_keys
from millrace.plans.load import run_load
from millrace.plans.request import LoadRequest
from millrace.session import scratch_path
from millrace.sinks.tables import SnapshotTable, TableGroup

D = dt.date
SYMBOLS = "symbol string, date date, name string"


def first_quotes(spark):
    return spark.createDataFrame(
        [("A", D(2024, 4, 19), "a"), ("AA", D(2024, 4, 19), "aa"), ("AAA", D(2024, 4, 19), "aaa")], SYMBOLS
    )


def second_quotes(spark):
    return spark.createDataFrame(
        [
            ("A", D(2024, 4, 20), "a+"),
            ("AA", D(2024, 4, 19), "aa+"),
            ("AAA", D(2024, 4, 21), "aaa+"),
            ("AAAU", D(2024, 4, 22), "aaau+"),
        ],
        SYMBOLS,
    )


def load_twice(spark, first, second, **options):
    path = scratch_path(spark, "golden")
    request = LoadRequest(source="quotes", target=path, **options)
    run_load(first, request, "one")
    run_load(second, request, "two")
    return SnapshotTable(spark, path), request


def test_merge_ignores_a_change_that_does_not_move_the_cursor(spark, rows):
    table, request = load_twice(
        spark, first_quotes(spark), second_quotes(spark), strategy="merge", incremental_key="date", primary_key=["symbol"]
    )
    expected = [("A", "a+"), ("AA", "aa"), ("AAA", "aaa+"), ("AAAU", "aaau+")]
    assert rows(table.read(), "symbol", "name") == expected
    run_load(second_quotes(spark), request, "three")
    assert rows(table.read(), "symbol", "name") == expected
    assert dict(rows(table.load_counts())) == {"one": 1, "two": 3}


def test_delete_insert_takes_the_boundary_again(spark, rows):
    first = first_quotes(spark).union(spark.createDataFrame([("B", D(2024, 4, 18), "b")], SYMBOLS))
    table, _ = load_twice(spark, first, second_quotes(spark), strategy="delete+insert", incremental_key="date")
    assert rows(table.read(), "symbol", "name") == [
        ("A", "a+"), ("AA", "aa+"), ("AAA", "aaa+"), ("AAAU", "aaau+"), ("B", "b"),
    ]


@pytest.mark.parametrize("partitioned", [False, True])
def test_delete_insert_by_day_and_by_partition_agree(spark, rows, partitioned):
    first = first_quotes(spark).union(spark.createDataFrame([("B", D(2024, 4, 18), "b")], SYMBOLS))
    options = {"partition_by": "date"} if partitioned else {}
    table, _ = load_twice(spark, first, second_quotes(spark), strategy="delete+insert", incremental_key="date", **options)
    assert len(rows(table.read(), "symbol")) == 5
    assert table.head()["partition_by"] == (["date"] if partitioned else [])


def test_append_adds_nothing_on_a_rerun(spark, rows):
    data = spark.createDataFrame([(1, "x", D(2022, 1, 1)), (2, "y", D(2022, 1, 2))], "id int, val string, at date")
    table, request = load_twice(spark, data, data, strategy="append", incremental_key="at")
    assert rows(table.read(), "id") == [(1,), (2,)]
    more = data.union(spark.createDataFrame([(3, "z", D(2022, 1, 2)), (4, "w", D(2021, 1, 1))], data.schema))
    run_load(more, request, "three")
    # Same day but unseen comes in; older than the position does not.
    assert rows(table.read(), "id") == [(1,), (2,), (3,)]
    run_load(more, request, "four")
    assert rows(table.read(), "id") == [(1,), (2,), (3,)]


def test_closed_interval_neither_uses_nor_moves_the_position(spark, rows):
    data = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1 + i // 2, 12 * (i % 2))) for i in range(6)], "id int, at timestamp_ntz"
    )
    path = scratch_path(spark, "intervals")

    def load(day, load_id):
        request = LoadRequest(
            source="t", target=path, strategy="delete+insert", incremental_key="at",
            interval_start=dt.datetime(2024, 1, day), interval_end=dt.datetime(2024, 1, day + 1),
        )
        run_load(data, request, load_id)

    load(1, "a")
    load(3, "b")
    load(1, "c")
    table = SnapshotTable(spark, path)
    assert rows(table.read(), "id", "_load_id") == [(0, "c"), (1, "c"), (2, "c"), (4, "b"), (5, "b")]
    assert table.head()["cursor"] is None


def test_replace_reads_the_table_it_replaces(spark, rows):
    table = SnapshotTable(spark, scratch_path(spark, "self"))
    table.replace(spark.range(5).withColumn("v", F.lit(1)), "one")
    table.replace(table.read().withColumn("v", F.col("v") + 1), "two")
    assert rows(table.read(), "id", "v") == [(i, 2) for i in range(5)]


def test_failed_load_leaves_table_and_position(spark, rows):
    path = scratch_path(spark, "failing")
    request = LoadRequest(source="t", target=path, strategy="append", incremental_key="id")
    run_load(spark.range(3), request, "one")
    head = SnapshotTable(spark, path).head()
    broken = spark.range(6).withColumn("id", F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("x")).cast("long")))
    with pytest.raises(Exception):
        run_load(broken, request, "two")
    assert SnapshotTable(spark, path).head() == head
    run_load(spark.range(6), request, "three")
    assert rows(SnapshotTable(spark, path).read(), "id") == [(i,) for i in range(6)]


def test_merge_only_rewrites_the_partitions_of_the_batch(spark, rows):
    path = scratch_path(spark, "touched")
    data = spark.createDataFrame([(i, i % 3, "old") for i in range(30)], "id int, part int, v string")
    request = LoadRequest(source="t", target=path, strategy="merge", primary_key=["part", "id"], partition_by="part")
    run_load(data, request, "one")
    table = SnapshotTable(spark, path)

    def files():
        return {f for f in table.read().inputFiles()}

    before = files()
    run_load(data.filter("id IN (0, 3)").withColumn("v", F.lit("new")), request, "two")
    assert {f for f in before if "part=0" not in f} == {f for f in files() if "part=0" not in f}
    assert rows(table.read().filter("v = 'new'"), "id") == [(0,), (3,)]
    assert table.read().count() == 30


def test_buckets_confine_an_upsert(spark, rows):
    path = scratch_path(spark, "buckets")
    data = spark.range(200).selectExpr("CAST(id AS INT) AS id", "'old' AS v")
    run_load(data, LoadRequest(source="t", target=path, strategy="merge", primary_key=["id"], buckets=8), "one")
    table = SnapshotTable(spark, path)

    def files():
        return {bucket: set(fs) for bucket, fs in by_bucket(table.read().inputFiles()).items()}

    def by_bucket(names):
        found = {}
        for name in names:
            found.setdefault(name.split("_bucket_8=")[1].split("/")[0], []).append(name)
        return found

    before = files()
    assert len(before) == 8
    # The key has widened, and the number of buckets asked for is another one.
    batch = spark.createDataFrame([(7, "new"), (1000, "new")], "id bigint, v string")
    run_load(batch, LoadRequest(source="t", target=path, strategy="merge", primary_key=["id"], buckets=16), "two")
    after = files()
    changed = [b for b in before if before[b] != after[b]]
    assert 1 <= len(changed) <= 2
    out = table.data()
    assert out.columns == ["id", "v"] and out.count() == 201
    assert rows(out.filter("v = 'new'"), "id") == [(1000,), (7,)]


def test_append_to_a_partitioned_table(spark, rows):
    path = scratch_path(spark, "parts")
    request = LoadRequest(source="t", target=path, strategy="append", partition_by="at")
    one = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5)), (2, None)], "id int, at timestamp_ntz")
    run_load(one, request, "one")
    run_load(one.withColumn("extra", F.lit("x")), request, "two")
    table = SnapshotTable(spark, path)
    assert len(table.head()["dirs"]) == 2
    assert rows(table.read(), "id", "at_day", "extra") == [
        (1, dt.date(2024, 1, 1), "x"), (1, dt.date(2024, 1, 1), None), (2, None, "x"), (2, None, None),
    ]


def test_merge_in_null_partitions(spark, rows):
    path = scratch_path(spark, "nulls")
    data = spark.createDataFrame([(1, None, "old"), (2, "a", "old"), (3, "b", "old")], "id int, part string, v string")
    request = LoadRequest(source="t", target=path, strategy="merge", primary_key=["id", "part"], partition_by="part")
    run_load(data, request, "one")
    run_load(data.filter("id < 3").withColumn("v", F.lit("new")), request, "two")
    assert rows(SnapshotTable(spark, path).read(), "id", "part", "v") == [(1, None, "new"), (2, "a", "new"), (3, "b", "old")]


def test_new_column_and_new_type_in_an_append(spark, rows):
    path = scratch_path(spark, "evolving")
    request = LoadRequest(source="t", target=path, strategy="append")
    run_load(spark.createDataFrame([(1, 5)], "id int, n int"), request, "one")
    run_load(spark.createDataFrame([(2, 5_000_000_000, "x")], "id int, n bigint, extra string"), request, "two")
    run_load(spark.createDataFrame([(3, "many")], "id int, n string"), request, "three")
    # No file was written twice.
    assert len(SnapshotTable(spark, path).head()["dirs"]) == 3
    table = SnapshotTable(spark, path).read()
    assert rows(table, "id", "n", "extra", "n__v_text") == [
        (1, 5, None, None), (2, 5_000_000_000, "x", None), (3, None, None, "many"),
    ]


T1, T2, T3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
PEOPLE = "id int, name string, city string"


def test_history_of_a_move(spark, rows):
    one = spark.createDataFrame([(1, "Alice", "Auckland"), (2, "Bob", "Wellington")], PEOPLE)
    two = spark.createDataFrame([(1, "Alice", "Auckland"), (2, "Bob", "Christchurch")], PEOPLE)
    history = M.scd2(M.scd2(None, one, T1), two, T2)
    again = M.scd2(history, two, T3)
    expected = [
        ("Alice", "Auckland", T1, None), ("Bob", "Christchurch", T2, None), ("Bob", "Wellington", T1, T2),
    ]
    assert rows(history, "name", "city", "_valid_from", "_valid_to") == expected
    assert rows(again, "name", "city", "_valid_from", "_valid_to") == expected


def test_history_load_end_to_end(spark, rows):
    path = scratch_path(spark, "people")
    request = LoadRequest(source="people", target=path, strategy="scd2")
    run_load(spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, "b", None)], PEOPLE), request, "one", load_time=T1)
    run_load(spark.createDataFrame([(2, "b", None)], PEOPLE), request, "two", load_time=T2)
    run_load(spark.createDataFrame([(1, "a", "x"), (2, "b", None)], PEOPLE), request, "three", load_time=T3)
    assert rows(SnapshotTable(spark, path).read(), "id", "_valid_from", "_valid_to") == [
        (1, T1, T2), (1, T3, None), (2, T1, None),
    ]


def test_closed_records_are_not_written_again(spark, rows):
    path = scratch_path(spark, "long-history")
    request = LoadRequest(source="people", target=path, strategy="scd2")
    table = SnapshotTable(spark, path)
    snapshots = [[(1, "a", "x"), (2, "b", "y")], [(1, "a", "z"), (2, "b", "y")], [], [(1, "a", "z")], [(1, "a", "z"), (3, "c", "w")]]
    expected = None
    for i, snapshot in enumerate(snapshots):
        at = T1 + dt.timedelta(days=i)
        frame = spark.createDataFrame(snapshot, PEOPLE)
        run_load(frame, request, f"load-{i}", load_time=at)
        expected = M.scd2(expected, frame, at)
        columns = ("id", "city", "_valid_from", "_valid_to")
        assert rows(table.read(), *columns) == rows(expected, *columns)
        if i == 1:
            closed = table.closed_dirs()
        if i > 1:
            assert set(closed) <= set(table.head()["dirs"])
    before = rows(table.read())
    assert table.expire(hours=-1)
    assert rows(table.read()) == before


def test_history_of_a_table_that_changes_shape(spark, rows):
    path = scratch_path(spark, "changing-history")
    request = LoadRequest(source="people", target=path, strategy="scd2")
    run_load(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), request, "one", load_time=T1)
    run_load(spark.createDataFrame([(1, "a")], "id int, v string"), request, "two", load_time=T2)
    # A column more, and a key that is text now: open records are new versions.
    run_load(spark.createDataFrame([("1", "a", 5)], "id string, v string, n int"), request, "three", load_time=T3)
    assert rows(SnapshotTable(spark, path).read(), "id", "v", "n", "_valid_from", "_valid_to") == [
        ("1", "a", 5, T3, None), ("1", "a", None, T1, T3), ("2", "b", None, T1, T2),
    ]


cells = st.tuples(st.integers(0, 5), st.sampled_from(["x", "y", None]), st.integers(0, 3))
frames = st.lists(cells, max_size=12)
law = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "k int, v string, n int"


@law
@given(target=frames, batch=frames)
def test_merge_twice_is_merge_once(spark, rows, target, batch):
    target = dedup_by_key(spark.createDataFrame(target, SCHEMA), ["k"])
    batch = spark.createDataFrame(batch, SCHEMA)
    once = M.merge(target, batch, ["k"], ["n"])
    assert rows(M.merge(once, batch, ["k"], ["n"])) == rows(once)
    keys = [r.k for r in once.collect()]
    assert len(keys) == len(set(keys))


@law
@given(snapshots=st.lists(frames, min_size=2, max_size=3))
def test_open_records_equal_the_last_snapshot(spark, rows, snapshots):
    history = None
    for i, snapshot in enumerate(snapshots):
        frame = spark.createDataFrame(snapshot, SCHEMA)
        history = M.scd2(history, frame, T1 + dt.timedelta(days=i))
    current = history.filter("_valid_to IS NULL").select("k", "v", "n")
    assert rows(current) == rows(frame.distinct())


@law
@given(target=frames, batch=frames)
def test_delete_insert_against_brute_force(spark, rows, target, batch):
    got = M.delete_insert(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(batch, SCHEMA), "v")
    values = {b[1] for b in batch}
    expected = Counter([t for t in target if t[1] not in values] + batch)
    assert Counter(rows(got)) == expected


def lopsided(spark, n=3000):
    """One key holds a third of the rows; some keys are null."""
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END"
    return spark.range(n).repartition(6).selectExpr(f"{key} AS k", "id AS payload")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_a_hot_key_is_cut_by_adaptive_execution(spark, rows, no_broadcast, how):
    """Half of the rows have one key, the right side comes from an aggregation, and no job runs beforehand."""
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(20_000).repartition(6).selectExpr("CASE WHEN id % 2 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id END AS k", "id AS payload")
        keys = spark.range(0, 20_000, 3).selectExpr("IF(id = 6, 7, id) AS k")
        right = keys.union(spark.createDataFrame([(None,)], "k long")).groupBy("k").agg(F.max(F.lit(1)).alias("r"))
        spark.sparkContext.setJobGroup(f"planning-{how}", "none")
        joined = match_many(left, right, ["k"], how)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"planning-{how}")
        side = right.withColumnRenamed("k", "rk")
        plain = left.join(side, left.k.eqNullSafe(side.rk), how).drop("rk")
        got = joined.select(sorted(joined.columns))
        assert rows(got) == rows(plain.select(sorted(plain.columns)))
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString() or how == "left_anti"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)


def test_without_keys_on_a_hot_day(spark, rows, no_broadcast):
    target = lopsided(spark).withColumnRenamed("k", "day")
    batch = spark.createDataFrame([(7, 1), (7, 2), (None, 3)], "day long, payload long")
    kept = without_keys(target, batch, ["day"])
    assert kept.filter("day = 7 OR day IS NULL").count() == 0
    assert kept.count() == target.filter("day IS NOT NULL AND day <> 7").count()


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = dedup_by_key(lopsided(spark), ["k"], ["payload"])._jdf.queryExecution().executedPlan().toString()
    window, _, below = plan.partition("Exchange hashpartitioning(k")
    assert "WindowGroupLimit" in window and "WindowGroupLimit" in below


def test_lineage(spark, rows):
    data = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id int, v string")
    stamped = M.stamp_lineage(data, "load")
    assert stamped.select("_row_id").distinct().count() == 2
    assert M.stamp_lineage(data, "load", unique=True).select("_row_id").distinct().count() == 3
    assert rows(M.strip_lineage(stamped)) == rows(data)


def test_two_keys(spark, rows):
    target = spark.createDataFrame([(1, "mon", "old"), (2, "tue", "old"), (3, "wed", "old")], "id int, day string, v string")
    batch = spark.createDataFrame([(1, "fri", "new"), (9, "tue", "new"), (9, "tue", "new")], target.schema)
    got = M.merge_two_keys(target, batch, ["id"], ["day"])
    assert rows(got) == [(1, "fri", "new"), (3, "wed", "old"), (9, "tue", "new")]


def test_text_comes_first_then_numbers(spark, rows):
    """The table holds text: numbers of the batch are turned into text, old files stay."""
    path = scratch_path(spark, "texts")
    request = LoadRequest(source="t", target=path, strategy="append")
    run_load(spark.createDataFrame([("x",)], "v string"), request, "one")
    run_load(spark.createDataFrame([(2,)], "v int"), request, "two")
    run_load(spark.createDataFrame([(True,)], "flag boolean"), request, "three")
    table = SnapshotTable(spark, path)
    assert len(table.head()["dirs"]) == 3
    assert rows(table.read(), "v", "flag") == [("2", None), ("x", None), (None, True)]


def test_a_type_that_files_cannot_be_read_as(spark, rows):
    path = scratch_path(spark, "rewritten")
    request = LoadRequest(source="t", target=path, strategy="append")
    run_load(spark.createDataFrame([(5,)], "v int"), request, "one")
    run_load(spark.createDataFrame([(0.5,)], "v double").selectExpr("CAST(v AS DECIMAL(3, 1)) AS v"), request, "two")
    table = SnapshotTable(spark, path)
    assert len(table.head()["dirs"]) == 1
    assert rows(table.read(), "v", "_load_id") == [(0.5, "two"), (5.0, "one")]


@pytest.mark.parametrize("key", [["User Id"], []])
def test_names_types_and_masks_around_the_position(spark, rows, key):
    """Keys are given by source names; the key is masked, the cursor arrives as text."""
    path = scratch_path(spark, "shaped")
    schema = "`User Id` int, `updatedAt` string, secret string, note string"
    data = [(1, "2024-01-01T00:00:00", "a", "x"), (2, "2024-01-02T00:00:00", "b", "x")]
    request = LoadRequest(
        source="t", target=path, strategy="append", incremental_key="updatedAt", primary_key=key, naming="snake_case",
        columns="updatedAt:timestamp", masks=["User Id:sha256", "secret:random"], exclude=["note"],
    )
    run_load(spark.createDataFrame(data, schema), request, "one")
    more = [*data, (3, "2024-01-02T00:00:00", "c", "x"), (4, "2024-01-10T00:00:00", "d", "x")]
    run_load(spark.createDataFrame(more, schema), request, "two")
    run_load(spark.createDataFrame(more, schema), request, "three")
    table = SnapshotTable(spark, path).read()
    assert [c for c in table.columns if not c.startswith("_")] == ["user_id", "updated_at", "updated_at__v_text", "secret"]
    assert table.count() == 4 and table.select("user_id").distinct().count() == 4
    assert dict(rows(SnapshotTable(spark, path).load_counts())) == {"one": 2, "two": 2}


def test_transforms_and_limit(spark, rows):
    path = scratch_path(spark, "limited")
    request = LoadRequest(source="t", target=path, incremental_key="id", limit=3)
    run_load(spark.range(10), request, "one", transforms=(lambda df: df.withColumn("double", F.col("id") * 2),))
    assert rows(SnapshotTable(spark, path).read(), "id", "double") == [(0, 0), (1, 2), (2, 4)]


def test_expired_snapshots_go(spark, rows):
    table = SnapshotTable(spark, scratch_path(spark, "expiring"))
    for i in range(3):
        table.replace(spark.range(i + 1), f"load-{i}")
    assert table.expire(hours=1) == []
    assert len(table.expire(hours=-1)) == 2
    assert table.read().count() == 3


def test_bucketed_tables_join_in_place(spark, no_broadcast):
    from millrace.operators.keys import drop_right_keys
    from millrace.sinks.files import write_bucketed

    write_bucketed(spark.range(100).selectExpr("id AS k", "id AS a"), "bucketed_left", ["k"], 4)
    write_bucketed(spark.range(50).selectExpr("id AS k", "id AS b"), "bucketed_right", ["k"], 4)
    joined = drop_right_keys(spark.table("bucketed_left"), spark.table("bucketed_right"), ["k"], "inner", null_safe=False)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50


@pytest.mark.parametrize("format", ["parquet", "jsonl"])
def test_dataset_formats(spark, rows, tmp_path, format):
    from millrace.sinks.files import write_dataset

    data = spark.range(10).selectExpr("id", "id % 2 AS part")
    write_dataset(data, str(tmp_path / "d"), format, rows_per_file=2, layout=["part"], compression="gzip")
    reader = spark.read.schema("id long, part long")
    back = reader.parquet(str(tmp_path / "d")) if format == "parquet" else reader.json(str(tmp_path / "d"))
    assert rows(back) == rows(data)
    assert len(back.inputFiles()) == 6


def test_a_route_with_most_rows_is_written_by_many_tasks(spark, tmp_path):
    from millrace.sinks.files import route_tables

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        data = spark.range(0, 60000, 1, 6).selectExpr("id", "uuid() AS body", "IF(id % 3 < 2, 'hot', concat('r', id % 4)) AS kind")
        route_tables(data, "kind", str(tmp_path / "routes"))
    finally:
        spark.conf.set(key, before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "routes").iterdir() if d.is_dir()}
    assert files["_route=hot"] > 4
    back = spark.read.parquet(str(tmp_path / "routes"))
    assert back.count() == back.select("id").distinct().count() == 60000


@pytest.mark.parametrize("strategy", ["append", "merge"])
def test_newer_rows_come_in_and_older_ones_do_not(spark, rows, strategy):
    """A thousand rows, a thousand newer ones, a thousand older ones."""

    def frame(first, at):
        return spark.range(first, first + 1000).selectExpr("id", "id * 0.5 AS value", f"TIMESTAMP_NTZ '{at}' AS date")

    path = scratch_path(spark, "frames")
    request = LoadRequest(source="t", target=path, strategy=strategy, incremental_key="date", primary_key=["id"])
    run_load(frame(0, "2024-02-01 00:00:00"), request, "one")
    run_load(frame(1000, "2024-03-01 00:00:00"), request, "two")
    run_load(frame(2000, "2024-01-01 00:00:00"), request, "three")
    table = SnapshotTable(spark, path)
    assert table.read().count() == 2000
    assert dict(rows(table.load_counts())) == {"one": 1000, "two": 1000}


# ---- files, groups of tables, the log


def csv_file(folder, name, at, *ids):
    import os

    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("id\n" + "".join(f"{i}\n" for i in ids))
    os.utime(folder / name, (at, at))


def file_load(spark, scan_root, target, pattern="*.csv", namespace="", **options):
    from millrace.sources.filescan import FileScan

    def read(found):
        return spark.read.schema("id int").option("header", True).csv(found)

    scan = FileScan(spark=spark, root=str(scan_root), read=read, pattern=pattern, namespace=namespace)
    request = LoadRequest(source="files", target=target, source_kind="files", file_incremental=True)
    run_load(scan, request, **options)
    return scan


def test_files_are_loaded_once(spark, rows, tmp_path):
    target = scratch_path(spark, "files")
    csv_file(tmp_path / "in", "a.csv", 1_700_000_000, 1, 2)
    for _ in range(2):
        file_load(spark, tmp_path / "in", target)
        assert rows(SnapshotTable(spark, target).read(), "id") == [(1,), (2,)]
    # A file of the same time, one older, and one changed since.
    csv_file(tmp_path / "in", "b.csv", 1_700_000_000, 3)
    csv_file(tmp_path / "in", "old.csv", 1_600_000_000, 4)
    file_load(spark, tmp_path / "in", target)
    assert rows(SnapshotTable(spark, target).read(), "id") == [(1,), (2,), (3,)]
    csv_file(tmp_path / "in", "a.csv", 1_700_000_500, 5)
    file_load(spark, tmp_path / "in", target)
    assert rows(SnapshotTable(spark, target).read(), "id") == [(1,), (2,), (3,), (5,)]
    log = SnapshotTable(spark, target).loads().orderBy("version")
    assert [r.rows for r in log.collect()] == [2, 0, 1, 1]
    # A refresh reads everything, older files too.
    file_load(spark, tmp_path / "in", target, full_refresh=True)
    assert rows(SnapshotTable(spark, target).read(), "id") == [(3,), (4,), (5,)]
    file_load(spark, tmp_path / "in", target)
    assert SnapshotTable(spark, target).read().count() == 3


def test_globs_and_stores_have_positions_of_their_own(spark, rows, tmp_path):
    target = scratch_path(spark, "globs")
    csv_file(tmp_path / "new", "n.csv", 1_700_000_100, 1)
    csv_file(tmp_path / "old", "o.csv", 1_700_000_000, 2)
    file_load(spark, tmp_path / "new", target)
    file_load(spark, tmp_path / "old", target)
    assert rows(SnapshotTable(spark, target).read(), "id") == [(1,), (2,)]
    file_load(spark, tmp_path / "old", target, namespace="another")
    assert rows(SnapshotTable(spark, target).read(), "id") == [(1,), (2,), (2,)]


def test_a_load_that_dies_has_read_no_file(spark, tmp_path):
    target = scratch_path(spark, "dying")
    csv_file(tmp_path / "in", "a.csv", 1_700_000_000, 1)
    file_load(spark, tmp_path / "in", target)
    csv_file(tmp_path / "in", "b.csv", 1_700_000_100, 2)
    with pytest.raises(Exception, match="died"):
        file_load(spark, tmp_path / "in", target, transforms=(lambda df: df.withColumn("id", F.raise_error(F.lit("died")).cast("int")),))
    file_load(spark, tmp_path / "in", target)
    assert SnapshotTable(spark, target).read().count() == 2


def test_many_file_loads_fold_their_lists(spark, tmp_path):
    from millrace.sinks.tables import FOLD

    target = scratch_path(spark, "many")
    for i in range(FOLD + 3):
        csv_file(tmp_path / "in", f"{i}.csv", 1_700_000_000 + i // 2, i)
        file_load(spark, tmp_path / "in", target)
    table = SnapshotTable(spark, target)
    assert table.read().count() == FOLD + 3 and len(table.head()["files"]) <= 4


def test_rows_are_no_files(spark):
    request = LoadRequest(source="t", target=scratch_path(spark, "x"), source_kind="files", file_incremental=True)
    with pytest.raises(ValueError, match="FileScan"):
        run_load(spark.range(3), request)


ROUTED = dict(source="t", strategy="append", multiple_tables=True, route="kind")


def routed(spark, path):
    from millrace.sinks.tables import TableGroup

    group = TableGroup(spark, path)
    return {n: sorted(r.id for r in group.table(n).read().select("id").collect()) for n in group.names()}


def test_one_load_into_many_tables(spark):
    path = scratch_path(spark, "routes")
    data = spark.range(8).selectExpr("id", "CASE WHEN id < 3 THEN 'a/b c%' WHEN id < 6 THEN '' || '1e5' ELSE 'ä' END AS kind")
    run_load(data, LoadRequest(target=path, **ROUTED), "one")
    assert routed(spark, path) == {"a/b c%": [0, 1, 2], "1e5": [3, 4, 5], "ä": [6, 7]}
    more = spark.range(8, 10).selectExpr("id", "'ä' AS kind", "id AS extra")
    run_load(more, LoadRequest(target=path, **ROUTED), "two")
    assert routed(spark, path)["ä"] == [6, 7, 8, 9]
    replaced = LoadRequest(target=path, **{**ROUTED, "strategy": "replace"})
    run_load(more, replaced, "three")
    assert routed(spark, path) == {"ä": [8, 9]}
    with pytest.raises(Exception, match="no table"):
        run_load(data.withColumn("kind", F.nullif("kind", F.lit("ä"))), LoadRequest(target=path, **ROUTED), "four")
    assert routed(spark, path) == {"ä": [8, 9]}


def test_tables_commit_together_or_not_at_all(spark):
    from millrace.sinks.tables import ConcurrentLoadError, TableGroup

    path = scratch_path(spark, "together")
    data = spark.range(4).selectExpr("id", "concat('t', id % 2) AS kind")
    run_load(data, LoadRequest(target=path, **ROUTED), "one")
    group = TableGroup(spark, path)
    # A load that dies between two heads, and one that goes on after another has ruled it out.
    dead = group.begin(["t0", "t1"])
    dead[0].append(dead[0].read(), "dead")
    assert routed(spark, path) == {"t0": [0, 2], "t1": [1, 3]}
    slow = group.begin(["t0", "t1"])
    for table in slow:
        table.append(table.read(), "slow")
    run_load(spark.range(4, 6).selectExpr("id", "'t0' AS kind"), LoadRequest(target=path, **ROUTED), "two")
    with pytest.raises(ConcurrentLoadError):
        group.commit(slow)
    assert routed(spark, path) == {"t0": [0, 2, 4, 5], "t1": [1, 3]}
    assert [r.load_id for r in group.table("t0").loads().orderBy("version").collect()] == ["one", "two"]
    group.expire(hours=-1)
    assert routed(spark, path) == {"t0": [0, 2, 4, 5], "t1": [1, 3]}


def test_the_log_outlives_its_heads_and_heads_do_not_grow(spark):
    from pathlib import Path

    from millrace.sinks import tables

    table = SnapshotTable(spark, scratch_path(spark, "log"))
    sizes = []
    for i in range(45):
        table.append(spark.range(i % 3).selectExpr("id", "id AS part"), f"load-{i}")
        head = max(Path(table.path.removeprefix("file:")).glob("_heads/*.json"))
        sizes.append(head.stat().st_size)
    table.expire(hours=-1)
    assert len(table.versions()) == tables.KEPT_HEADS
    log = table.loads().orderBy("version").collect()
    assert [(r.version, r.load_id, r.rows) for r in log] == [(i + 1, f"load-{i}", i % 3) for i in range(45)]
    assert max(sizes[tables.FOLD :]) - min(sizes[tables.FOLD :]) < 60 * tables.FOLD
    assert table.read().count() == sum(i % 3 for i in range(45))
    wide = SnapshotTable(spark, scratch_path(spark, "wide"))
    wide.replace(spark.range(300).selectExpr("id", "id AS part"), "x", ["part"])
    one = max(Path(wide.path.removeprefix("file:")).glob("_heads/*.json")).stat().st_size
    wide.replace_partitions(spark.range(2).selectExpr("id", "id AS part"), "y")
    two = max(Path(wide.path.removeprefix("file:")).glob("_heads/*.json")).stat().st_size
    assert two < one + 200 and wide.read().count() == 300


@pytest.mark.parametrize("few", [10_000, 5])
def test_the_first_rows_by_counts(spark, monkeypatch, few):
    from millrace.operators import cursors

    monkeypatch.setattr(cursors, "FEW", few)
    values = [(i, None if i % 11 == 0 else (7 if i % 3 else i % 29), f"s{i % 5}" if i % 7 else None) for i in range(300)]
    frame = spark.createDataFrame(values, "id int, at int, s string").repartition(5)
    ranked = sorted(values, key=lambda r: ((r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""), r[0]))
    for n in (0, 1, 27, 28, 150, 299, 300, 1000):
        found = cursors.lowest(frame, n, "at", ["s", "id"])
        assert sorted(r.id for r in found.collect()) == sorted(r[0] for r in ranked[:n])
        assert "TakeOrdered" not in found._jdf.queryExecution().executedPlan().toString()
    # Equal rows: as many of them as belong.
    assert cursors.lowest(frame.select("at"), 200, "at").count() == 200


def test_a_merge_of_records_uses_the_batch_as_it_was_written(spark, rows, no_broadcast):
    """Keys that come twice, in a batch of a few buckets; what is kept is written by tasks of one bucket, the batch once."""
    path = scratch_path(spark, "once")
    request = LoadRequest(source="docs", target=path, strategy="merge", primary_key=["id"], incremental_key="at", nesting=1)
    old = spark.range(60).selectExpr("id", "1 AS at", "transform(sequence(1, 3), i -> 'old' || i) AS lines")
    run_load(old.unionByName(old.filter("id < 5").withColumn("at", F.lit(0))), request, "first")
    again = old.filter("id % 20 = 7").withColumns({"lines": F.expr("array('new')"), "at": F.lit(2)})
    run_load(again.unionByName(again.withColumns({"at": F.lit(1), "lines": F.expr("array('late')")})), request, "second")
    group = TableGroup(spark, path)
    lines, docs = group.table("docs__lines"), group.table("docs")
    for table in (lines, docs):
        dirs = table.head()["dirs"]
        assert any(d.startswith("__dir=batch-second") for d in dirs)
        kept = [d for d in dirs if d.startswith("__dir=second")]
        files = table.read(kept).selectExpr("_metadata.file_path AS f", "_load_id").distinct().collect()
        assert {r[1] for r in files} == {"first"}
    found = lines.read().join(docs.read().selectExpr("_row_id AS _root_id", "id"), "_root_id")
    want = [(i, j, f"old{j + 1}") for i in range(60) if i % 20 != 7 for j in range(3)] + [(i, 0, "new") for i in (7, 27, 47)]
    assert rows(found, "id", "_list_idx", "value") == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
