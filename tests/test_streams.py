"""Drains that fail, repeat and go on; envelopes and decoding."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sinks import tables
from millrace.sinks.tables import SnapshotTable
from millrace.streaming import drain, positions, queues, shards, topics


def messages(spark, items):
    """Items are (topic, partition, offset, key, value)."""
    frame = spark.createDataFrame(items, "topic string, partition int, offset long, key string, value string")
    return frame.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic", "partition", "offset",
        F.timestamp_seconds("offset").alias("timestamp"), F.lit(0).alias("timestampType"),
    )


TEXTS = [("t", 0, 0, "k", "hello"), ("t", 0, 1, "k", "again"), ("t", 1, 0, None, None)]


def test_envelopes(spark):
    frame = messages(spark, TEXTS)
    first = topics.envelope_v1(frame).orderBy("_kafka.partition", "_kafka.offset").collect()
    assert first[0]["_kafka"]["data"] == "hello" and first[0]["_kafka"]["ts"]["value"] == dt.datetime(1970, 1, 1)
    assert first[0]["_kafka_msg_id"] == first[1]["_kafka_msg_id"] != first[2]["_kafka_msg_id"]
    assert topics.envelope_v2(frame).schema["_kafka"].dataType.names[-1] == "msg_id"
    assert topics.envelope_include(frame, ["offset", "value", "partition"]).columns == ["partition", "offset", "data"]
    assert topics.envelope_select(frame, "value").columns == ["data"]
    assert topics.envelope_select(frame, "ts").columns == ["type", "value"]
    with pytest.raises(ValueError):
        topics.envelope_include(frame, ["headers"])
    assert frame.select(topics.offset_id().alias("i")).distinct().count() == 3


def test_decoding(spark):
    frame = messages(spark, [("t", 0, 0, "k", "[1,2]")])
    assert frame.select(topics.decode("value", "json", "array<int>").alias("v")).first().v == [1, 2]
    with pytest.raises(ValueError):
        topics.decode("value", "avro")
    bad = messages(spark, [("t", 0, 0, "k", "{oops")])
    with pytest.raises(Exception):
        bad.select(topics.decode("value", "json", "a int").alias("v")).collect()


def test_start_offsets(spark, rows):
    frame = messages(spark, [("t", 0, i, "k", "v") for i in range(5)] + [("t", 1, i, "k", "v") for i in range(2)])
    starts = topics.start_offsets(frame, dt.datetime(1970, 1, 1, 0, 0, 3))
    assert rows(starts) == [("t", 0, 3), ("t", 1, 1)]
    assert rows(topics.from_offsets(frame, starts), "partition", "offset") == [(0, 3), (0, 4), (1, 1)]


def test_topic_options():
    options = topics.topic_options("b:9092", ["x", "y"], dt.datetime(2024, 1, 1), 500)
    assert options["startingTimestamp"] == "1704067200000" and options["startingOffsetsByTimestampStrategy"] == "latest"
    assert options["subscribe"] == "x,y" and options["maxOffsetsPerTrigger"] == "500"
    assert topics.topic_options("b", ["x"])["startingOffsets"] == "earliest"


def test_shard_payload(spark):
    record = spark.createDataFrame([("s", "1", dt.datetime(2024, 1, 1), "p", '{"a":1}')], "shard_id string, seq_no string, arrived timestamp_ntz, partition_key string, data string")
    assert shards.shard_envelope(record, "x", "a int").columns == ["kinesis", "kinesis_msg_id", "a"]
    assert shards.shard_envelope(record, "x").first()["data"] == '{"a":1}'
    with pytest.raises(ValueError):
        shards.shard_envelope(record, "x", "kinesis int")


def test_queue_payloads(spark):
    bodies = ['{"a":1,"value":"own"}', "[1]", "5", '"text"', "null"]
    frame = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "id string, body string").withColumn("metadata", F.lit(None).cast("map<string,string>"))
    got = {r["_mqb_id"]: (r["a"], r["value"]) for r in queues.queue_envelope(frame, "a int, value string").collect()}
    assert got["0"] == (1, "own") and got["1"] == (None, "[1]") and got["2"] == (None, "5") and got["3"] == (None, "text")
    texts = queues.queue_envelope(frame, text=True)
    assert [r.value for r in texts.orderBy("_mqb_id").collect()] == bodies
    assert queues.bounded_slice(frame, "id", 2).count() == 2


def queue_folder(spark, items):
    path = scratch_path(spark, "queue")
    for part in items:
        spark.createDataFrame(part, "id string, v int").coalesce(1).write.mode("append").parquet(path)
    return path


def stream_of(spark, path):
    return spark.readStream.schema("id string, v int").option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("apply", [drain.merge_into, drain.insert_new])
def test_drain_goes_on_where_it_stopped(spark, rows, apply):
    path = queue_folder(spark, [[("a", 1), ("b", 1)], [("b", 1), ("c", 1)]])
    table, checkpoint = SnapshotTable(spark, scratch_path(spark, "t")), scratch_path(spark, "c")
    drain.drain(stream_of(spark, path), apply(table, "id"), checkpoint)
    assert rows(table.read(), "id") == [("a",), ("b",), ("c",)]
    loads = table.loads().count()
    drain.drain(stream_of(spark, path), apply(table, "id"), checkpoint)
    assert table.loads().count() == loads == 2
    spark.createDataFrame([("d", 1), ("a", 1)], "id string, v int").coalesce(1).write.mode("append").parquet(path)
    drain.drain(stream_of(spark, path), apply(table, "id"), checkpoint)
    assert rows(table.read(), "id") == [("a",), ("b",), ("c",), ("d",)]


def test_upsert_takes_the_later_message(spark, rows):
    path = queue_folder(spark, [[("a", 1)]])
    table, checkpoint = SnapshotTable(spark, scratch_path(spark, "t")), scratch_path(spark, "c")
    drain.drain(stream_of(spark, path), drain.merge_into(table, "id"), checkpoint)
    spark.createDataFrame([("a", 2)], "id string, v int").coalesce(1).write.mode("append").parquet(path)
    drain.drain(stream_of(spark, path), drain.merge_into(table, "id"), checkpoint)
    assert rows(table.read()) == [("a", 2)]


@pytest.mark.parametrize("when", ["before", "after"])
def test_failure_around_the_commit(spark, rows, when):
    path = queue_folder(spark, [[("a", 1)], [("b", 1)], [("c", 1)]])
    table, checkpoint = SnapshotTable(spark, scratch_path(spark, "t")), scratch_path(spark, "c")
    state = {"failed": False}

    def fail(number):
        if number == 1 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("boom")

    inner = drain.insert_new(table, "id", on_commit=fail if when == "after" else None)

    def apply(slice_, number):
        if when == "before":
            fail(number)
        inner(slice_, number)

    with pytest.raises(Exception, match="boom"):
        drain.drain(stream_of(spark, path), apply, checkpoint)
    assert table.read().count() == (2 if when == "after" else 1)
    drain.drain(stream_of(spark, path), apply, checkpoint)
    assert rows(table.read(), "id") == [("a",), ("b",), ("c",)]
    assert table.loads().count() == 3


def test_slices_are_merged_level_by_level(spark, rows, monkeypatch):
    """Parts are merged on their own, an older row in a later slice loses, and a read has no exchange."""
    monkeypatch.setattr(tables, "FAN", 3)
    table, want, rng = SnapshotTable(spark, scratch_path(spark, "levels")), {}, random.Random(3)
    levels = set()
    for number in range(14):
        slice_ = [(f"id{rng.randrange(40)}", rng.randrange(6), number) for _ in range(rng.randrange(1, 30))]
        drain.merge_into(table, "id", "at", parts=4)(spark.createDataFrame(slice_, "id string, at int, v int"), number)
        for key, at, v in slice_:
            if (at, v) >= want.get(key, (-1, -1)):
                want[key] = (at, v)
        levels |= {d.split("-")[0] for d in table.head()["dirs"]}
    assert rows(table.read()) == sorted((k, *x) for k, x in want.items())
    assert {"__dir=level0", "__dir=level1", "__dir=level2"} <= levels
    parts = Counter((d.split("-")[0], d.rsplit("/")[-1]) for d in table.head()["dirs"])
    assert max(parts.values()) < 3
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_parts_are_read_by_tasks_of_their_own(spark, rows, monkeypatch, most):
    """Each part is a task at least, also where a merge writes them; a large part is dealt to several."""
    monkeypatch.setattr(tables, "PART_BYTES", most)
    table = SnapshotTable(spark, scratch_path(spark, "parts"))
    for number in range(6):
        slice_ = spark.range(number, 200).selectExpr("CAST(id AS STRING) AS id", f"{number % 5} AS at", f"{number} AS v")
        drain.merge_into(table, "id", "at", parts=4)(slice_, number)
    read = table.read()
    assert ("Exchange" in read._jdf.queryExecution().executedPlan().toString()) == (not most)
    assert read.rdd.getNumPartitions() >= 4
    assert rows(read) == sorted((str(i), min(i, 4), min(i, 4)) for i in range(200))
    merged = [d for d in table.head()["dirs"] if d.startswith("__dir=level1")]
    assert len({d.rsplit("/")[-1] for d in merged}) == 4


def test_slices_whose_types_widen(spark, rows):
    table = SnapshotTable(spark, scratch_path(spark, "wider"))
    drain.merge_into(table, "id")(spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int"), 0)
    drain.merge_into(table, "id")(spark.createDataFrame([("b", 5_000_000_000, "new")], "id string, v bigint, w string"), 1)
    drain.merge_into(table, "id")(spark.createDataFrame([("c", 2)], "id string, v int"), 2)
    assert rows(table.read(), "id", "v", "w") == [("a", 1, None), ("b", 5_000_000_000, "new"), ("c", 2, None)]


def log_of(spark, sizes, parts=3):
    rows = [(p, str(3 * n + 10**20), f"{p}{n}") for p, size in sizes.items() for n in range(size)]
    return spark.createDataFrame(rows, "shard string, seq string, v string").repartition(parts)


def test_a_log_is_drained_by_positions(spark, rows):
    """Numbers beyond any whole number type, a hot partition, a drain that stops, and messages that come later."""
    table = SnapshotTable(spark, scratch_path(spark, "log"))
    log = log_of(spark, {"hot": 400, "b": 3, "c": 0})
    assert positions.drain_log(table, lambda: log, "shard", "seq", 100, slices=2) == 2
    assert table.head()["positions"]["b"] == str(3 * 2 + 10**20) and 150 < table.read().count() < 300
    positions.drain_log(table, lambda: log, "shard", "seq", 100)
    assert rows(table.read()) == rows(log)
    assert positions.drain_log(table, lambda: log, "shard", "seq", 100) == 0
    more = log_of(spark, {"hot": 401, "b": 3, "new": 2})
    positions.drain_log(table, lambda: more, "shard", "seq", 100)
    assert rows(table.read()) == rows(more)


def test_children_of_a_split_wait_for_their_parent(spark):
    table = SnapshotTable(spark, scratch_path(spark, "split"))
    log, parents = log_of(spark, {"a": 50, "a1": 4, "a2": 4, "a21": 2}), {"a1": "a", "a2": "a", "a21": "a2", "late": "gone"}
    seen = []
    while positions.drain_log(table, lambda: log, "shard", "seq", 20, parents=parents, slices=1):
        seen.append({r.shard for r in table.read().select("shard").distinct().collect()})
    assert seen[0] == {"a"} and seen[-2] == {"a", "a1", "a2"} and seen[-1] == {"a", "a1", "a2", "a21"}


def test_positions_by_time(spark):
    frame = spark.createDataFrame([("p", n, dt.datetime(2024, 1, 1 + n)) for n in range(5)] + [("q", 7, dt.datetime(2023, 1, 1))], "part string, n long, at timestamp_ntz")
    assert positions.positions_at(frame, "part", "n", "at", dt.datetime(2024, 1, 3, 12)) == {"p": "2", "q": "6"}
