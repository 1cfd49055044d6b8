"""Bounded drains over events, delivered as files of messages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import maintenance as M
from ..session import scratch_path
from ..sinks import files as sink
from ..sinks.tables import SnapshotTable
from ..streaming import drain, positions, queues, shards, topics
from .common import register, table

PAYLOAD = "event_id long, user_id long, event_type string, value double, props string"
PAYLOAD_SQL = "event_id, user_id, event_type, value, props"


def messages(spark, sf):
    """Events as topic messages: a topic per event type, the user as key, four partitions."""
    body = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props"))
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.col("event_type").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def message_files(spark, sf, parts=4):
    """The same as a folder of files, in time order, as a broker's archive would be."""
    path = scratch_path(spark, "topic")
    messages(spark, sf).repartitionByRange(parts, "timestamp").write.parquet(path)
    return path


KEYED_ID = """sha256(concat_ws('|', length(event_type) || ':' || event_type, length(CAST(user_id % 4 AS VARCHAR)) || ':' || (user_id % 4),
  length(CAST(user_id AS VARCHAR)) || ':' || user_id))"""
ATTRIBUTES_SQL = """CAST(user_id % 4 AS INTEGER) AS "partition", event_type AS topic, CAST(user_id AS VARCHAR) AS key, event_id AS "offset",
  0 AS ts_type, ts AS ts_value"""


def flat(df, column="_kafka"):
    """The envelope's fields as columns, for comparison."""
    return df.select(
        *[c for c in df.columns if c != column],
        f"{column}.partition", f"{column}.topic", f"{column}.key", f"{column}.offset",
        F.col(f"{column}.ts.type").alias("ts_type"), F.col(f"{column}.ts.value").alias("ts_value"), f"{column}.data.*",
    )


@register("T01_drain_topic", f"SELECT {ATTRIBUTES_SQL}, {KEYED_ID} AS _kafka_msg_id, {PAYLOAD_SQL} FROM events")
def drain_topic(spark, sf):
    """The stream drained to its end into files, in envelopes."""
    stream = topics.read_topic_files(spark, message_files(spark, sf))
    rows = topics.envelope_v1(stream, topics.decode("value", "json", PAYLOAD))
    path = scratch_path(spark, "drained")
    drain.drain_to_files(rows, path, scratch_path(spark, "checkpoint"))
    return flat(spark.read.parquet(path))


@register("T02_envelope_v1", f"SELECT {ATTRIBUTES_SQL}, {KEYED_ID} AS _kafka_msg_id, {PAYLOAD_SQL} FROM events")
def envelope_v1(spark, sf):
    return flat(topics.envelope_v1(messages(spark, sf), topics.decode("value", "json", PAYLOAD)))


@register("T03_envelope_v2", f"SELECT {ATTRIBUTES_SQL}, {KEYED_ID} AS msg_id, {PAYLOAD_SQL} FROM events")
def envelope_v2(spark, sf):
    rows = topics.envelope_v2(messages(spark, sf), topics.decode("value", "json", PAYLOAD))
    return flat(rows.select("_kafka", F.col("_kafka.msg_id").alias("msg_id")))


@register(
    "T04_envelope_include",
    """SELECT CAST(user_id % 4 AS INTEGER) AS "partition", event_type AS topic, CAST(user_id AS VARCHAR) AS key, event_id AS "offset" FROM events""",
)
def envelope_include(spark, sf):
    return topics.envelope_include(messages(spark, sf), ["partition", "topic", "key", "offset"])


@register("T05_envelope_select", f"SELECT {PAYLOAD_SQL} FROM events")
def envelope_select(spark, sf):
    return topics.envelope_select(messages(spark, sf), "value", topics.decode("value", "json", PAYLOAD))


@register(
    "T06_decode_payload",
    "SELECT CAST(user_id AS VARCHAR) AS key, event_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def decode_payload(spark, sf):
    """Key as text, value as a variant with the properties as JSON inside it."""
    decoded = messages(spark, sf).select(topics.decode("key").alias("key"), topics.decode("value", "json").alias("v"))
    return decoded.select(
        "key",
        F.variant_get("v", "$.event_id", "bigint").alias("event_id"),
        F.variant_get("v", "$.value", "double").alias("value"),
        F.variant_get(F.parse_json(F.variant_get("v", "$.props", "string")), "$.k", "bigint").alias("k"),
    )


@register(
    "T07_message_id",
    f"""SELECT count(DISTINCT {KEYED_ID}) AS keyed_ids, count(DISTINCT (event_type, user_id)) AS keys, count(*) AS offset_ids,
  count(*) AS n FROM events""",
)
def message_ids(spark, sf):
    """Keyed ids are as many as keys, offset ids as many as messages."""
    ids = messages(spark, sf).select(topics.keyed_id().alias("k"), topics.offset_id().alias("o"), "topic", "key")
    per_key = ids.groupBy("k").agg(
        F.count_distinct("topic", "key").alias("keys"), F.count_distinct("o").alias("offsets"), F.count(F.lit(1)).alias("n")
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("keyed_ids"), F.sum("keys").alias("keys"), F.sum("offsets").alias("offset_ids"), F.sum("n").alias("n")
    )


@register(
    "T08_start_from",
    """WITH m AS (SELECT *, CAST(user_id % 4 AS INTEGER) AS part FROM events),
s AS (SELECT event_type, part, coalesce(min(CASE WHEN ts >= TIMESTAMP '2024-01-20 00:00:00' THEN event_id END), max(event_id)) AS start_offset
  FROM m GROUP BY 1, 2)
SELECT event_type AS topic, part AS "partition", event_id AS "offset" FROM m JOIN s USING (event_type, part) WHERE event_id >= start_offset""",
)
def start_from(spark, sf):
    frame = messages(spark, sf)
    starts = topics.start_offsets(frame, dt.datetime(2024, 1, 20))
    return topics.from_offsets(frame, starts).select("topic", "partition", "offset")


@register(
    "T08_drain_from_time",
    """WITH m AS (SELECT *, event_type || '-' || (user_id % 4) AS part FROM events),
s AS (SELECT part, coalesce(min(CASE WHEN ts >= TIMESTAMP '2024-01-20 00:00:00' THEN event_id END), max(event_id)) AS first FROM m GROUP BY 1)
SELECT part, event_id, user_id FROM m JOIN s USING (part) WHERE event_id >= first""",
)
def drain_from_time(spark, sf):
    """A log read from a time on in small slices, by two drains: the first one stops in the middle."""
    log = table(spark, sf, "events").withColumn("part", F.concat("event_type", F.lit("-"), F.col("user_id") % 4))
    start = positions.positions_at(log, "part", "event_id", "ts", dt.datetime(2024, 1, 20))
    target = SnapshotTable(spark, scratch_path(spark, "log"))
    most = log.count() // 40 + 1
    for slices in (2, None):
        positions.drain_log(target, lambda: log.select("part", "event_id", "user_id"), "part", "event_id", most, start, slices=slices)
    return target.read()


@register(
    "T12_split_shards",
    """SELECT 'shard-' || event_type AS shard, count(*) AS n, true AS after_parent FROM events GROUP BY 1""",
)
def split_shards(spark, sf):
    """Shards that came from another by a split are read after it, whatever arrives when."""
    log = shard_records(spark, sf).select("shard_id", "seq_no")
    parents = {"shard-view": "shard-click", "shard-error": "shard-view"}
    target = SnapshotTable(spark, scratch_path(spark, "shards"))
    positions.drain_log(target, lambda: log, "shard_id", "seq_no", log.count() // 6 + 1, parents=parents)
    loads = target.loads().select("load_id", "version")
    staged = None
    for directory in target.head()["dirs"]:
        part = target.read([directory]).withColumn("load_id", F.regexp_extract(F.lit(directory), "(slice-[0-9]+)", 1))
        staged = part if staged is None else staged.unionByName(part)
    seen = staged.join(loads, "load_id").groupBy(F.col("shard_id").alias("shard")).agg(
        F.count(F.lit(1)).alias("n"), F.min("version").alias("first"), F.max("version").alias("last")
    )
    known = spark.createDataFrame(list(parents.items()), "shard string, parent string")
    of_parent = seen.select(F.col("shard").alias("parent"), F.col("last").alias("parent_last"))
    joined = seen.join(known, "shard", "left").join(of_parent, "parent", "left")
    return joined.select("shard", "n", F.coalesce(F.col("first") > F.col("parent_last"), F.lit(True)).alias("after_parent"))


@register("T09_topic_tables", "SELECT event_type AS topic, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def topic_tables(spark, sf):
    """Each slice is written to a table per topic in one pass."""
    path = scratch_path(spark, "topics")

    def apply(slice_, number):
        sink.route_tables(slice_, "topic", f"{path}/slice={number}")

    stream = topics.read_topic_files(spark, message_files(spark, sf), max_files=2)
    drain.drain(stream, apply, scratch_path(spark, "checkpoint"))
    routed = spark.read.parquet(path)
    return routed.groupBy(F.col("_route").alias("topic")).agg(F.count(F.lit(1)).alias("n"), F.sum("offset").alias("ids"))


def shard_records(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("shard-"), F.col("event_type")).alias("shard_id"),
        F.col("event_id").cast("string").alias("seq_no"),
        F.col("ts").alias("arrived"),
        F.col("user_id").cast("string").alias("partition_key"),
        F.to_json(F.struct("value", "props")).cast("binary").alias("data"),
    )


SHARD_ID = """sha256(concat_ws('|', length('shard-' || event_type) || ':shard-' || event_type,
  length(CAST(event_id AS VARCHAR)) || ':' || event_id))"""


@register(
    "T10_shard_envelope",
    f"""SELECT 'shard-' || event_type AS shard_id, CAST(event_id AS VARCHAR) AS seq_no, ts, CAST(user_id AS VARCHAR) AS "partition",
  'clicks' AS stream_name, {SHARD_ID} AS kinesis_msg_id, value, props FROM events""",
)
def shard_envelope(spark, sf):
    rows = shards.shard_envelope(shard_records(spark, sf), "clicks", "value double, props string")
    return rows.select("kinesis.*", "kinesis_msg_id", "value", "props")


@register(
    "T11_shard_message_id", f"SELECT CAST(event_id AS VARCHAR) AS seq_no, {SHARD_ID} AS id FROM events"
)
def shard_message_id(spark, sf):
    return shard_records(spark, sf).select("seq_no", shards.shard_message_id().alias("id"))


@register(
    "T12_shard_state",
    "SELECT 'shard-' || event_type AS shard, CAST(max(event_id) AS VARCHAR) AS seq FROM events GROUP BY 1",
)
def shard_state(spark, sf):
    return shards.shard_state(shard_records(spark, sf)).select(F.explode("positions").alias("shard", "seq"))


@register(
    "T13_bounded_slice",
    f"SELECT {PAYLOAD_SQL} FROM events",
)
def bounded_slice(spark, sf):
    """Drained a file per slice: every slice is bounded, nothing is left."""
    path = scratch_path(spark, "slices")
    stream = topics.read_topic_files(spark, message_files(spark, sf, 3), max_files=1)
    rows = topics.envelope_select(stream, "value", topics.decode("value", "json", PAYLOAD))
    drain.drain_to_files(rows, path, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(path)


@register("T13_queue_slice", "SELECT event_id AS id, props AS body FROM events ORDER BY event_id LIMIT 500")
def queue_slice(spark, sf):
    """One batch off the front of the queue."""
    frame = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("props").alias("body"))
    return queues.bounded_slice(frame, "id", queues.BATCH_SIZE)


@register("T13_queue_slices", "SELECT event_id AS id, props AS body FROM events")
def queue_slices(spark, sf):
    """Slice after slice, each beyond the position of the last, until the queue is empty."""
    frame = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("props").alias("body"))
    path, size, last = scratch_path(spark, "queue-slices"), frame.count() // 3 + 1, None
    while True:
        queues.bounded_slice(frame, "id", size, last).write.mode("append").parquet(path)
        now = spark.read.schema(frame.schema).parquet(path).agg(F.max("id")).first()[0]
        if now == last:
            return spark.read.schema(frame.schema).parquet(path)
        last = now


@register(
    "T14_queue_envelope",
    """SELECT CAST(event_id AS VARCHAR) AS _mqb_id, event_type AS kind,
  CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
  CASE event_type WHEN 'view' THEN CAST(user_id AS VARCHAR) WHEN 'error' THEN 'failed' END AS value FROM events""",
)
def queue_envelope(spark, sf):
    """Objects, and among them numbers and texts that become the value column."""
    frame = table(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS id", "map('kind', event_type) AS metadata",
        """CASE event_type WHEN 'view' THEN CAST(user_id AS STRING) WHEN 'error' THEN '"failed"' ELSE props END AS body""",
    )
    rows = queues.queue_envelope(frame, "k long")
    return rows.select("_mqb_id", F.col("_mqb_metadata")["kind"].alias("kind"), "k", "value")


def redelivered(spark, sf):
    """Queue messages, with everything since the middle of the month delivered a second time."""
    frame = table(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS _mqb_id", "ts", "user_id", "event_type", "value"
    )
    path = scratch_path(spark, "queue")
    frame.repartitionByRange(3, "ts").write.parquet(path)
    frame.filter("ts >= TIMESTAMP_NTZ '2024-01-15 00:00:00'").repartitionByRange(2, "ts").write.mode("append").parquet(path)
    return path, frame.schema


ONCE = "SELECT CAST(event_id AS VARCHAR) AS _mqb_id, ts, user_id, event_type, value FROM events"


@register("T15_queue_dedup_merge", ONCE)
def queue_dedup_merge(spark, sf):
    path, schema = redelivered(spark, sf)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)
    target = SnapshotTable(spark, scratch_path(spark, "queue-table"))
    drain.drain(stream, drain.merge_into(target, "_mqb_id"), scratch_path(spark, "checkpoint"))
    return target.read()


@register(
    "T15_changed_redelivery",
    """SELECT CAST(event_id AS VARCHAR) AS _mqb_id, ts, user_id, event_type,
  CASE WHEN event_type IN ('click', 'view') THEN value + 1 ELSE value END AS value,
  CASE WHEN event_type IN ('click', 'view') THEN 2 ELSE 1 END AS edition FROM events""",
)
def changed_redelivery(spark, sf):
    """Messages come again: some in a later edition, in slices of their own, and all in an older one, last of all."""
    frame = table(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS _mqb_id", "ts", "user_id", "event_type", "value", "1 AS edition"
    )
    later = frame.filter("event_type IN ('click', 'view')").withColumns({"value": F.col("value") + 1, "edition": F.lit(2)})
    older = frame.withColumns({"value": F.col("value") - 1, "edition": F.lit(0)})
    target = SnapshotTable(spark, scratch_path(spark, "editions"))
    checkpoint = scratch_path(spark, "checkpoint")
    path = scratch_path(spark, "queue")
    for part in (frame, later, older):
        part.repartitionByRange(2, "ts").write.mode("append").parquet(path)
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(path)
        drain.drain(stream, drain.merge_into(target, "_mqb_id", "edition", parts=4), checkpoint)
    return target.read()


@register("T15_insert_new", ONCE)
def queue_insert_new(spark, sf):
    path, schema = redelivered(spark, sf)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)
    target = SnapshotTable(spark, scratch_path(spark, "queue-table"))
    drain.drain(stream, drain.insert_new(target, "_mqb_id"), scratch_path(spark, "checkpoint"))
    return target.read()


@register("T15_stream_dedup", ONCE)
def stream_dedup(spark, sf):
    path, schema = redelivered(spark, sf)
    stream = spark.readStream.schema(schema).parquet(path)
    out = scratch_path(spark, "deduped")
    rows = drain.dedup_stream(stream, "_mqb_id", "ts", "40 days")
    drain.drain_to_files(rows, out, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("T16_ack_after_commit", ONCE)
def ack_after_commit(spark, sf):
    """The first run dies after a commit and before its acknowledgement; the second one loads the rest."""
    path, schema = redelivered(spark, sf)
    target, checkpoint = SnapshotTable(spark, scratch_path(spark, "acked")), scratch_path(spark, "checkpoint")
    acked = []

    def die_once(number):
        if number == 1 and not acked.count("died"):
            acked.append("died")
            raise ConnectionError("the broker went away before the acknowledgement")
        acked.append(number)

    for _ in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)
        try:
            drain.drain(stream, drain.merge_into(target, "_mqb_id", on_commit=die_once), checkpoint)
        except Exception:
            if acked[-1] != "died":
                raise
    return target.data()
