"""Topic messages: decoding, ids, envelopes and start positions.

Functions work on the seven columns a Kafka read gives, in batch and in streams:
``key, value, topic, partition, offset, timestamp, timestampType``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import message_id
from ..operators.keys import drop_right_keys

TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)
ATTRIBUTES = ("partition", "topic", "key", "offset", "ts", "data")


def decode(column: str, kind: str = "text", schema: str | None = None) -> Column:
    """Bytes to text, to a struct of ``schema``, or without one to a variant. Bad JSON ends the load."""
    text = F.col(column).cast("string")
    if kind == "text":
        return text
    if kind == "json":
        return F.from_json(text, schema, {"mode": "FAILFAST"}) if schema else F.parse_json(text)
    raise ValueError(f"cannot decode {kind!r}; use text or json")


def keyed_id() -> Column:
    """The id of topic, partition and key: the same for all messages of a key."""
    return message_id(F.col("topic"), F.col("partition"), F.col("key").cast("string"))


def offset_id() -> Column:
    """The id of topic, partition and offset: one per message, fit for deduplication."""
    return message_id(F.col("topic"), F.col("partition"), F.col("offset"))


def attributes(value: Column | None = None, key: Column | None = None) -> dict[str, Column]:
    stamp = F.struct(F.col("timestampType").alias("type"), F.col("timestamp").cast("timestamp_ntz").alias("value"))
    return {
        "partition": F.col("partition"),
        "topic": F.col("topic"),
        "key": key if key is not None else decode("key"),
        "offset": F.col("offset"),
        "ts": stamp,
        "data": value if value is not None else decode("value"),
    }


def envelope_v1(messages: DataFrame, value: Column | None = None, key: Column | None = None) -> DataFrame:
    """``_kafka`` with all attributes, the id beside it."""
    fields = [c.alias(n) for n, c in attributes(value, key).items()]
    return messages.select(F.struct(*fields).alias("_kafka"), keyed_id().alias("_kafka_msg_id"))


def envelope_v2(messages: DataFrame, value: Column | None = None, key: Column | None = None) -> DataFrame:
    """The id inside the envelope."""
    fields = [c.alias(n) for n, c in attributes(value, key).items()]
    return messages.select(F.struct(*fields, keyed_id().alias("msg_id")).alias("_kafka"))


def envelope_include(messages: DataFrame, include: Sequence[str], value: Column | None = None) -> DataFrame:
    """The listed attributes only; ``value`` stands for ``data``."""
    known = attributes(value)
    names = ["data" if n == "value" else n for n in include]
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown attributes: {', '.join(unknown)}")
    return messages.select(*[known[n].alias(n) for n in known if n in names])


def envelope_select(messages: DataFrame, attribute: str, value: Column | None = None) -> DataFrame:
    """One attribute is the row; a struct gives its fields."""
    picked = envelope_include(messages, [attribute], value)
    only = picked.schema.fields[0]
    return picked.select(f"{only.name}.*") if isinstance(only.dataType, T.StructType) else picked


def topic_options(
    servers: str, topics: Sequence[str], start_from: dt.datetime | None = None, max_per_trigger: int | None = None
) -> dict[str, str]:
    """Options of a Kafka read. A start time past the end of a partition means its end."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics)}
    if start_from is not None:
        stamp = start_from if start_from.tzinfo else start_from.replace(tzinfo=dt.timezone.utc)
        options["startingTimestamp"] = str(int(stamp.timestamp() * 1000))
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        options["startingOffsets"] = "earliest"
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream. The connector comes with the session."""
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A topic kept as Parquet files of the seven columns, as a stream."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_offsets(messages: DataFrame, at: dt.datetime) -> DataFrame:
    """Per partition the first offset at or after ``at``; if there is none, its last message."""
    late = F.col("timestamp") >= F.lit(at).cast(messages.schema["timestamp"].dataType)
    return messages.groupBy("topic", "partition").agg(
        F.coalesce(F.min(F.when(late, F.col("offset"))), F.max("offset")).alias("start_offset")
    )


def from_offsets(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Messages at or after the start of their partition.

    There is one start per partition of the topics; Catalyst broadcasts them by their size.
    """
    joined = drop_right_keys(messages, starts, ["topic", "partition"], "inner")
    return joined.filter(F.col("offset") >= F.col("start_offset")).drop("start_offset")
