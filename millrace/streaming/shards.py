"""Shard records: ``shard_id, seq_no, arrived, partition_key, data``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import message_id
from ..operators.cursors import map_cursor

ENVELOPE = ("kinesis", "kinesis_msg_id")


def shard_message_id():
    """Shard and sequence number name one message."""
    return message_id(F.col("shard_id"), F.col("seq_no"))


def shard_envelope(records: DataFrame, stream: str, schema: str | None = None) -> DataFrame:
    """Where a record came from, its id, and its data.

    With a ``schema`` the JSON fields become columns beside the envelope; a field that has the
    name of the envelope is an error, where it would otherwise replace it.
    """
    envelope = F.struct(
        F.col("shard_id"),
        F.col("seq_no"),
        F.col("arrived").cast("timestamp_ntz").alias("ts"),
        F.col("partition_key").alias("partition"),
        F.lit(stream).alias("stream_name"),
    ).alias("kinesis")
    text = F.col("data").cast("string")
    if schema is None:
        return records.select(envelope, shard_message_id().alias("kinesis_msg_id"), text.alias("data"))
    clash = [n for n in T._parse_datatype_string(schema).names if n in ENVELOPE]
    if clash:
        raise ValueError(f"payload fields clash with the envelope: {', '.join(clash)}")
    parsed = F.from_json(text, schema, {"mode": "FAILFAST"}).alias("__payload")
    rows = records.select(envelope, shard_message_id().alias("kinesis_msg_id"), parsed)
    return rows.select(*ENVELOPE, "__payload.*")


def shard_state(records: DataFrame) -> DataFrame:
    """Highest sequence number per shard."""
    return map_cursor(records, "shard_id", "seq_no")
