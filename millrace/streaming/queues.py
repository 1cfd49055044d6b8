"""Queue messages: ``id, metadata, body``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cursors import lowest

# A fixed value: how many messages come at once.
BATCH_SIZE = 500


def queue_envelope(messages: DataFrame, schema: str | None = None, text: bool = False) -> DataFrame:
    """``_mqb_id``, ``_mqb_metadata`` and the payload's fields.

    A payload that is no object, or any payload in text form, is the column ``value``.
    """
    body = F.col("body").cast("string")
    head = [F.col("id").alias("_mqb_id"), F.col("metadata").alias("_mqb_metadata")]
    if text or schema is None:
        return messages.select(*head, body.alias("value"))
    kind = T._parse_datatype_string(schema)
    is_object = F.schema_of_variant(F.parse_json(body)).startswith("OBJECT")
    parsed = F.when(is_object, F.from_json(body, kind, {"mode": "FAILFAST"})).alias("__p")
    plain = F.when(~is_object, F.coalesce(F.get_json_object(body, "$"), body)).alias("__plain")
    rows = messages.select(*head, parsed, plain)
    if "value" in kind.names:
        own = F.coalesce(F.col("__p.value").cast("string"), F.col("__plain")).alias("value")
        others = [F.col(f"__p.`{n}`").alias(n) for n in kind.names if n != "value"]
        return rows.select("_mqb_id", "_mqb_metadata", *others, own)
    return rows.select("_mqb_id", "_mqb_metadata", "__p.*", F.col("__plain").alias("value"))


def bounded_slice(messages: DataFrame, order_by: str = "id", max_messages: int | None = None, after=None) -> DataFrame:
    """The messages beyond the position ``after``; the first ``max_messages`` of them if that is given.

    The next slice begins after the last message of this one, so that slices reach every message. The end of a slice is
    found by counts (``cursors.lowest``), so a slice may be large.
    """
    rest = messages if after is None else messages.filter(F.col(order_by) > F.lit(after))
    return rest if max_messages is None else lowest(rest, max_messages, order_by)
