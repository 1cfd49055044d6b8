"""Values that source databases deliver in shapes of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted
from ..functions.times import ZERO_DATE


def repair_source_types(
    df: DataFrame,
    dates: Sequence[str] = (),
    sets: Sequence[str] = (),
    json: Sequence[str] = (),
    zero_date: str = "epoch",
) -> DataFrame:
    """Zero dates to the epoch (they stand for missing; ``zero_date="null"`` says so), comma sets
    to lists, JSON text to variants. A date or JSON that cannot be read is kept in ``<name>__v_text``."""
    out = {}
    for name in dates:
        value = F.col(quoted(name))
        if isinstance(df.schema[name].dataType, T.StringType):
            stand_in = F.lit("1970-01-01 00:00:00" if zero_date == "epoch" else None)
            text = F.when(value.startswith(ZERO_DATE), stand_in).otherwise(value)
            out[name] = text.try_cast("timestamp_ntz")
            out[f"{name}__v_text"] = F.when(text.isNotNull() & out[name].isNull(), value)
    for name in sets:
        value = F.col(quoted(name))
        out[name] = F.when(value == "", F.array().cast("array<string>")).otherwise(F.split(value, ","))
    for name in json:
        out[name] = F.try_parse_json(quoted(name))
        out[f"{name}__v_text"] = F.when(out[name].isNull(), F.col(quoted(name)))
    return df.withColumns(out) if out else df
