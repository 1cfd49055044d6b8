"""Reading times out of numbers and untidy text. Results carry no zone and mean UTC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms tried for date text, and text that stands for no date.
DATE_FORMS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd")
NO_DATE = ("", "0", "null", "NULL")
ZERO_DATE = "0000-00-00"
# Above this a number counts milliseconds.
MILLIS_FROM = 10_000_000_000

NTZ = "timestamp_ntz"


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(NTZ)


def parse(value: Column, forms: Sequence[str]) -> Column:
    """The first form that fits, else null."""
    tries = [F.try_to_timestamp(value, F.lit(form)).cast(NTZ) for form in forms]
    return F.coalesce(*tries) if len(tries) > 1 else tries[0]


def parse_iso(value: Column) -> Column:
    """ISO text with or without a zone, at UTC; blank or unreadable gives null."""
    return F.nullif(F.trim(value), F.lit("")).try_cast("timestamp").cast(NTZ)


def from_epoch(value: Column, unit: str = "auto") -> Column:
    number = value.try_cast("double")
    seconds = {"s": number, "ms": number / 1000}.get(unit)
    if unit == "auto":
        seconds = F.when(number > MILLIS_FROM, number / 1000).otherwise(number)
    if seconds is None:
        raise ValueError(f"unit must be s, ms or auto, got {unit!r}")
    return F.timestamp_micros(F.round(seconds * 1_000_000).cast("bigint")).cast(NTZ)


def repair(value: Column, zero_date: str = "epoch") -> tuple[Column, Column]:
    """The time, and the text where there is text that is no time."""
    zero = value.startswith(ZERO_DATE)
    blank = value.isin(*NO_DATE)
    read = parse(F.when(~zero & ~blank, value), DATE_FORMS)
    fixed = F.when(zero, epoch() if zero_date == "epoch" else F.lit(None).cast(NTZ)).otherwise(read)
    left = F.when(value.isNotNull() & ~zero & ~blank & read.isNull(), value)
    return fixed, left
