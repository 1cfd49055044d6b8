"""Column masking: ``column:algorithm[:parameter]`` applied to a whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import masks
from ..functions.hashing import quoted
from ..session import cut_lineage

Mask = Callable[[Column, T.DataType, str | None], Column]

MASKS: dict[str, Mask] = {
    "hash": lambda c, t, p: masks.sha256(c, t),
    "sha256": lambda c, t, p: masks.sha256(c, t),
    "md5": lambda c, t, p: masks.md5(c, t),
    "hmac": lambda c, t, p: masks.hmac_sha256(c, t, required_key(p)),
    "email": lambda c, t, p: masks.email(c, t),
    "phone": lambda c, t, p: masks.phone(c, t),
    "credit_card": lambda c, t, p: masks.credit_card(c, t),
    "ssn": lambda c, t, p: masks.ssn(c, t),
    "redact": lambda c, t, p: F.lit("REDACTED"),
    "stars": lambda c, t, p: masks.all_stars(c, t),
    "fixed": lambda c, t, p: F.lit(p or "MASKED"),
    "random": lambda c, t, p: masks.random_value(c, t),
    "partial": lambda c, t, p: masks.partial(c, t, int(p) if p else 2),
    "first_letter": lambda c, t, p: masks.first_letter(c, t),
    "round": lambda c, t, p: masks.rounded(c, t, int(p) if p else 10),
    "range": lambda c, t, p: masks.bucketed(c, t, int(p) if p else 100),
    "noise": lambda c, t, p: masks.noise(c, t, float(p) if p else 0.1),
    "date_shift": lambda c, t, p: masks.date_shift(c, t, int(p) if p else 30),
    "year_only": lambda c, t, p: masks.year_only(c, t),
    "month_year": lambda c, t, p: masks.month_year(c, t),
}
# Masks over the distinct values of a column rather than over one cell.
TOKEN_MASKS = ("uuid", "sequential")
UNSTABLE = ("date_shift", "noise", "random", "uuid")
# Sequential numbers are the same for the same table, but not for the next batch of it.
PER_RUN = (*UNSTABLE, "sequential")


def required_key(key: str | None) -> str:
    if not key:
        raise ValueError("hmac needs a key: column:hmac:<key>")
    return key


def parse_mask(config: str) -> tuple[str, str, str | None]:
    parts = config.split(":")
    if len(parts) not in (2, 3) or not parts[0]:
        raise ValueError(f"mask {config!r} is not column:algorithm[:parameter]")
    algorithm = parts[1].strip().lower()
    if algorithm not in MASKS and algorithm not in TOKEN_MASKS:
        raise ValueError(f"unknown masking algorithm {algorithm!r}")
    return parts[0].strip(), algorithm, parts[2] if len(parts) == 3 else None


def unstable_masks(configs: Sequence[str]) -> list[str]:
    """Those whose result differs from run to run."""
    named = [(c, c.split(":")[1].strip().lower()) for c in configs if len(c.split(":")) in (2, 3)]
    return [c for c, algorithm in named if algorithm in UNSTABLE]


def mask_table(df: DataFrame, configs: Sequence[str]) -> DataFrame:
    """Apply all masks. Columns the frame lacks are passed over.

    Fails closed: a cell a mask cannot handle never comes out clear by accident, since every
    mask is an expression over the whole column and an error ends the load.
    """
    cells: dict[str, Column] = {}
    sequential: list[str] = []
    for config in configs:
        column, algorithm, parameter = parse_mask(config)
        if column not in df.columns:
            continue
        kind = df.schema[column].dataType
        source = F.col(quoted(column))
        if algorithm == "uuid":
            cells[column] = masks.uuid_token(source, kind, uuid.uuid4().hex)
        elif algorithm == "sequential":
            sequential.append(column)
        else:
            cells[column] = MASKS[algorithm](source, kind, parameter)
    out = df.withColumns(cells) if cells else df
    for column in sequential:
        out = mask_sequential(out, column)
    return out


def number_values(df: DataFrame, column: str, order_by: Sequence[str] = ()) -> DataFrame:
    """1..n over the distinct values of ``column``, in order of first arrival.

    ``order_by`` says what arrival means; without it values are numbered in their own order.
    The values are ranged over all tasks, counted per task, and numbered from the running total
    of the counts, so no task sees them all. The counts are one row per task.
    """
    arrival = F.min(F.struct(*[F.col(quoted(c)) for c in order_by])) if order_by else F.lit(0)
    values = (
        df.filter(F.col(quoted(column)).isNotNull())
        .groupBy(F.col(quoted(column)).alias("value"))
        .agg(arrival.alias("__first"))
        .repartitionByRange(F.col("__first"), F.col("value"))
        .sortWithinPartitions("__first", "value")
        .select("value", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at"))
    )
    # The range bounds are drawn from a sample, so the numbering must not be computed twice.
    placed = cut_lineage(values)
    per_part = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("__start"))
    before = per_part.selectExpr("__part", "__start", "sum(n) OVER (ORDER BY __part) - n AS __before")
    return placed.join(F.broadcast(before), "__part").select(
        "value", (F.col("__before") + F.col("__at") - F.col("__start") + 1).alias("number")
    )


def mask_sequential(df: DataFrame, column: str, order_by: Sequence[str] = ()) -> DataFrame:
    from .keys import match_many

    numbers = number_values(df, column, order_by).select(F.col("value").alias(column), F.col("number").alias("__number"))
    joined = match_many(df, numbers, [column], "left")
    return joined.withColumn(column, F.col("__number")).drop("__number").select(*df.columns)
