"""Table maintenance: what the target holds after a batch. Nothing is written here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import LINEAGE_COLUMNS, VALIDITY_COLUMNS, hash_columns, quoted, row_hash
from .keys import dedup_by_key, drop_right_keys, match_many, without_keys
from .widening import align, cast_like

BUCKET_PREFIX = "_bucket_"


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Old rows and new rows; missing columns become null."""
    return target.unionByName(batch, allowMissingColumns=True)


def merge(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Matched rows are replaced, absent rows kept, new rows added.

    The target side is only anti-joined: a small batch is broadcast as a key set and the target
    is not shuffled. Keys compare null-safe. Target keys are unique, so no key is hot there.
    """
    if not keys:
        raise ValueError("merge needs a primary key")
    kept = drop_right_keys(target, batch.select(*keys).distinct(), keys, "left_anti")
    return append(kept, dedup_by_key(batch, keys, order_by))


def delete_insert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the target sharing a key value with the batch go, the batch comes in whole."""
    return append(without_keys(target, batch, [key]), batch)


def merge_two_keys(
    target: DataFrame,
    batch: DataFrame,
    primary_key: Sequence[str],
    merge_key: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Target rows matching on the primary key or on the merge key go, deduplicated batch in."""
    kept = without_keys(target, batch, merge_key)
    kept = drop_right_keys(kept, batch.select(*primary_key).distinct(), primary_key, "left_anti")
    return append(kept, dedup_by_key(batch, primary_key, order_by))


def scd2(
    history: DataFrame | None, batch: DataFrame, load_time, data_columns: Sequence[str] | None = None
) -> DataFrame:
    """Full history of a table from whole snapshots.

    Open records and the snapshot are put on one pile and grouped by all their columns: a group
    without a snapshot row is closed now, one without an open record is opened now, one with
    both is untouched. That is a single aggregation with partial sums, which also folds copies
    within the snapshot, and it compares values, not hashes of them. Closed records pass
    through, so a row that went and came back opens a second record.
    """
    columns = list(data_columns or batch.columns)
    clash = sorted({*columns} & {*VALIDITY_COLUMNS, "__had", "__has"})
    if clash:
        raise ValueError(f"a history has columns of its own with the names {', '.join(clash)}")
    when = F.lit(load_time).cast("timestamp_ntz")
    never = F.lit(None).cast("timestamp_ntz")
    now = batch.select(*columns, never.alias("_valid_from"), F.lit(False).alias("__had"), F.lit(True).alias("__has"))
    if history is not None:
        was = history.filter(F.col("_valid_to").isNull()).drop("_valid_to")
        was = was.withColumns({"__had": F.lit(True), "__has": F.lit(False)})
        columns = [*columns, *[c for c in history.columns if c not in (*columns, "_valid_from", "_valid_to")]]
        now, was = align(now, was)
        now = now.unionByName(was, allowMissingColumns=True)
    grouped = now.groupBy(*[F.col(quoted(c)) for c in columns]).agg(
        F.bool_or("__had").alias("__had"), F.bool_or("__has").alias("__has"), F.min("_valid_from").alias("_valid_from")
    )
    current = grouped.select(
        *[F.col(quoted(c)) for c in columns],
        F.when(F.col("__had"), F.col("_valid_from")).otherwise(when).alias("_valid_from"),
        F.when(~F.col("__has"), when).alias("_valid_to"),
    )
    if history is None:
        return current
    closed = cast_like(history.filter(F.col("_valid_to").isNotNull()), current.schema)
    return current.unionByName(closed, allowMissingColumns=True)


def stamp_lineage(
    df: DataFrame, load_id: str, key: Sequence[str] = (), unique: bool = False
) -> DataFrame:
    """``_load_id`` per run and ``_row_id`` per row, without a shuffle.

    The row id is the hash of the key, or of the whole row. ``unique`` adds the row's place in
    its partition, which tells exact copies apart; a retried task reading the same files gives
    the same ids.
    """
    digest = hash_columns(key) if key else row_hash(df)
    if unique:
        place = F.monotonically_increasing_id().cast("string")
        digest = F.sha2(F.concat_ws(":", digest, place), 256)
    return df.withColumns({"_load_id": F.lit(load_id), "_row_id": digest})


def strip_lineage(df: DataFrame, buckets: int = 0) -> DataFrame:
    """Without the columns a load adds: its two, and the one of a table cut into ``buckets``."""
    return df.drop(*LINEAGE_COLUMNS, *([bucket_column(buckets)] if buckets else []))


def bucket_column(buckets: int) -> str:
    return f"{BUCKET_PREFIX}{buckets}"


def add_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> tuple[DataFrame, str]:
    """A partition column from the key, so that an upsert rewrites the buckets of its keys only.

    The number is part of the name. Keys are hashed as text: a key that widens from int to
    bigint keeps its bucket.
    """
    name = bucket_column(buckets)
    if name in df.columns:
        raise ValueError(f"the data has a column {name} of its own")
    digest = F.xxhash64(*[F.col(quoted(k)).cast("string") for k in keys])
    return df.withColumn(name, F.pmod(digest, F.lit(buckets)).cast("int")), name


def fan_out(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, carry: Sequence[str]) -> DataFrame:
    """Each child row carries columns of its parent. Parents are unique by key.

    One parent may own a large share of the children, hence the spread join.
    """
    side = parents.select(F.col(parent_key).alias(child_key), *[F.col(c).alias(f"parent_{c}") for c in carry])
    return match_many(children, side, [child_key], "inner", null_safe=False)
