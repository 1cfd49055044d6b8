"""Keyed joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted

def match_many(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = True
) -> DataFrame:
    """Join many ``left`` rows to the distinct keys of ``right``.

    A small ``right`` is broadcast by Catalyst and ``left`` is not moved at all. Otherwise both sides
    are shuffled by an exchange of the join's own, so that adaptive execution can cut a partition of
    ``left`` that one key fills, by its size, and hand each piece that key's row of ``right``. Nothing
    runs before the query does.

    ``right`` has one row per key. Columns of ``right`` beside the keys must not clash.
    """
    # An aggregation right below the join would tie its partitions to its own; so they are dealt anew.
    return drop_right_keys(left, right.hint("rebalance"), keys, how, null_safe)


def drop_right_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = True
) -> DataFrame:
    """Equi-join on ``keys`` that keeps the left key columns only.

    Null-safe by default, as merge keys are; plain equality lets bucketed tables join in place.
    """
    renamed = right.select(
        *[F.col(quoted(k)).alias(f"__right_{i}") for i, k in enumerate(keys)],
        *[F.col(quoted(c)) for c in right.columns if c not in keys],
    )
    condition = F.lit(True)
    for i, key in enumerate(keys):
        mine, theirs = F.col(quoted(key)), F.col(f"__right_{i}")
        condition = condition & (mine.eqNullSafe(theirs) if null_safe else mine == theirs)
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__right_{i}" for i in range(len(keys))])


def without_keys(target: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key does not occur in ``keys_of``."""
    distinct = keys_of.select(*[F.col(quoted(k)) for k in keys]).distinct()
    return match_many(target, distinct, keys, "left_anti")


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), newest: bool = True
) -> DataFrame:
    """One row per key, the newest by ``order_by``.

    Ties are settled by the other columns, so the answer does not depend on partitioning. The
    ``== 1`` filter lets Catalyst place a group limit before the shuffle: each task sends at
    most one row per key, however many copies it holds.
    """
    ranked = [F.col(quoted(c)).desc_nulls_last() if newest else F.col(quoted(c)).asc_nulls_last() for c in order_by]
    rest = [c for c in sorted(df.columns) if c not in {*keys, *order_by} and sortable(df.schema[c].dataType)]
    ranked += [F.col(quoted(c)).desc_nulls_last() for c in rest] or [F.lit(1)]
    window = Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*ranked)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(sortable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))
