"""Which type holds the values of two others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted

# Digits of whole numbers, and whole numbers up to which a fraction type is exact, by kind (fixed values).
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
EXACT_IN = {"float": ("tinyint", "smallint"), "double": ("tinyint", "smallint", "int", "float")}


def wider(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The type that holds every value of both unchanged, or None if there is none."""
    if left == right:
        return left
    if isinstance(left, T.DecimalType) and isinstance(right, T.DecimalType):
        return decimal_of(max(left.precision - left.scale, right.precision - right.scale), max(left.scale, right.scale))
    names = [k.simpleString() for k in (left, right)]
    if all(n in DIGITS for n in names):
        return max((left, right), key=lambda k: DIGITS[k.simpleString()])
    for one, other in ((left, right), (right, left)):
        whole, name = DIGITS.get(one.simpleString()), other.simpleString()
        if isinstance(other, T.DecimalType) and whole:
            return decimal_of(max(whole, other.precision - other.scale), other.scale)
        if one.simpleString() in EXACT_IN.get(name, ()):
            return other
    if set(names) == {"int", "float"}:
        return T.DoubleType()
    return None


def decimal_of(whole: int, scale: int) -> T.DecimalType | None:
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def cast_like(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns the schema knows, in its types."""
    known = {f.name: f.dataType for f in schema.fields}
    differing = [f.name for f in df.schema.fields if f.name in known and known[f.name] != f.dataType]
    return df.withColumns({n: F.col(quoted(n)).cast(known[n]) for n in differing}) if differing else df


def align(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with their shared columns in a type that holds either; text if nothing else does."""
    theirs = {f.name: f.dataType for f in right.schema.fields}
    shared = [f for f in left.schema.fields if f.name in theirs]
    common = T.StructType([T.StructField(f.name, wider(f.dataType, theirs[f.name]) or T.StringType()) for f in shared])
    return cast_like(left, common), cast_like(right, common)
