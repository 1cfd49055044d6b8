"""XML files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted


def blank_to_null(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return F.nullif(F.trim(value), F.lit(""))
    if isinstance(kind, T.StructType):
        fields = [blank_to_null(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: blank_to_null(x, kind.elementType))
    return value


def scan_xml(spark: SparkSession, path: str, tagname: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One row per ``tagname`` element, the outermost where they nest.

    Attributes are ``@name``, text beside children ``#text``, repeated children lists,
    namespaces are dropped. Values are text, trimmed; an empty element is null.
    """
    if not tagname:
        raise ValueError("XML needs the tag of a row")
    reader = (
        spark.read.format("xml")
        .option("rowTag", tagname)
        .option("attributePrefix", "@")
        .option("valueTag", "#text")
        .option("ignoreNamespace", True)
        .option("inferSchema", False)
        .option("mode", "FAILFAST")
    )
    rows = (reader.schema(schema) if schema else reader).load(path)
    return rows.select(*[blank_to_null(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in rows.schema.fields])
