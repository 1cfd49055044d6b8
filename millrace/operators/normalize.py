"""Types, names, nesting and schema change."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted
from .maintenance import stamp_lineage
from ..session import stage
from .widening import wider

# Type names of column hints.
TYPE_NAMES = {
    "text": "string",
    "bigint": "bigint",
    "double": "double",
    "decimal": "decimal(38,9)",
    "bigdecimal": "decimal(38,18)",
    "bool": "boolean",
    "timestamp": "timestamp",
    "date": "date",
    "time": "string",
    "json": "string",
    "binary": "binary",
    "wei": "decimal(38,0)",
}

VARIANT_NAMES = {"string": "text", "double": "double", "bigint": "bigint", "boolean": "bool", "date": "date"}


def parse_columns(text: str) -> dict[str, str]:
    """``name:type[,name:type]`` to Spark type names."""
    hints: dict[str, str] = {}
    for part in re.split(r",(?![^()]*\))", text):
        if not part.strip():
            continue
        name, colon, kind = part.strip().partition(":")
        base = kind.split("(")[0].strip().lower()
        if not colon or not name.strip() or base not in TYPE_NAMES:
            raise ValueError(f"column hint {part!r} is not name:type with a known type")
        hints[name.strip()] = kind.strip().lower() if "(" in kind else TYPE_NAMES[base]
    return hints


def apply_column_types(df: DataFrame, hints: str | dict[str, str], on_unfit: str = "variant") -> DataFrame:
    """Cast to the hinted types.

    A text value that does not fit is kept in ``<col>__v_text``; ``on_unfit="raise"`` stops the
    load instead. Hints for columns the frame lacks are ignored.
    """
    wanted = parse_columns(hints) if isinstance(hints, str) else hints
    out: list[Column] = []
    for field in df.schema.fields:
        source = F.col(quoted(field.name))
        if field.name not in wanted:
            out.append(source)
            continue
        kind = wanted[field.name]
        cast = source.try_cast(kind)
        unfit = source.isNotNull() & cast.isNull()
        fails = kind != "string" and isinstance(field.dataType, T.StringType)
        if on_unfit == "raise" or (not fails and kind.startswith("decimal")):
            message = F.concat(F.lit(f"{field.name}: value does not fit {kind}: "), source.cast("string"))
            out.append(F.when(unfit, F.raise_error(message)).otherwise(cast).cast(kind).alias(field.name))
            continue
        out.append(cast.alias(field.name))
        if fails:
            out.append(F.when(unfit, source).alias(f"{field.name}__v_text"))
    return df.select(*out)


def snake_case(name: str) -> str:
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    if not text:
        raise ValueError(f"no name is left of {name!r}")
    return f"_{text}" if text[0].isdigit() else text


def normalize_names(df: DataFrame, naming: str = "snake_case") -> DataFrame:
    """snake_case, or ``direct`` to leave names alone. Two names becoming one is an error."""
    if naming == "direct":
        return df
    if naming != "snake_case":
        raise ValueError(f"unknown naming {naming!r}")
    # A leading underscore marks our own columns and stays.
    names = [("_" if c.startswith("_") else "") + snake_case(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after normalising: {', '.join(clashes)}")
    return df.toDF(*names)


def is_list(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType)


def flatten_structs(df: DataFrame, separator: str = "__") -> DataFrame:
    """Struct fields become columns, names joined by ``separator``, at any depth."""

    def walk(path: str, name: str, kind: T.DataType) -> list[Column]:
        if not isinstance(kind, T.StructType):
            return [F.col(path).alias(name)]
        return [
            c
            for f in kind.fields
            for c in walk(f"{path}.{quoted(f.name)}", f"{name}{separator}{f.name}", f.dataType)
        ]

    out = [c for f in df.schema.fields for c in walk(quoted(f.name), f.name, f.dataType)]
    flat = df.select(*out)
    if len(set(flat.columns)) != len(flat.columns):
        raise ValueError("flattened names collide")
    return flat


def shred_nested(
    df: DataFrame, name: str, key: Sequence[str] = (), levels: int = 1, load_id: str = "load"
) -> dict[str, DataFrame]:
    """Lists become child tables ``<name>__<column>``, down to ``levels``; a list of plain values has the column ``value``.

    A child row holds ``_parent_id``, ``_list_idx`` and, for the maintenance of whole records, ``_root_id``. Ids come from the
    key. Without one, the place of a row tells equal rows apart, and rows are staged with their ids, so that
    all tables agree on them. Lists left at the last level are kept as JSON. Every level is a projection; no shuffle.
    """
    if "_row_id" not in df.columns:
        df = stamp_lineage(df, load_id, key=key, unique=not key).drop("_load_id")
        df = df if key else stage(df, "with-ids")
    return _shredded(df, name, levels, root=True)


def _shredded(df: DataFrame, name: str, levels: int, root: bool) -> dict[str, DataFrame]:
    rows = flatten_structs(df)
    lists = [f.name for f in rows.schema.fields if is_list(f.dataType)]
    if levels == 0 or not lists:
        return {name: keep_as_json(rows, lists)}
    tables = {name: rows.drop(*lists)}
    for column in lists:
        child = rows.select(
            F.col("_row_id").alias("_parent_id"),
            F.col("_row_id" if root else "_root_id").alias("_root_id"),
            F.posexplode(F.col(quoted(column))).alias("_list_idx", "__item"),
        )
        item_id = F.sha2(F.concat_ws(":", "_parent_id", F.lit(column), F.col("_list_idx").cast("string")), 256)
        kind = rows.schema[column].dataType.elementType
        item = "__item.*" if isinstance(kind, T.StructType) else F.col("__item").alias("value")
        child = child.select("_parent_id", "_root_id", "_list_idx", item, item_id.alias("_row_id"))
        tables.update(_shredded(child, f"{name}__{column}", levels - 1, root=False))
    return tables


def keep_as_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Array columns as JSON text. The schema decides, not the first row."""
    chosen = columns if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)
    ]
    return df.withColumns({c: F.to_json(F.col(quoted(c))) for c in chosen}) if chosen else df


# Types a Parquet file may have when it is read as another one.
READ_AS = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
    ("int", "bigint"), ("int", "double"), ("float", "double"),
}


def readable_as(files: T.StructType, schema: T.StructType) -> bool:
    """Whether files with these columns can be read with that schema as they are."""
    wanted = {f.name: f.dataType.simpleString() for f in schema.fields}
    have = {f.name: f.dataType.simpleString() for f in files.fields}
    return all(n in wanted and (k == wanted[n] or (k, wanted[n]) in READ_AS) for n, k in have.items())


def evolve(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union in which new columns appear, missing ones are null and types widen.

    Where the batch type does not fit the table's, the batch values go to
    ``<col>__v_<type>`` and the column is null for them.
    """
    left, right = target, batch
    for field in target.schema.fields:
        if field.name not in batch.columns:
            continue
        theirs = batch.schema[field.name].dataType
        common = wider(field.dataType, theirs)
        if common is None and isinstance(field.dataType, T.StringType):
            right = right.withColumn(field.name, F.col(quoted(field.name)).cast("string"))
        elif common is None:
            label = VARIANT_NAMES.get(theirs.simpleString(), theirs.typeName())
            right = right.withColumnRenamed(field.name, f"{field.name}__v_{label}")
        else:
            left = left.withColumn(field.name, F.col(quoted(field.name)).cast(common))
            right = right.withColumn(field.name, F.col(quoted(field.name)).cast(common))
    return left.unionByName(right, allowMissingColumns=True)


def exclude_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop named columns; commas split and names are trimmed."""
    parts = [columns] if isinstance(columns, str) else list(columns)
    names = [n.strip() for part in parts for n in part.split(",") if n.strip()]
    return df.drop(*names)
