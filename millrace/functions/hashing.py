"""Row and key hashes, message ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINEAGE_COLUMNS = ("_load_id", "_row_id")
VALIDITY_COLUMNS = ("_valid_from", "_valid_to")


def hash_columns(columns: Iterable[str]) -> Column:
    """SHA-256 of named values; null and the text "null" differ, as do ("a","b") and ("ab","")."""
    row = F.struct(*[F.col(quoted(c)) for c in columns])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def row_hash(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """Hash of every data column, in name order, leaving lineage and validity columns out."""
    skip = {*LINEAGE_COLUMNS, *VALIDITY_COLUMNS, *exclude}
    return hash_columns(sorted(c for c in df.columns if c not in skip))


def message_id(*parts: Column) -> Column:
    """Hex digest over the parts in order. Nulls count as empty, lengths keep parts apart."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *[F.concat_ws(":", F.length(t).cast("string"), t) for t in texts]), 256)


def quoted(name: str) -> str:
    """Column name with backticks, so that dots in it are not read as struct access."""
    return "`" + name.replace("`", "``") + "`"
