"""Grids of cells, as sheets deliver them, to tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.normalize import snake_case

# Day number of 1970-01-01 in sheets, seconds per day, and the number formats that
# mean a time.
EPOCH_DAY = 25569
DAY_SECONDS = 86400
FORMAT_TYPES = {"DATE_TIME": "timestamp", "TIME": "timestamp", "DATE": "date"}

# Sheet column types and the column type they hint.
SHEET_TYPES = {"DATE": "date", "DATETIME": "timestamp", "CHECKBOX": "boolean", "TEXT_NUMBER": "string"}


def serial_to_time(value: Column, kind: str) -> Column:
    """Day numbers to times. Cells that hold no number give null."""
    number = value.try_cast("double")
    at = F.timestamp_seconds(F.round((number - EPOCH_DAY) * DAY_SECONDS).cast("bigint")).cast("timestamp_ntz")
    return F.to_date(at) if kind == "date" else at


def grid_to_table(grid: DataFrame, formats: Sequence[str | None] = (), row: str = "row_no", cells: str = "cells") -> DataFrame:
    """Rows of cells (``row_no``, ``cells`` as text) to a table.

    Blank rows on top and blank cells left of the header are trimmed. The first row left is the
    header; a blank header becomes ``col_<n>``, cells beyond the header are dropped, blank rows
    and blank cells give nothing. ``formats`` are the number formats of the first data row: day
    numbers in DATE, DATE_TIME and TIME columns become dates and times.

    The header is the only row that goes to the driver.
    """
    filled = F.exists(cells, lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    head = grid.filter(filled).agg(F.min_by(cells, row).alias("header"), F.min(row).alias("at")).first()
    if head["header"] is None:
        raise ValueError("the grid is blank")
    header = head["header"]
    left = next(i for i, name in enumerate(header) if (name or "").strip())
    names = [(n or "").strip() or f"col_{i + 1}" for i, n in enumerate(header[left:])]
    normal = [snake_case(n) for n in names]
    if len(set(normal)) != len(normal):
        raise ValueError(f"header names collide: {names}")
    body = grid.filter(filled & (F.col(row) > F.lit(head["at"])))
    out = []
    for i, name in enumerate(names):
        cell = F.get(F.col(cells), F.lit(left + i))
        value = F.nullif(cell, F.lit(""))
        kind = FORMAT_TYPES.get((formats[i] if i < len(formats) else None) or "")
        out.append((serial_to_time(value, kind) if kind else value).alias(name))
    return body.select(*out)


def sheet_rows(grid: DataFrame, titles: Sequence[str], kinds: Mapping[str, str], row_id: str = "row_no") -> DataFrame:
    """Sheet variant: titles are given, columns typed by the sheet, each row with its ``_row_id``."""
    cols = [
        F.nullif(F.get("cells", F.lit(i)), F.lit("")).try_cast(SHEET_TYPES.get(kinds.get(t, ""), "string")).alias(t)
        for i, t in enumerate(titles)
    ]
    return grid.select(F.col(row_id).alias("_row_id"), *cols)
