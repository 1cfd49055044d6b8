"""What a load is asked to do, and the checks made before any data moves."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

STRATEGIES = ("replace", "append", "merge", "delete+insert", "scd2", "none")
SOURCE_KINDS = ("table", "files", "queue", "documents")
SINK_KINDS = ("table", "documents")
FORMATS = ("parquet", "jsonl", "csv")


class LoadError(ValueError):
    """A combination of options that would harm the data."""


@dataclass(kw_only=True)
class LoadRequest:
    source: str
    target: str | None = None
    strategy: str | None = None
    incremental_key: str | None = None
    primary_key: list[str] = field(default_factory=list)
    merge_key: list[str] = field(default_factory=list)
    interval_start: dt.datetime | dt.date | int | None = None
    interval_end: dt.datetime | dt.date | int | None = None
    bounds: str = "[]"
    file_incremental: bool = False
    full_refresh: bool = False
    partition_by: str | None = None
    cluster_by: list[str] = field(default_factory=list)
    # Parts of an upserted table without a partition of its own, by hash of the primary key.
    buckets: int = 0
    columns: str = ""
    exclude: list[str] = field(default_factory=list)
    masks: list[str] = field(default_factory=list)
    naming: str = "direct"
    limit: int | None = None
    format: str | None = None
    source_kind: str = "table"
    sink_kind: str = "table"
    # Set where the source brings its own way of writing (a queue merges on the message id).
    source_strategy: str | None = None
    # One stream into many tables: the column ``route`` names the table of each row.
    multiple_tables: bool = False
    route: str | None = None
    # Levels of lists that become tables of their own, in a folder of tables; none: lists stay lists.
    nesting: int | None = None
    files_have_times: bool = True
    durable_state: bool = True
