"""The rules V01 to V13: refuse what would lose or corrupt rows, and settle what was left open."""

from __future__ import annotations

import dataclasses
import datetime as dt

from ..operators.masking import PER_RUN, unstable_masks
from .request import FORMATS, SINK_KINDS, SOURCE_KINDS, STRATEGIES, LoadError, LoadRequest


def refuse(condition: object, message: str) -> None:
    if condition:
        raise LoadError(message)


def resolve(request: LoadRequest) -> LoadRequest:
    """The final strategy and target of a checked request."""
    check(request, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    strategy = request.strategy
    if request.source_strategy:
        strategy = request.source_strategy
    elif strategy is None:
        strategy = "append" if request.source_kind == "files" else "replace"
    return dataclasses.replace(request, strategy=strategy, target=request.target or request.source)


def check(request: LoadRequest, now: dt.datetime | None = None) -> None:
    r = request
    refuse(r.strategy is not None and r.strategy not in STRATEGIES, f"unknown strategy {r.strategy!r}")
    refuse(r.source_kind not in SOURCE_KINDS, f"unknown source kind {r.source_kind!r}")
    refuse(r.sink_kind not in SINK_KINDS, f"unknown sink kind {r.sink_kind!r}")
    # V01
    refuse(
        not r.target and (r.source.count(".") != 1 or not all(r.source.split("."))),
        "without a target the source must be named schema.table",
    )
    # V02
    if r.file_incremental:
        refuse(r.source_kind != "files" or not r.files_have_times, "incremental files need modification times")
        refuse(r.strategy not in (None, "append", "none"), "incremental files can only be appended")
        refuse(not r.durable_state, "incremental files need a place to keep their cursor")
    # V03
    refuse(
        r.source_kind == "files" and r.strategy in ("merge", "scd2", "delete+insert"),
        f"{r.strategy} needs a key that files do not expose; use append or replace",
    )
    # V04, V05
    if r.strategy == "scd2" and not r.source_strategy:
        partial = next((n for n in ("incremental_key", "limit") if getattr(r, n)), None)
        refuse(partial, f"scd2 compares whole tables; {partial} would retire the rows it leaves out")
        refuse(
            unstable_masks(r.masks), f"scd2 with masks that change per run: {', '.join(unstable_masks(r.masks))}"
        )
    # A position or a key that a mask has changed finds nothing on the next run.
    masked = {m.split(":")[0]: m.split(":")[1].strip().lower() for m in r.masks if ":" in m}
    refuse(r.incremental_key in masked, "the incremental key cannot be masked")
    lost = [k for k in r.primary_key if masked.get(k) in PER_RUN]
    refuse(lost, f"the mask of the key {', '.join(lost)} changes per run")
    # V07
    refuse(r.multiple_tables and r.sink_kind == "documents", "a document collection holds one table")
    refuse(r.multiple_tables and not r.route, "rows of several tables need a column that names the table (route)")
    refuse(r.route and not r.multiple_tables, "a route makes several tables; say so with multiple_tables")
    if r.multiple_tables:
        refuse(r.strategy not in (None, "replace", "append"), f"{r.strategy} works on one table; routed rows are appended or replaced")
        single = [n for n in ("incremental_key", "limit", "partition_by", "cluster_by", "buckets", "file_incremental") if getattr(r, n)]
        refuse(single, f"{', '.join(single)} belongs to a load of one table")
        refuse(r.route in {m.split(":")[0] for m in r.masks}, "the route cannot be masked")
    if r.nesting is not None:
        refuse(r.strategy not in (None, "replace", "append", "merge"), f"{r.strategy} does not work on records with child tables")
        other = [n for n in ("multiple_tables", "partition_by", "cluster_by", "merge_key", "file_incremental") if getattr(r, n)]
        refuse(other or r.sink_kind == "documents", f"records with child tables have no place for {', '.join(other) or 'documents'}")
    # V08
    refuse(r.format is not None and r.format not in FORMATS, f"unknown format {r.format!r}")
    refuse(
        r.format not in (None, "parquet"),
        f"a table is stored as Parquet; for {r.format} write it out with sinks.files.export",
    )
    # V09
    refuse(
        r.source_kind == "queue" and (r.incremental_key or r.primary_key),
        "a queue brings its own key and position; leave incremental_key and primary_key out",
    )
    # V10
    check_interval(r.interval_start, r.interval_end, now)
    # V11
    refuse(
        r.sink_kind == "documents" and r.strategy == "merge" and not r.primary_key,
        "a document upsert needs a primary key",
    )
    refuse(r.sink_kind == "documents" and r.strategy not in (None, "replace", "merge"), "document sinks take replace or merge")
    if r.sink_kind == "documents":
        kept = [n for n in ("incremental_key", "partition_by", "cluster_by", "buckets", "file_incremental") if getattr(r, n)]
        refuse(kept, f"a document collection has no place for {', '.join(kept)}")
    refuse(r.strategy == "merge" and r.sink_kind == "table" and not r.primary_key, "merge needs a primary key")
    refuse(r.strategy == "delete+insert" and not r.incremental_key, "delete+insert needs an incremental key")


def check_interval(start, end, now: dt.datetime | None = None) -> None:
    """Start before end, and neither in the future."""
    refuse(start is not None and end is not None and start > end, "the interval starts after its end")
    if now is None:
        return
    for bound in (start, end):
        late = isinstance(bound, dt.datetime) and bound > now
        late = late or (isinstance(bound, dt.date) and not isinstance(bound, dt.datetime) and bound > now.date())
        refuse(late, f"the interval reaches into the future: {bound}")
