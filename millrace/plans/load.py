"""One load: validate, read what is new, transform, stage, apply, commit."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import quoted
from ..operators import cursors, maintenance, masking, normalize
from ..operators.keys import dedup_by_key, drop_right_keys, match_many
from ..operators.widening import cast_like
from ..session import stage
from ..sinks.documents import DocumentStore, shape_documents
from ..sinks.files import cluster_by, day_column, gathered
from ..sinks.tables import FOLD, SnapshotTable, TableGroup
from ..sources.filescan import LISTED, FileScan
from .request import LoadError, LoadRequest
from .rules import resolve

Transform = Callable[[DataFrame], DataFrame]


def run_load(
    source: DataFrame | FileScan,
    request: LoadRequest,
    load_id: str | None = None,
    transforms: tuple[Transform, ...] = (),
    full_refresh: bool = False,
    on_commit: Callable[[str], None] | None = None,
    load_time: dt.datetime | None = None,
) -> str:
    """Bring ``source`` into the table at ``request.target``; returns the load id.

    The head of the target table names both its data and the read position, so both move in one
    step. A load that dies before leaves the table and the position as they were.
    ``on_commit`` runs after that step, to acknowledge what was read.

    Files come as a ``FileScan``. With ``file_incremental`` only those are read that the table's list of
    loaded files leaves; the list is part of the same head.
    """
    request = resolve(request)
    load_id = load_id or uuid.uuid4().hex
    files = isinstance(source, FileScan)
    if request.file_incremental and not files:
        raise LoadError("file_incremental needs the files: hand over a FileScan, not rows")
    spark = source.spark if files else source.sparkSession
    write = route_load if request.multiple_tables else document_load if request.sink_kind == "documents" else None
    write = nested_load if request.nesting is not None else write
    if write:
        rows = source.rows(source.listing()) if files else source
        if rows is not None:
            write(spark, rows, request, load_id, transforms, full_refresh)
        if on_commit:
            on_commit(load_id)
        return load_id
    table = SnapshotTable(spark, request.target)
    head = table.begin()
    fresh_start = full_refresh or request.full_refresh or not head["dirs"]
    # A replacement is whole: it neither starts at the position nor leaves out what was there.
    cursor = None if fresh_start or request.strategy == "replace" else head["cursor"]

    rows, table.files_next = (source, None) if not files else file_rows(table, source, request, fresh_start)
    if rows is None:
        # No new file: the table stays as it is, and the log says so.
        if not fresh_start:
            table.commit(load_id, head["dirs"], table.schema(), head["partition_by"], head["cursor"], loaded=0)
        if on_commit:
            on_commit(load_id)
        return load_id
    rows, request = prepared(rows, request, transforms)
    rows = new_rows(rows, request, cursor)
    if request.masks:
        rows = masking.mask_table(rows, request.masks)
    told_by = identity(rows, request)
    rows = without_seen(rows, request, cursor, told_by)
    if request.limit is not None:
        # Of what is not yet loaded, so that every run gets on.
        rows = cursors.lowest(rows, request.limit, request.incremental_key, told_by)
    if request.strategy == "merge" and request.primary_key:
        rows = dedup_by_key(rows, request.primary_key, [request.incremental_key] if request.incremental_key else [])
    rows, partition, buckets = partitioned(rows, request, head)
    if request.strategy != "scd2":
        rows = maintenance.stamp_lineage(rows, load_id, key=request.primary_key)
    if request.cluster_by:
        rows = cluster_by(rows, request.cluster_by)

    # The batch is written once, inside the table's folder. Appends and replacements use these
    # files as they are; the other strategies read them back with their true size known.
    name = table.write_files(rows, f"batch-{load_id}", partition)
    batch = table.spark.read.schema(rows.schema).parquet(f"{table.path}/{name}")
    table.loaded_next = batch.count()
    position = next_position(table, batch, request, cursor, told_by)
    apply_batch(table, batch, name, request, load_id, fresh_start, partition, buckets, position, load_time)
    if on_commit:
        on_commit(load_id)
    return load_id


def file_rows(
    table: SnapshotTable, scan: FileScan, request: LoadRequest, fresh_start: bool
) -> tuple[DataFrame | None, list[dict] | None]:
    """Rows of the files to load, and the lists of loaded files as they are after that.

    The list of this load is written before anything is read, so that what is read and what is listed agree.
    """
    if not request.file_incremental:
        return scan.rows(scan.listing()), None
    lists = [] if fresh_start else table.head()["files"]
    mine = [e for e in lists if e["key"] == scan.key]
    done = table.spark.read.schema(LISTED).parquet(*[f"{table.path}/{e['dir']}" for e in mine]) if mine else None
    name = f"files-{uuid.uuid4().hex[:12]}"
    fresh = scan.unread(done)
    # After many loads one list takes the place of all.
    whole = len(mine) >= FOLD
    (fresh.withColumn("fresh", F.lit(True)).unionByName(done.withColumn("fresh", F.lit(False))) if whole else fresh.withColumn("fresh", F.lit(True))).coalesce(1).write.parquet(f"{table.path}/{name}")
    fresh = table.spark.read.schema(f"{LISTED}, fresh boolean").parquet(f"{table.path}/{name}").filter("fresh")
    others = [e for e in lists if not whole or e["key"] != scan.key]
    return scan.rows(fresh), [*others, {"dir": name, "key": scan.key}]


def prepared(rows: DataFrame, request: LoadRequest, transforms: tuple[Transform, ...]) -> tuple[DataFrame, LoadRequest]:
    """Rows after the transforms of the request's author, under their final names and types."""
    for transform in transforms:
        rows = rows.transform(transform)
    return typed_rows(rows, request)


ROUTE = "__table"


def route_load(
    spark: SparkSession, rows: DataFrame, request: LoadRequest, load_id: str, transforms: tuple[Transform, ...], full_refresh: bool
) -> None:
    """Rows into the tables that the route column names, in one write and with one commit.

    Each table takes its folder of that write. Either all tables have the load or none has, also if it dies between two heads.
    A replacement empties tables that it has no rows for.
    """
    rows, request = prepared(rows, request, transforms)
    if request.masks:
        rows = masking.mask_table(rows, request.masks)
    if ROUTE in rows.columns:
        raise LoadError(f"the data has a column {ROUTE} of its own")
    missing = F.raise_error(F.lit(f"a row has no table in the column {request.route}")).cast("string")
    route = F.coalesce(F.col(quoted(request.route)).cast("string"), missing)
    rows = maintenance.stamp_lineage(rows, load_id, key=request.primary_key)
    # Folders are named by digest, as a table's name may hold what a folder's cannot.
    rows = rows.withColumn(ROUTE, F.substring(F.sha2(route, 256), 1, 32))
    group = TableGroup(spark, request.target)
    writer = SnapshotTable(spark, request.target)
    top = writer.write_files(rows, f"batch-{load_id}", [ROUTE])
    schema = rows.drop(ROUTE).schema
    written = spark.read.schema(rows.schema).option("basePath", f"{writer.path}/{top}").parquet(f"{writer.path}/{top}")
    # One row a table.
    found = {r[0]: (r[1], r[2]) for r in written.groupBy(F.col(quoted(request.route)).cast("string")).agg(F.first(ROUTE), F.count(F.lit(1))).collect()}
    whole = full_refresh or request.full_refresh or request.strategy == "replace"
    names = sorted(found.keys() | set(group.names()) if whole else found)
    tables = group.begin(names)
    for name, table in zip(names, tables):
        folder, n = found.get(name, (None, 0))
        dirs = [f"{top}/{ROUTE}={folder}"] if folder else []
        table.loaded_next = n
        if whole or not table.exists():
            table.commit(load_id, dirs, schema)
        else:
            batch = spark.read.schema(schema).parquet(*[f"{table.path}/{d}" for d in dirs])
            append_batch(table, batch, dirs[0], load_id, None)
    group.commit(tables)


def nested_load(
    spark: SparkSession, rows: DataFrame, request: LoadRequest, load_id: str, transforms: tuple[Transform, ...], full_refresh: bool
) -> None:
    """Records into a table of their own and one for each kind of list below them, with one commit.

    A merge takes whole records: where a record comes again, its row and all rows below it give way, those of other
    records stay. Tables are cut into buckets by the record's id, and a merge reads and writes the buckets of the batch alone.
    The position of the load is that of the record table.
    """
    rows, request = prepared(rows, request, transforms)
    name = request.source.rsplit(".", 1)[-1]
    group = TableGroup(spark, request.target)
    head = group.table(name).head()
    merging = request.strategy == "merge"
    whole = full_refresh or request.full_refresh or request.strategy == "replace" or not head["dirs"]
    cursor = None if whole else head["cursor"]
    rows = new_rows(rows, request, cursor)
    if request.masks:
        rows = masking.mask_table(rows, request.masks)
    told_by = identity(rows, request)
    rows = without_seen(rows, request, cursor, told_by)
    if request.limit is not None:
        rows = cursors.lowest(rows, request.limit, request.incremental_key, told_by)
    rows = maintenance.stamp_lineage(rows, load_id, key=request.primary_key, unique=not request.primary_key).drop("_load_id")
    buckets = head["buckets"] or request.buckets or NESTED_BUCKETS
    # Computed once for all tables, and gathered by bucket before lists become rows: their tables are written without a shuffle.
    rows, bucket = in_buckets(rows, buckets)
    if merging:
        rows = in_buckets(rows, buckets, request)[0]
    of_batch, rows = rows.select(F.col("_row_id").alias("_root_id"), bucket), rows.drop(bucket)
    shredded = normalize.shred_nested(rows, name, levels=request.nesting)
    shredded[name] = shredded[name].withColumn("_root_id", F.col("_row_id"))
    names = sorted(shredded.keys() | set(group.names()) if whole or merging else shredded)
    tables = group.begin(names)
    touched = {r[0] for r in of_batch.select(bucket).distinct().collect()} if merging and not whole else set()
    for each, table in zip(names, tables):
        batch = shredded.get(each)
        if batch is None:
            if whole:
                # No record has such a list any more.
                table.commit(load_id, [], table.schema(), loaded=0)
                continue
            batch = maintenance.strip_lineage(table.read()).filter(F.lit(False)).drop(maintenance.bucket_column(buckets))
        batch = batch.withColumn("_load_id", F.lit(load_id))
        batch, _ = maintenance.add_bucket(batch, ["_root_id"], buckets)
        top = table.write_files(batch, f"batch-{load_id}", [bucket], gather=False)
        dirs = [f"{top}/{p}" for p in table.partitions_of(top, 1)]
        table.loaded_next = table.rows_in(dirs, batch.schema)
        position = next_position(table, rows, request, cursor, told_by) if each == name else None
        if whole or not table.exists():
            table.commit(load_id, dirs, batch.schema, [bucket], position, buckets)
        else:
            stored = spark.read.schema(batch.schema).option("basePath", table.path).parquet(*[f"{table.path}/{d}" for d in dirs]) if dirs else batch.filter(F.lit(False))
            replace_records(table, stored.select(*batch.columns), dirs, of_batch if merging else None, touched, load_id, position, bucket)
    group.commit(tables)


# Buckets of records with child tables, where the request names no number.
NESTED_BUCKETS = 8


# Buckets that are merged one by one; where a batch meets more of them, all are merged together and gathered again.
MOST_APART = 64


def in_buckets(rows: DataFrame, buckets: int, request: LoadRequest | None = None) -> tuple[DataFrame, str]:
    """Records staged in folders by the bucket of their id, and the name of the bucket's column.

    With ``request`` the rows are staged so already, and one row of each key is left: only keys that occur more than once
    are looked at, so rows are not moved for the sake of those that do not.
    """
    if request is None:
        rows, bucket = maintenance.add_bucket(rows, ["_row_id"], buckets)
    else:
        bucket, keys = maintenance.bucket_column(buckets), request.primary_key
        often = rows.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
        often = stage(often, "often")
        if often.isEmpty():
            return rows, bucket
        first = dedup_by_key(drop_right_keys(rows, often, keys, "left_semi"), keys, [request.incremental_key] if request.incremental_key else [])
        rows = match_many(rows, often, keys, "left_anti").unionByName(first)
    return stage(gathered(rows, [bucket]), "records", bucket), bucket


def replace_records(
    table: SnapshotTable, batch: DataFrame, dirs: list[str], roots: DataFrame | None, touched: set[int], load_id: str, position, bucket: str
) -> None:
    """One table of nested records: rows of the ``roots`` go, those of the batch come.

    A bucket's rows are held against the roots of that bucket, so what is left is written as it comes. The files of the
    batch are used as they are.
    """
    there = table.head()["dirs"]
    final = normalize.evolve(empty_like(table), batch).schema
    fits = normalize.readable_as(table.schema(), final) and normalize.readable_as(batch.schema, final)
    if roots is None and fits:
        table.commit(load_id, [*there, *dirs], final, [bucket], position)
        return
    of = {f"{bucket}={b}": b for b in touched}
    met = [d for d in there if not fits or d.rsplit("/", 1)[-1] in of]
    apart = fits and len(of) <= MOST_APART
    if not met:
        kept = empty_like(table)
    elif apart:
        kept = None
        for folder, number in sorted(of.items()):
            if mine := [d for d in met if d.rsplit("/", 1)[-1] == folder]:
                gone = roots.filter(F.col(bucket) == number).select("_root_id")
                rest = maintenance.drop_right_keys(table.read(mine), gone, ["_root_id"], "left_anti")
                kept = rest if kept is None else kept.union(rest)
    else:
        kept = table.read(met)
        if roots is not None:
            kept = maintenance.drop_right_keys(kept, roots.select("_root_id"), ["_root_id"], "left_anti")
    merged = normalize.evolve(kept, batch.filter(F.lit(False)) if fits else batch)
    name = table.write_files(merged, load_id, [bucket], gather=not apart)
    added = [f"{name}/{p}" for p in table.partitions_of(name, 1)] + (dirs if fits else [])
    table.commit(load_id, [*[d for d in there if d not in met], *added], merged.schema, [bucket], position)


def document_load(
    spark: SparkSession, rows: DataFrame, request: LoadRequest, load_id: str, transforms: tuple[Transform, ...], full_refresh: bool
) -> None:
    """Documents into the collection at the target, replaced as a whole or upserted by ``_id``."""
    rows, request = prepared(rows, request, transforms)
    if request.masks:
        rows = masking.mask_table(rows, request.masks)
    if request.limit is not None:
        rows = cursors.lowest(rows, request.limit, None, request.primary_key)
    replace = request.strategy == "replace" or full_refresh or request.full_refresh
    DocumentStore(spark, request.target).write(shape_documents(rows, request.primary_key), load_id, replace)


def typed_rows(source: DataFrame, request: LoadRequest) -> tuple[DataFrame, LoadRequest]:
    """Columns under their final names and types, and the request naming them so."""
    rows = normalize.exclude_columns(source, request.exclude) if request.exclude else source
    renamed = normalize.normalize_names(rows, request.naming)
    final = dict(zip(rows.columns, renamed.columns))
    request = dataclasses.replace(
        request,
        incremental_key=final.get(request.incremental_key, request.incremental_key),
        primary_key=[final.get(k, k) for k in request.primary_key],
        route=final.get(request.route, request.route),
        merge_key=[final.get(k, k) for k in request.merge_key],
        cluster_by=[final.get(k, k) for k in request.cluster_by],
        partition_by=final.get(request.partition_by, request.partition_by),
        masks=[":".join([final.get(m.split(":")[0], m.split(":")[0]), *m.split(":")[1:]]) for m in request.masks],
    )
    if request.columns:
        hints = {final.get(n, n): kind for n, kind in normalize.parse_columns(request.columns).items()}
        renamed = normalize.apply_column_types(renamed, hints)
    return renamed, request


def new_rows(rows: DataFrame, request: LoadRequest, cursor: dict | None) -> DataFrame:
    """Rows of the interval, or from the position on, that row included; the filter reaches the scan.

    A row without a cursor value passes every filter here, and ends the load.
    """
    key = request.incremental_key
    if not key:
        return rows
    if request.interval_end is not None:
        # A closed-off interval is a backfill: it neither uses the position nor moves it.
        inside = cursors.interval_condition(rows, key, request.interval_start, request.interval_end, request.bounds)
    elif cursor:
        inside = F.col(quoted(key)) >= cursors.literal_of(rows, key, cursor["last"])
    else:
        inside = cursors.interval_condition(rows, key, request.interval_start, None, request.bounds)
    return cursors.with_cursor(rows.filter(inside | F.col(quoted(key)).isNull()), key)


def without_seen(rows: DataFrame, request: LoadRequest, cursor: dict | None, told_by: list[str]) -> DataFrame:
    """Rows at the position that the last run loaded go, unless their whole day is replaced anyway.

    What was loaded is remembered in its final form, so this comes after the masks.
    """
    key = request.incremental_key
    if not (key and cursor) or request.interval_end is not None or request.strategy == "delete+insert":
        return rows
    seen = rows.sparkSession.read.schema("key_hash string").parquet(cursor["seen"])
    last = cursors.literal_of(rows, key, cursor["last"])
    return cursors.read_after(rows, key, last, seen, told_by)


def identity(rows: DataFrame, request: LoadRequest) -> list[str]:
    """What tells a row: its key, or its data as far as that is the same on every run.

    ``rows`` has not yet got the columns that the load adds.
    """
    if request.primary_key:
        return request.primary_key
    changing = {m.split(":")[0] for m in request.masks if m.split(":")[1].strip().lower() in masking.PER_RUN}
    return sorted(c for c in rows.columns if c not in changing)


def partitioned(rows: DataFrame, request: LoadRequest, head: dict) -> tuple[DataFrame, list[str], int]:
    """Partition columns: the ones asked for, or buckets and their number. A table keeps the buckets it has."""
    if request.partition_by:
        rows, column = day_column(rows, request.partition_by)
        return rows, [column], 0
    buckets = head["buckets"] or request.buckets
    if buckets and request.primary_key and request.strategy == "merge":
        rows, column = maintenance.add_bucket(rows, request.primary_key, buckets)
        return rows, [column], buckets
    return rows, [], 0


def next_position(
    table: SnapshotTable, batch: DataFrame, request: LoadRequest, cursor: dict | None, told_by: list[str]
) -> dict | None:
    """Highest cursor value, and the key hashes of the rows that hold it, kept as a table."""
    key = request.incremental_key
    if not key or request.interval_end is not None:
        return table.head()["cursor"] if request.interval_end is not None else None
    text = batch.agg(F.max(quoted(key)).cast("string").alias("m")).first()["m"]
    if text is None:
        return cursor
    hashes = cursors.key_hashes(batch, key, text, told_by)
    if cursor and cursor["last"] == text:
        old = batch.sparkSession.read.schema("key_hash string").parquet(cursor["seen"])
        hashes = hashes.union(old).distinct()
    path = table.seen_path(f"seen-{uuid.uuid4().hex[:12]}")
    hashes.write.parquet(path)
    return {"column": key, "last": text, "seen": path}


def apply_batch(
    table: SnapshotTable,
    batch: DataFrame,
    name: str,
    request: LoadRequest,
    load_id: str,
    fresh_start: bool,
    partition: list[str],
    buckets: int,
    position: dict | None,
    load_time: dt.datetime | None,
) -> None:
    strategy = request.strategy
    if strategy == "scd2":
        when = load_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        apply_snapshot(table, batch, load_id, fresh_start, partition, position, when)
        return
    if fresh_start or strategy == "replace":
        table.commit(load_id, [name], batch.schema, partition, position, buckets)
        return
    head = table.head()
    if strategy in ("append", "none"):
        append_batch(table, batch, name, load_id, position)
        return
    merge_key = request.merge_key or ([request.incremental_key] if strategy == "delete+insert" else [])
    by, known = head["partition_by"], table.schema()
    final = normalize.evolve(empty_like(table), batch).schema
    # Rows cannot change partition, and files that stay can be read as the table will be.
    settled = partition == by and bool(by) and normalize.readable_as(known, final)
    if strategy == "delete+insert":
        pruned = settled and len(merge_key) == 1 and by in ([merge_key[0]], [f"{merge_key[0]}_day"])
    else:
        pruned = settled and not merge_key and (bool(buckets) or set(by) <= set(request.primary_key))
    if pruned:
        touched, _ = table.split_dirs(name)
        old = table.read(touched) if touched else empty_like(table)
    else:
        old = table.read()
    if strategy == "delete+insert":
        kept = maintenance.without_keys(old, batch, merge_key)
    else:
        kept = maintenance.drop_right_keys(old, batch.select(*request.primary_key), request.primary_key, "left_anti")
        if merge_key:
            kept = maintenance.without_keys(kept, batch, merge_key)
    rows = normalize.evolve(kept, batch)
    if pruned:
        table.replace_partitions(rows, load_id, position)
    else:
        table.replace(rows, load_id, by, position)


def empty_like(table: SnapshotTable) -> DataFrame:
    return table.spark.createDataFrame([], table.schema())


def apply_snapshot(
    table: SnapshotTable,
    batch: DataFrame,
    load_id: str,
    fresh_start: bool,
    partition: list[str],
    position: dict | None,
    when: dt.datetime,
) -> None:
    """SCD2: only open records are compared, and closed ones are left where they are."""
    data = batch.columns
    if fresh_start:
        opened = maintenance.scd2(None, batch, when, data)
        table.replace_open_records(opened, load_id, opened.filter(F.lit(False)), partition, position)
        return
    dirs = table.open_dirs()
    current = maintenance.scd2(table.read(dirs) if dirs else None, batch, when, data)
    # Columns gone from the source stay in the table, as nulls.
    gone = {f.name: F.lit(None).cast(f.dataType) for f in table.schema().fields if f.name not in current.columns}
    current = current.withColumns(gone) if gone else current
    closed = None
    if not normalize.readable_as(table.schema(), current.schema):
        earlier = table.closed_dirs()
        closed = cast_like(table.read(earlier), current.schema) if earlier else current.filter(F.lit(False))
    table.replace_open_records(current, load_id, closed, partition, position)


def append_batch(table: SnapshotTable, batch: DataFrame, name: str, load_id: str, position: dict | None) -> None:
    """Add the batch at the cost of the batch: old files are rewritten only if they cannot be
    read with the new schema, which a new column or a wider number does not cause."""
    head, target = table.head(), table.read()
    merged = normalize.evolve(target, batch)
    if not normalize.readable_as(table.schema(), merged.schema):
        table.replace(merged, load_id, head["partition_by"], position)
    elif normalize.readable_as(batch.schema, merged.schema):
        table.commit(load_id, [*head["dirs"], name], merged.schema, head["partition_by"], position)
    else:
        table.append(normalize.evolve(empty_like(table), batch), load_id, position)

