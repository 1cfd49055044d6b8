"""Record shaping: nested and badly typed records into plain columns and rows.

Everything here is a projection, a filter or an ``explode`` inside a row, so nothing is shuffled
unless the docstring says so.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times
from ..functions.hashing import quoted
from .keys import match_many
from .normalize import flatten_structs


def c(name: str) -> Column:
    return F.col(quoted(name))


def refuse_clash(names: Sequence[str]) -> None:
    doubled = sorted({n for n in names if list(names).count(n) > 1})
    if doubled:
        raise ValueError(f"columns clash: {', '.join(doubled)}")


# ---- nesting -------------------------------------------------------------------------------


def flatten_struct(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested objects become ``a_b`` columns."""
    return flatten_structs(df, separator)


def lift(df: DataFrame, column: str) -> DataFrame:
    """The fields of one object become columns without a prefix."""
    fields = df.schema[column].dataType.names
    others = [n for n in df.columns if n != column]
    refuse_clash([*others, *fields])
    return df.select(*[c(n) for n in others], *[c(column)[f].alias(f) for f in fields])


def collapse_refs(df: DataFrame, sole_key: bool = False) -> DataFrame:
    """An object with an id becomes ``<name>_id``, a list of such objects a list of ids.

    ``sole_key`` collapses only objects that hold nothing but the id.
    """

    def is_ref(kind: T.DataType) -> bool:
        return isinstance(kind, T.StructType) and "id" in kind.names and (not sole_key or len(kind.names) == 1)

    out = []
    for field in df.schema.fields:
        kind = field.dataType
        if is_ref(kind):
            out.append(c(field.name)["id"].alias(f"{field.name}_id"))
        elif isinstance(kind, T.ArrayType) and is_ref(kind.elementType):
            out.append(F.transform(c(field.name), lambda x: x["id"]).alias(field.name))
        else:
            out.append(c(field.name))
    refuse_clash([f.name for f in df.select(*out).schema.fields])
    return df.select(*out)


def unwrap(value: Column, kind: T.DataType) -> Column:
    """``{nodes: [...]}`` to the list, at any depth."""
    if isinstance(kind, T.StructType):
        if "nodes" in kind.names:
            return unwrap(value["nodes"], kind["nodes"].dataType)
        fields = [unwrap(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(value, lambda x: unwrap(x, kind.elementType))
    return value


def unwrap_nodes(df: DataFrame) -> DataFrame:
    """Connection objects become lists; a ``totalCount`` is kept as ``<name>_total_count``."""
    out = []
    for field in df.schema.fields:
        out.append(unwrap(c(field.name), field.dataType).alias(field.name))
        if isinstance(field.dataType, T.StructType) and {"nodes", "totalCount"} <= set(field.dataType.names):
            out.append(c(field.name)["totalCount"].alias(f"{field.name}_total_count"))
    return df.select(*out)


def found_labels(df: DataFrame, bag: str, known: DataFrame | None = None, field: str = "label") -> DataFrame:
    """The dictionary (field, code, label) of a bag after a look at the data: old columns stay, new labels come in.

    One partial aggregation of the labels; a label's column is its ``universal_id`` where the bag has that, else its text in
    lower case with underscores.
    """
    entry = df.select(F.explode(c(bag)).alias("e"))
    own = F.lower(F.replace(F.col("e.label"), F.lit(" "), F.lit("_")))
    kind = df.schema[bag].dataType.elementType
    if "universal_id" in kind.names:
        own = F.coalesce(F.nullif(F.col("e.universal_id"), F.lit("")), own)
    found = entry.where("e.label is not null").groupBy(F.lit(field).alias("field"), F.col("e.label").alias("code"))
    return stable_dictionary(known, found.agg(F.min(own).alias("label")))


def names_of(dictionary: DataFrame, field: str = "label") -> dict[str, str]:
    """The dictionary of one bag as a mapping from label to column: as many as the wide table has columns."""
    return {r.code: r.label for r in dictionary.where(F.col("field") == field).orderBy("code").collect()}


def pivot_label_bag(
    df: DataFrame, bag: str, names: Mapping[str, str], dates: Sequence[str] = (), other: str | None = "__other"
) -> DataFrame:
    """A list of ``{label, value, type}`` becomes columns.

    ``names`` maps label to column, from the field dictionary (``found_labels``), so no pass over the data
    finds them here and no shuffle brings them together. Labels in ``dates`` are typed as times. What has no column, comes a
    second time, or is no time though its label says so, is kept in ``other`` as JSON, for the next run's dictionary.
    """
    kept = [n for n in df.columns if n != bag]
    refuse_clash([*kept, *names.values(), *([other] if other else [])])

    def first_of(label: str) -> Column:
        return F.get(F.filter(c(bag), lambda x: x["label"] == F.lit(label)), F.lit(0))

    def value_of(label: str) -> Column:
        value = first_of(label)["value"]
        return times.parse_iso(value) if label in dates else value

    out = [value_of(k).alias(v) for k, v in names.items()]
    if other:
        place = F.transform(c(bag), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        labels = F.transform(c(bag), lambda x: x["label"])
        known = F.array(*[F.lit(k) for k in names]) if names else F.array().cast("array<string>")

        def lifted(e: Column) -> Column:
            first = F.array_position(labels, e["x"]["label"]) == e["i"] + 1
            read = F.lit(True)
            for label in dates:
                unread = (e["x"]["label"] == F.lit(label)) & e["x"]["value"].isNotNull() & times.parse_iso(e["x"]["value"]).isNull()
                read = read & ~F.coalesce(unread, F.lit(False))
            return F.coalesce(F.array_contains(known, e["x"]["label"]) & first & read, F.lit(False))

        rest = F.transform(F.filter(place, lambda e: ~lifted(e)), lambda e: e["x"])
        out.append(F.when(F.size(rest) > 0, F.to_json(rest)).alias(other))
    return df.select(*[c(n) for n in kept], *out)


def label_name(universal_id: str | None, label: str) -> str:
    """Column of a label: its universal id, else the label in lower case with underscores."""
    return universal_id or label.replace(" ", "_").lower()


def explode_history(df: DataFrame, keys: Sequence[str], history: str) -> DataFrame:
    """``{property: [changes]}`` to one row per object, property and change."""
    per_property = df.select(*[c(k) for k in keys], F.explode(c(history)).alias("property", "__changes"))
    return per_property.select(*[c(k) for k in keys], "property", F.explode("__changes").alias("__change")).select(
        *[c(k) for k in keys], "property", "__change.*"
    )


def unnest_series(df: DataFrame, keys: Sequence[str], series: str, period: str) -> DataFrame:
    """A series to rows with the parent's keys, the period and the position."""
    kind = df.schema[series].dataType.elementType
    rows = df.select(*[c(k) for k in keys], F.posexplode(c(series)).alias("step_index", "__step"))
    values = [F.col("__step.*")] if isinstance(kind, T.StructType) else [F.col("__step").alias("value")]
    return rows.select(*[c(k) for k in keys], F.lit(period).alias("period"), F.col("step_index").cast("long"), *values)


def unnest_breakdown(df: DataFrame, keys: Sequence[str], own: Column, breakdown: str) -> DataFrame:
    """Breakdown items take the place of the parent row; a parent without any keeps its own.

    ``own`` is a struct shaped like one breakdown item.
    """
    items = F.when(F.size(c(breakdown)) > 0, c(breakdown)).otherwise(F.array(own))
    return df.select(*[c(k) for k in keys], F.explode(items).alias("__item")).select(*[c(k) for k in keys], "__item.*")


def map_to_rows(
    df: DataFrame, keys: Sequence[str], column: str, names: tuple[str, str], base: Column | None = None
) -> DataFrame:
    """``{name: value}`` to one row per entry, and a base row with 1.0."""
    entries = F.map_entries(c(column))
    if base is not None:
        entries = F.concat(F.array(F.struct(base.alias("key"), F.lit(1.0).alias("value"))), entries)
    rows = df.select(*[c(k) for k in keys], F.explode(entries).alias("__e"))
    return rows.select(*[c(k) for k in keys], F.col("__e.key").alias(names[0]), F.col("__e.value").alias(names[1]))


def wide_to_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """The same for a record with one column per name; nulls are left out."""
    return df.unpivot(list(keys), list(columns), *names).filter(c(names[1]).isNotNull())


def total(items: Column, value: Callable[[Column], Column], kind: str = "bigint") -> Column:
    """Sum over a list inside the row; absent lists and values count as zero."""
    zero = F.lit(0).cast(kind)
    add = lambda acc, x: acc + F.coalesce(value(x).cast(kind), zero)
    return F.coalesce(F.aggregate(items, zero, add), zero)


# Token counts that a usage record adds up, and what they are called.
TOKEN_COUNTS = {
    "input": "total_input_tokens",
    "output": "total_output_tokens",
    "cache_read": "total_cache_read_tokens",
    "cache_creation": "total_cache_creation_tokens",
}


def rollup_nested(df: DataFrame, items: str = "model_breakdown", actor: str | None = "actor") -> DataFrame:
    """Token counts and cost added up over a nested list, without exploding it.

    Cost counts only in USD. Models in use become comma text. The actor id is the mail address
    of a user and the key name of a program.
    """
    listed = c(items)
    known = df.schema[items].dataType.elementType["tokens"].dataType.names
    sums = {
        name: total(listed, lambda x, f=field: x["tokens"][f]) if field in known else F.lit(0).cast("bigint")
        for field, name in TOKEN_COUNTS.items()
    }
    dollars = F.filter(listed, lambda x: x["estimated_cost"]["currency"] == "USD")
    sums["total_estimated_cost_cents"] = total(dollars, lambda x: x["estimated_cost"]["amount"])
    models = F.filter(F.transform(listed, lambda x: x["model"]), lambda m: m != "")
    sums["models_used"] = F.when(F.size(models) > 0, F.array_join(models, ","))
    if actor:
        who = c(actor)
        sums["actor_type"] = F.coalesce(who["type"], F.lit(""))
        sums["actor_id"] = (
            F.when(who["type"] == "user_actor", F.coalesce(who["email_address"], F.lit("")))
            .when(who["type"] == "api_actor", F.coalesce(who["api_key_name"], F.lit("")))
            .otherwise(F.lit(""))
        )
    return df.withColumns(sums).drop(items, *([actor] if actor else []))


def join_lists(df: DataFrame, separator: str = ",") -> DataFrame:
    """Lists of plain values to text."""
    lists = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, (T.StructType, T.ArrayType))
    ]
    joined = {n: F.array_join(F.transform(c(n), lambda x: x.cast("string")), separator) for n in lists}
    return df.withColumns(joined) if joined else df


# ---- keys, codes and links -----------------------------------------------------------------


def fill_missing_keys(df: DataFrame, sentinels: Mapping[str, str]) -> DataFrame:
    """Absent or blank key parts get a sentinel, so that keyed merges match them."""
    return df.withColumns(
        {
            name: F.coalesce(F.nullif(F.trim(c(name).cast("string")), F.lit("")), F.lit(sentinel))
            if name in df.columns
            else F.lit(sentinel)
            for name, sentinel in sentinels.items()
        }
    )


def map_codes(df: DataFrame, column: str, labels: Mapping[str, str], unknown: str = "keep") -> DataFrame:
    """Codes to labels, lists element by element; ``unknown`` keeps the code or gives null."""
    if unknown not in ("keep", "null"):
        raise ValueError("unknown is keep or null")
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])

    def label(code: Column) -> Column:
        found = F.try_element_at(table, code.cast("string"))
        return F.coalesce(found, code.cast("string")) if unknown == "keep" else found

    many = isinstance(df.schema[column].dataType, T.ArrayType)
    return df.withColumn(column, F.transform(c(column), label) if many else label(c(column)))


def map_codes_from(df: DataFrame, column: str, labels: DataFrame, unknown: str = "keep") -> DataFrame:
    """R05 with the labels in a table ``(code, label)``; the join is spread for frequent codes."""
    side = labels.select(F.col("code").alias(column), F.col("label").alias("__label"))
    joined = match_many(df, side, [column], "left")
    text = F.coalesce(F.col("__label"), c(column).cast("string")) if unknown == "keep" else F.col("__label")
    return joined.withColumn(column, text).drop("__label").select(*df.columns)


def stable_dictionary(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """``(field, code, label)`` over runs: old labels never change, new codes come in.

    The dictionary has one row per known code, so the join is small.
    """
    if old is None:
        return new
    joined = old.withColumnRenamed("label", "__old").join(
        new.withColumnRenamed("label", "__new"), ["field", "code"], "full_outer"
    )
    return joined.select("field", "code", F.coalesce("__old", "__new").alias("label"))


def link_table(df: DataFrame, key: str, associations: Mapping[str, str]) -> DataFrame:
    """R34 for all kinds in one scan: distinct (kind, object, other_id); ids of unlike types become text.

    Lists are made distinct in the row first, so links stated twice neither make rows nor travel; and links of unlike kinds
    never meet, so each kind is distinct by itself.
    """
    kinds = {df.schema[column].dataType.elementType.simpleString() for column in associations.values()}
    one = kinds.pop() if len(kinds) == 1 else "string"
    lists = [F.transform(F.array_distinct(c(column)), lambda x: x.cast(one)) for column in associations.values()]
    # One map entry a kind: the kinds are exploded as a few lists, the links without a struct each.
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), ids.alias("ids")) for kind, ids in zip(associations, lists)])
    rows = df.select(c(key), F.explode(pairs).alias("__k")).select(F.col("__k.kind").alias("kind"), c(key), F.explode("__k.ids").alias("other_id"))
    return rows.distinct()


def link_rows(df: DataFrame, key: str, associations: Mapping[str, str]) -> dict[str, DataFrame]:
    """Per kind of association a link table of distinct (object, other) pairs.

    Pairs are made distinct before they are shuffled, so repeated links do not travel.
    """
    return {
        kind: df.select(c(key), F.explode(c(column)).alias(f"{kind}_id")).distinct()
        for kind, column in associations.items()
    }


def explode_changelog(df: DataFrame, key: str, histories: str = "histories") -> DataFrame:
    """One row per changed item, with the history's own columns."""
    kind = df.schema[histories].dataType.elementType
    own = [n for n in kind.names if n != "items"]
    rows = df.select(c(key), F.explode(c(histories)).alias("__h"))
    rows = rows.select(c(key), *[F.col(f"__h.{quoted(n)}").alias(n) for n in own], F.explode("__h.items").alias("__i"))
    return rows.select(c(key), *[c(n) for n in own], "__i.*")


# ---- types and times -----------------------------------------------------------------------


# Time dimensions of reports and how they are written.
REPORT_TIMES = {"date": "yyyyMMdd", "dateHour": "yyyyMMddHH", "dateHourMinute": "yyyyMMddHHmm"}
METRIC_TYPES = {"string": "string", "int": "bigint", "float": "double"}


def type_report(df: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """Text cells typed by their header: time dimensions to times, metrics by kind."""
    typed = {n: times.parse(c(n), [form]) for n, form in REPORT_TIMES.items() if n in df.columns}
    typed.update({n: c(n).try_cast(METRIC_TYPES[kind]) for n, kind in metrics.items()})
    return df.withColumns(typed)


def epoch_to_time(df: DataFrame, columns: Sequence[str], unit: str = "auto", as_text: bool = False) -> DataFrame:
    """Numbers since 1970 to times in UTC; ``auto`` takes large ones for milliseconds."""
    out = {n: times.from_epoch(c(n), unit) for n in columns}
    if as_text:
        out = {n: F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") for n, v in out.items()}
    return df.withColumns(out)


def repair_dates(df: DataFrame, columns: Sequence[str], zero_date: str = "epoch") -> DataFrame:
    """Zero dates to the epoch (or null), blanks to null, four forms tried.

    Text that is still no date is kept in ``<col>__v_text``.
    """
    out = df
    for name in columns:
        fixed, left = times.repair(c(name), zero_date)
        out = out.withColumns({f"{name}__v_text": left, name: fixed})
    return out


def scale_micros(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Money in millionths to units."""
    return df.withColumns({n: c(n) / F.lit(1_000_000) for n in columns if n in df.columns})


def conform_record(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Floats to four places, blank text to null, single values of json fields into a list."""
    out = []
    for name in [n for n in df.columns if n in kinds or n == "id"]:
        kind, have = kinds.get(name), df.schema[name].dataType
        if isinstance(have, (T.FloatType, T.DoubleType)):
            out.append(F.bround(c(name), 4).alias(name))
        elif kind == "json" and not isinstance(have, (T.ArrayType, T.StructType, T.MapType)):
            value = F.nullif(c(name), F.lit("")) if isinstance(have, T.StringType) else c(name)
            out.append(F.when(value.isNotNull(), F.array(value)).alias(name))
        elif kind in ("date", "timestamp", "datetime", "text") and isinstance(have, T.StringType):
            out.append(F.nullif(c(name), F.lit("")).alias(name))
        else:
            out.append(c(name))
    return df.select(*out)


def report_period(df: DataFrame, pivot: str, daily: bool) -> DataFrame:
    """``dateRange`` to a date, or to start and end; a single pivot value is unwrapped."""

    def day(which: str) -> Column:
        part = F.col("dateRange")[which]
        return F.make_date(part["year"], part["month"], part["day"])

    dates = {"date": day("start")} if daily else {"start_date": day("start"), "end_date": day("end")}
    one = F.get(F.col("pivotValues"), F.lit(0))
    many = F.to_json("pivotValues")
    value = F.when(F.size("pivotValues") > 1, many).otherwise(one)
    return df.withColumns({pivot: value, **dates}).drop("dateRange", "pivotValues")


def parse_times(value: Column, kind: T.DataType, names: frozenset[str], inside: bool = False) -> Column:
    if isinstance(kind, T.StructType):
        fields = [parse_times(value[f.name], f.dataType, names, f.name in names).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: parse_times(x, kind.elementType, names, inside))
    return times.parse_iso(value) if inside and isinstance(kind, T.StringType) else value


def parse_time_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Named time fields become times wherever they sit."""
    wanted = frozenset(names)
    return df.select(*[parse_times(c(f.name), f.dataType, wanted, f.name in wanted).alias(f.name) for f in df.schema.fields])


def partition_date(df: DataFrame, source: str, platform: str, unit: str | None = None) -> DataFrame:
    """Partition date from epoch time or a date-time column, and a platform tag."""
    at = times.from_epoch(c(source), unit) if unit else c(source)
    return df.withColumns({"partition_dt": F.to_date(at), "platform": F.lit(platform)})


def cohort_available(df: DataFrame, day: str, today: dt.date, prefix: str = "cohort_day_") -> DataFrame:
    """``cohort_day_N`` is null until more than N days have passed."""
    age = F.datediff(F.lit(today), c(day))
    days = {n: int(n.removeprefix(prefix)) for n in df.columns if n.startswith(prefix)}
    return df.withColumns({n: F.when(age > d, c(n)) for n, d in days.items()})


# ---- columns -------------------------------------------------------------------------------


def standardize_headers(df: DataFrame, expected: Mapping[str, str] | None = None) -> DataFrame:
    """Lower case, dashes out, spaces to underscores; metrics that are absent come as null."""
    names = [n.lower().replace("-", "").replace(" ", "_") for n in df.columns]
    refuse_clash(names)
    out = df.toDF(*names)
    absent = {n: F.lit(None).cast(kind) for n, kind in (expected or {}).items() if n not in names}
    return out.withColumns(absent) if absent else out


def group_flow(df: DataFrame, entity: str, at: str) -> DataFrame:
    """A mixed stream as (entity, time, payload), ready to be routed to a table each."""
    payload = [c(n) for n in df.columns if n not in (entity, at)]
    return df.select(c(entity).alias("entity"), c(at).alias("timestamp"), F.to_json(F.struct(*payload)).alias("payload"))


def drop_compound_fields(df: DataFrame, compounds: Mapping[str, Sequence[str]], keep: Sequence[str] = ("Name",)) -> DataFrame:
    """A compound field goes where its parts are there; ``attributes`` always goes."""
    gone = [n for n, parts in compounds.items() if n not in keep and set(parts) & set(df.columns)]
    return df.drop(*gone, "attributes")


def stamp_constants(df: DataFrame, **values: object) -> DataFrame:
    """Constant columns such as a report date, the time of the load or a type tag."""
    return df.withColumns({n: F.lit(v) for n, v in values.items()})


# Columns of sibling records, the path each comes from, and what stands for a missing one.
USAGE_FIELDS = {
    "bucket": ("bucket", ""), "api_key_id": ("api_key_id", ""), "workspace_id": ("workspace_id", ""), "model": ("model", ""),
    "service_tier": ("service_tier", ""), "context_window": ("context_window", ""),
    "uncached_input_tokens": ("tokens.uncached_input_tokens", 0), "cached_input_tokens": ("tokens.cached_input_tokens", 0),
    "cache_creation_tokens": ("tokens.cache_creation_tokens", 0), "output_tokens": ("tokens.output_tokens", 0),
    "web_search_usage": ("server_tool_usage.web_search_usage", 0),
    "code_execution_usage": ("server_tool_usage.code_execution_usage", 0),
}
COST_FIELDS = {
    "bucket": ("bucket", ""), "workspace_id": ("workspace_id", ""), "description": ("description", ""), "amount_cents": ("amount_cents", 0),
}
ACTIVITY_FIELDS = {
    "num_sessions": ("core_metrics.num_sessions", 0), "lines_added": ("core_metrics.lines_of_code.added", 0),
    "lines_removed": ("core_metrics.lines_of_code.removed", 0),
}
PLAN_FIELDS = {"plan_id": ("plan.id", None), "plan_name": ("plan.name", None)}
CONVERSATION_FIELDS = {
    **{
        name: (f"statistics.{name}", None)
        for name in (
            "first_contact_reply_at", "first_admin_reply_at", "last_contact_reply_at", "last_admin_reply_at",
            "median_admin_reply_time", "mean_admin_reply_time",
        )
    },
    "conversation_parts_count": ("conversation_parts.total_count", 0),
}


def lift_fields(df: DataFrame, fields: Mapping[str, tuple[str, object]], only: bool = False, drop: Sequence[str] = ()) -> DataFrame:
    """Columns from nested paths, each with what stands for a missing one; a path that no record has gives that alone.

    With ``only`` the record is these columns, else they come to it in the place of those in ``drop``.
    """
    out = []
    for name, (path, default) in fields.items():
        found = resolve_path(df.schema, path.split("."))
        kind = None
        if found:
            value = F.col(".".join(quoted(p) for p in found))
            kind = df.select(value.alias("v")).schema[0].dataType
        missing = F.lit(default) if default is not None else F.lit(None).cast(kind or "string")
        if kind is not None and default is not None:
            missing = missing.cast(kind)
        out.append((F.coalesce(value, missing) if found else missing).alias(name))
    if only:
        return df.select(*out)
    kept = [n for n in df.columns if n not in drop and n not in fields]
    return df.select(*[c(n) for n in kept], *out)


def spread_actions(df: DataFrame, column: str, counts: Sequence[str] = ("accepted", "rejected")) -> DataFrame:
    """An object of tools, each with counts, to the columns ``<tool>_<count>``; a missing count is zero."""
    kind = df.schema[column].dataType
    out = {}
    for tool in kind.fields:
        for name in counts:
            there = isinstance(tool.dataType, T.StructType) and name in tool.dataType.names
            value = c(column)[tool.name][name] if there else F.lit(None)
            out[f"{tool.name}_{name}"] = F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))
    refuse_clash([*[n for n in df.columns if n != column], *out])
    return df.withColumns(out).drop(column)


def flatten_contact(df: DataFrame) -> DataFrame:
    """Location to three columns, companies to ids and a count, attributes never null."""
    out: dict[str, Column] = {}
    if "location" in df.columns:
        known = df.schema["location"].dataType.names
        for part in ("country", "region", "city"):
            out[f"location_{part}"] = F.col("location")[part] if part in known else F.lit(None).cast("string")
    if "companies" in df.columns:
        listed = F.coalesce(F.col("companies")["data"], F.array().cast(df.select("companies.data").schema[0].dataType))
        ids = F.transform(listed, lambda x: x["id"])
        out["company_ids"] = F.filter(ids, lambda i: i.isNotNull())
        out["companies_count"] = F.size(listed).cast("long")
    empty = F.create_map().cast("map<string,string>")
    has = "custom_attributes" in df.columns
    out["custom_attributes"] = F.coalesce(F.col("custom_attributes"), empty) if has else empty
    return df.withColumns(out).drop("location", "companies")


def resolve_path(kind: T.DataType, parts: Sequence[str]) -> list[str] | None:
    """The stored spelling of a path; each part may carry a trailing underscore."""
    found = []
    for part in parts:
        names = kind.names if isinstance(kind, T.StructType) else []
        name = next((n for n in (part, part + "_") if n in names), None)
        if name is None:
            return None
        found.append(name)
        kind = kind[name].dataType
    return found


def extract_paths(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Dotted paths to ``a_b``; a path that is not there gives null."""
    out = []
    for path in paths:
        parts = path.split(".")
        found = resolve_path(df.schema, parts)
        value = F.col(".".join(quoted(p) for p in found)) if found else F.lit(None).cast("string")
        out.append(value.alias("_".join(parts)))
    return df.select(*out)


def extract_json_paths(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    """R27 on JSON text: JSONPath to columns."""
    return df.withColumns({name: F.get_json_object(c(column), path) for name, path in paths.items()})


def found_properties(df: DataFrame, column: str, known: DataFrame | None = None, field: str = "property") -> DataFrame:
    """The dictionary (field, code, label) of a property map's keys, a leading ``$`` stripped; old ones stay."""
    keys = df.select(F.explode(F.map_keys(F.from_json(c(column), "map<string,string>"))).alias("k"))
    name = F.regexp_replace("k", r"^\$", "")
    return stable_dictionary(known, keys.select(F.lit(field).alias("field"), name.alias("code"), name.alias("label")).distinct())


def lift_properties(
    df: DataFrame, column: str, names: Mapping[str, str], profile: bool = False, other: str | None = "__other"
) -> DataFrame:
    """A JSON property map to typed columns, a leading ``$`` of the key stripped.

    The profile form looks at keys with ``$`` only and sets ``distinct_id``. Properties without a column, a plain one that gives
    way to one with ``$``, and values that are not of the column's type are kept in ``other`` as a JSON map; text that is no
    map at all is kept there as it is.
    """
    refuse_clash([*[n for n in df.columns if n != column and n not in names], *names, *([other] if other else [])])
    whole = F.from_json(c(column), "map<string,string>")
    entries = F.map_filter(whole, lambda k, v: k.startswith("$")) if profile else whole
    # A plain key gives way to the same key with a dollar sign.
    marked = F.map_filter(entries, lambda k, v: k.startswith("$"))
    raw = {n: F.coalesce(F.try_element_at(marked, F.lit("$" + n)), F.try_element_at(entries, F.lit(n))) for n in names}
    lifted = {name: raw[name].try_cast(kind) for name, kind in names.items()}
    out = df
    if other:

        def left_over(k: Column, v: Column) -> Column:
            used = F.lit(False)
            for name in names:
                mine = (k == F.lit("$" + name)) | ((k == F.lit(name)) & ~F.coalesce(F.map_contains_key(marked, F.lit("$" + name)), F.lit(False)))
                used = used | (mine & (lifted[name].isNotNull() | v.isNull()))
            return ~used & (F.lit(True) if not profile else k.startswith("$"))

        rest = F.map_filter(whole, left_over)
        # Bad text gives a map of nulls or none, by Spark's reading of it.
        bad = c(column).isNotNull() & F.try_parse_json(c(column)).isNull()
        out = out.withColumn(other, F.when(bad, c(column)).when(F.size(rest) > 0, F.to_json(rest)))
    out = out.withColumns(lifted).drop(column)
    return out.withColumn("distinct_id", F.coalesce(F.col("distinct_id"), F.col("$distinct_id"))) if (
        profile and "$distinct_id" in df.columns
    ) else out


def map_values_to_rows(df: DataFrame, column: str, time_fields: Sequence[str] = ()) -> DataFrame:
    """An object keyed by id to one row per value; blank times are null."""
    kind = df.schema[column].dataType.valueType
    rows = df.select(F.explode(F.map_values(c(column))).alias("__v"))
    fields = [
        (times.parse_iso(F.col(f"__v.{quoted(n)}")) if n in time_fields else F.col(f"__v.{quoted(n)}")).alias(n)
        for n in kind.names
    ]
    return rows.select(*fields)


def promote_key(df: DataFrame, promotions: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Nested keys and times lifted to the record under a new name, the old ones dropped.

    Names differing in case only are one name to Spark, so the frame is built in one projection.
    """
    gone = {*drop, *[path for path in promotions if "." not in path]}
    kept = [n for n in df.columns if n not in gone]
    lifted = [F.col(".".join(quoted(p) for p in path.split("."))).alias(name) for path, name in promotions.items()]
    refuse_clash([n.lower() for n in (*kept, *promotions.values())])
    return df.select(*[c(n) for n in kept], *lifted)

