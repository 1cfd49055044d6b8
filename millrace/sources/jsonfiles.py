"""JSON files in their three shapes, JSON lines, and Extended JSON values."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import evolve
from .listing import first_shapes, require_files


def is_lines(first_line: str) -> bool:
    """Whether each line of a file holds whole records (an object, or a list of them), told from its first line."""
    try:
        return isinstance(json.loads(first_line), (dict, list))
    except ValueError:
        return False


# Characters of text that a list of records holds at least, before the next begins; a record is not cut. Bytes of lines looked at together, about.
LIST_CHARS, TEXT_BYTES = 1 << 16, 1 << 20
SPACE = re.compile("[ \t\r\n]*")


def lines_in_order(spark: SparkSession, files: list[str]) -> DataFrame:
    """``file, value``: lines that are not empty, in order; a file is one task's, which reads it a bit at a time, however large.

    The reader of lines would deal parts of a file to several tasks, and that of whole texts would hold it at once; a
    multi-line CSV reader does neither. Bytes are read as one character each, so nothing is lost to a wrong
    encoding, and the signs that CSV knows are set to characters that no byte gives.
    """
    signs = {"sep": "\ue000", "quote": "\ue001", "escape": "\ue002", "comment": "\ue003"}
    lines = spark.read.options(multiLine=True, lineSep="\n", encoding="ISO-8859-1", mode="FAILFAST", **signs)
    return lines.schema("value string").csv(files).select(F.col("_metadata.file_path").alias("file"), "value")


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    """Lines of a file, some at a time, as one text."""
    for batch in batches:
        lines, files, begin = batch.column("value"), pc.run_end_encode(batch.column("file")), 0
        step = max(1, TEXT_BYTES * len(lines) // max(1, lines.nbytes))
        for file, end in zip(files.values.to_pylist(), files.run_ends.to_pylist()):
            for at in range(begin, end, step):
                text = "\n".join([line or "" for line in lines.slice(at, min(step, end - at)).to_pylist()] + [""])
                yield file, text if text.isascii() else text.encode("latin-1").decode("utf-8")
            begin = end


def records_of(file: str, texts: Iterator[str]) -> Iterator[list[str]]:
    """The one JSON document of a file as lists of its records, from texts of some lines each.

    No token of JSON goes beyond its line. So what the parser finds wrong before the end of a text is wrong, and what it misses
    at the end may be in the next. A record that is not complete is parsed again when its text has doubled, so the work
    grows with the text, and no more is held than some lines and a record. What follows the document ends the load.
    """
    decoder, due = json.JSONDecoder(), "start"
    held: list[str] = []
    size = least = 0
    for text in chain(texts, [None]):
        if text is not None:
            held.append(text)
            size += len(text)
            if size < least:
                continue
        body, lists, at, first, last = "".join(held), [], 0, -1, 0
        while (at := SPACE.match(body, at).end()) < len(body):
            sign = body[at]
            if due == "end":
                if body[at:].strip():
                    raise ValueError(f"{file}: text after the first JSON document")
                at = len(body)
            elif due == "start" and sign in "\ufeff[":
                due = "first" if sign == "[" else due
                at += 1
            elif due == "comma" and sign in ",]" or due == "first" and sign == "]":
                due = "record" if sign == "," else "end"
                at += 1
            elif due == "comma":
                raise ValueError(f"{file}: no comma after a record")
            else:
                try:
                    _, end = decoder.raw_decode(body, at)
                except json.JSONDecodeError as error:
                    if error.pos < len(body):
                        raise ValueError(f"{file}: {error.msg}") from error
                    break
                if due == "start":
                    lists.append(body[at:end])
                    due = "end"
                else:
                    first, last, due = at if first < 0 else first, end, "comma"
                    if last - first >= LIST_CHARS:
                        lists.append(f"[{body[first:last]}]")
                        first = -1
                at = end
        if first >= 0:
            lists.append(f"[{body[first:last]}]")
        if lists:
            yield lists
        held, size, least = [body[at:]], len(body) - at, 2 * (len(body) - at)
    if size or due not in ("start", "end"):
        raise ValueError(f"{file}: ends within its JSON document")


def record_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of records, as JSON, out of the lines of files that hold one document each."""
    for file, texts in groupby(texts_of(batches), itemgetter(0)):
        for lists in records_of(file, (text for _, text in texts)):
            yield pa.RecordBatch.from_arrays([pa.array(lists, type=pa.string())], ["value"])


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """An object, an array of objects, or lines of either; each file is read the way it is written.

    Reading lines as one document would give their first record only, hence the look at each
    file's first line. A record that does not parse ends the load, and so does text after the one
    document of a file, which is checked where the document is parsed. A document is read record by record; one
    task has a file from start to end. Folders are read to any depth.
    """
    groups = first_shapes(spark, path, lambda line: str(is_lines(line))) if require_files(spark, path) else {}
    reader = spark.read.option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema else reader
    frames = []
    if groups.get("True"):
        frames.append(reader.json(groups["True"]))
    if groups.get("False"):
        files = groups["False"]
        kind = schema or reader.option("multiLine", True).json(files).schema
        kind = T._parse_datatype_string(kind) if isinstance(kind, str) else kind
        # One object is a list of one here.
        records = F.from_json("value", T.ArrayType(kind), {"mode": "FAILFAST"})
        lists = lines_in_order(spark, files).mapInArrow(record_lists, "value string")
        frames.append(lists.select(F.explode(records).alias("r")).select("r.*"))
    if not frames:
        return spark.createDataFrame([], schema or T.StructType([]))
    return frames[0] if len(frames) == 1 else evolve(frames[0], frames[1])


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Strict lines: a blank line, or one that is no object, ends the load."""
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path)
    record = F.from_json("value", kind, {"mode": "FAILFAST"})
    strict = F.when(F.trim("value") == "", F.raise_error(F.lit("blank line in a JSON lines file"))).otherwise(record)
    return lines.select(strict.alias("r")).select("r.*")


# Wrappers of Extended JSON, by the kind of value they hold.
WRAPPERS = {
    "text": ("$oid", "$numberDecimal", "$numberLong", "$numberInt", "$numberDouble", "$symbol", "$code"),
    "binary": ("$binary.base64", "$binary"),
    "regex": ("$regularExpression.pattern", "$regex"),
}


def inside(document: Column, field: str, wrapper: str) -> Column:
    """Text at ``field`` below a wrapper key, null where the value is not wrapped so."""
    steps = "".join(f"['{step}']" for step in (*field.split("."), *wrapper.split(".")) if step)
    return F.try_variant_get(document, "$" + steps, "string")


def normalize_extended_json(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Typed columns out of documents whose values may be wrapped.

    ``fields`` maps a dotted path to ``text``, ``binary`` (base64 text), ``regex``,
    ``timestamp``, or a Spark type. The document is parsed once; a plain value is taken as is.
    """
    parsed = df.withColumn("__doc", F.try_parse_json(column))
    doc = F.col("__doc")
    out: dict[str, Column] = {}
    for field, kind in fields.items():
        plain = inside(doc, field, "")
        if kind == "timestamp":
            millis = F.coalesce(inside(doc, field, "$date.$numberLong"), inside(doc, field, "$date"))
            from_millis = F.timestamp_millis(millis.try_cast("bigint"))
            seconds = F.timestamp_seconds(inside(doc, field, "$timestamp.t").try_cast("bigint"))
            text = F.coalesce(inside(doc, field, "$date"), plain)
            value = F.coalesce(from_millis, seconds, text.try_cast("timestamp")).cast("timestamp_ntz")
        else:
            wrappers = WRAPPERS.get(kind, WRAPPERS["text"])
            text = F.coalesce(*[inside(doc, field, w) for w in wrappers], plain)
            value = text if kind in WRAPPERS else text.try_cast(kind)
        out[field.replace(".", "_")] = value
    return parsed.withColumns(out).drop("__doc", column)
