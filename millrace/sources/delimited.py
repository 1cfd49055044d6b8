"""CSV and TSV files, headers taken file by file."""

from __future__ import annotations

import csv
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import quoted
from ..operators.widening import align
from .listing import first_shapes, lookup, require_files

# Delimiters looked for when none is named, the likeliest first.
DELIMITERS = (",", "\t", ";", "|")


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def header_of(line: str, delimiter: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line], delimiter=delimiter)))


def read_groups(
    spark: SparkSession, groups: dict[tuple[str, tuple[str, ...]], list[str]], infer: bool, options: dict[str, str]
) -> DataFrame:
    """Files by delimiter and header, joined together by column name; a type that differs becomes text."""
    whole = None
    for (delimiter, header), files in groups.items():
        reader = spark.read.option("header", True).option("sep", delimiter).options(**options)
        reader = reader.option("inferSchema", True) if infer else reader.schema(text_schema(header))
        frame = reader.csv(files)
        if whole is not None:
            whole, frame = align(whole, frame)
        whole = frame if whole is None else whole.unionByName(frame, allowMissingColumns=True)
    return spark.createDataFrame([], T.StructType([])) if whole is None else whole


def by_header(spark: SparkSession, path: str, delimiter_of) -> dict[tuple[str, tuple[str, ...]], list[str]]:
    """Files by delimiter and header, told from each file's first line by the task that reads it."""

    def shape_of(line: str) -> str:
        delimiter = delimiter_of(line)
        return json.dumps([delimiter, header_of(line, delimiter)])

    if not require_files(spark, path):
        return {}
    found = first_shapes(spark, path, shape_of)
    return {(delimiter, tuple(header)): files for (delimiter, header), files in ((json.loads(k), v) for k, v in found.items())}


def scan_csv(
    spark: SparkSession, path: str, delimiter: str = ",", infer: bool = False, **options: str
) -> DataFrame:
    """Every file with its own header, joined together by column name; folders to any depth.

    One read over files with different headers would map columns by position. The files are
    grouped by header, which a look at the first line of each tells, and each group is one read.
    """
    return read_groups(spark, by_header(spark, path, lambda line: delimiter), infer, options)


def scan_csv_headless(
    spark: SparkSession, path: str, names: Sequence[str] | None = None, delimiter: str = ",", **options: str
) -> DataFrame:
    """No header; names as given, else ``unknown_col_0`` and so on, as many as the widest line has cells.

    The first line is data.
    """
    root, lookups = lookup(path)
    if names is None:
        plain = F.regexp_replace("value", r'"([^"]|"")*"', "")
        cells = F.length(plain) - F.length(F.replace(plain, F.lit(delimiter), F.lit(""))) + F.lit(len(delimiter))
        lines = spark.read.options(**lookups).text(root)
        widest = lines.filter(F.trim("value") != "").agg(F.max(cells)).first()[0]
        names = [f"unknown_col_{i}" for i in range((widest or 0) // len(delimiter))]
    return spark.read.schema(text_schema(names)).option("sep", delimiter).options(**lookups).options(**options).csv(root)


def sniff_delimiter(line: str) -> str:
    """The delimiter that cuts the header into most parts."""
    return max(DELIMITERS, key=lambda d: (len(header_of(line, d)), -DELIMITERS.index(d)))


def scan_csv_sniffed(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Each file's delimiter from its own header, types from the data."""
    return read_groups(spark, by_header(spark, path, sniff_delimiter), True, options)


def clean_csv_rows(df: DataFrame) -> DataFrame:
    """Blank cells become null, rows with nothing but blanks go."""
    if not df.columns:
        raise ValueError("no header row")
    cleaned = df.select(*[F.when(F.trim(F.col(quoted(c))) != "", F.col(quoted(c))).alias(c) for c in df.columns])
    return cleaned.filter(F.coalesce(*[F.col(quoted(c)) for c in cleaned.columns]).isNotNull())


def scan_stamped_reports(spark: SparkSession, path: str, columns: Sequence[str], delimiter: str = "\t") -> DataFrame:
    """Report files, packed or not, with ``processing_date`` from their folder or name."""
    rows = spark.read.schema(text_schema(columns)).option("header", True).option("sep", delimiter).csv(path)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}-\d{2}-\d{2})", 1)
    return rows.select(F.to_date(F.nullif(day, F.lit(""))).alias("processing_date"), *[F.col(quoted(c)) for c in columns])
