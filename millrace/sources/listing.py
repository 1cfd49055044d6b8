"""A glob as a table of files, from metadata alone."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

# Media types by file extension.
MEDIA_TYPES = {
    "csv": "text/csv",
    "json": "application/json",
    "jsonl": "application/x-ndjson",
    "xml": "application/xml",
    "yaml": "application/yaml",
    "yml": "application/yaml",
    "tsv": "text/tab-separated-values",
    "txt": "text/plain",
    "parquet": "application/vnd.apache.parquet",
    "arrow": "application/vnd.apache.arrow.file",
    "gz": "application/gzip",
}


def list_files(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """``file_name, relative_path, file_url, mime_type, modification_date, size_in_bytes``.

    ``pattern`` matches file names; ``recursive`` goes down the folders. Contents are not read:
    the projection leaves the content column out of the scan.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    found = files.option("recursiveFileLookup", str(recursive).lower()).load(root)
    base = root.rstrip("/").split("://")[-1].removeprefix("file:")
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.lit(None).cast("string")
    for extension, media in MEDIA_TYPES.items():
        kind = F.when(F.lower(name).endswith(f".{extension}"), F.lit(media)).otherwise(kind)
    return found.select(
        name.alias("file_name"),
        F.substring_index("path", f"{base}/", -1).alias("relative_path"),
        F.col("path").alias("file_url"),
        kind.alias("mime_type"),
        F.col("modificationTime").alias("modification_date"),
        F.col("length").alias("size_in_bytes"),
    )


def paths(listing: DataFrame) -> list[str]:
    """The addresses to hand to a reader: file names, of which the driver keeps a list anyway."""
    return [row.file_url for row in listing.select("file_url").collect()]


def file_state(listing: DataFrame) -> dict:
    """Position after reading a listing: the latest time, and the files that have it."""
    last = listing.agg(F.max("modification_date").alias("m")).first()["m"]
    edge = listing.filter(F.col("modification_date") == F.lit(last)).select("file_url")
    return {"last": last, "seen": stage(edge, "seen-files")}


def cursor_key(namespace: str, bucket: str, pattern: str) -> str:
    """Identity of a file cursor. User names and passwords in the bucket are left out."""
    clean = re.sub(r"//[^/@]*@", "//", bucket)
    return hashlib.sha256("\0".join((namespace, clean, pattern)).encode()).hexdigest()


def lookup(path: str) -> tuple[str, dict[str, str]]:
    """Where a reader starts, and its options: folders are read to any depth, and so is ``**``."""
    if "**" in path:
        root, _, rest = path.partition("**")
        name = rest.strip("/") or "*"
        if "/" in name:
            raise ValueError(f"after ** only a file name may follow: {path}")
        return root.rstrip("/") or "/", {"recursiveFileLookup": "true", "pathGlobFilter": name}
    return path, {"recursiveFileLookup": "true"}


def require_files(spark: SparkSession, path: str) -> bool:
    """A named path without a file is an error, a glob without a match an empty success."""
    root, options = lookup(path)
    try:
        found = not spark.read.format("binaryFile").options(**options).load(root).select("path").isEmpty()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        found = False
    if not found and not any(c in path for c in "*?["):
        raise FileNotFoundError(f"no file at {path}")
    return found


# Settings under which a scan has a task for each file, and hands lines on a few at a time.
FILE_BY_FILE = {
    "spark.sql.files.maxPartitionBytes": str(1 << 40),
    "spark.sql.files.openCostInBytes": str(1 << 40),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}


def first_shapes(spark: SparkSession, path: str, shape_of: Callable[[str], str]) -> dict[str, list[str]]:
    """What ``shape_of`` tells from the first line of each file that is not blank: shape, and the files that have it.

    Each file is one task, which stops reading after that line, so the pass costs first lines, however large files are. Lines
    stay in the tasks; the driver gets each shape once, and the names of files, which the reader lists anyway. Where the session
    does not take the settings for that, tasks get parts of files, and several: all is read, and a file's first part counts.
    """
    root, options = lookup(path)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            for file, begin, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (file, begin) == part:
                    continue
                text = line.as_py().lstrip("\ufeff")
                if text.strip(" \t\r"):
                    shape, part = shape_of(text), (file, begin)
                    digest = hashlib.sha256(shape.encode("utf-8", "surrogatepass")).hexdigest()
                    yield pa.RecordBatch.from_pylist([{"digest": digest, "shape": shape, "file": file, "begin": begin}])
                    if alone:
                        # The rest of the file is not read.
                        return

    before = {key: spark.conf.get(key) for key in FILE_BY_FILE}
    for key, value in FILE_BY_FILE.items():
        spark.conf.set(key, value)
    alone = spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
    alone = alone and all(spark.conf.get(key) == value for key, value in FILE_BY_FILE.items())
    try:
        place = [F.col(f"_metadata.{name}").alias(to) for name, to in (("file_path", "file"), ("file_block_start", "begin"))]
        lines = spark.read.options(**options).text(root).select(*place, "value")
        found = stage(lines.mapInArrow(told, "digest string, shape string, file string, begin long"), "shapes")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    if not alone:
        found = found.groupBy("file").agg(F.min_by(F.struct("digest", "shape"), "begin").alias("first")).select("file", "first.*")
    shapes = {r.digest: r["shape"] for r in found.select("digest", "shape").distinct().collect()}
    out: dict[str, list[str]] = {shape: [] for shape in sorted(shapes.values())}
    for row in found.select("digest", "file").orderBy("file").toLocalIterator():
        out[shapes[row.digest]].append(row.file)
    return out
