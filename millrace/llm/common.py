"""Registry of the operators' queries and small helpers of theirs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tasks that write a table of known size: at least so many, each of up to so many bytes.
LEAST_TASKS = 12
TASK_BYTES = 1 << 24


def gathered(df: DataFrame, rows: int, width: int = 48) -> DataFrame:
    """At most as many partitions as ``rows`` rows of about ``width`` bytes need, so that small tables cost few tasks."""
    return df.coalesce(max(LEAST_TASKS, rows * width // TASK_BYTES))


def staged(df: DataFrame, label: str, rows: int | None = None, width: int = 48) -> DataFrame:
    """Write to the shared folder and read back: computed once, and safe from lost executors.

    ``rows``, where a bound of the size is known, keeps the number of tasks in proportion.
    """
    path = scratch_path(df.sparkSession, label)
    (df if rows is None else gathered(df, rows, width)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None]):
    """A function over Arrow batches for mapInArrow, from one over a single batch."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            if batch.num_rows:
                made = function(batch)
                if isinstance(made, pa.Table):
                    yield from made.to_batches()
                elif made is not None:
                    yield made

    return run


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def refuse_names(column: str, *taken: str) -> None:
    """An id column may not be named like a column that the operator adds."""
    if column.lower() in taken:
        raise ValueError(f"{column} is a column of the result or of its making: rename the id column")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    there = {c.lower() for c in df.columns}
    while name.lower() in there:
        name += "_"
    return name


def text_hash(column: str = "text"):
    """Tells rows of one id apart by their text."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))
