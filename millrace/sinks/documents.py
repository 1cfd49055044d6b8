"""Document sinks: shape rows to documents, keep them in a collection, or hand them to a database."""

from __future__ import annotations

import base64
import json
import pickle
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.hashing import quoted
from ..operators.keys import dedup_by_key
from ..operators.maintenance import merge, strip_lineage
from .tables import SnapshotTable


def shape_documents(df: DataFrame, id_fields: Sequence[str] = ()) -> DataFrame:
    """``_id`` from ``id_fields``, else from ``_id``, else from ``id``, else generated."""
    plain = strip_lineage(df)
    if id_fields:
        missing = F.lit(False)
        for field in id_fields:
            missing = missing | F.col(field).isNull()
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in id_fields])
        return plain.withColumn(
            "_id", F.when(missing, F.raise_error(F.lit("document without a key"))).otherwise(key)
        )
    known = [F.col(c).cast("string") for c in ("_id", "id") if c in plain.columns]
    return plain.withColumn("_id", F.coalesce(*known, F.uuid()))


def upsert(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """ReplaceOne semantics: a document takes the place of the one with its ``_id``."""
    return merge(stored, batch, ["_id"])


class DocumentStore:
    """A collection of JSON documents by ``_id``, kept as a table that loads commit to."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = SnapshotTable(spark, path)

    def write(self, documents: DataFrame, load_id: str, replace: bool = False, parts: int = 0) -> None:
        """Shaped documents take the place of those with their ``_id``, or with ``replace`` of the whole collection.

        Readers see the old collection until the new head is there. Writing a batch again changes nothing. A document that
        comes twice in a batch is taken once.
        """
        head = self.table.begin()
        whole = F.to_json(F.struct(*[F.col(quoted(c)) for c in documents.columns]), {"ignoreNullFields": "false"})
        rows = dedup_by_key(documents.select(F.col("_id"), whole.alias("document")), ["_id"])
        self.table.upsert(rows, "_id", head["version"] + 1, parts=parts, empty_first=replace)

    def read(self, schema: str | None = None) -> DataFrame:
        """``_id`` and ``document``, or the fields of ``schema``; a document that does not fit it fails."""
        rows = self.table.read()
        if schema is None:
            return rows
        return rows.select(F.from_json("document", schema, {"mode": "FAILFAST"}).alias("d")).select("d.*")


class Client(Protocol):
    """A document database, as a sink sees it. It is sent to tasks, so it opens connections when it is called."""

    def stage(self, run: str, documents: list[dict]) -> None:
        """Put documents where only ``swap`` finds them, by ``_id``; a task that runs twice stages them twice."""

    def swap(self, run: str) -> None:
        """Make what was staged the collection, at once."""

    def discard(self, run: str) -> None:
        """Drop what was staged."""

    def upsert(self, documents: list[dict]) -> None:
        """Each document takes the place of the one with its ``_id``."""


@dataclass
class _Sent(WriterCommitMessage):
    documents: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, client: Client, run: str, replace: bool, batch_size: int):
        self.client, self.run, self.replace, self.batch_size = client, run, replace, batch_size

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Sent:
        sent = 0
        for batch in iterator:
            texts = batch.column("document")
            for first in range(0, len(texts), self.batch_size):
                documents = [json.loads(d) for d in texts.slice(first, self.batch_size).to_pylist()]
                if self.replace:
                    self.client.stage(self.run, documents)
                else:
                    self.client.upsert(documents)
                sent += len(documents)
        return _Sent(sent)

    def commit(self, messages: list[_Sent | None]) -> None:
        if self.replace:
            self.client.swap(self.run)

    def abort(self, messages: list[_Sent | None]) -> None:
        if self.replace:
            self.client.discard(self.run)


class DocumentSink(DataSource):
    """``millrace_documents``: hands JSON documents to a client; the options hold the client, pickled, in base64."""

    @classmethod
    def name(cls) -> str:
        return "millrace_documents"

    def schema(self) -> str:
        return "document string"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        client = pickle.loads(base64.b64decode(self.options["client"]))
        return _Writer(client, self.options["run"], overwrite, int(self.options["batchsize"]))


def write_documents(df: DataFrame, client: Client, replace: bool = False, batch_size: int = 1000) -> None:
    """Hand shaped documents to a database, from the executors, in columns of JSON text that Spark builds.

    An upsert is sent as it comes and may be sent again: it is by ``_id``. A replacement is staged by all tasks and
    swapped in once, after the last of them; if one fails for good, the old collection stays and what was staged goes.
    """
    spark = df.sparkSession
    spark.dataSource.register(DocumentSink)
    whole = F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns]), {"ignoreNullFields": "false"})
    writer = df.select(whole.alias("document")).write.format(DocumentSink.name()).mode("overwrite" if replace else "append")
    client_ = base64.b64encode(cloudpickle.dumps(client)).decode()
    writer.options(client=client_, run=uuid.uuid4().hex, batchsize=batch_size).save()
