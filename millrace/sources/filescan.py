"""Files as the source of a load, with the position kept as a list of the files that were read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cursors import new_files
from .listing import cursor_key, list_files, paths

LISTED = "file_url string, modification_date timestamp, size_in_bytes long"


@dataclass(frozen=True, kw_only=True)
class FileScan:
    """Files below ``root`` whose names match ``pattern``, and how some of them become rows.

    ``namespace`` tells stores apart that give equal addresses to different files.
    """

    spark: SparkSession
    root: str
    read: Callable[[list[str]], DataFrame]
    pattern: str = "*"
    recursive: bool = True
    namespace: str = ""

    @property
    def key(self) -> str:
        """What the position belongs to: another pattern has one of its own."""
        return cursor_key(self.namespace, self.root.rstrip("/"), f"{self.pattern}\0{self.recursive}")

    def listing(self) -> DataFrame:
        """Address, time and size of each file, from metadata alone."""
        found = list_files(self.spark, self.root, self.pattern, self.recursive)
        return found.select("file_url", "modification_date", "size_in_bytes")

    def unread(self, done: DataFrame | None) -> DataFrame:
        """Files changed after the last one in ``done``, and files of that time that are not in it."""
        if done is None:
            return self.listing()
        last = done.agg(F.max("modification_date").alias("m")).first()["m"]
        return self.listing() if last is None else new_files(self.listing(), last, done.filter(F.col("modification_date") == F.lit(last)))

    def rows(self, listing: DataFrame) -> DataFrame | None:
        """The rows of the listed files; none if there is no file."""
        found = paths(listing)
        return self.read(found) if found else None
