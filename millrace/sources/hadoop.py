"""Small file-system calls through Hadoop's FileSystem, so any store Spark reads will do."""

from __future__ import annotations

import time
import uuid
from pyspark.sql import SparkSession


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _fs(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write beside, then rename to a name that must be free: of two writers one fails, and no reader sees half."""
    fresh = f"{path}.{uuid.uuid4().hex}"
    stream = _fs(spark, fresh).create(_path(spark, fresh), False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    flags = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, fresh).toUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, fresh), _path(spark, path), flags)
    except Exception as error:
        delete_folder(spark, fresh)
        if exists(spark, path):
            raise FileExistsError(path) from error
        raise


def names_in(spark: SparkSession, path: str, folders: bool) -> list[str]:
    """Names of the folders, or of the files, in ``path``; none if it is not there."""
    if not exists(spark, path):
        return []
    children = _fs(spark, path).listStatus(_path(spark, path))
    return sorted(c.getPath().getName() for c in children if c.isDirectory() == folders)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def old_folders(spark: SparkSession, path: str, hours: float) -> list[str]:
    """Names of the folders in ``path`` last changed more than ``hours`` ago."""
    limit = (time.time() - hours * 3600) * 1000
    children = _fs(spark, path).listStatus(_path(spark, path))
    return [c.getPath().getName() for c in children if c.isDirectory() and c.getModificationTime() < limit]


def delete_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)
