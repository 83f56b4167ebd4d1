"""Folders and small files of the cluster's file systems.

The driver reaches them through Hadoop's file systems, as Spark itself does; this module is the only
place that asks the session for them. Workers open files by address, see :func:`opener`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is directly in ``folder``; none if it does not exist."""
    files, target = _system(spark, folder)
    return sorted(found.getPath().getName() for found in files.listStatus(target)) if files.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The whole text of a small file."""
    files, target = _system(spark, path)
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; ``FileExistsError`` if there is one already, which stays as it is."""
    files, target = _system(spark, path)
    if files.exists(target):
        raise FileExistsError(path)
    stream = files.create(target, False)
    stream.write(bytearray(text.encode()))
    stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it; nothing if it does not exist."""
    files, target = _system(spark, path)
    files.delete(target, True)


def opener(schemes: dict[str, str] | None = None) -> Callable[[str], tuple]:
    """A function from an address to its file system (of Arrow) and the path in it, for workers.

    ``schemes`` maps schemes of the cluster to those that Arrow knows, beside s3a and s3n to s3; an empty
    scheme is the machine's own file system, which has to be shared. The function needs no package
    on the workers but Arrow. Addresses of other schemes (hdfs, gs, abfs) are opened as they are.
    """
    known = {"s3a": "s3", "s3n": "s3", "file": "", **(schemes or {})}

    def located(uri: str) -> tuple:
        from pyarrow.fs import FileSystem, LocalFileSystem

        scheme, found, rest = uri.partition(":")
        if not found or "/" in scheme:
            scheme, rest = "file", uri
        own = known.get(scheme, scheme)
        if own:
            return FileSystem.from_uri(f"{own}:{rest}")
        return LocalFileSystem(), "/" + rest.lstrip("/")

    return located
