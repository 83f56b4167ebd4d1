"""Distributed download of planned files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidings.files import opener


def http_get(url: str) -> Iterator[bytes]:
    """Body of ``url`` in small blocks; an error if it is shorter than the server announced."""
    from urllib.request import urlopen

    with urlopen(url, timeout=60) as response:
        yield from body_blocks(response)


def body_blocks(response) -> Iterator[bytes]:
    """Blocks of a response, held against its announced length.

    A connection that closes early ends a read without an error, so the bytes are counted.
    """
    announced, received = response.headers.get("Content-Length"), 0
    while block := response.read(8192):
        received += len(block)
        yield block
    if announced is not None and received != int(announced):
        raise ConnectionError(f"{received} of {announced} bytes received")


def missing_files(plan: DataFrame, landing: str, status_path: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``plan`` whose files have to be fetched, and those whose files have landed.

    A file appears under its name only when it is complete. It counts as landed if it has the size
    that an earlier outcome below ``status_path`` has for it, or, without one, any size but 0. Files are
    listed by Spark without reading their content.
    """
    spark = plan.sparkSession
    no_files = spark.createDataFrame([], "landed_name string, landed_bytes long")
    no_sizes = spark.createDataFrame([], "known_name string, known_bytes long")
    try:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(landing)
        listed = listed.select(F.col("_metadata.file_name").alias("landed_name"), F.col("length").alias("landed_bytes"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = no_files
    try:
        done = spark.read.schema("filename string, stored_bytes long").option("recursiveFileLookup", True).parquet(status_path)
        done = done.where("stored_bytes is not null").groupBy(F.col("filename").alias("known_name")).agg(
            F.collect_set("stored_bytes").alias("known_bytes")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        done = no_sizes.select("known_name", F.array("known_bytes").alias("known_bytes"))
    whole = F.coalesce(F.array_contains("known_bytes", F.col("landed_bytes")), F.col("landed_bytes") > 0)
    there = listed.join(done, F.col("landed_name") == F.col("known_name"), "left").where(whole).select("landed_name", "landed_bytes")
    landed = plan.join(there, F.col("filename") == F.col("landed_name")).withColumnRenamed("landed_bytes", "stored_bytes")
    missing = plan.join(there, F.col("filename") == F.col("landed_name"), "left_anti")
    return missing, landed.select(*plan.columns, "stored_bytes")


def fetch_files(
    plan: DataFrame,
    fetch: Callable[[str], Iterable[bytes]] = http_get,
    tasks: int | None = None,
    attempts: int = 1,
    wait: float = 1.0,
    located: Callable[[str], tuple] | None = None,
) -> DataFrame:
    """Store each ``file_url`` at its ``local_filepath`` and append ``download_status`` and ``stored_bytes``.

    Targets are paths of a file system that every worker reaches; ``located`` opens them (see
    ``tidings.files.opener``). A file appears under its name only when complete. Lost connections and
    timeouts are tried again, up to ``attempts`` times in all, after ``wait`` seconds, twice as long
    each time. A worker that is killed may leave a ``.part`` file, which nothing reads. The result is
    lazy and downloads again on each use: write it once and read the written rows.
    """
    located = located or opener()

    def store(batches: Iterator) -> Iterator:
        # Imports stay inside: workers need not have this package installed.
        import posixpath
        import time
        import uuid
        from itertools import chain
        from urllib.error import HTTPError, URLError

        import pyarrow as pa

        def save(url: str, target: str) -> tuple[str, int | None]:
            files, path = located(target)
            partial = f"{path}.{uuid.uuid4().hex}.part"
            files.create_dir(posixpath.dirname(path), recursive=True)
            try:
                blocks = (block for block in fetch(url) if block)
                first = next(blocks, None)
                if first is None:
                    return "SKIPPED: Empty File", None
                size = 0
                with files.open_output_stream(partial) as out:
                    for block in chain([first], blocks):
                        out.write(block)
                        size += len(block)
                files.move(partial, path)
                return "SUCCESS", size
            except Exception as error:
                if files.get_file_info(partial).is_file:
                    files.delete_file(partial)
                # The status texts.
                if isinstance(error, HTTPError) and error.code != 404:
                    return f"FAILED: HTTP Error {error.code}", None
                if isinstance(error, (HTTPError, FileNotFoundError)):
                    return "FAILED: Not Found", None
                if isinstance(error, (URLError, ConnectionError)):
                    return "FAILED: Connection Error", None
                if isinstance(error, TimeoutError):
                    return "FAILED: Timeout", None
                return "FAILED: Unspecified Error", None

        def tried(url: str, target: str) -> tuple[str, int | None]:
            for k in range(attempts):
                if k:
                    time.sleep(wait * 2 ** (k - 1))
                outcome = save(url, target)
                if outcome[0] not in ("FAILED: Connection Error", "FAILED: Timeout"):
                    break
            return outcome

        for batch in batches:
            pairs = zip(batch.column("file_url").to_pylist(), batch.column("local_filepath").to_pylist())
            outcomes = [tried(url, target) for url, target in pairs]
            done = pa.Table.from_batches([batch])
            done = done.append_column("download_status", pa.array([o[0] for o in outcomes], pa.string()))
            yield from done.append_column("stored_bytes", pa.array([o[1] for o in outcomes], pa.int64())).to_batches()

    spread = plan.repartition(tasks or plan.sparkSession.sparkContext.defaultParallelism)
    more = [StructField("download_status", StringType()), StructField("stored_bytes", LongType())]
    return spread.mapInArrow(store, StructType([*plan.schema, *more]))
