"""Zipped event files.

Spark lists the archives and packs them into tasks by size without reading their content.
Each task streams its archives from the shared file system in blocks and reads them once, so
its memory does not grow with an archive. A zip member is one deflate stream and cannot be split
further. Whether an archive is whole is known at its end, so its state is its last row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.files import opener
from tidings.functions import file_date
from tidings.schema import RAW_COLUMNS

OK = "OK"
BAD_ZIP = "BAD_ZIP"

_LINES = "archive string, member string, line string, status string"


def expand_archives(
    spark: SparkSession,
    path: str,
    encoding: str = "UTF-8",
    dates: tuple[dt.date, dt.date] | None = None,
    located: Callable[[str], tuple] | None = None,
) -> DataFrame:
    """Lines of all members of the ``*.zip`` files in ``path``: ``archive, member, line, status``.

    Rows of lines have a member. Each archive ends with one row without a member and a line: ``OK``
    if it was read whole, ``BAD_ZIP`` if it is damaged. Lines in front of the damage come before
    that row, and whoever stores them has to discard them (:func:`whole_lines`, or the ingest job).
    Archives stay where they are. ``dates`` leaves out, by file name, the archives outside an
    inclusive date range. ``located`` opens addresses on the workers (see ``tidings.files.opener``).
    """
    ok, bad, located = OK, BAD_ZIP, located or opener()

    def lines_of(batches: Iterator) -> Iterator:
        # Imports and constants stay inside: workers need not have this package installed.
        import codecs
        import io
        import zipfile
        import zlib

        import pyarrow as pa

        block = 4 * 1024 * 1024
        damage = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, ValueError)

        def rows(archive: str, member: str | None, lines: list, status: str):
            n = len(lines)
            columns = [pa.array([archive] * n), pa.array([member] * n, pa.string())]
            columns += [pa.array(lines, pa.string()), pa.array([status] * n)]
            return pa.RecordBatch.from_arrays(columns, names=["archive", "member", "line", "status"])

        def member_rows(archive: str, member: str, stream):
            decoder = io.IncrementalNewlineDecoder(codecs.getincrementaldecoder(encoding)("replace"), True)
            rest = ""
            while data := stream.read(block):
                *whole, rest = (rest + decoder.decode(data)).split("\n")
                if whole:
                    yield rows(archive, member, whole, ok)
            rest += decoder.decode(b"", True)
            if rest:
                yield rows(archive, member, [rest], ok)

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                files, name = located(archive)
                status = ok
                with files.open_input_file(name) as source:
                    try:
                        contents = zipfile.ZipFile(source)
                        for entry in contents.infolist():
                            if not entry.is_dir():
                                with contents.open(entry) as stream:
                                    yield from member_rows(archive, entry.filename, stream)
                    except damage:
                        status = bad
                yield rows(archive, None, [None], status)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    if dates:
        archives = archives.filter(file_date("_metadata.file_name").between(*map(F.lit, dates)))
    return archives.select("path").mapInArrow(lines_of, _LINES)


def whole_lines(lines: DataFrame) -> DataFrame:
    """``lines`` of undamaged archives only, without the rows of their states.

    Reads ``lines`` twice; a job that stores them anyway takes the damaged archives from its own rows.
    """
    damaged = lines.filter(F.col("status") == BAD_ZIP).select("archive").distinct()
    return lines.filter(F.col("member").isNotNull()).join(damaged, "archive", "left_anti")


def archive_events(
    lines: DataFrame,
    headers: Sequence[str] = RAW_COLUMNS,
    file_date_column: str | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Events of expanded archives: what ``read_events`` gives for the unzipped members.

    ``file_date_column`` names a column for the date in the name of the archive, by which archives
    are also chosen; members may be named in any way. ``carry`` keeps columns of ``lines``.
    """
    member = F.lower(F.substring_index("member", "/", -1))
    # Text files have no rows for lines of blanks and control characters.
    filled = F.ltrim("line", F.lit("".join(map(chr, range(0x21))))) != ""
    listed = lines.filter(F.endswith(member, F.lit(".csv")) & filled)
    columns = ", ".join(f"`{header}` string" for header in headers)
    event = F.from_csv("line", columns, {"sep": "\t", "quote": ""})
    archive = F.substring_index("archive", "/", -1)
    dated = [file_date(archive).alias(file_date_column)] if file_date_column else []
    # As a generator a condition on columns, such as a term search, is not moved below the parsing, which
    # would parse each line once more for every column in it.
    return listed.select(F.inline(F.array(event)), *dated, *carry)


def archive_status(lines: DataFrame) -> DataFrame:
    """State of each archive and the number of lines read from it."""
    state = F.max(F.when(F.col("member").isNull(), F.col("status"))).alias("status")
    return lines.groupBy("archive").agg(state, F.count("line").alias("lines"))
