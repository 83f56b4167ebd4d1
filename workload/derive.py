"""Event-shaped inputs derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.files import opener
from tidings.functions import domain_of
from tidings.schema import RAW_COLUMNS

# Last labels of the derived addresses, by event_id % 18.
LABELS = [
    "ca", "uk", "au", "de", "fr", "jp", "cn", "in", "ru", "es", "nz",
    "gov", "edu", "mil", "co.uk", "gov.au", "CA", "com",
]


# Stated, so that no job reads footers before a query starts.
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "pages": "page_id long, url string, html string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _digits(number: Column) -> Column:
    return number.cast("string")


def _event_code() -> Column:
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    root = F.lpad(_digits(1 + k % 20), 2, "0")
    listed = F.concat(root, _digits(F.floor(k / 20) * 2))
    event = F.col("event_id")
    return F.when(event % 97 == 0, F.lit(None)).when(event % 11 == 0, "0211").otherwise(listed)


def _label_address() -> Column:
    event = F.col("event_id")
    label = F.get(F.array(*[F.lit(text) for text in LABELS]), (event % len(LABELS)).cast("int"))
    port = F.when(event % 3 == 0, ":8080").otherwise("")
    site = _digits(F.col("user_id") % 50)
    address = F.concat(F.lit("https://www.site"), site, F.lit("."), label, port, F.lit("/a/"), _digits(event % 100))
    return F.when(event % 101 != 0, address)


def raw_events(spark: SparkSession, sf_dir: str, addresses: str = "label") -> DataFrame:
    """One raw event (58 string columns) per row of ``events``.

    ``addresses`` is "label" (made from the row, many top-level domains) or "page" (the
    address of a row of ``pages``).
    """
    events = table(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")
    if addresses == "page":
        pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("SOURCEURL"))
        total = pages.agg(F.count("*")).scalar()
        events = events.withColumn("_page", event % total).join(pages, F.col("_page") == F.col("page_id"))
    else:
        events = events.withColumn("SOURCEURL", _label_address())

    nation = table(spark, sf_dir, "nation")
    for column, key in (
        ("Actor1Geo_FullName", user % 25),
        ("Actor2Geo_FullName", event % 25),
        ("ActionGeo_FullName", (user + event) % 25),
    ):
        named = nation.select(F.col("n_nationkey").alias("_nation"), F.col("n_name").alias(column))
        events = events.join(named, key == F.col("_nation")).drop("_nation")

    day = F.date_format("ts", "yyyyMMdd")
    code = _event_code()
    known = {
        "GLOBALEVENTID": _digits(event),
        "SQLDATE": day,
        "Actor1Name": F.when(user % 5 != 0, F.upper("event_type")),
        "Actor1Geo_FullName": F.col("Actor1Geo_FullName"),
        "Actor2Name": F.concat(F.lit("USER"), _digits(user)),
        "Actor2Geo_FullName": F.when(event % 7 != 0, F.col("Actor2Geo_FullName")),
        "IsRootEvent": _digits(event % 2),
        "EventCode": code,
        "EventBaseCode": F.substring(code, 1, 3),
        "EventRootCode": F.substring(code, 1, 2),
        "QuadClass": _digits(1 + event % 4),
        "GoldsteinScale": _digits((event % 201 - 100).cast("double") / 10),
        "NumMentions": _digits(1 + user % 10),
        "NumSources": _digits(1 + user % 3),
        "NumArticles": _digits(1 + user % 7),
        "AvgTone": _digits(((user * 7) % 401 - 200).cast("double") / 20),
        "ActionGeo_Type": _digits(event % 6),
        "ActionGeo_FullName": F.col("ActionGeo_FullName"),
        "ActionGeo_CountryCode": F.concat(F.lit("N"), _digits((user + event) % 25)),
        "DATEADDED": day,
        "SOURCEURL": F.col("SOURCEURL"),
    }
    absent = F.lit(None).cast("string")
    return events.select(*[known.get(name, absent).alias(name) for name in RAW_COLUMNS])


def lookups(spark: SparkSession, sf_dir: str, fan_out: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two (domain, country_name) lookups over the domains of ``pages``.

    The first has the domains of even length, the second those with a length divisible by
    three; ``fan_out`` gives domains of length divisible by six another country in the second.
    """
    domain = domain_of("url").alias("domain")
    domains = table(spark, sf_dir, "pages").select(domain).distinct()
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country_name"))
    size = F.length("domain")
    official = domains.filter(size % 2 == 0).join(nation, size % 25 == F.col("n_nationkey"))
    shift = F.when((size % 6 == 0) & F.lit(fan_out), 1).otherwise(0)
    manual = domains.filter(size % 3 == 0).join(nation, (size + shift) % 25 == F.col("n_nationkey"))
    pair = ["domain", "country_name"]
    return official.select(*pair), manual.select(*pair)


def action_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small JSON dictionary per row of ``part``: a root code, a base code and a full code."""
    part = F.col("p_partkey")
    root = F.lpad(_digits(1 + part % 20), 2, "0")
    base = F.concat(root, _digits(F.floor(part / 20) % 7))
    full = F.concat(base, _digits(1 + F.floor(part / 140) % 3))
    entries = F.create_map(
        root, F.upper("p_type"), base, F.col("p_name"), full, F.concat_ws(" ", "p_name", "p_brand")
    )
    return table(spark, sf_dir, "part").select(F.to_json(entries).alias("value"), part.alias("document"))


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``size name`` line per row of ``orders``, some of them monthly, malformed or undated."""
    order = F.col("o_orderkey")
    size = _digits(F.floor("o_totalprice").cast("long") * 10000 + 1234)
    day = F.date_format("o_orderdate", "yyyyMMdd")
    line = (
        F.when(order % 7 == 0, F.concat_ws(" ", size, F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit(".zip"))))
        .when(order % 53 == 0, F.concat_ws(" ", size, day, F.lit("extra")))
        .when(order % 59 == 0, F.concat_ws(" ", size, F.lit("20241399.export.CSV.zip")))
        .when(order % 61 == 0, F.concat_ws(" ", F.lit("n/a"), F.concat(day, F.lit(".export.CSV.zip"))))
        .otherwise(F.concat(F.lit("  "), size, F.lit("\t "), day, F.lit(".export.CSV.zip ")))
    )
    return table(spark, sf_dir, "orders").select(line.alias("value"))


def event_lines(events: DataFrame) -> DataFrame:
    """Events as tab-separated lines in column ``line``."""
    return events.select(_line(events).alias("line"))


def write_archives(lines: DataFrame, folder: str) -> int:
    """Store ``lines`` as zip archives, one per batch of a task; returns their number."""
    located = opener()

    def zipped(batches):
        import io
        import zipfile

        import pyarrow as pa
        from pyspark import TaskContext

        files, base = located(folder)
        files.create_dir(base, recursive=True)
        for number, batch in enumerate(batches):
            stem = f"p{TaskContext.get().partitionId():06d}b{number:06d}.export.CSV"
            content = io.BytesIO()
            with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(stem, "".join(f"{line}\n" for line in batch.column(0).to_pylist()))
            with files.open_output_stream(f"{base}/{stem}.zip") as out:
                out.write(content.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([stem])], names=["archive"])

    return lines.mapInArrow(zipped, "archive string").count()


def write_daily_archives(events: DataFrame, folder: str, member: str, damaged: str = "", parts: int = 1) -> None:
    """Zip archives for each ``SQLDATE``, named after it, with its events in ``member``.

    A day has up to ``parts`` archives, their number after the date. Archives of days that end in
    ``damaged`` lack their end. Lines are written as they come, so a day of any size is held by no task.
    """
    _write_daily(events, folder, ".export.CSV.zip", member, damaged, parts)


def cut_archives(spark: SparkSession, folder: str, target: str, days: str) -> None:
    """The archives of ``folder`` once more in ``target``; those of days that end in ``days`` lack their end.

    What is left out is what ``damaged`` archives of :func:`write_daily_archives` lack, the list of members.
    """
    located = opener()

    def copied(batches):
        import zipfile

        import pyarrow as pa

        files, base = located(target)
        files.create_dir(base, recursive=True)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                origin, place = located(path)
                name = place.rsplit("/", 1)[1]
                with origin.open_input_file(place) as source, files.open_output_stream(f"{base}/{name}") as out:
                    left = zipfile.ZipFile(source).start_dir if name[:8].endswith(days) else source.size()
                    source.seek(0)
                    while block := source.read(min(left, 1 << 22)):
                        out.write(block)
                        left -= len(block)
                yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    archives.select("path").mapInArrow(copied, "file string").count()


def write_daily_files(events: DataFrame, folder: str, parts: int = 3) -> None:
    """Plain event files for each ``SQLDATE``, named after it, written like the archives."""
    _write_daily(events, folder, ".export.CSV", None, "", parts)


def _write_daily(events: DataFrame, folder: str, ending: str, member: str | None, damaged: str, parts: int) -> None:
    located = opener()
    part = F.pmod(F.xxhash64(*events.columns), F.lit(parts))
    name = F.concat("SQLDATE", F.when(part > 0, F.concat(F.lit("."), part.cast("string"))).otherwise(""), F.lit(ending))
    lines = events.select(name.alias("name"), F.concat(_line(events), F.lit("\n")).alias("line"))

    def written(batches):
        import contextlib
        import zipfile
        from itertools import groupby

        import pyarrow as pa
        import pyarrow.compute as pc

        def blocks():
            """The lines of a batch that go to one file, joined."""
            for batch in batches:
                runs = pc.run_end_encode(batch.column(0))
                ends = pa.concat_arrays([pa.array([0], pa.int32()), runs.run_ends])
                yield from zip(runs.values.to_pylist(), pc.binary_join(pa.ListArray.from_arrays(ends, batch.column(1)), ""))

        files, base = located(folder)
        files.create_dir(base, recursive=True)
        for name, group in groupby(blocks(), key=lambda pair: pair[0]):
            with files.open_output_stream(f"{base}/{name}") as out:
                if member is None:
                    for _, block in group:
                        out.write(block.as_buffer())
                else:
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    with archive.open(member, "w") as inner:
                        for _, block in group:
                            inner.write(block.as_buffer())
                    if damaged and name[:8].endswith(damaged):
                        archive._didModify = False  # its end, the list of members, is never written
                    with contextlib.suppress(ValueError):
                        archive.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["file"])

    lines.repartition("name").sortWithinPartitions("name").mapInArrow(written, "file string").count()


def _line(events: DataFrame) -> Column:
    return F.concat_ws("\t", *[F.coalesce(name, F.lit("")) for name in events.columns])


def read_blocks(url: str):
    """Blocks of a published file on the shared file system, in the place of a server."""
    files, path = opener()(url)
    with files.open_input_stream(path) as source:
        while block := source.read(1 << 16):
            yield block
