"""Registered queries: every operator over the whole supplied tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions import contains_any, country_from_tld, domain_of, file_date, file_stem, root_code
from tidings.operators import (
    SizedLookup,
    add_actions,
    add_publisher,
    article_lists,
    article_parts,
    download_plan,
    filter_many_terms,
    filter_terms,
    in_date_range,
    left_lookup,
    merge_articles,
    one_country_per_domain,
    parse_manifest,
    plan_chunks,
    publisher_lookup,
    range_size,
    select_existing,
    size_lookup,
    status_counts,
    summarize_articles,
)
from tidings.operators.manifest import manifest_rejects
from tidings.plans import Loaded, enrich_events, fetch_range, ingest_archives, ingest_files, run_ingest, update_article_states
from tidings.schema import KEEP_LARGE, KEEP_SHORT, RAW_COLUMNS
from tidings.shared import new_folder, settled
from tidings.sinks import append_table, compact_changed, compact_table, load_dates, load_table, write_events
from tidings.sources import (
    archive_events,
    archive_status,
    count_rejects,
    expand_archives,
    parse_action_codes,
    read_action_codes,
    read_events,
    read_events_latin1,
    read_manifest,
    read_manual_lookup,
    read_official_lookup,
    read_table,
    whole_lines,
)
from workload.derive import (
    action_documents,
    cut_archives,
    event_lines,
    lookups,
    manifest_lines,
    raw_events,
    read_blocks,
    table,
    write_archives,
    write_daily_archives,
    write_daily_files,
)

RANGE = (dt.date(1996, 1, 1), dt.date(1997, 12, 31))
TERMS = ["USER1", "nation_3", "Site7."]


def _publishers(spark: SparkSession, sf_dir: str, fan_out: bool = False, **bounds) -> SizedLookup:
    return size_lookup(publisher_lookup(*lookups(spark, sf_dir, fan_out)), keep=True, **bounds)


def _actions(spark: SparkSession, sf_dir: str, **bounds) -> SizedLookup:
    return size_lookup(parse_action_codes(action_documents(spark, sf_dir), "document"), keep=True, **bounds)


def _short_events(spark: SparkSession, sf_dir: str, addresses: str = "label") -> DataFrame:
    return raw_events(spark, sf_dir, addresses).select(*KEEP_SHORT)


# Selection and search


def select_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_existing(table(spark, sf_dir, "documents"), ["source", "doc_id", "no_such_column", "n_chars"])


def select_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_existing(table(spark, sf_dir, "documents"), ["no_such_column"])


def select_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_existing(raw_events(spark, sf_dir), KEEP_LARGE)


def filter_terms_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = filter_terms(documents, ["License", "SRC3", "the the"], ["text", "lang", "source", "no_such_column"])
    return found.select("doc_id", "lang", "source", "n_chars")


def filter_terms_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_terms(table(spark, sf_dir, "pages"), ["Example.NET", "cookie", "100%"], ["url", "html"])
    return found.select("page_id", "url")


def filter_terms_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with any of ten thousand terms of five letters, by one automaton."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    numbers = [i * 1_187 for i in range(10_000)]
    terms = ["".join(letters[n // 26**k % 26] for k in range(5)) for n in numbers]
    return filter_many_terms(table(spark, sf_dir, "documents"), terms, ["text", "no_such_column"]).select("doc_id", "source")


# Publisher domain and country


def domain_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", domain_of("url").alias("domain_name"))


def country_tld(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = raw_events(spark, sf_dir).select("GLOBALEVENTID", domain_of("SOURCEURL").alias("domain_name"))
    return located.withColumn("country", country_from_tld("domain_name"))


def lookup_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publisher_lookup(*lookups(spark, sf_dir, fan_out=True))


def lookup_one_per_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_country_per_domain(*lookups(spark, sf_dir, fan_out=True))


def _pages_per_country(spark: SparkSession, sf_dir: str, publishers: SizedLookup) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("SOURCEURL"))
    return add_publisher(pages, publishers)


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_per_country(spark, sf_dir, _publishers(spark, sf_dir))


def lookup_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_per_country(spark, sf_dir, _publishers(spark, sf_dir, fan_out=True))


def country_lookup_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_per_country(spark, sf_dir, _publishers(spark, sf_dir, fan_out=True, max_rows=0))


def lookup_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shuffled lookup of rows with many exact copies."""
    pages = raw_events(spark, sf_dir, "page").select("SOURCEURL", domain_of("SOURCEURL").alias("domain_name"))
    publishers = _publishers(spark, sf_dir, fan_out=True, max_rows=0)
    return left_lookup(pages, publishers, F.col("domain_name"), "domain")


def lookup_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both lookups written in their file formats, read back and applied."""
    official, manual = lookups(spark, sf_dir)
    tsv, csv = new_folder(spark, "official"), new_folder(spark, "manual")
    coded = official.select("domain", F.lpad(F.length("domain").cast("string"), 2, "0").alias("code"), "country_name")
    coded.write.option("sep", "\t").csv(tsv)
    manual.write.option("header", True).csv(csv)
    pairs = publisher_lookup(read_official_lookup(spark, tsv), read_manual_lookup(spark, csv))
    return _pages_per_country(spark, sf_dir, size_lookup(pairs))


# Action descriptions


def action_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of all documents, written as one JSON object per file and read back with a correction."""
    path = new_folder(spark, "codes")
    codes = parse_action_codes(action_documents(spark, sf_dir), "document")
    entries = codes.agg(F.map_from_entries(F.collect_list(F.struct("code", "description"))).alias("m"))
    entries.select(F.to_json("m").alias("value")).write.text(path)
    return read_action_codes(spark, path, {"106": "Demand withdrawal"})


def action_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = raw_events(spark, sf_dir).select("GLOBALEVENTID", "EventCode")
    return add_actions(events, _actions(spark, sf_dir))


def action_enrich_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = raw_events(spark, sf_dir).select("GLOBALEVENTID", "EventCode")
    return add_actions(events, _actions(spark, sf_dir, max_rows=0))


def events_per_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = raw_events(spark, sf_dir).select(root_code("EventCode").alias("root"))
    return roots.groupBy("root").agg(F.count("*").alias("events"))


# Articles


def _enriched(spark: SparkSession, sf_dir: str, addresses: str = "label", **options) -> DataFrame:
    events = raw_events(spark, sf_dir, addresses)
    return enrich_events(events, _publishers(spark, sf_dir), _actions(spark, sf_dir), **options)


def _mean(name: str):
    # Means of grid values can end on an exact half, which the last bit of a sum may tip.
    return F.round(F.col(name) + 1e-9, 6).alias(name)


def _flat(summary: DataFrame) -> DataFrame:
    def pairs(name: str, first: str, second: str):
        shown = F.transform(name, lambda p: F.concat_ws("|", *[F.coalesce(p[f], F.lit("-")) for f in (first, second)]))
        return F.array_join(shown, ";").alias(name)

    return summary.select(
        "SOURCEURL",
        "FirstEventDate",
        "EventCount",
        F.array_join("EventIDs", ";").alias("EventIDs"),
        _mean("GoldsteinMean"),
        _mean("AvgToneMean"),
        F.array_join("EventDescriptions", ";").alias("EventDescriptions"),
        pairs("ActorPairs", "Actor1Name", "Actor2Name"),
        pairs("GeoPairs", "Actor1Geo_FullName", "Actor2Geo_FullName"),
    )


def article_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(article_parts(_enriched(spark, sf_dir, "page")))


def article_summary_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(article_parts(_enriched(spark, sf_dir)))


def article_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalars of every article, with their number of events over the whole result."""
    return _with_total(summarize_articles(_enriched(spark, sf_dir)))


def article_scalars_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from states by date: the first days of the months are loaded in half, then whole, and only their states are made anew."""
    events = _enriched(spark, sf_dir).withColumn("file_date", F.to_date("SQLDATE", "yyyyMMdd"))
    loaded, states = new_folder(spark, "table"), new_folder(spark, "states")
    again = F.dayofmonth("file_date") == 1
    load_dates(events.where(~again | (F.pmod(F.xxhash64("GLOBALEVENTID"), F.lit(2)) == 0)), loaded)
    update_article_states(spark, loaded, states)
    load_dates(events.where(again), loaded)
    update_article_states(spark, loaded, states)
    return _with_total(merge_articles(read_table(spark, states)))


def _with_total(summary: DataFrame) -> DataFrame:
    total = summary.agg(F.sum("EventCount")).scalar().alias("AllEvents")
    return summary.select("SOURCEURL", "FirstEventDate", "EventCount", _mean("GoldsteinMean"), _mean("AvgToneMean"), total)


def _together(lists: DataFrame) -> DataFrame:
    """The parts of each article put together: all lists sorted, and the length of the longest part."""

    def shown(name: str, *fields: str):
        items = F.flatten(F.collect_list(name))
        if fields:
            items = F.transform(items, lambda p: F.concat_ws("|", *[F.coalesce(p[f], F.lit("-")) for f in fields]))
        return F.array_join(F.array_sort(items), ";").alias(name)

    return lists.groupBy("SOURCEURL").agg(
        F.count("*").alias("parts"),
        F.max(F.size("ActorPairs")).cast("long").alias("longest"),
        shown("EventIDs"),
        shown("EventDescriptions"),
        shown("ActorPairs", "Actor1Name", "Actor2Name"),
        shown("GeoPairs", "Actor1Geo_FullName", "Actor2Geo_FullName"),
    )


def article_lists_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _together(article_lists(_enriched(spark, sf_dir)))


def article_summary_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in parts of at most ten events, put together again."""
    return _together(article_lists(_enriched(spark, sf_dir), max_items=10))


# Enrichment


def enrich_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, "page")


def enrich_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, terms=TERMS)


def events_per_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = _enriched(spark, sf_dir)
    return enriched.groupBy("news_source_country", "Cameo").agg(F.count("*").alias("events"))


def term_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = contains_any(["Actor2Name", "ActionGeo_FullName", "SOURCEURL"], TERMS)
    return raw_events(spark, sf_dir).select("GLOBALEVENTID", hit.alias("hit"))


# Manifest


def _size():
    return F.coalesce("FileSizeMB", F.lit(-1.0)).alias("FileSizeMB")


def manifest_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = parse_manifest(manifest_lines(spark, sf_dir))
    return listed.select(_size(), "FileName", F.date_format("Date", "yyyy-MM-dd").alias("Date"))


def manifest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest landed as a text file and read back."""
    path = new_folder(spark, "manifest")
    manifest_lines(spark, sf_dir).write.text(path)
    listed = read_manifest(spark, path)
    return listed.select(_size(), "FileName", F.date_format("Date", "yyyy-MM-dd").alias("Date"))


def manifest_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_rejects(manifest_lines(spark, sf_dir))


def manifest_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = in_date_range(parse_manifest(manifest_lines(spark, sf_dir)), *RANGE)
    return listed.groupBy("FileName").agg(F.count("*").alias("files"))


def manifest_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_size(parse_manifest(manifest_lines(spark, sf_dir)), *RANGE)


def manifest_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surrogate ids are unique: as many distinct ids as rows."""
    listed = parse_manifest(manifest_lines(spark, sf_dir))
    return listed.agg(F.count("*").alias("files"), F.countDistinct("id").alias("ids"))


def file_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.regexp_extract("value", r"(\S+\.\S+)", 1)
    day = F.date_format(file_date(name), "yyyy-MM-dd").alias("day")
    dated = manifest_lines(spark, sf_dir).select(file_stem(name).alias("stem"), day)
    return dated.groupBy("stem", "day").agg(F.count("*").alias("files"))


def download_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = parse_manifest(manifest_lines(spark, sf_dir))
    plan = download_plan(manifest, *RANGE, "http://files.example.org/", "/landing")
    return plan.select("date_str", "filename", "file_url", "local_filepath", _size())


def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    bounds = table(spark, sf_dir, "events").agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))
    chunks = plan_chunks(bounds, 4)
    return chunks.select(
        F.col("chunk").cast("long").alias("chunk"),
        F.date_format("chunk_start", "yyyy-MM-dd").alias("chunk_start"),
        F.date_format("chunk_end", "yyyy-MM-dd").alias("chunk_end"),
    )


def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "FAILED: Not Found").when(kind == "view", "SKIPPED: Empty File").otherwise("SUCCESS")
    )
    return status_counts(table(spark, sf_dir, "events").select(status.alias("download_status")))


# Files


def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tsv")
    write_events(raw_events(spark, sf_dir), path, "tsv")
    return read_events(spark, path).select(*KEEP_SHORT)


def latin1_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "latin1")
    accented = F.concat_ws(" ", F.lit("Café à"), "Actor1Geo_FullName").alias("Actor1Geo_FullName")
    events = raw_events(spark, sf_dir)
    accents = events.select(*[accented if c == "Actor1Geo_FullName" else F.col(c) for c in events.columns])
    accents.write.options(sep="\t", encoding="ISO-8859-1", nullValue="", emptyValue="").csv(path)
    return read_events_latin1(spark, path).select("GLOBALEVENTID", "Actor1Geo_FullName", "SOURCEURL")


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article summary as CSV, arrays joined."""
    path = new_folder(spark, "csv")
    write_events(article_parts(_enriched(spark, sf_dir, "page")).drop("part"), path, "csv")
    columns = (
        "SOURCEURL string, FirstEventDate string, EventCount long, EventIDs string, GoldsteinMean double, "
        "AvgToneMean double, EventDescriptions string, ActorPairs string, GeoPairs string"
    )
    stored = spark.read.schema(columns).option("header", True).csv(path)
    return stored.withColumns({"GoldsteinMean": _mean("GoldsteinMean"), "AvgToneMean": _mean("AvgToneMean")})


def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends compacted by size; the stored rows and the number of files left."""
    parts, merged = new_folder(spark, "parts"), new_folder(spark, "merged")
    events = _short_events(spark, sf_dir)
    root = F.col("IsRootEvent") == "1"
    append_table(events.filter(root), f"{parts}/root")
    append_table(events.filter(~root), f"{parts}/other")
    append_table(events.filter(~root), f"{parts}/other")
    compact_table(spark, parts, merged, num_files=None, recursive=True)
    stored = read_table(spark, merged)
    files = stored.select(F.input_file_name().alias("file")).distinct().count()
    copies = stored.groupBy("GLOBALEVENTID", "IsRootEvent", "SOURCEURL").agg(F.count("*").alias("copies"))
    return copies.withColumn("files", F.lit(files).cast("long"))


def compaction_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table partitioned by date, compacted in place of its dates; rows per date."""
    path, merged = new_folder(spark, "table"), new_folder(spark, "merged")
    load_table(_short_events(spark, sf_dir).withColumn("file_date", F.to_date("SQLDATE", "yyyyMMdd")), path)
    compact_table(spark, path, merged, by="file_date")
    stored = read_table(spark, merged)
    return stored.groupBy("SQLDATE", F.date_format("file_date", "yyyyMMdd").alias("day")).agg(
        F.count("*").alias("events"), F.countDistinct("GLOBALEVENTID").alias("ids")
    )


def idempotent_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates loaded, then every date loaded again."""
    path = new_folder(spark, "table")
    events = _short_events(spark, sf_dir).withColumn("file_date", F.to_date("SQLDATE", "yyyyMMdd"))
    load_table(events, path)
    load_table(events, path)
    return read_table(spark, path).select(*KEEP_SHORT)


def archive_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archives")
    write_archives(event_lines(raw_events(spark, sf_dir)), folder)
    return archive_events(expand_archives(spark, folder)).select(*KEEP_SHORT)


def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archives")
    write_archives(event_lines(raw_events(spark, sf_dir)), folder)
    status = archive_status(expand_archives(spark, folder))
    return status.groupBy("status").agg(F.sum("lines").alias("lines"))


def archive_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of one day, several a day, cut short on days that end in 5: events of the whole ones, by day."""
    folder = new_folder(spark, "archives")
    write_daily_archives(_short_events(spark, sf_dir), folder, "events.csv", damaged="5", parts=3)
    lines = whole_lines(expand_archives(spark, folder))
    events = archive_events(lines, KEEP_SHORT, "file_date")
    return events.groupBy(F.date_format("file_date", "yyyyMMdd").alias("day")).agg(
        F.count("*").alias("events"), F.countDistinct("SQLDATE").alias("dates")
    )


# Jobs


def _bounds(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    day = F.col("ts").cast("date")
    return tuple(table(spark, sf_dir, "events").agg(F.min(day), F.max(day)).first())


def _stored(spark: SparkSession, path: str) -> DataFrame:
    stored = read_table(spark, path)
    return stored.select("GLOBALEVENTID", "SOURCEURL", "news_source_country", F.date_format("file_date", "yyyyMMdd").alias("day"))


def _loads(spark: SparkSession, sf_dir: str, landed: str = "", damaged: str = "") -> dict:
    """A landing area of all days, or with those archives of ``landed``, cut short on days that end in ``damaged``."""
    folder = new_folder(spark, "landing")
    if landed:
        cut_archives(spark, landed, folder, damaged)
    else:
        write_daily_archives(_short_events(spark, sf_dir), folder, "events.csv", parts=3)
    return dict(
        landing=folder, table=new_folder(spark, "table"), publishers=_publishers(spark, sf_dir), actions=_actions(spark, sf_dir),
        headers=KEEP_SHORT,
    )


def ingest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives with members that carry no date, loaded window by window; the stored table."""
    first, last = _bounds(spark, sf_dir)
    job = _loads(spark, sf_dir)
    while first <= last:
        ingest_archives(spark, first, first + dt.timedelta(days=6), **job)
        first += dt.timedelta(days=7)
    return _stored(spark, job["table"])


def ingest_again_with_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, then loaded again with search terms: nothing else stays, also of days without a hit."""
    first, last = _bounds(spark, sf_dir)
    job = _loads(spark, sf_dir)
    ingest_archives(spark, first, last, **job)
    ingest_archives(spark, first, last, **job, terms=["USER10 ", "user77"])
    return _stored(spark, job["table"])


def ingest_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded; then again from archives of which some are damaged: those days keep their rows."""
    first, last = _bounds(spark, sf_dir)
    job = _loads(spark, sf_dir)
    ingest_archives(spark, first, last, **job)
    again = _loads(spark, sf_dir, landed=job["landing"], damaged="5") | {"table": job["table"]}
    ingest_archives(spark, first, last, **again, terms=["user7"])
    return _stored(spark, job["table"])


def ingest_plain_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed plain event files, several a day, loaded twice; the stored table."""
    first, last = _bounds(spark, sf_dir)
    job = _loads(spark, sf_dir)
    plain = new_folder(spark, "plain")
    write_daily_files(_short_events(spark, sf_dir), plain)
    for _ in range(2):
        ingest_files(spark, first, last, **(job | {"landing": plain}))
    return _stored(spark, job["table"])


def _whole_job(spark: SparkSession, sf_dir: str, **options) -> tuple[Loaded, str, str]:
    """Every day of ``events`` listed in a manifest, published as archives, fetched and loaded."""
    source, folder = new_folder(spark, "published"), new_folder(spark, "job")
    write_daily_archives(_short_events(spark, sf_dir), source, "events.csv")
    first, last = _bounds(spark, sf_dir)
    days = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyyMMdd").alias("day")).distinct()
    manifest = parse_manifest(days.select(F.concat(F.lit("1000000 "), "day", F.lit(".export.CSV.zip")).alias("value")))
    done = run_ingest(
        spark, options.pop("start", first), options.pop("end", last), manifest, f"{source}/", f"{folder}/landing",
        f"{folder}/status", f"{folder}/table", _publishers(spark, sf_dir), _actions(spark, sf_dir), fetch=read_blocks,
        headers=KEEP_SHORT, compacted=f"{folder}/compact", **options,
    )
    return done, f"{folder}/table", f"{folder}/compact"


def job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the whole job returns: downloads by status, rows stored and days replaced."""
    done, _, _ = _whole_job(spark, sf_dir, chunk_days=11)
    return done.statuses.select(
        "download_status", "count", F.lit(done.rows).cast("long").alias("rows"), F.lit(len(done.dates)).cast("long").alias("days")
    )


def job_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compact copy that the whole job leaves."""
    return _stored(spark, _whole_job(spark, sf_dir)[2])


def job_compacted_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, then its last three days again: which days the compact copy has written anew, by file names."""
    first, last = _bounds(spark, sf_dir)
    job = _loads(spark, sf_dir)
    copy = new_folder(spark, "compact")

    def compacted() -> DataFrame:
        compact_changed(spark, job["table"], copy)
        stored = read_table(spark, copy).select(F.date_format("file_date", "yyyyMMdd").alias("day"), F.col("_metadata.file_name").alias("file"))
        return stored.groupBy("day").agg(F.count("*").alias("events"), F.collect_set("file").alias("files"))

    ingest_archives(spark, first, last, **job)
    before = settled(compacted())
    ingest_archives(spark, last - dt.timedelta(days=2), last, **job)
    after = compacted().select("day", F.col("events").alias("events_now"), F.col("files").alias("files_now"))
    kept = F.size(F.array_intersect("files", "files_now"))
    return before.join(after, "day").select("day", "events", "events_now", (kept == 0).alias("rewritten"))


def job_empty_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range without files: no downloads, and nothing stored; one row from ``events`` beside it."""
    first, _ = _bounds(spark, sf_dir)
    early = first - dt.timedelta(days=400)
    done, _, _ = _whole_job(spark, sf_dir, start=early, end=early + dt.timedelta(days=5))
    files = done.statuses.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()
    events = table(spark, sf_dir, "events").agg(F.count("*").alias("events"))
    return events.select("events", files.alias("files"), F.lit(done.rows).cast("long").alias("rows"))


def fetch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed day fetched once, from a publisher that lacks some days and has empty ones.

    Beside each status: its files, and how many stored files have the text that was sent.
    """

    def publisher(url: str):
        day = url.rsplit("/", 1)[1][6:8]
        if day == "13":
            raise FileNotFoundError(url)
        if day == "29":
            raise TimeoutError(url)
        return [] if day == "01" else [url.encode()]

    manifest = parse_manifest(manifest_lines(spark, sf_dir)).dropDuplicates(["Date"])
    folder = new_folder(spark, "fetch")
    base = "http://files.example.org/"
    counts = fetch_range(manifest, *RANGE, base, f"{folder}/landing", f"{folder}/status", publisher)
    files = spark.read.text(f"{folder}/landing", wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    right = files.where(F.concat(F.lit(base), "name") == F.col("value")).agg(F.count("*")).scalar()
    stored = F.when(F.col("download_status") == "SUCCESS", right).otherwise(F.lit(0)).alias("stored")
    return counts.select("download_status", "count", stored)


def fetch_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed day fetched twice, the second time from a publisher that has them all: only what failed is asked for."""

    def failing(url: str):
        if url.rsplit("/", 1)[1][6:8] in ("13", "29"):
            raise TimeoutError(url)
        return [url.encode()]

    manifest = parse_manifest(manifest_lines(spark, sf_dir)).dropDuplicates(["Date"])
    folder = new_folder(spark, "fetch")
    places = ("http://files.example.org/", f"{folder}/landing", f"{folder}/status")
    fetch_range(manifest, *RANGE, *places, failing)
    return fetch_range(manifest, *RANGE, *places, lambda url: [url.encode()], resume=True)


def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files with lines of 57, 58 and 59 fields: how many of each the reader keeps."""
    path = new_folder(spark, "rejects")
    events = raw_events(spark, sf_dir)
    event = F.col("GLOBALEVENTID").cast("long")
    line = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in RAW_COLUMNS])
    short = F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in RAW_COLUMNS[:-1]])
    line = F.when(event % 10 == 3, short).when(event % 10 == 7, F.concat(line, F.lit("\textra"))).otherwise(line)
    events.select(line.alias("value")).write.option("compression", "none").text(f"{path}/text")
    kept = read_events(spark, f"{path}/text", rejected_column="rejected", pattern="*.txt")
    counted = count_rejects(kept, "rejected")
    return counted.agg(*[F.sum(c).alias(c) for c in ("lines", "too_short", "too_long")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        select_lenient,
        select_none,
        select_large,
        filter_terms_documents,
        filter_terms_pages,
        filter_terms_many,
        term_hits,
        domain_extract,
        country_tld,
        lookup_union_distinct,
        lookup_one_per_domain,
        country_lookup,
        lookup_fanout,
        country_lookup_salted,
        lookup_copies,
        lookup_files,
        action_dictionary,
        action_enrich,
        action_enrich_salted,
        events_per_root,
        article_summary,
        article_summary_labels,
        article_scalars,
        article_scalars_merged,
        article_lists_whole,
        article_summary_split,
        enrich_all,
        enrich_filtered,
        events_per_country,
        manifest_parse,
        manifest_file,
        manifest_malformed,
        manifest_range,
        manifest_size,
        manifest_ids,
        file_dates,
        download_files,
        chunk_plan,
        status_summary,
        tsv_round_trip,
        latin1_round_trip,
        csv_round_trip,
        compaction,
        compaction_by_date,
        idempotent_load,
        archive_expand,
        archive_lines,
        archive_damaged,
        ingest_windows,
        ingest_again_with_terms,
        ingest_damaged,
        ingest_plain_files,
        job_counts,
        job_compacted,
        job_compacted_twice,
        job_empty_range,
        fetch_status,
        fetch_again,
        event_rejects,
    )
}
