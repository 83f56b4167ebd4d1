import datetime as dt
import io
import os
import zipfile

import pytest

from tidings.operators import parse_manifest, size_lookup
from tidings.plans import ingest_archives, ingest_files, load_actions, load_publishers, run_ingest
from tidings.schema import ENRICHMENT_COLUMNS, KEEP_SHORT, RAW_COLUMNS
from tidings.sources import read_table

DAYS = ["20240101", "20240102", "20240103", "20240104", "20240105"]


def _publisher():
    days, columns = DAYS[:4], list(RAW_COLUMNS)

    def fetch(url):
        """Two events a day; the third day is damaged and the fifth is missing."""
        day = url.rsplit("/", 1)[1][:8]
        if day not in days:
            raise FileNotFoundError(url)
        if day == days[2]:
            return [b"damaged"]
        events = [
            {"GLOBALEVENTID": day + "1", "SQLDATE": day, "EventCode": "010", "SOURCEURL": "https://www.cbc.ca/1"},
            # A file may carry an event of an earlier date.
            {"GLOBALEVENTID": day + "2", "SQLDATE": "20231231", "EventCode": "05", "SOURCEURL": "http://x.org"},
        ]
        text = "".join("\t".join(e.get(c, "") for c in columns) + "\n" for e in events)
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w") as archive:
            archive.writestr(f"{day}.export.CSV", text)
        return [content.getvalue()]

    return fetch


@pytest.fixture
def job(spark, tmp_path):
    lines = [(f"1000000 {day}.export.CSV.zip",) for day in DAYS] + [("5 2006.zip",)]
    codes = [("01", "STATE"), ("010", "State"), ("05", "COOPERATE")]
    arguments = dict(
        spark=spark,
        manifest=parse_manifest(spark.createDataFrame(lines, "value string")),
        base_url="http://files.example.org/",
        landing=str(tmp_path / "landing"),
        status_path=str(tmp_path / "status"),
        table=str(tmp_path / "table"),
        publishers=size_lookup(spark.createDataFrame([("cbc.ca", "Kanada")], "domain string, country_name string")),
        actions=size_lookup(spark.createDataFrame(codes, "code string, description string")),
        fetch=_publisher(),
        tasks=2,
    )

    def run(first, last, **options):
        start, end = (dt.datetime.strptime(day, "%Y%m%d").date() for day in (first, last))
        return run_ingest(start=start, end=end, **{**arguments, **options})

    run.table, run.landing, run.folder = arguments["table"], arguments["landing"], tmp_path
    return run


def _ids(spark, path):
    return sorted(r[0] for r in read_table(spark, path).select("GLOBALEVENTID").collect())


EXPECTED = ["202401011", "202401012", "202401021", "202401022", "202401041", "202401042"]


def test_ingest(spark, job):
    done = job(DAYS[0], DAYS[-1], compacted=str(job.folder / "compact"), num_files=1)
    assert {r["download_status"]: r["count"] for r in done.statuses.collect()} == {"SUCCESS": 4, "FAILED: Not Found": 1}
    assert done.rows == 6 and [d.day for d in done.dates] == [1, 2, 4]
    assert done.damaged == ["20240103.export.CSV.zip"]
    table = read_table(spark, job.table)
    assert table.columns == [*KEEP_SHORT, *ENRICHMENT_COLUMNS, "file_date"]
    assert _ids(spark, job.table) == EXPECTED
    row = table.filter("GLOBALEVENTID = '202401011'").first()
    assert (row.domain_name, row.news_source_country, row.Cameo, row.Cameo_full) == ("cbc.ca", "Kanada", "STATE", "State")
    assert row.file_date == dt.date(2024, 1, 1)
    assert sorted(r[0].day for r in table.filter("SQLDATE = '20231231'").select("file_date").collect()) == [1, 2, 4]
    assert _ids(spark, str(job.folder / "compact")) == EXPECTED
    assert len([f for f in os.listdir(job.folder / "compact") if f.endswith(".parquet")]) == 1


def test_ingest_keeps_the_compact_copy_partitioned(spark, job):
    job(DAYS[0], DAYS[-1], compacted=str(job.folder / "compact"))
    assert sorted(f for f in os.listdir(job.folder / "compact") if "=" in f) == [
        "file_date=2024-01-01", "file_date=2024-01-02", "file_date=2024-01-04",
    ]
    assert _ids(spark, str(job.folder / "compact")) == EXPECTED


def test_ingest_again_and_wider(spark, job):
    job(DAYS[0], DAYS[1])
    assert _ids(spark, job.table) == EXPECTED[:4]
    job(DAYS[1], DAYS[-1])
    assert _ids(spark, job.table) == EXPECTED
    job(DAYS[0], DAYS[-1])
    assert _ids(spark, job.table) == EXPECTED


def test_ingest_in_windows(spark, job):
    job(DAYS[0], DAYS[-1], chunk_days=2)
    assert _ids(spark, job.table) == EXPECTED


def test_ingest_with_terms(spark, job):
    job(DAYS[0], DAYS[-1], terms=["CBC.ca"])
    assert _ids(spark, job.table) == EXPECTED[::2]


def test_download_only(spark, job):
    job(DAYS[0], DAYS[1], download_only=True)
    assert sorted(os.listdir(job.landing)) == [f"{day}.export.CSV.zip" for day in DAYS[:2]]
    job(DAYS[3], DAYS[3], download_only=True)
    assert len(os.listdir(job.landing)) == 3
    assert not os.path.exists(job.table)


def test_range_without_events(spark, job):
    job(DAYS[4], DAYS[4])
    assert not os.path.exists(job.table)


def test_rows_of_a_load(spark, job):
    job(DAYS[0], DAYS[-1], download_only=True)
    publishers = size_lookup(spark.createDataFrame([], "domain string, country_name string"))
    actions = size_lookup(spark.createDataFrame([], "code string, description string"))
    first, last = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert ingest_archives(spark, first, last, job.landing, job.table, publishers, actions).rows == 4
    assert ingest_archives(spark, dt.date(2025, 1, 1), last, job.landing, job.table, publishers, actions).rows == 0
    assert len(_ids(spark, job.table)) == 4


def test_dates_without_rows_are_emptied(spark, job):
    job(DAYS[0], DAYS[-1])
    done = job(DAYS[0], DAYS[1], terms=["nowhere"])
    assert done.rows == 0 and _ids(spark, job.table) == EXPECTED[4:]


def _landed(folder, day, member, *ids, damaged=False):
    text = "".join("\t".join({"GLOBALEVENTID": i}.get(c, "") for c in RAW_COLUMNS) + "\n" for i in ids)
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        archive.writestr(member, text)
    data = content.getvalue()
    folder.mkdir(exist_ok=True)
    (folder / f"{day}.export.CSV.zip").write_bytes(data[: len(data) // 2] if damaged else data)


def _load(spark, load, folder, first, last, table, **options):
    publishers = size_lookup(spark.createDataFrame([], "domain string, country_name string"))
    actions = size_lookup(spark.createDataFrame([], "code string, description string"))
    bounds = (dt.datetime.strptime(day, "%Y%m%d").date() for day in (first, last))
    return load(spark, *bounds, str(folder), table, publishers, actions, **options)


def test_members_of_any_name_keep_the_date_of_their_archive(spark, tmp_path):
    """Undated and otherwise dated members, loaded day by day, replace nothing of other days."""
    folder, table = tmp_path / "landing", str(tmp_path / "table")
    for day, member in zip(DAYS, ["events.csv", "events.csv", "20231231.csv"]):
        _landed(folder, day, member, day)
        assert _load(spark, ingest_archives, folder, day, day, table).rows == 1
    stored = {r.GLOBALEVENTID: r.file_date.strftime("%Y%m%d") for r in read_table(spark, table).collect()}
    assert stored == {day: day for day in DAYS[:3]}


def test_a_damaged_day_keeps_its_rows(spark, tmp_path):
    folder, table = tmp_path / "landing", str(tmp_path / "table")
    for day in DAYS[:2]:
        _landed(folder, day, "e.csv", f"old {day}")
    _load(spark, ingest_archives, folder, DAYS[0], DAYS[1], table)
    _landed(folder, DAYS[0], "e.csv", *[f"new {i}" for i in range(500)], damaged=True)
    _landed(folder, DAYS[1], "e.csv", "new")
    done = _load(spark, ingest_archives, folder, DAYS[0], DAYS[1], table)
    assert done.damaged == [f"{DAYS[0]}.export.CSV.zip"] and [d.day for d in done.dates] == [2]
    assert _ids(spark, table) == ["new", f"old {DAYS[0]}"]


def test_plain_files(spark, tmp_path):
    folder, table = tmp_path / "landing", str(tmp_path / "table")
    folder.mkdir()
    for day in DAYS[:3]:
        (folder / f"{day}.export.CSV").write_bytes(f"{day}\tS\xe3o\n".encode("latin-1"))
    (folder / "undated.csv").write_text("9\tx\n")
    options = {"headers": ["GLOBALEVENTID", "Actor1Name", "SOURCEURL"], "encoding": "ISO-8859-1"}
    done = _load(spark, ingest_files, folder, DAYS[0], DAYS[1], table, **options)
    assert done.rows == 2 and [d.day for d in done.dates] == [1, 2]
    assert {r.Actor1Name for r in read_table(spark, table).collect()} == {"S\xe3o"}
    (folder / f"{DAYS[0]}.export.CSV").write_text("")
    assert _load(spark, ingest_files, folder, DAYS[0], DAYS[-1], table, **options).rows == 2
    assert _ids(spark, table) == DAYS[1:3]


def test_archives_in_latin1_with_other_headers(spark, tmp_path):
    folder, table = tmp_path / "landing", str(tmp_path / "table")
    folder.mkdir()
    with zipfile.ZipFile(folder / f"{DAYS[0]}.zip", "w") as archive:
        archive.writestr("e.csv", "7\tS\xe3o\n".encode("latin-1"))
    options = {"headers": ["GLOBALEVENTID", "Actor1Name", "SOURCEURL"], "encoding": "ISO-8859-1"}
    assert _load(spark, ingest_archives, folder, DAYS[0], DAYS[0], table, **options).rows == 1
    assert read_table(spark, table).first().Actor1Name == "S\xe3o"


def test_lookup_files(spark, tmp_path):
    (tmp_path / "official.txt").write_text("nytimes.com\tUS\tUnited States\ncbc.ca\tCA\tCanada\n")
    (tmp_path / "manual.csv").write_text("domain,country_name\ncbc.ca,Kanada\n")
    (tmp_path / "codes").write_text('{"05": "ENGAGE IN DIPLOMATIC COOPERATION"}')
    paths = str(tmp_path / "official.txt"), str(tmp_path / "manual.csv")
    assert load_publishers(spark, *paths).rows == 3
    assert sorted(load_publishers(spark, *paths, one_per_domain=True).df.collect()) == [
        ("cbc.ca", "Kanada"), ("nytimes.com", "United States"),
    ]
    assert load_actions(spark, str(tmp_path / "codes"), {"106": "Demand withdrawal"}).rows == 2


def test_order_of_dates(job):
    with pytest.raises(ValueError):
        job(DAYS[1], DAYS[0])
