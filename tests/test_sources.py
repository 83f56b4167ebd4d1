import io
import json
import os
import random
import zipfile
from urllib.error import HTTPError, URLError

import pytest
from pyspark.sql import functions as F

from tidings.operators import filter_terms
from tidings.schema import RAW_COLUMNS, RAW_SCHEMA
from tidings.sinks import write_events
from tidings.sources import (
    archive_events,
    archive_status,
    count_rejects,
    expand_archives,
    fetch_files,
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
from tidings.files import opener
from tidings.sources.fetch import body_blocks


def _line(*cells, width=58):
    return "\t".join([*cells, *[""] * (width - len(cells))])


def test_read_events(spark, tmp_path):
    full = [f"v{i}" for i in range(58)]
    (tmp_path / "20240101.export.CSV").write_text("\t".join(full) + "\n" + _line("010", '"q', "w") + "\n")
    (tmp_path / "20240102.export.csv").write_text(_line("2", "x", width=57) + "\n\n   \n")
    (tmp_path / "notes.txt").write_text("ignored")
    events = read_events(spark, str(tmp_path), file_date_column="file_date")
    assert events.columns == [*RAW_COLUMNS, "file_date"]
    rows = {r.GLOBALEVENTID: r for r in events.collect()}
    assert list(rows["v0"])[:58] == full and rows["v0"].file_date.day == 1
    assert rows["010"][1:4] == ('"q', "w", None)
    assert rows["2"][1] == "x" and rows["2"].SOURCEURL is None and rows["2"].file_date.day == 2
    assert len(rows) == 3


def test_read_events_without_files(spark, tmp_path):
    for path in (tmp_path, tmp_path / "absent"):
        events = read_events(spark, str(path))
        assert events.schema == RAW_SCHEMA and events.count() == 0
    dated = read_events(spark, str(tmp_path / "absent"), file_date_column="file_date")
    assert dated.columns[-1] == "file_date" and dated.count() == 0


def test_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1\t2\t3\n")
    assert read_events(spark, str(tmp_path), ["a", "b"]).collect() == [("1", "2")]
    assert read_events(spark, str(tmp_path), ["a", "b", "c", "d"]).collect() == [("1", "2", "3", None)]


def test_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("São\tx\n".encode("latin-1"))
    assert read_events_latin1(spark, str(tmp_path), ["a", "b"]).first()[0] == "São"
    assert read_events(spark, str(tmp_path), ["a", "b"]).first()[0] == "S�o"


def test_latin1_path(spark, tmp_path):
    (tmp_path / "events.txt").write_bytes("Bogotá\t1\n".encode("latin-1"))
    assert read_events_latin1(spark, str(tmp_path / "events.txt"), ["a", "b"]).collect() == [("Bogotá", "1")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_events_latin1(spark, str(tmp_path / "absent"), ["a", "b"])


def test_lines_are_parsed_once(spark, tmp_path):
    _landing(tmp_path)
    events = archive_events(expand_archives(spark, str(tmp_path))).select("GLOBALEVENTID", "SQLDATE", "SOURCEURL")
    assert events._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1


def test_only_needed_columns_are_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text(_line("1") + "\n")
    plan = read_events(spark, str(tmp_path)).select("SOURCEURL")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<SOURCEURL:string>" in plan


def test_lookups(spark, tmp_path):
    (tmp_path / "official.txt").write_text("nytimes.com\tUS\tUnited States\ncbc.ca\tCA\tCanada\n")
    (tmp_path / "manual.csv").write_text("domain,country_name\ntheguardian.co.uk,United Kingdom\n")
    official = read_official_lookup(spark, str(tmp_path / "official.txt"))
    manual = read_manual_lookup(spark, str(tmp_path / "manual.csv"))
    assert official.columns == manual.columns == ["domain", "country_name"]
    assert official.collect() == [("nytimes.com", "United States"), ("cbc.ca", "Canada")]
    assert manual.collect() == [("theguardian.co.uk", "United Kingdom")]


def test_action_codes(spark, tmp_path):
    path = tmp_path / "codes"
    path.write_text('{\n "01": "MAKE PUBLIC STATEMENT",\n "010": "first",\n "010": "last"\n}')
    assert sorted(read_action_codes(spark, str(path)).collect()) == [("01", "MAKE PUBLIC STATEMENT"), ("010", "last")]
    patched = read_action_codes(spark, str(path), {"106": "Demand withdrawal", "01": "SAY"})
    assert sorted(patched.collect()) == [("01", "SAY"), ("010", "last"), ("106", "Demand withdrawal")]


def test_action_codes_of_several_documents(spark):
    documents = spark.createDataFrame([(json.dumps({"1": c}), n) for n, c in enumerate("abc")], "value string, n int")
    assert parse_action_codes(documents, "n").collect() == [("1", "c")]


def test_broken_dictionary_fails(spark, tmp_path):
    (tmp_path / "codes").write_text('{"01": "A", ')
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_action_codes(spark, str(tmp_path / "codes")).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_action_codes(spark, str(tmp_path / "absent"))


def test_manifest(spark, tmp_path):
    (tmp_path / "filesizes").write_text("1000000 20240101.export.CSV.zip\n\nx\n5 2006.zip\n")
    assert [(r.FileSizeMB, r.FileName) for r in read_manifest(spark, str(tmp_path / "filesizes")).collect()] == [
        (1.0, "20240101.export.CSV.zip")
    ]


def test_recursive_table(spark, tmp_path):
    for n in range(2):
        spark.range(n, n + 1).write.parquet(str(tmp_path / "t" / f"part{n}" / "deep"))
    assert sorted(r[0] for r in read_table(spark, str(tmp_path / "t"), recursive=True).collect()) == [0, 1]


def _zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)


def _landing(folder):
    a = _line("1", '"q', "x") + "\r\n" + _line("010", "y") + "\n\n \t\n" + "2\tz"
    _zip(folder / "20240101.export.CSV.zip", {"20240101.export.CSV": a, "readme.txt": "no event"})
    _zip(folder / "20240102.export.CSV.zip", {"20240102.export.csv": _line("3") + "\n", "d/20240103.csv": _line("4")})
    _zip(folder / "20240104.export.CSV.zip", {"20240104.export.CSV": ""})
    (folder / "20240105.export.CSV.zip").write_bytes(b"not an archive")
    damaged = folder / "20240106.export.CSV.zip"
    _zip(damaged, {"20240106.export.CSV": "".join(_line(str(n), str(n * n)) + "\n" for n in range(5000))})
    content = bytearray(damaged.read_bytes())
    content[len(content) // 2] ^= 0xFF
    damaged.write_bytes(bytes(content))


def test_archives(spark, tmp_path):
    _landing(tmp_path)
    lines = expand_archives(spark, str(tmp_path))
    status = {(os.path.basename(r.archive)[:8], r.status): r.lines for r in archive_status(lines).collect()}
    partly = status["20240106", "BAD_ZIP"]
    assert status == {
        ("20240101", "OK"): 6,
        ("20240102", "OK"): 2,
        ("20240104", "OK"): 0,
        ("20240105", "BAD_ZIP"): 0,
        ("20240106", "BAD_ZIP"): partly,
    }
    assert partly < 5000
    events = archive_events(whole_lines(lines), file_date_column="file_date")
    assert events.columns == [*RAW_COLUMNS, "file_date"]
    got = sorted((r[0], r[1], r[2], r.file_date.day) for r in events.collect())
    assert got == [
        ("010", "y", None, 1), ("1", '"q', "x", 1), ("2", "z", None, 1), ("3", None, None, 2), ("4", None, None, 2),
    ]
    assert sorted(os.listdir(tmp_path))[0] == "20240101.export.CSV.zip"


def test_archives_of_a_range(spark, tmp_path):
    import datetime as dt

    _landing(tmp_path)
    lines = expand_archives(spark, str(tmp_path), dates=(dt.date(2024, 1, 2), dt.date(2024, 1, 4)))
    assert sorted(r[0] for r in archive_events(lines).select("GLOBALEVENTID").collect()) == ["3", "4"]


def test_archives_equal_files(spark, tmp_path):
    """Blocks larger than one read: the zipped file gives what the plain file gives."""
    text = "".join(_line(str(n), f"é{n}" * 20, "" if n % 3 else '"x') + ("\r\n" if n % 2 else "\n") for n in range(60_000))
    assert len(text) > 9_000_000
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "20240101.export.CSV").write_bytes(text.encode())
    _zip(tmp_path / "20240101.export.CSV.zip", {"20240101.export.CSV": text.encode()})
    plain = read_events(spark, str(tmp_path / "plain"))
    zipped = archive_events(expand_archives(spark, str(tmp_path)))
    assert zipped.count() == plain.count() == 60_000
    assert zipped.exceptAll(plain).isEmpty()


def test_a_condition_on_events_of_archives_parses_no_line_again(spark, tmp_path, capsys):
    rows = [("1", "Café", "x"), ("2", "", "caf"), ("3", "z", None), ("4", None, "CAFÉ")]
    text = "\n".join("\t".join(cell or "" for cell in row) for row in rows) + "\n \t\x01\n\n5\n"
    _zip(tmp_path / "20240101.zip", {"a.csv": text.encode()})
    events = archive_events(expand_archives(spark, str(tmp_path)), ["n", "a", "b"], "file_date", carry=["member"])
    assert events.columns == ["n", "a", "b", "file_date", "member"]
    found = filter_terms(events, ["café", "z"], ["a", "b"])
    assert sorted((r.n, r.file_date.day, r.member) for r in found.collect()) == [(n, 1, "a.csv") for n in "134"]
    assert sorted(tuple(r)[:3] for r in events.where("a IS NULL").collect()) == [("2", None, "caf"), ("4", None, "CAFÉ"), ("5", None, None)]
    capsys.readouterr()
    found.explain()
    assert capsys.readouterr().out.count("from_csv(") == 1


def test_any_text_survives(spark, tmp_path):
    """Plain files, and zipped ones in a folder with a blank, keep every character of a field."""
    rng = random.Random(11)
    alphabet = ['"', "\\", "#", "'", " ", ",", ";", "a", "é", "%20", "\u2028", "\u0085", "€", "😀", "\\N", '""']
    rows = [tuple("".join(rng.choices(alphabet, k=rng.randint(1, 6))) for _ in range(3)) for _ in range(500)]
    rows = [(f"{n}", *row) for n, row in enumerate(rows)]
    text = "".join("\t".join(row) + "\n" for row in rows)
    folder = tmp_path / "with blank"
    folder.mkdir()
    (folder / "x.csv").write_bytes(text.encode())
    _zip(folder / "x.zip", {"x.csv": text.encode()})
    columns = ["n", "a", "b", "c"]
    assert sorted(read_events(spark, str(folder), columns).collect()) == sorted(rows)
    assert sorted(archive_events(expand_archives(spark, str(folder)), columns).collect()) == sorted(rows)
    written = str(tmp_path / "written")
    write_events(spark.createDataFrame(rows, columns), written, "tsv")
    assert sorted(read_events(spark, written, columns).collect()) == sorted(rows)


class _Response:
    """What a server sent, and the length that it announced."""

    def __init__(self, body, announced):
        self.headers = {} if announced is None else {"Content-Length": str(announced)}
        self._body = io.BytesIO(body)

    def read(self, n):
        return self._body.read(n)


def test_short_bodies_are_errors():
    body = b"x" * 20_000
    assert b"".join(body_blocks(_Response(body, 20_000))) == body
    assert b"".join(body_blocks(_Response(body, None))) == body
    with pytest.raises(ConnectionError):
        list(body_blocks(_Response(body, 20_001)))
    with pytest.raises(ConnectionError):
        list(body_blocks(_Response(b"", 5)))


def _fetch(url):
    name = url.rsplit("/", 1)[1]
    failures = {
        "b": HTTPError(url, 404, "", None, None),
        "c": HTTPError(url, 503, "", None, None),
        "d": URLError("refused"),
        "e": TimeoutError(),
        "f": ValueError(),
    }
    if name in failures:
        raise failures[name]
    if name == "g":
        return []

    def blocks():
        yield b"first"
        if name == "h":
            raise ConnectionResetError
        yield b" second"

    return blocks()


def test_fetch_statuses(spark, tmp_path):
    plan = spark.createDataFrame(
        [(n, f"http://x/{n}", f"{tmp_path}/land/{n}", None) for n in "abcdefgh"],
        "n string, file_url string, local_filepath string, size double",
    )
    fetched = fetch_files(plan, _fetch_by_value(), tasks=3)
    assert fetched.columns == [*plan.columns, "download_status", "stored_bytes"]
    assert {r.n: r.download_status for r in fetched.collect()} == {
        "a": "SUCCESS",
        "b": "FAILED: Not Found",
        "c": "FAILED: HTTP Error 503",
        "d": "FAILED: Connection Error",
        "e": "FAILED: Timeout",
        "f": "FAILED: Unspecified Error",
        "g": "SKIPPED: Empty File",
        "h": "FAILED: Connection Error",
    }
    assert os.listdir(tmp_path / "land") == ["a"]
    assert (tmp_path / "land" / "a").read_bytes() == b"first second"
    assert fetched.filter(F.col("size").isNull()).count() == 8


def _fetch_by_value():
    """A copy of ``_fetch`` that workers can load without importing this module."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))
    return _fetch


def test_lost_connections_are_tried_again(spark, tmp_path):
    plan = spark.createDataFrame([(f"http://x/{n}", f"{tmp_path}/land/{n}") for n in "abc"], "file_url string, local_filepath string")

    def fetch(url, folder=str(tmp_path)):
        """The first file comes at the third try, the second never; the third is not there at all."""
        import os

        if url.endswith("c"):
            raise FileNotFoundError(url)
        tries = f"{folder}/{url[-1]}.tries"
        with open(tries, "a") as out:
            out.write("x")
        if url.endswith("b") or os.path.getsize(tries) < 3:
            raise ConnectionError(url)
        return [b"12345"]

    got = {r.file_url[-1]: (r.download_status, r.stored_bytes) for r in fetch_files(plan, fetch, 1, attempts=3, wait=0.01).collect()}
    assert got == {"a": ("SUCCESS", 5), "b": ("FAILED: Connection Error", None), "c": ("FAILED: Not Found", None)}
    assert os.path.getsize(tmp_path / "b.tries") == 3


def test_other_schemes_are_opened_through_an_opener(spark, tmp_path):
    located = opener({"shelf": ""})
    plan = spark.createDataFrame([("http://x/a", f"shelf:{tmp_path}/land/a.csv.zip")], "file_url string, local_filepath string")
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        archive.writestr("a.csv", "1\t20240101\n")
    data = content.getvalue()
    assert fetch_files(plan, lambda url: [data], located=located).first().stored_bytes == len(data)
    assert (tmp_path / "land" / "a.csv.zip").read_bytes() == data
    def watched(uri):
        return located(uri.replace("file:", "shelf:"))

    lines = expand_archives(spark, str(tmp_path / "land"), located=watched)
    assert [r.line for r in lines.collect()] == ["1\t20240101", None]


def test_lines_of_other_lengths_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "20240101.export.CSV").write_text("1\ta\tx\n2\tb\n3\tc\ty\tz\n4\t\t\n")
    (tmp_path / "20240102.export.CSV").write_text("5\ta\tx\n")
    events = read_events(spark, str(tmp_path), ["id", "u", "v"], file_date_column="day", rejected_column="bad")
    assert events.columns == ["id", "u", "v", "bad", "day"]
    rows = {r.id: (r.u, r.v, r.bad) for r in events.collect()}
    assert rows == {"1": ("a", "x", None), "2": ("b", None, "2\tb"), "3": ("c", "y", "3\tc\ty\tz"), "4": (None, None, None), "5": ("a", "x", None)}
    assert [r.id for r in events.select("id").where("bad is not null").orderBy("id").collect()] == ["2", "3"]
    counted = count_rejects(events, "bad", 3).orderBy("file").collect()
    assert [tuple(r) for r in counted] == [("20240101.export.CSV", 4, 1, 1), ("20240102.export.CSV", 1, 0, 0)]
    assert read_events(spark, str(tmp_path / "none"), ["id"], rejected_column="bad").columns == ["id", "bad"]
