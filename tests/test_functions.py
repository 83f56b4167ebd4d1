import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidings.functions import contains_any, country_from_tld, domain_of, file_date, file_stem, root_code


def _map(spark, column, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[0] for row in rows.orderBy("i").select(column).collect()]


DOMAINS = {
    "http://www.a.ca:8080/x": "a.ca",
    "https://X.CA?q=1": "X.CA?q=1",
    "ftp://z": "",
    None: None,
    "https://u:p@www.b.gov.uk/1": "u:p@www.b.gov.uk",
    "https://www.www.c.edu": "www.c.edu",
    "HTTP://d.ca/": "",
    "": "",
    "see http://e.fr/x": "e.fr",
    "http:///x": "",
    "http:///https://f.de/1": "f.de",
    "https://https://g.in/1": "https:",
    "http://www.": "",
    "http://www./x": "",
    "http://:80/x": "",
    "http://www.:80/x": "",
    "http://h.jp:/x": "h.jp:",
    "http://h.jp:80:81/x": "h.jp:80",
    "http://h.jp:80a/x": "h.jp:80a",
    "http://h.jp:80?q=a:9": "h.jp:80?q=a",
    "http://www2.i.ru/": "www2.i.ru",
    "http://m.j.es:1": "m.j.es",
    "http://wwww.k.nz/": "wwww.k.nz",
    "https://[::1]:80/x": "[::1]",
    "http://é.ca/x": "é.ca",
}


def test_domain_of(spark):
    assert _map(spark, domain_of("v"), list(DOMAINS)) == list(DOMAINS.values())


def test_domain_of_equals_three_step_definition(spark):
    """Against host, www and port taken off one after the other, over all short addresses."""
    parts = ["http://", "https://", "www.", ":", "80", "/", "a", ".", "x:1"]
    texts = [a + b + c + d for a in parts for b in parts for c in parts for d in parts]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    host = F.regexp_extract("v", "https?://([^/]+)", 1)
    steps = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":\d+$", "")
    assert rows.filter(~steps.eqNullSafe(domain_of("v"))).collect() == []


def test_country_from_tld(spark):
    expected = {
        "a.ca": "Canada", "b.co.uk": "United Kingdom", "c.au": "Australia", "d.de": "Germany", "e.fr": "France",
        "f.jp": "Japan", "g.cn": "China", "h.in": "India", "i.ru": "Russia", "j.es": "Spain", "k.nz": "New Zealand",
        "l.gov": "United States", "m.edu": "United States", "n.mil": "United States", "x.gov.au": "Australia",
        "X.CA": None, "ca": None, "": None, None: None, "o.com": None, "p.ca?q=1": None, ".ca": "Canada",
        "q.ca.": None, "127.0.0.1": None,
    }
    assert _map(spark, country_from_tld("v"), list(expected)) == list(expected.values())


def test_root_code(spark):
    codes = ["010", "0211", "5", None, "1056", "x10", ""]
    assert _map(spark, root_code("v"), codes) == ["01", "02", "", None, "10", "", ""]


def test_file_date(spark):
    names = ["20240229.export.CSV.zip", "20241399.export.CSV.zip", "2006.zip", "200601.zip", ".x", "20240101", None]
    days = [dt.date(2024, 2, 29), None, None, None, None, dt.date(2024, 1, 1), None]
    assert _map(spark, file_date("v"), names) == days
    assert _map(spark, file_stem("v"), names) == ["20240229", "20241399", "2006", "200601", "", "20240101", None]


def test_file_date_of_odd_names(spark):
    names = ["20240101\n.csv", " 0240101.csv", "2024 1 1.csv", "+2024010.csv", "٢٠٢٤٠١٠١.csv", "20230229.csv", "20240431.csv", "00010101.csv", "99991231.csv"]
    assert _map(spark, file_date("v"), names) == [None] * 7 + [dt.date(1, 1, 1), dt.date(9999, 12, 31)]


@pytest.mark.parametrize(
    ("terms", "hits"),
    [
        (["AuStra"], [True, False, False, False, False]),
        (["%"], [False, True, False, False, False]),
        ([""], [True] * 5),
        (["50%", "a.b"], [False, True, True, False, False]),
        (["^", "]", "\\", "-", "&&"], [False, False, False, True, False]),
        (["nab"], [False] * 5),
        (["\x01", "zz"], [False] * 5),
    ],
)
def test_contains_any(spark, terms, hits):
    rows = [
        (0, "AUSTRALIAN", None),
        (1, "50% off", "x"),
        (2, "xn", "ab A.B"),
        (3, None, "^]\\-&&"),
        (4, None, None),
    ]
    table = spark.createDataFrame(rows, "i int, a string, b string").orderBy("i")
    assert [row[0] for row in table.select(contains_any(["a", "b"], terms)).collect()] == hits


def test_contains_any_over_lines(spark):
    table = spark.createDataFrame([("one\ntwo\nÉCOLE",)], "a string")
    assert table.select(contains_any(["a"], ["école"]), contains_any(["a"], ["e\nt"])).first() == (True, True)


def test_contains_any_needs_input():
    with pytest.raises(ValueError):
        contains_any([], ["a"])
    with pytest.raises(ValueError):
        contains_any(["a"], [])
