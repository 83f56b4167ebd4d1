"""SQL that states the expected result of each registered query."""

from __future__ import annotations

# Fixed values, stated here on their own: no list or rule is taken from the code under test.
_LABELS = "ca uk au de fr jp cn in ru es nz gov edu mil co.uk gov.au CA com".split()
_COUNTRIES = {
    "Canada": "ca", "United Kingdom": "uk", "Australia": "au", "Germany": "de", "France": "fr", "Japan": "jp", "China": "cn",
    "India": "in", "Russia": "ru", "Spain": "es", "New Zealand": "nz", "United States": "gov edu mil",
}
_SHORT_COLUMNS = """
    GLOBALEVENTID SQLDATE Actor1Name Actor1Geo_FullName Actor2Name Actor2Geo_FullName IsRootEvent EventCode EventBaseCode
    QuadClass GoldsteinScale NumMentions NumSources NumArticles AvgTone ActionGeo_Type ActionGeo_FullName
    ActionGeo_CountryCode SOURCEURL
""".split()
_LARGE_COLUMNS = """
    GLOBALEVENTID SQLDATE Actor1Code Actor1Name Actor1CountryCode Actor1Geo_CountryCode Actor1Geo_FullName
    Actor1KnownGroupCode Actor2Code Actor2Name Actor2CountryCode Actor2KnownGroupCode Actor2Geo_CountryCode
    Actor2Geo_FullName IsRootEvent EventCode EventBaseCode EventRootCode QuadClass GoldsteinScale NumMentions NumSources
    NumArticles AvgTone ActionGeo_Type ActionGeo_FullName ActionGeo_CountryCode DATEADDED SOURCEURL
""".split()

_LABEL_LIST = ", ".join(f"'{label}'" for label in _LABELS)

_DOMAIN = r"regexp_replace(regexp_replace(regexp_extract({0}, 'https?://([^/]+)', 1), '^www\.', ''), ':[0-9]+$', '')"


def _domain(column: str) -> str:
    return _DOMAIN.format(column)


def _country(domain: str) -> str:
    label = rf"regexp_extract({domain}, '\.([a-zA-Z]{{2,}})$', 1)"
    cases = " ".join(f"WHEN {label} IN ({', '.join(map(repr, last.split()))}) THEN '{name}'" for name, last in _COUNTRIES.items())
    return f"CASE {cases} END"


def _raw(addresses: str) -> str:
    """CTE ``raw``: the derived events, all columns that a selection can have."""
    k = r"CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER)"
    url = (
        "CASE WHEN event_id % 101 <> 0 THEN 'https://www.site' || (user_id % 50) || '.' || "
        f"(list_value({_LABEL_LIST}))[CAST(event_id % {len(_LABELS)} + 1 AS INTEGER)] || "
        "CASE WHEN event_id % 3 = 0 THEN ':8080' ELSE '' END || '/a/' || (event_id % 100) END"
    )
    source = "events"
    if addresses == "page":
        url = "url"
        source = "events JOIN pages ON page_id = event_id % (SELECT count(*) FROM pages)"
    known = {
        "GLOBALEVENTID": "CAST(event_id AS VARCHAR)",
        "SQLDATE": "strftime(ts, '%Y%m%d')",
        "Actor1Name": "CASE WHEN user_id % 5 <> 0 THEN upper(event_type) END",
        "Actor1Geo_FullName": "'NATION_' || (user_id % 25)",
        "Actor2Name": "'USER' || user_id",
        "Actor2Geo_FullName": "CASE WHEN event_id % 7 <> 0 THEN 'NATION_' || (event_id % 25) END",
        "IsRootEvent": "CAST(event_id % 2 AS VARCHAR)",
        "EventCode": "code",
        "EventBaseCode": "substr(code, 1, 3)",
        "EventRootCode": "substr(code, 1, 2)",
        "QuadClass": "CAST(1 + event_id % 4 AS VARCHAR)",
        "GoldsteinScale": "CAST(CAST(event_id % 201 - 100 AS DOUBLE) / 10 AS VARCHAR)",
        "NumMentions": "CAST(1 + user_id % 10 AS VARCHAR)",
        "NumSources": "CAST(1 + user_id % 3 AS VARCHAR)",
        "NumArticles": "CAST(1 + user_id % 7 AS VARCHAR)",
        "AvgTone": "CAST(CAST((user_id * 7) % 401 - 200 AS DOUBLE) / 20 AS VARCHAR)",
        "ActionGeo_Type": "CAST(event_id % 6 AS VARCHAR)",
        "ActionGeo_FullName": "'NATION_' || ((user_id + event_id) % 25)",
        "ActionGeo_CountryCode": "'N' || ((user_id + event_id) % 25)",
        "DATEADDED": "strftime(ts, '%Y%m%d')",
        "SOURCEURL": "address",
    }
    columns = ", ".join(f"{known.get(name, 'CAST(NULL AS VARCHAR)')} AS {name}" for name in dict.fromkeys([*_LARGE_COLUMNS, *known]))
    return f"""coded AS (
  SELECT *, {url} AS address,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '0211'
      ELSE lpad(CAST(1 + {k} % 20 AS VARCHAR), 2, '0') || (({k} // 20) * 2) END AS code
  FROM {source}
), raw AS (SELECT {columns} FROM coded)"""


def _lookups(fan_out: bool) -> str:
    """CTEs ``official``, ``manual`` and ``publishers``."""
    shift = "CASE WHEN length(domain) % 6 = 0 THEN 1 ELSE 0 END" if fan_out else "0"
    return f"""domains AS (SELECT DISTINCT {_domain('url')} AS domain FROM pages),
official AS (
  SELECT domain, n_name AS country_name FROM domains JOIN nation ON n_nationkey = length(domain) % 25
  WHERE length(domain) % 2 = 0),
manual AS (
  SELECT domain, n_name AS country_name FROM domains JOIN nation ON n_nationkey = (length(domain) + {shift}) % 25
  WHERE length(domain) % 3 = 0),
publishers AS (SELECT DISTINCT * FROM (SELECT * FROM official UNION ALL SELECT * FROM manual))"""


_ACTIONS = """rooted AS (
  SELECT *, lpad(CAST(1 + p_partkey % 20 AS VARCHAR), 2, '0') AS root FROM part
), based AS (SELECT *, root || ((p_partkey // 20) % 7) AS base FROM rooted),
entries AS (
  SELECT root AS code, upper(p_type) AS description, p_partkey FROM based
  UNION ALL SELECT base, p_name, p_partkey FROM based
  UNION ALL SELECT base || (1 + (p_partkey // 140) % 3), p_name || ' ' || p_brand, p_partkey FROM based
), actions AS (SELECT code, arg_max(description, p_partkey) AS description FROM entries GROUP BY code)"""

_SHORT = ", ".join(_SHORT_COLUMNS)


def _enriched(addresses: str, where: str = "TRUE") -> str:
    """CTE ``enriched``: the derived events with publisher and action columns."""
    return f"""{_raw(addresses)}, {_lookups(False)}, {_ACTIONS},
located AS (SELECT {_SHORT}, {_domain('SOURCEURL')} AS domain_name FROM raw WHERE {where}),
enriched AS (
  SELECT {_SHORT}, domain_name,
    coalesce(country_name, {_country('domain_name')}, 'Unknown') AS news_source_country,
    short.description AS Cameo, whole.description AS Cameo_full
  FROM located LEFT JOIN publishers ON domain_name = domain
  LEFT JOIN actions AS short ON short.code = regexp_extract(EventCode, '^[0-9]{{2}}')
  LEFT JOIN actions AS whole ON whole.code = EventCode)"""


def _pages_per_country(fan_out: bool) -> str:
    return f"""WITH {_lookups(fan_out)},
located AS (SELECT page_id, url AS SOURCEURL, {_domain('url')} AS domain_name FROM pages)
SELECT page_id, SOURCEURL, domain_name,
  coalesce(country_name, {_country('domain_name')}, 'Unknown') AS news_source_country
FROM located LEFT JOIN publishers ON domain_name = domain"""


def _summary(addresses: str) -> str:
    order = "ORDER BY GLOBALEVENTID"
    return f"""WITH {_enriched(addresses)}
SELECT SOURCEURL, min(SQLDATE) AS FirstEventDate, count(GLOBALEVENTID) AS EventCount,
  string_agg(GLOBALEVENTID, ';' {order}) AS EventIDs,
  round(avg(CAST(GoldsteinScale AS DOUBLE)) + 1e-9, 6) AS GoldsteinMean,
  round(avg(CAST(AvgTone AS DOUBLE)) + 1e-9, 6) AS AvgToneMean,
  coalesce(string_agg(Cameo_full, ';' {order}), '') AS EventDescriptions,
  string_agg(coalesce(Actor1Name, '-') || '|' || coalesce(Actor2Name, '-'), ';' {order}) AS ActorPairs,
  string_agg(coalesce(Actor1Geo_FullName, '-') || '|' || coalesce(Actor2Geo_FullName, '-'), ';' {order}) AS GeoPairs
FROM enriched GROUP BY SOURCEURL"""


_ARTICLE_SCALARS = f"""WITH {_enriched('label')}
SELECT SOURCEURL, min(SQLDATE) AS FirstEventDate, count(GLOBALEVENTID) AS EventCount,
  round(avg(CAST(GoldsteinScale AS DOUBLE)) + 1e-9, 6) AS GoldsteinMean,
  round(avg(CAST(AvgTone AS DOUBLE)) + 1e-9, 6) AS AvgToneMean,
  (SELECT count(*) FROM enriched)::BIGINT AS AllEvents
FROM enriched GROUP BY SOURCEURL"""


def _lists_together(bound: int) -> str:
    """All list columns of each article, sorted, with the number and the longest of its parts."""
    actors = "coalesce(Actor1Name, '-') || '|' || coalesce(Actor2Name, '-')"
    places = "coalesce(Actor1Geo_FullName, '-') || '|' || coalesce(Actor2Geo_FullName, '-')"
    lists = {"EventIDs": "GLOBALEVENTID", "EventDescriptions": "Cameo_full", "ActorPairs": actors, "GeoPairs": places}
    shown = ", ".join(f"coalesce(string_agg({v}, ';' ORDER BY {v}), '') AS {k}" for k, v in lists.items())
    return f"""WITH {_enriched('label')}
SELECT SOURCEURL, CAST(ceil(count(*) / {bound}) AS BIGINT) AS parts, least(count(*), {bound}) AS longest, {shown}
FROM enriched GROUP BY SOURCEURL"""


_MANIFEST = r"""sized AS (
  SELECT *, CAST(CAST(floor(o_totalprice) AS BIGINT) * 10000 + 1234 AS VARCHAR) AS size,
    strftime(o_orderdate, '%Y%m%d') AS day FROM orders
), listed AS (
  SELECT
    CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 53 <> 0 AND o_orderkey % 59 <> 0 AND o_orderkey % 61 = 0
      THEN NULL ELSE size END AS size,
    CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%Y%m') || '.zip'
      WHEN o_orderkey % 53 = 0 THEN day
      WHEN o_orderkey % 59 = 0 THEN '20241399.export.CSV.zip'
      ELSE day || '.export.CSV.zip' END AS FileName,
    o_orderkey % 7 <> 0 AND o_orderkey % 53 = 0 AS malformed, day
  FROM sized
), manifest AS (
  SELECT round(CAST(CAST(size AS FLOAT) AS DOUBLE) * 1e-6, 2) AS FileSizeMB, FileName,
    CAST(strptime(day, '%Y%m%d') AS DATE) AS Date, day
  FROM listed
  WHERE NOT malformed AND regexp_matches(FileName, '^[0-9]{8}\.') AND FileName NOT LIKE '20241399%'
)"""

_IN_RANGE = "Date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"

_TERMS_MATCH = """(
  contains(lower(coalesce({0}, '')), 'user1') OR contains(lower(coalesce({0}, '')), 'nation_3')
  OR contains(lower(coalesce({0}, '')), 'site7.'))"""


def _terms(*columns: str) -> str:
    return " OR ".join(_TERMS_MATCH.format(column) for column in columns)


_SEARCHED = (
    "Actor1Name", "Actor1Geo_FullName", "Actor2Name", "Actor2Geo_FullName",
    "ActionGeo_FullName", "ActionGeo_CountryCode", "SOURCEURL",
)


def _contains(columns: list[str], terms: list[str]) -> str:
    return " OR ".join(f"contains(lower(coalesce({c}, '')), '{t}')" for c in columns for t in terms)


def _found(*terms: str) -> str:
    """Whether an event has one of ``terms`` in a searched column."""
    return "(" + _contains(list(_SEARCHED), list(terms)) + ")"


def _loaded(where: str = "TRUE") -> str:
    """The stored table of a load: each event at the date of its archive."""
    return f"""WITH {_enriched('label', where)}
SELECT GLOBALEVENTID, SOURCEURL, news_source_country, SQLDATE AS day FROM enriched"""


_ENRICHED_COLUMNS = f"{_SHORT}, domain_name, news_source_country, Cameo, Cameo_full"
_EVENTS = f"WITH {_raw('label')} SELECT {_SHORT} FROM raw"
_MANIFEST_ROWS = f"WITH {_MANIFEST} SELECT coalesce(FileSizeMB, -1) AS FileSizeMB, FileName, strftime(Date, '%Y-%m-%d') AS Date FROM manifest"
_ENRICH_CODES = f"""WITH {_raw('label')}, {_ACTIONS}
SELECT GLOBALEVENTID, EventCode, short.description AS Cameo, whole.description AS Cameo_full FROM raw
LEFT JOIN actions AS short ON short.code = regexp_extract(EventCode, '^[0-9]{{2}}')
LEFT JOIN actions AS whole ON whole.code = EventCode"""

ORACLES: dict[str, str] = {
    "select_lenient": "SELECT source, doc_id, n_chars FROM documents",
    "select_none": "SELECT * FROM documents WHERE FALSE",
    "select_large": f"WITH {_raw('label')} SELECT {', '.join(_LARGE_COLUMNS)} FROM raw",
    "filter_terms_documents": f"""SELECT doc_id, lang, source, n_chars FROM documents
WHERE {_contains(['text', 'lang', 'source'], ['license', 'src3', 'the the'])}""",
    "filter_terms_pages": f"""SELECT page_id, url FROM pages
WHERE {_contains(['url', 'html'], ['example.net', 'cookie', '100%'])}""",
    "term_hits": f"""WITH {_raw('label')}
SELECT GLOBALEVENTID, {_terms('Actor2Name', 'ActionGeo_FullName', 'SOURCEURL')} AS hit FROM raw""",
    "domain_extract": f"SELECT page_id, {_domain('url')} AS domain_name FROM pages",
    "country_tld": f"""WITH {_raw('label')}, located AS (
  SELECT GLOBALEVENTID, {_domain('SOURCEURL')} AS domain_name FROM raw)
SELECT GLOBALEVENTID, domain_name, {_country('domain_name')} AS country FROM located""",
    "lookup_union_distinct": f"WITH {_lookups(True)} SELECT domain, country_name FROM publishers",
    "lookup_one_per_domain": f"""WITH {_lookups(True)}, ranked AS (
  SELECT *, 1 AS rank FROM official UNION ALL SELECT *, 0 AS rank FROM manual)
SELECT domain, country_name FROM ranked
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY rank, country_name) = 1""",
    "country_lookup": _pages_per_country(False),
    "lookup_fanout": _pages_per_country(True),
    "country_lookup_salted": _pages_per_country(True),
    "lookup_copies": f"""WITH {_raw('page')}, {_lookups(True)},
located AS (SELECT SOURCEURL, {_domain('SOURCEURL')} AS domain_name FROM raw)
SELECT SOURCEURL, domain_name, country_name FROM located LEFT JOIN publishers ON domain_name = domain""",
    "lookup_files": _pages_per_country(False),
    "action_dictionary": f"""WITH {_ACTIONS}
SELECT code, description FROM actions WHERE code <> '106' UNION ALL SELECT '106', 'Demand withdrawal'""",
    "action_enrich": _ENRICH_CODES,
    "action_enrich_salted": _ENRICH_CODES,
    "events_per_root": f"""WITH {_raw('label')}
SELECT regexp_extract(EventCode, '^[0-9]{{2}}') AS root, count(*) AS events FROM raw GROUP BY 1""",
    "article_summary": _summary("page"),
    "article_summary_labels": _summary("label"),
    "article_scalars": _ARTICLE_SCALARS,
    "article_scalars_merged": _ARTICLE_SCALARS,
    "article_lists_whole": _lists_together(50_000),
    "article_summary_split": _lists_together(10),
    "enrich_all": f"WITH {_enriched('page')} SELECT {_ENRICHED_COLUMNS} FROM enriched",
    "enrich_filtered": f"WITH {_enriched('label', _terms(*_SEARCHED))} SELECT {_ENRICHED_COLUMNS} FROM enriched",
    "events_per_country": f"""WITH {_enriched('label')}
SELECT news_source_country, Cameo, count(*) AS events FROM enriched GROUP BY 1, 2""",
    "manifest_parse": _MANIFEST_ROWS,
    "manifest_file": _MANIFEST_ROWS,
    "manifest_malformed": f"""WITH {_MANIFEST}
SELECT count(*) FILTER (WHERE malformed) AS rejected,
  count(*) FILTER (WHERE NOT malformed AND FileName LIKE '20241399%') AS undated,
  (SELECT count(*) FROM manifest WHERE FileSizeMB IS NULL) AS unsized FROM listed""",
    "manifest_range": f"""WITH {_MANIFEST}
SELECT FileName, count(*) AS files FROM manifest WHERE {_IN_RANGE} GROUP BY FileName""",
    "manifest_size": f"""WITH {_MANIFEST}
SELECT bool_or(Date = DATE '1996-01-01') AS start_exists, bool_or(Date = DATE '1997-12-31') AS end_exists,
  round(sum(FileSizeMB) FILTER ({_IN_RANGE}), 2) AS total_mb FROM manifest""",
    "manifest_ids": f"WITH {_MANIFEST} SELECT count(*) AS files, count(*) AS ids FROM manifest",
    "file_dates": f"""WITH {_MANIFEST}
SELECT CASE WHEN malformed THEN '' ELSE split_part(FileName, '.', 1) END AS stem,
  CASE WHEN regexp_matches(FileName, '^[0-9]{{8}}\\.') AND FileName NOT LIKE '20241399%'
    THEN strftime(strptime(day, '%Y%m%d'), '%Y-%m-%d') END AS day,
  count(*) AS files
FROM listed GROUP BY 1, 2""",
    "download_files": f"""WITH {_MANIFEST}
SELECT day AS date_str, day || '.export.CSV.zip' AS filename,
  'http://files.example.org/' || day || '.export.CSV.zip' AS file_url,
  '/landing/' || day || '.export.CSV.zip' AS local_filepath,
  coalesce(FileSizeMB, -1) AS FileSizeMB
FROM manifest WHERE {_IN_RANGE}""",
    "chunk_plan": """WITH bounds AS (SELECT min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events),
chunks AS (SELECT first, last, unnest(range(0, (last - first) // 4 + 1)) AS chunk FROM bounds)
SELECT chunk, strftime(first + CAST(chunk * 4 AS INTEGER), '%Y-%m-%d') AS chunk_start,
  strftime(least(first + CAST(chunk * 4 + 3 AS INTEGER), last), '%Y-%m-%d') AS chunk_end FROM chunks""",
    "status_summary": """SELECT CASE event_type WHEN 'error' THEN 'FAILED: Not Found'
  WHEN 'view' THEN 'SKIPPED: Empty File' ELSE 'SUCCESS' END AS download_status, count(*) AS count
FROM events GROUP BY 1""",
    "tsv_round_trip": _EVENTS,
    "latin1_round_trip": f"""WITH {_raw('label')}
SELECT GLOBALEVENTID, 'Café à ' || Actor1Geo_FullName AS Actor1Geo_FullName, SOURCEURL FROM raw""",
    "csv_round_trip": f"""WITH {_enriched('page')}
SELECT SOURCEURL, min(SQLDATE) AS FirstEventDate, count(*) AS EventCount,
  string_agg(GLOBALEVENTID, ';' ORDER BY GLOBALEVENTID) AS EventIDs,
  round(avg(CAST(GoldsteinScale AS DOUBLE)) + 1e-9, 6) AS GoldsteinMean,
  round(avg(CAST(AvgTone AS DOUBLE)) + 1e-9, 6) AS AvgToneMean,
  string_agg(Cameo_full, ';' ORDER BY GLOBALEVENTID) AS EventDescriptions,
  string_agg(coalesce(Actor1Name, '') || '|' || Actor2Name, ';' ORDER BY GLOBALEVENTID) AS ActorPairs,
  string_agg(coalesce(Actor1Geo_FullName, '') || '|' || coalesce(Actor2Geo_FullName, ''), ';' ORDER BY GLOBALEVENTID) AS GeoPairs
FROM enriched GROUP BY SOURCEURL""",
    "compaction": f"""WITH {_raw('label')}
SELECT GLOBALEVENTID, IsRootEvent, SOURCEURL, 2 - CAST(IsRootEvent AS BIGINT) AS copies, 1::BIGINT AS files FROM raw""",
    "compaction_by_date": f"""WITH {_raw('label')}
SELECT SQLDATE, SQLDATE AS day, count(*) AS events, count(DISTINCT GLOBALEVENTID) AS ids FROM raw GROUP BY SQLDATE""",
    "idempotent_load": _EVENTS,
    "archive_expand": _EVENTS,
    "archive_lines": "SELECT 'OK' AS status, count(*) AS lines FROM events",
    "archive_damaged": f"""WITH {_raw('label')}
SELECT SQLDATE AS day, count(*) AS events, 1::BIGINT AS dates FROM raw WHERE SQLDATE NOT LIKE '%5' GROUP BY SQLDATE""",
    "ingest_windows": _loaded(),
    "ingest_again_with_terms": _loaded(_found("user10 ", "user77")),
    "ingest_damaged": _loaded(f"SQLDATE LIKE '%5' OR {_found('user7')}"),
    "ingest_plain_files": _loaded(),
    "job_counts": """SELECT 'SUCCESS' AS download_status, count(DISTINCT CAST(ts AS DATE)) AS count, count(*) AS rows,
  count(DISTINCT CAST(ts AS DATE)) AS days FROM events""",
    "job_compacted": _loaded(),
    "job_compacted_twice": """WITH days AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1)
SELECT strftime(d, '%Y%m%d') AS day, n AS events, n AS events_now, d >= (SELECT max(d) FROM days) - 2 AS rewritten FROM days""",
    "fetch_again": f"""WITH {_MANIFEST}, days AS (SELECT DISTINCT day FROM manifest WHERE {_IN_RANGE})
SELECT CASE WHEN substr(day, 7, 2) IN ('13', '29') THEN 'SUCCESS' ELSE 'SKIPPED: Landed' END AS download_status, count(*) AS count
FROM days GROUP BY 1""",
    "event_rejects": """SELECT count(*) AS lines, count(*) FILTER (event_id % 10 = 3) AS too_short,
  count(*) FILTER (event_id % 10 = 7) AS too_long FROM events""",
    "filter_terms_many": """WITH numbers AS (SELECT unnest(range(0, 10000)) * 1187 AS n),
terms AS (SELECT string_agg(chr((97 + n // power(26, k)::BIGINT % 26)::INTEGER), '' ORDER BY k) AS term
  FROM numbers, range(0, 5) t(k) GROUP BY n),
grams AS (SELECT doc_id, source, unnest(list_distinct(list_transform(range(1, greatest(length(text) - 3, 1)), lambda i: lower(text)[i:i + 4]))) AS term
  FROM documents)
SELECT DISTINCT doc_id, source FROM grams JOIN terms USING (term)""",
    "job_empty_range": "SELECT count(*) AS events, 0::BIGINT AS files, 0::BIGINT AS rows FROM events",
    "fetch_status": f"""WITH {_MANIFEST}, days AS (SELECT DISTINCT day FROM manifest WHERE {_IN_RANGE}),
counted AS (SELECT CASE substr(day, 7, 2) WHEN '13' THEN 'FAILED: Not Found' WHEN '29' THEN 'FAILED: Timeout'
  WHEN '01' THEN 'SKIPPED: Empty File' ELSE 'SUCCESS' END AS download_status, count(*) AS count
FROM days GROUP BY 1)
SELECT *, CASE download_status WHEN 'SUCCESS' THEN count ELSE 0 END AS stored FROM counted""",
}
