"""SQL that gives the rows of the registered queries where SQL can express them."""

from __future__ import annotations

_OP4 = r"""
WITH lines AS (
    SELECT row_number() OVER () AS page, doc_id, coalesce(source, '') AS host, string_split(text, chr(10)) AS ls FROM documents
), single AS (
    SELECT page, host, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM lines
), boilerplate AS (
    SELECT host, trim(line, ' ' || chr(9) || chr(13)) AS line
    FROM single JOIN (SELECT host, count(*) AS host_pages FROM lines GROUP BY host) USING (host)
    WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
    GROUP BY host, trim(line, ' ' || chr(9) || chr(13)), host_pages
    HAVING count(DISTINCT page) >= 5 AND count(DISTINCT page) > 0.02 * host_pages
), marked AS (
    SELECT s.page, s.i, s.line, b.line IS NOT NULL AS dropped
    FROM single s LEFT JOIN boilerplate b ON b.host = s.host AND b.line = trim(s.line, ' ' || chr(9) || chr(13))
), cleaned AS (
    SELECT page, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '') AS kept
    FROM marked GROUP BY page
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM lines d LEFT JOIN cleaned USING (page)
"""

_OP8 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s, least(len(ws), 4) AS n
    FROM (SELECT *, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT x.a, x.b FROM (
        SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common
        FROM shingles p JOIN shingles q ON p.s = q.s AND p.n = q.n AND p.doc_id <> q.doc_id GROUP BY ALL
    ) x JOIN sizes sa ON sa.doc_id = x.a JOIN sizes sb ON sb.doc_id = x.b
    WHERE 100 * common >= 80 * (sa.n + sb.n - common)
), reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id)
    JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""

_OP9 = r"""
WITH w AS (
    SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), windows AS (
    SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), again AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), lined AS (
    SELECT *, list_filter(string_split(t, chr(10)), lambda x: NOT regexp_full_match(x, '[\x20\x09-\x0D]*')) AS ls FROM w
), figures AS (
    SELECT l.doc_id, l.host, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls) AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM lined l LEFT JOIN repeated r USING (doc_id)
), failures AS (
    SELECT *, unnest([
        {'rule': 1, 'failed': n_words < 50}, {'rule': 2, 'failed': 100 * n_repeat_words > 50 * n_words},
        {'rule': 3, 'failed': 100 * n_dup_lines > 30 * n_lines}, {'rule': 4, 'failed': 100 * n_symbols > 100 * n_words}
    ]) AS f FROM figures
), hosts AS (
    SELECT host, f.rule AS rule, count(*) AS n, count(*) FILTER (WHERE f.failed) AS k FROM failures GROUP BY ALL
), moments AS (
    SELECT rule, sum(k) / sum(n) AS mean, greatest(sum(k * k / n) / sum(n) - (sum(k) / sum(n)) ** 2, 0) AS spread
    FROM hosts GROUP BY rule
), prior AS (
    SELECT rule, mean, CASE WHEN spread > 1e-12 THEN least(greatest(mean * (1 - mean) / spread - 1, 1), 1000) ELSE 1000 END AS s
    FROM moments
), verdicts AS (
    SELECT host, max((k + mean * s) / (n + s)) <= 0.5 AS host_kept FROM hosts JOIN prior USING (rule) GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND host_kept AS kept, host_kept
FROM figures JOIN verdicts USING (host)
"""

_OP10 = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
    SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + 9], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
), lengths AS (
    SELECT DISTINCT n FROM windows
), places AS (
    SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS phrase
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths)
), matches AS (
    SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, phrase)
), hits AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM matches) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
    FROM (SELECT DISTINCT doc_id, item_id FROM matches) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_OP11 = r"""
WITH sized AS MATERIALIZED (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        ('0x' || md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, ''))[1:15])::BIGINT AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), ordered AS (
    SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, source) AS r FROM sources
), levels AS (
    SELECT r, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT
        / sum(weight) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS level FROM ordered
), chosen AS (
    SELECT coalesce(arg_min(level, r), 0) AS level FROM levels JOIN ordered USING (r) WHERE level * weight <= 3 * source_size AND source_size > 0
), targets AS (
    SELECT source, source_size, CASE WHEN level * weight > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE level * weight END AS target
    FROM sources, chosen
), wanted AS (
    SELECT *, least(round(target)::BIGINT, 3 * source_size) AS wanted FROM targets
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS whole,
        CASE WHEN source_size > 0 THEN wanted % source_size ELSE 0 END AS part FROM wanted
), places AS (
    SELECT source, place, sum(size)::BIGINT AS there FROM sized GROUP BY source, place
), running AS (
    SELECT *, sum(there) OVER (PARTITION BY source ORDER BY place)::BIGINT AS until FROM places
)
SELECT d.doc_id, d.size, p.source_size, p.target, (p.whole * d.size + CASE
        WHEN r.until <= p.part THEN d.size
        WHEN r.until - r.there < p.part THEN (p.part - r.until + r.there) * d.size // r.there ELSE 0 END)::BIGINT AS taken
FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
    JOIN running r ON r.source IS NOT DISTINCT FROM d.source AND r.place = d.place
"""


#: crc32 of a number's digits, bit by bit: a byte is taken in before every eighth step.
_OP12 = r"""
WITH RECURSIVE crc AS (
    SELECT conv_id, conv_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS r FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
    UNION ALL
    SELECT conv_id, s, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
    FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(r, ascii(s[k // 8 + 1])::BIGINT) ELSE r END AS x FROM crc WHERE k < 8 * length(s))
), ids AS MATERIALIZED (
    SELECT conv_id, xor(r, 4294967295) % 9 AS h, conv_id - conv_id % 5 AS base FROM crc WHERE k = 8 * length(s)
), turns AS MATERIALIZED (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(coalesce(role, '')), sha256(coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
    SELECT i.conv_id, 0 AS own, place, role, text FROM ids i JOIN turns t ON t.conv_id = i.base AND place <= h
    UNION ALL
    SELECT i.conv_id, 1, place, role, text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND place > h
), placed AS MATERIALIZED (
    SELECT conv_id, row_number() OVER w AS depth, text, list(sha256(sha256(role) || sha256(text))) OVER (w ROWS UNBOUNDED PRECEDING) AS path
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)
), begun AS MATERIALIZED (
    SELECT conv_id, depth, sha256(array_to_string(path, '')) AS node, CASE WHEN depth > 1 THEN sha256(array_to_string(path[:-2], '')) ELSE '' END AS parent,
        strlen(text) AS n_bytes FROM placed
    UNION ALL
    SELECT conv_id, 0, '', NULL, 0 FROM ids
), sizes AS (
    SELECT conv_id, max(depth) AS turns FROM begun GROUP BY conv_id
), nodes AS MATERIALIZED (
    SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = turns), '') AS ends
    FROM begun JOIN sizes USING (conv_id) GROUP BY node, depth
), kids AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), family AS MATERIALIZED (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (node)
), totals AS (
    SELECT m.node, count(*) FILTER (WHERE y.n_children = 0) AS n_leaves, sum((y.n_convs - 1) * y.n_bytes) AS saved_tokens
    FROM family y JOIN begun m ON m.conv_id = y.conv_id AND m.depth <= y.depth GROUP BY m.node
)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children, t.n_leaves,
    t.saved_tokens::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM family f JOIN totals t USING (node) LEFT JOIN nodes p ON p.node = f.parent
"""


def _clusters(k: int = 8, dims: int = 64, rounds: int = 10) -> str:
    """Lloyd's rounds written out, all distances in each; equally near centroids by number."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"""far{r} AS MATERIALIZED (
    SELECT rid, c, list_sum(list_transform(list_zip(x.v, y.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM kept x, centers{r} y
), near{r} AS MATERIALIZED (
    SELECT rid, c, d FROM far{r} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1
)"""
        )
        if r < rounds:
            steps.append(
                f"""means{r} AS (
    SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM near{r} JOIN flat USING (rid) GROUP BY c, i
), centers{r + 1} AS MATERIALIZED (
    SELECT c, coalesce(m.v, old.v) AS v FROM centers{r} old LEFT JOIN (
        SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM means{r} GROUP BY c
    ) m USING (c)
)"""
            )
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), flat AS MATERIALIZED (
    SELECT rid, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM kept
), centers0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM kept
    ORDER BY sha256('3:' || vec_id) LIMIT {k}
), {", ".join(steps)}
SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(y.v, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (rid) JOIN centers{rounds} y USING (c)
"""


ORACLES: dict[str, str] = {
    "op4_line_dedup": _OP4,
    "op8_minhash_near_dedup": _OP8,
    "op9_quality_rules": _OP9,
    "op10_decontamination": _OP10,
    "op11_source_mix": _OP11,
    "op12_prefix_trie": _OP12,
    "op13_centroid_clusters": _clusters(),
}
