"""DuckDB SQL for the operators that SQL can express, over the supplied tables."""

# Lines one edit apart, as a deletion neighbourhood over the distinct lines.
LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, CAST(unnest(range(0, len(parts))) AS INTEGER) AS line, unnest(parts) AS l
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), filled AS (
    SELECT * FROM lines WHERE regexp_matches(l, '[^ \t\n\x0b\f\r]')
), firsts AS (
    SELECT l, min((doc_id, line)) AS place FROM filled GROUP BY l
), variants AS (
    SELECT l, place, i, md5(substr(l, 1, i - 1) || chr(10) || substr(l, i + 1)) AS replaced, md5(substr(l, 1, i - 1) || substr(l, i + 1)) AS deleted
    FROM (SELECT l, place, unnest(range(1, length(l) + 1)) AS i FROM firsts WHERE length(l) >= 20)
), near AS (
    SELECT l FROM (SELECT l, place, min(place) OVER (PARTITION BY replaced) AS least FROM variants) WHERE least < place
    UNION SELECT v.l FROM variants v JOIN firsts f ON v.deleted = md5(f.l) WHERE f.place < v.place AND length(f.l) >= 20
    UNION SELECT f.l FROM variants v JOIN firsts f ON v.deleted = md5(f.l) WHERE v.place < f.place AND length(f.l) >= 20
), gone AS (
    SELECT doc_id, list_sort(list(line)) AS removed
    FROM filled JOIN firsts USING (l)
    WHERE (doc_id, line) <> place OR l IN (SELECT l FROM near)
    GROUP BY doc_id
)
SELECT d.doc_id, n_lines, CAST(len(coalesce(removed, [])) AS BIGINT) AS n_removed, array_to_string(coalesce(removed, []), ',') AS removed
FROM (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id) d LEFT JOIN gone USING (doc_id)
"""

# Every 50-byte window with the smallest document it starts in; texts are cut in pieces so that taking a window is cheap.
SUFFIX_DEDUP = """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), parts AS (
    SELECT doc_id, n, p, substr(x, 2 * p + 1, 2 * 561) AS y FROM (SELECT *, unnest(range(0, n, 512)) AS p FROM d WHERE n >= 50)
), windows AS (
    SELECT doc_id, p + o AS s, md5(substr(y, 2 * o + 1, 100)) AS k
    FROM (SELECT *, unnest(range(0, least(512, n - 49 - p))) AS o FROM parts)
), firsts AS (
    SELECT k, min(doc_id) AS f FROM windows GROUP BY k
), gone AS (
    SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before
    FROM windows JOIN firsts USING (k) WHERE f < doc_id
), runs AS (
    SELECT doc_id, min(s) AS a, max(s) + 50 AS b
    FROM (SELECT *, count(CASE WHEN before IS NULL OR s > before + 50 THEN 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM gone)
    GROUP BY doc_id, run
), cuts AS (
    SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, n, n FROM d
), kept AS (
    SELECT doc_id, string_agg(substr(x, 2 * since + 1, 2 * (a - since)), '' ORDER BY a, b) AS x
    FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS since FROM cuts) JOIN d USING (doc_id)
    GROUP BY doc_id
), removed AS (
    SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(kept.x)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""
