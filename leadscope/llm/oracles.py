"""DuckDB SQL of the operators that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_sql(text: str) -> str:
    """List of the words of ``text``: A-Z lower-cased, runs without ASCII other than letters and digits."""
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def hits_sql(documents: str) -> str:
    """CTEs up to ``hits`` (doc_id, s, n, win) and ``item_windows`` (item_id, win, n)."""
    return f"""
doc_words AS (SELECT doc_id, {words_sql('text')} AS w FROM {documents}),
item_words AS (SELECT item_id, {words_sql('text')} AS w FROM benchmark),
item_starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item_words WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS win, least(len(w), 10) AS n FROM item_starts),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_starts AS (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS s FROM doc_words, lengths),
doc_windows AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM doc_starts),
hits AS (SELECT DISTINCT d.doc_id, d.s, d.n, d.win FROM doc_windows d
         JOIN (SELECT DISTINCT win, n FROM item_windows) i ON d.win = i.win AND d.n = i.n)"""


DECONTAMINATION = f"""
WITH {hits_sql('documents')},
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT h.doc_id, CAST(i.item_id AS VARCHAR) AS item FROM hits h
                JOIN item_windows i ON i.win = h.win AND i.n = h.n) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN named m ON m.doc_id = d.doc_id
"""

LINES = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM texts),
keyed AS (SELECT r, doc_id, line, i, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                               '{_UPPER}', '{_LOWER}') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON c.key = k.key GROUP BY k.r, k.doc_id
"""

ORACLES: dict[str, str] = {
    "op4_decontamination": DECONTAMINATION,
    "op13_line_dedup": LINES,
}
