"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from contrail.llm.license_scan import _COPYRIGHT, _PUNCTUATION, KNOWN, KNOWN_DIGESTS, SPELLINGS

QUALITY_RULES = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
grams AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
named AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] || ' ' || ws[i + 4] AS g FROM grams),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM named),
spans AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM again WHERE c > 1),
rep AS (SELECT doc_id, sum(least(5, coalesce(nx - i, 5))) AS n FROM spans GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(t) - len(regexp_extract_all(t, '[\x20\x09-\x0D]')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(regexp_extract_all(t, '[A-Z]')) AS BIGINT) AS n_upper
      FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
f AS (SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (word_chars > 25 * n_words)::INT
        + 16 * (word_chars < n_words + n_words // 2)::INT + 32 * (100 * n_dup_lines > 30 * n_lines)::INT + 64 * (2 * n_upper > word_chars AND word_chars >= 40)::INT AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM f
"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _lines(x: str) -> str:
    out = f"regexp_replace(lower({x}), '{_COPYRIGHT}', '', 'g')"
    for a, b in SPELLINGS:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    return f"[trim(l) FOR l IN string_split(regexp_replace({out}, '{_PUNCTUATION}', ' ', 'g'), chr(10)) IF trim(l) <> '']"


def license_scan_sql() -> str:
    values = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in sorted(KNOWN.items()))
    digests = ", ".join(f"({_quoted(v)}, {_quoted(k)})" for k, v in sorted(KNOWN_DIGESTS.items()))
    return f"""
WITH texts AS (SELECT name, {_lines('t')} AS ls FROM (VALUES {values}) AS k(name, t)),
known AS (SELECT digest, min(license) AS license FROM (SELECT sha256(array_to_string(ls, ' ')) AS digest, name AS license FROM texts WHERE len(ls) > 0
          UNION ALL SELECT * FROM (VALUES {digests}) AS k(digest, license)) GROUP BY digest),
d AS (SELECT row_number() OVER () AS r, doc_id, {_lines("coalesce(text, '')")} AS ls FROM documents),
lines AS (SELECT DISTINCT r, unnest(ls) AS x FROM d),
hit AS (SELECT r, string_agg(DISTINCT known.license, ',' ORDER BY known.license) AS notices FROM lines JOIN known ON sha256(x) = known.digest GROUP BY r),
g AS (SELECT r, doc_id, CASE WHEN len(ls) > 0 THEN sha256(array_to_string(ls, ' ')) END AS digest FROM d)
SELECT g.doc_id, g.digest, known.license, coalesce(hit.notices, '') AS notices FROM g LEFT JOIN known USING (digest) LEFT JOIN hit USING (r)
"""
