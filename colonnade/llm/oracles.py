"""SQL (DuckDB) for the queries of operators that SQL can express, beside those that stand with their operators."""

from __future__ import annotations

from colonnade.llm.quality_rules import RULES, STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def quality_rules_sql() -> str:
    """Counts and verdicts, with the rules' thresholds."""
    cases = []
    for r in RULES:
        bad = [f"{r.count} < {r.low} * {r.per}"] * (r.low is not None) + [f"{r.count} > {r.high} * {r.per}"] * (r.high is not None)
        cases.append(f"WHEN {' OR '.join(bad)} THEN '{r.name}'")
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
runs AS (SELECT doc_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS run FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, unnest([0, 1, 2]) AS v(j) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS m FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_exclamations,
  CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words,
  CAST(coalesce(lines.n - lines.m, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines,
  CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CASE {' '.join(cases)} END AS rejected_by FROM c)
SELECT *, NOT base_failed AND rejected_by IS NULL AS kept FROM j"""


NGRAM_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, w[i:i + 4] AS gram FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
r AS (SELECT DISTINCT a AS node, a AS reached FROM l UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reached)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(least(d.doc_id, m.low), d.doc_id) AS component_id
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(reached) AS low FROM r GROUP BY node) m USING (doc_id)"""

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
r AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS run FROM d, unnest(range(1, len(w) - 48)) AS u(i)),
f AS (SELECT run, min(doc_id) AS first FROM r GROUP BY run HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT DISTINCT doc_id, i + j AS i FROM r JOIN f USING (run), unnest(range(0, 50)) AS v(j) WHERE first < doc_id),
k AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
e AS (SELECT d.doc_id, d.w, unnest(range(1, len(d.w) + 1)) AS i FROM d JOIN k USING (doc_id)),
t AS (SELECT e.doc_id, coalesce(string_agg(w[e.i], ' ' ORDER BY e.i) FILTER (g.i IS NULL), '') AS kept, count(g.i) AS gone FROM e LEFT JOIN g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(t.gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(t.kept, array_to_string(w, ' '))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)"""

ORACLES = {"op1_quality_rules": quality_rules_sql(), "op3_ngram_join": NGRAM_JOIN, "op9_substring_dedup": SUBSTRING_DEDUP}
