"""DuckDB SQL that gives the rows of those queries which SQL can express."""

from __future__ import annotations

from tillcast.llm import quality

_LEADS = ", ".join(f"lead(word, {k}) OVER p" for k in range(1, quality.WINDOW))


def quality_tables(source: str) -> str:
    """Common table expressions ending in ``verdicts``: a row ``r`` and the judgement of each row of ``source``."""
    values = " UNION ALL ".join(
        f"SELECT r, lang, source, '{m}' AS measure, CASE WHEN {of} > 0 THEN {part} * 100 // {of} ELSE 0 END AS v FROM counts WHERE n_words > 0"
        for m, (part, of) in quality.PER.items())
    widths = " ".join(f"WHEN '{m}' THEN {least}" for m, (least, _) in quality.MEASURES.items())
    two_sided = ", ".join(f"'{m}'" for m, (_, low) in quality.MEASURES.items() if low)
    return f"""
d AS (SELECT row_number() OVER () AS r, *, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM {source}),
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
grams AS (SELECT r, i, word, CASE WHEN lead(word, {quality.WINDOW - 1}) OVER p IS NOT NULL THEN concat_ws(' ', word, {_LEADS}) END AS gram
  FROM x WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i, word, CASE WHEN gram IS NOT NULL AND count(*) OVER (PARTITION BY r, gram) > 1 THEN 1 ELSE 0 END AS dup FROM grams),
cover AS (SELECT r, word, max(dup) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {quality.WINDOW - 1} PRECEDING AND CURRENT ROW) AS inside FROM twice),
per_words AS (SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars, sum(inside)::BIGINT AS n_repeat_words FROM cover GROUP BY r),
per_lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
counts AS (SELECT d.r, d.lang, d.source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    (length(t) - length(regexp_replace(t, '{quality.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN per_words USING (r) LEFT JOIN per_lines USING (r)),
vals AS ({values}),
sketch AS (SELECT lang, source, measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket FROM vals),
levels AS (SELECT 0 AS level, * FROM sketch UNION ALL SELECT 1, lang, NULL, measure, bucket FROM sketch UNION ALL SELECT 2, NULL, NULL, measure, bucket FROM sketch),
binned AS (SELECT level, lang, source, measure, bucket, count(*) AS n FROM levels GROUP BY ALL),
summed AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY level, lang, source, measure) AS docs FROM binned),
quarts AS (SELECT level, lang, source, measure, max(docs) AS docs, min(bucket) FILTER (below * 4 >= docs) AS q1, min(bucket) FILTER (below * 4 >= docs * 3) AS q3
  FROM summed GROUP BY ALL),
fences AS (SELECT *, {quality.FENCE} * greatest(q3 - q1, CASE measure {widths} END) AS width FROM quarts),
chosen AS (SELECT a.lang, a.source, a.measure,
    CASE WHEN a.docs >= {quality.FEW} THEN a.q3 + a.width WHEN b.docs >= {quality.FEW} THEN b.q3 + b.width ELSE c.q3 + c.width END AS high,
    CASE WHEN a.docs >= {quality.FEW} THEN a.q1 - a.width WHEN b.docs >= {quality.FEW} THEN b.q1 - b.width ELSE c.q1 - c.width END AS low
  FROM fences a LEFT JOIN fences b ON b.level = 1 AND b.lang IS NOT DISTINCT FROM a.lang AND b.measure = a.measure
  LEFT JOIN fences c ON c.level = 2 AND c.measure = a.measure WHERE a.level = 0),
outside AS (SELECT DISTINCT r FROM vals v JOIN chosen c ON v.lang IS NOT DISTINCT FROM c.lang AND v.source IS NOT DISTINCT FROM c.source AND v.measure = c.measure
  WHERE v > high OR (v < low AND v.measure IN ({two_sided}))),
verdicts AS (SELECT counts.*, (n_words < {quality.BASE_WORDS} OR 100 * n_repeat_words > {quality.BASE_REPEAT} * n_words) AS base_failed,
    NOT (n_words < {quality.BASE_WORDS} OR 100 * n_repeat_words > {quality.BASE_REPEAT} * n_words) AND r NOT IN (SELECT r FROM outside) AS kept FROM counts)"""


SQL = {
    "op8_quality_rules": f"""WITH {quality_tables('documents')}
SELECT d.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM verdicts JOIN d USING (r)""",
}
