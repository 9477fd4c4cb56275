"""The queries of this subpackage and, where SQL can express them, their SQL (DuckDB's)."""

from __future__ import annotations

from vocalake.llm import byte_bpe, fill_middle, fm_quality, jaccard_join, lm_scoring, matroska, packing, quality_rules, resampling, run_length_index, token_counts, url_filter, weak_toxicity

QUERIES = {
    "op1_fm_quality": fm_quality.op1_fm_quality,
    "op2_packing": packing.op2_packing,
    "op3_byte_bpe": byte_bpe.op3_byte_bpe,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_weak_toxicity": weak_toxicity.op5_weak_toxicity,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_run_length_index": run_length_index.op7_run_length_index,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_lm_scoring": lm_scoring.op9_lm_scoring,
    "op10_matroska": matroska.op10_matroska,
    "lm_scoring_joined": lm_scoring.lm_scoring_joined,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_resampling": resampling.op12_resampling,
    "op13_token_counts": token_counts.op13_token_counts,
}

_JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(l) >= 3 THEN list_distinct(list_transform(range(1, len(l) - 1), lambda i: array_to_string(l[i:i + 2], ' '))) WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)), both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT r.doc_id, both_ways.b FROM r JOIN both_ways ON r.m = both_ways.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.m) AS component_id FROM documents d JOIN r ON d.doc_id = r.doc_id LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id
"""


def _quality() -> str:
    q = quality_rules
    ratio = {"symbols": "n_symbols / w", "long_words": "word_chars / w", "short_words": "-(word_chars / w)", "dup_lines": "n_dup_lines / greatest(n_lines, 1)", "repeats": "n_repeat_words / w"}
    level = lambda r: "CASE " + " ".join(f"WHEN {ratio[r]} > {c}::DOUBLE THEN {i}" for i, c in enumerate(q.RULES[r], 1)) + f" ELSE {len(q.RULES[r]) + 1} END"
    levels = "[" + ", ".join(f"{{'rule': '{r}', 'level': {level(r)}}}" for r in q.RULES) + "]"
    grid = " UNION ALL ".join(f"SELECT '{r}' AS rule, unnest(range(1, {len(g) + 1})) AS step" for r, g in q.RULES.items())
    p = q.LIMIT / len(q.RULES)
    tests = len(q.RULES) * (len(q.STRATA) + 1)
    crc = "xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
    return rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents), w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS l, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
x AS (SELECT doc_id, unnest(range(1, len(l) - 3)) AS i, unnest(list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' '))) AS g FROM w WHERE len(l) > 5),
y AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM x), z AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM y WHERE n > 1) GROUP BY doc_id),
c AS (SELECT w.doc_id, len(l) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
 coalesce(z.n, 0) AS n_repeat_words, CASE WHEN lang IN ('en', 'de', 'fr', 'es') THEN lang ELSE 'other' END AS stratum, greatest(len(l), 1) AS w FROM w LEFT JOIN z ON w.doc_id = z.doc_id),
d AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {levels} AS levels FROM c),
g AS (SELECT stratum, unnest(levels) AS v FROM d JOIN labels USING (doc_id) WHERE quality = 1 AND NOT base_failed AND {crc} % 5 <> 0),
h AS (SELECT stratum, v.rule AS rule, v.level AS level FROM g), steps AS (SELECT stratum, rule, step, count(*) AS n, count(*) FILTER (level <= step) AS k FROM h JOIN ({grid}) USING (rule) GROUP BY ALL),
tails AS (SELECT stratum, rule, step, CASE WHEN k >= n * {p} THEN 1 ELSE list_sum(list_transform(range(k + 1), lambda i: exp(lgamma(n + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - lgamma(n - i + 1) + i * ln({p}::DOUBLE) + (n - i) * ln({1 - p}::DOUBLE)))) END AS p FROM steps),
chosen AS (SELECT stratum, rule, coalesce(min(step) FILTER (p > {q.DELTA / tests}) - 1, max(step)) AS step FROM tails GROUP BY ALL),
fired AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, stratum, unnest(levels) AS v FROM d) f JOIN chosen ON f.stratum = chosen.stratum AND f.v.rule = chosen.rule WHERE f.v.level <= chosen.step)
SELECT d.doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fired.doc_id IS NULL AS kept FROM d LEFT JOIN fired ON d.doc_id = fired.doc_id
"""


ORACLE_SQL: dict[str, str] = {"op4_quality_rules": _quality(), "op8_jaccard_join": _JACCARD, "op9_lm_scoring": lm_scoring.SQL, "lm_scoring_joined": lm_scoring.SQL, "op11_fill_middle": fill_middle.SQL, "op12_resampling": resampling.SQL}
