"""Manifest lines and their validation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vocalake.adapters import oracle
from vocalake.functions.text import SPACE
from vocalake.operators import validation as V
from vocalake.registry import ORACLE_SQL, query
from vocalake.sources.manifest import canonicalise_columns, read_manifest, read_splits, read_text_lines
from vocalake.streaming import streams
from vocalake.tables import shared_path, spread



def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


_VALID = "coalesce(TRY(json_valid(raw)), false)"
_TYPE = "CASE json_type({}) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END"
_CLASS = f"CASE WHEN {_strip('raw')} = '' THEN 'blank' WHEN NOT {_VALID} THEN 'invalid_json' WHEN json_type(raw) = 'OBJECT' THEN 'object' ELSE concat('not_object(', {_TYPE.format('raw')}, ')') END"
_OBJECT = f"({_VALID} AND {_strip('raw')} <> '' AND json_type(raw) = 'OBJECT')"
_CHECKED = f"""WITH c0 AS (SELECT m.*, a.path, a.frames, a.sample_rate, a.readable, a.duration AS md, r.path AS rpath FROM manifest m LEFT JOIN media a ON m.audio = a.path LEFT JOIN (SELECT DISTINCT path FROM media) r ON m.ref_audio = r.path),
c1 AS (SELECT *, CASE WHEN path IS NULL THEN 'not_found' WHEN frames = 0 THEN 'zero_frames' WHEN sample_rate <> 16000 THEN 'sample_rate' WHEN NOT readable THEN 'unreadable' END AS media_error FROM c0),
checked AS (SELECT *, CASE WHEN media_error IS NULL THEN md END AS media_duration, CASE WHEN media_error IS NULL THEN CASE WHEN md < 0.3 THEN 'very_short' WHEN md > 30 THEN 'very_long' ELSE 'ok' END END AS band,
 {_strip("coalesce(text, '')")} = '' AS blank_text, CASE WHEN coalesce(ref_audio, '') = '' THEN NULL WHEN rpath IS NOT NULL THEN 'ok' ELSE 'missing' END AS ref, media_error IS NULL AS valid FROM c1),
found AS (SELECT sample_id, 'error' AS severity, 'media' AS category, 5 AS seq FROM checked WHERE media_error IS NOT NULL UNION ALL SELECT sample_id, 'warning', 'blank_text', 1 FROM checked WHERE blank_text
 UNION ALL SELECT sample_id, 'warning', band, 2 FROM checked WHERE band IN ('very_short', 'very_long') UNION ALL SELECT sample_id, 'warning', 'ref_missing', 3 FROM checked WHERE ref = 'missing')
"""
# The list of messages: of two categories five at most, and a last message for the others.
_LISTED = """, listed AS (SELECT sample_id, severity, category, seq, NULL::BIGINT AS more FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY sample_id) AS nth FROM found) WHERE nth <= 5 OR category NOT IN ('media', 'blank_text')
 UNION ALL SELECT NULL, severity, category, 100, count(*) - 5 FROM found WHERE category IN ('media', 'blank_text') GROUP BY severity, category HAVING count(*) > 5)
"""


def _written(lines):
    path = shared_path(lines.sparkSession)
    lines.repartitionByRange("line_no").sortWithinPartitions("line_no").select("raw").write.text(path)
    return path


@query("s1_read_manifest", "SELECT line_no, raw FROM raw_lines WHERE trim(raw) <> ''", "raw_lines")
def _(lines):
    return read_manifest(lines.sparkSession, _written(lines))


@query("s2_read_splits", "SELECT split, count(*) AS n, sum(length(text))::BIGINT AS chars FROM (SELECT 'train' AS split, text FROM documents UNION ALL SELECT 'validation', text FROM benchmark) GROUP BY split", "documents", "benchmark")
def _(train, val):
    return read_splits(train.select("text"), val.select("text")).groupBy("split").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("s3_canonicalise_columns", "SELECT sample_id, text, audio, ref_audio, 0 AS dataset_id FROM manifest", "manifest")
def _(m):
    raw = m.select("sample_id", F.col("text").alias("sentence"), F.col("audio").alias("wav"), F.col("ref_audio").alias("ref"))
    return canonicalise_columns(raw, {"text": "sentence", "audio": "wav", "ref_audio": "ref"})


@query("s4_read_text_lines", f"SELECT row_number() OVER (ORDER BY line_no) AS i, {_strip('raw')} AS text FROM raw_lines WHERE {_strip('raw')} <> ''", "raw_lines")
def _(lines):
    return read_text_lines(lines.sparkSession, _written(lines))


@query("p1_json_line_class", f"SELECT line_no, {_CLASS} AS class FROM raw_lines", "raw_lines")
def _(lines):
    return V.parsed(lines).select("line_no", "class")


@query("p2_required_keys", f"WITH o AS (SELECT line_no, CASE WHEN {_OBJECT} THEN raw END AS raw FROM raw_lines), k AS (SELECT line_no, CASE WHEN raw IS NULL THEN [] ELSE json_keys(raw) END AS keys FROM o) SELECT line_no, list_contains(keys, 'text') AS has_text, list_contains(keys, 'audio') AS has_audio FROM k", "raw_lines")
def _(lines):
    return V.parsed(lines).select("line_no", V.has_key("text").alias("has_text"), V.has_key("audio").alias("has_audio"))


@query("p3_text_present", f"WITH o AS (SELECT line_no, CASE WHEN {_OBJECT} THEN raw END AS raw FROM raw_lines) SELECT line_no, json_type(raw, '$.text') = 'VARCHAR' AND {_strip('''(raw->>'$.text')''')} <> '' AS text_present FROM o WHERE raw IS NOT NULL AND list_contains(json_keys(raw), 'text')", "raw_lines")
def _(lines):
    return V.parsed(lines).where(V.has_key("text")).select("line_no", F.coalesce(V.text_present(), F.lit(False)).alias("text_present"))


_PATH = "CASE json_type(raw, '$.audio') WHEN 'VARCHAR' THEN raw->>'$.audio' WHEN 'OBJECT' THEN coalesce(raw->>'$.audio.path', '') END"


@query("p4_path_or_struct", f"WITH o AS (SELECT line_no, CASE WHEN {_OBJECT} THEN raw END AS raw FROM raw_lines) SELECT line_no, {_PATH} AS path FROM o WHERE raw IS NOT NULL AND list_contains(json_keys(raw), 'audio')", "raw_lines")
def _(lines):
    return V.parsed(lines).where(V.has_key("audio")).select("line_no", V.media_path().alias("path"))


@query("p5_resolve_path", "SELECT sample_id, CASE WHEN p LIKE '/%' THEN p ELSE concat('/data/', p) END AS path FROM (SELECT sample_id, CASE WHEN sample_id % 3 = 0 THEN concat('/abs/', audio) ELSE audio END AS p FROM manifest)", "manifest")
def _(m):
    p = F.when(F.col("sample_id") % 3 == 0, F.concat(F.lit("/abs/"), "audio")).otherwise(F.col("audio"))
    return m.select("sample_id", V.resolve_path(p, "/data/").alias("path"))


@query("p6_media_error", _CHECKED + "SELECT sample_id, media_error FROM checked", "manifest", "media")
def _(m, a):
    return V.checked(m, a).select("sample_id", "media_error")


@query("p7_duration_band", _CHECKED + "SELECT band, count(*) AS n FROM checked WHERE media_error IS NULL GROUP BY band", "manifest", "media")
def _(m, a):
    return V.checked(m, a).where("media_error is null").groupBy("band").agg(F.count("*").alias("n"))


@query("p8_ref_check", _CHECKED + "SELECT sample_id, ref FROM checked WHERE ref IS NOT NULL", "manifest", "media")
def _(m, a):
    return V.checked(m, a).where("ref is not null").select("sample_id", "ref")


@query("p9_row_valid", _CHECKED + "SELECT sample_id, valid FROM checked", "manifest", "media")
def _(m, a):
    return V.checked(m, a).select("sample_id", "valid")


@query("p10_cap_samples", f"SELECT line_no, {_CLASS} AS class FROM raw_lines WHERE line_no <= 100", "raw_lines")
def _(lines):
    return V.parsed(V.cap_samples(lines, 100)).select("line_no", "class")


@query("j1_manifest_media_join", "SELECT sample_id, path, frames, sample_rate FROM manifest m LEFT JOIN media a ON m.audio = a.path", "manifest", "media")
def _(m, a):
    out = V.manifest_media_join(m, a)
    return out.select("sample_id", F.col("_m_path").alias("path"), F.col("_m_frames").alias("frames"), F.col("_m_sample_rate").alias("sample_rate"))


@query("j2_missing_media", "SELECT sample_id, audio FROM manifest WHERE audio NOT IN (SELECT path FROM media)", "manifest", "media")
def _(m, a):
    return V.missing_media(m, a).select("sample_id", "audio")


@query("j3_rows_with_ref", "SELECT sample_id, ref_audio FROM manifest WHERE ref_audio IN (SELECT path FROM media)", "manifest", "media")
def _(m, a):
    return V.rows_with_ref(m, a).select("sample_id", "ref_audio")


_OF = lambda table, severity: f"(SELECT count(*) FROM {table} WHERE severity = '{severity}')"
_SUMMARY = f"SELECT count(*) AS total, count(*) FILTER (valid) AS valid, count(*) FILTER (ref = 'ok') AS with_ref, {_OF('listed', 'error')} AS n_errors, {_OF('listed', 'warning')} AS n_warnings, {_OF('found', 'error')} AS found_errors, {_OF('found', 'warning')} AS found_warnings, {_OF('found', 'error')} = 0 AND count(*) FILTER (valid) > 0 AS is_valid FROM checked"


@query("a1_validation_summary", _CHECKED + _LISTED + _SUMMARY, "manifest", "media")
def _(m, a):
    return V.summary(V.checked(m, a))


@query("a2_findings_capped", _CHECKED + _LISTED + "SELECT sample_id, severity, category, more FROM listed", "manifest", "media")
def _(m, a):
    return V.findings_capped(V.findings(V.checked(m, a)))


_DURATIONS = "SELECT round(sum(media_duration) / 3600, 6) AS hours, round(min(media_duration), 6) AS min_duration, round(max(media_duration), 6) AS max_duration, round(avg(media_duration), 6) AS mean_duration, round(quantile_disc(media_duration, 0.5 ORDER BY media_duration DESC), 6) AS median_duration FROM checked WHERE media_error IS NULL".replace("quantile_disc(media_duration, 0.5 ORDER BY media_duration DESC)", "percentile_disc(0.5) WITHIN GROUP (ORDER BY media_duration DESC)")
_LENGTHS = "SELECT min(length(text))::INT AS min_length, max(length(text))::INT AS max_length, round(avg(length(text)), 6) AS mean_length FROM checked WHERE NOT blank_text"


@query("a3_duration_stats", _CHECKED + _DURATIONS, "manifest", "media")
def _(m, a):
    return V.duration_stats(V.checked(m, a))


@query("a4_text_length_stats", _CHECKED + _LENGTHS, "manifest", "media")
def _(m, a):
    return V.text_length_stats(V.checked(m, a))


_ITEMS = [("total", "s"), ("valid", "s"), ("with_ref", "s"), ("n_errors", "s"), ("n_warnings", "s"), ("found_errors", "s"), ("found_warnings", "s"), ("hours", "d"), ("min_duration", "d"), ("median_duration", "d"), ("max_duration", "d"), ("min_length", "t"), ("max_length", "t")]


@query("a5_validation_report", _CHECKED + _LISTED + f", s AS ({_SUMMARY}), d AS ({_DURATIONS}), t AS ({_LENGTHS}), x AS (" + " UNION ALL ".join(f"SELECT '{c}' AS item, {c}::DOUBLE AS value FROM {t}" for c, t in _ITEMS) + " UNION ALL SELECT 'passed', is_valid::INT::DOUBLE FROM s) SELECT item, round(value, 6) AS value FROM x WHERE value IS NOT NULL", "manifest", "media")
def _(m, a):
    return V.report(V.checked(m, a))


_TOP = ", placed AS (SELECT *, row_number() OVER (PARTITION BY severity ORDER BY sample_id NULLS LAST, seq) AS place, count(*) OVER (PARTITION BY severity) AS n, CASE severity WHEN 'error' THEN 20 ELSE 10 END AS shown FROM listed)\n"
_FULL = _LISTED + f", s AS ({_SUMMARY}), d AS ({_DURATIONS}), t AS ({_LENGTHS}), x AS (" + " UNION ALL ".join(f"SELECT '{c}' AS item, {c}::DOUBLE AS value FROM {t}" for c, t in [*_ITEMS, ("mean_duration", "d"), ("mean_length", "t")]) + " UNION ALL SELECT 'passed', is_valid::INT::DOUBLE FROM s)" + _TOP + "SELECT 'report' AS section, item, NULL::BIGINT AS sample_id, round(value, 6) AS value FROM x WHERE value IS NOT NULL UNION ALL SELECT severity, category, sample_id, more::DOUBLE FROM placed WHERE place <= shown UNION ALL SELECT DISTINCT severity, 'omitted', NULL::BIGINT, (n - shown)::DOUBLE FROM placed WHERE n > shown"


@query("a5_full_report", _CHECKED + _FULL, "manifest", "media")
def _(m, a):
    return V.full_report(V.checked(m, a))


@query("o1_top_findings", _CHECKED + _LISTED + _TOP + "SELECT sample_id, severity, category, more, NULL::BIGINT AS omitted FROM placed WHERE place <= shown UNION ALL SELECT DISTINCT NULL::BIGINT, severity, NULL, NULL::BIGINT, n - shown FROM placed WHERE n > shown", "manifest", "media")
def _(m, a):
    return V.top_findings(V.findings(V.checked(m, a)))


@query("st4_stream_validate", _CHECKED + "SELECT sample_id, media_error, band, blank_text, ref, valid FROM checked", "manifest", "media")
def _(m, a):
    out = streams.replayed(m, lambda rows: streams.stream_checked(rows, a), "sample_id")
    return out.select("sample_id", "media_error", "band", "blank_text", "ref", "valid")


# The same over the lines of a manifest, broken ones included. SQL of their own: each error is told from the raw line.
_LREF = _PATH.replace("$.audio", "$.ref_audio")
_LINES = f"""WITH l0 AS (SELECT line_no, {_CLASS} AS class, CASE WHEN {_OBJECT} THEN raw END AS raw FROM raw_lines WHERE {_strip("raw")} <> ''),
l1 AS (SELECT *, CASE WHEN raw IS NULL THEN [] ELSE json_keys(raw) END AS keys FROM l0),
l2 AS (SELECT line_no, class, raw, list_contains(keys, 'text') AS kt, list_contains(keys, 'audio') AS ka FROM l1),
l3 AS (SELECT line_no, class, kt, ka, kt AND ka AS whole, CASE WHEN kt AND ka AND json_type(raw, '$.text') = 'VARCHAR' THEN raw->>'$.text' END AS text, CASE WHEN kt AND ka THEN {_PATH} END AS audio, CASE WHEN kt AND ka THEN {_LREF} END AS ref_audio FROM l2),
c0 AS (SELECT l3.*, a.path, a.frames, a.sample_rate, a.readable, a.duration AS md, r.path AS rpath FROM l3 LEFT JOIN media a ON l3.audio = a.path LEFT JOIN (SELECT DISTINCT path FROM media) r ON l3.ref_audio = r.path),
c1 AS (SELECT *, CASE WHEN NOT whole OR coalesce(audio, '') = '' THEN NULL WHEN path IS NULL THEN 'not_found' WHEN frames = 0 THEN 'zero_frames' WHEN sample_rate <> 16000 THEN 'sample_rate' WHEN NOT readable THEN 'unreadable' END AS media_error FROM c0),
c2 AS (SELECT *, whole AND coalesce(audio, '') <> '' AND media_error IS NULL AS valid FROM c1),
checked AS (SELECT line_no AS sample_id, class, kt, ka, whole, audio, text, media_error, valid, CASE WHEN valid THEN md END AS media_duration, CASE WHEN valid THEN CASE WHEN md < 0.3 THEN 'very_short' WHEN md > 30 THEN 'very_long' ELSE 'ok' END END AS band,
 whole AND {_strip("coalesce(text, '')")} = '' AS blank_text, CASE WHEN coalesce(ref_audio, '') = '' THEN NULL WHEN rpath IS NOT NULL THEN 'ok' ELSE 'missing' END AS ref FROM c2),
found AS (SELECT sample_id, 'error' AS severity, 'invalid_json' AS category, 1 AS seq FROM checked WHERE class = 'invalid_json' UNION ALL SELECT sample_id, 'error', 'not_object', 2 FROM checked WHERE class LIKE 'not_object%'
 UNION ALL SELECT sample_id, 'error', 'missing_key', 3 FROM checked WHERE class = 'object' AND NOT kt UNION ALL SELECT sample_id, 'error', 'missing_key', 4 FROM checked WHERE class = 'object' AND NOT ka
 UNION ALL SELECT sample_id, 'error', 'invalid_path', 6 FROM checked WHERE whole AND coalesce(audio, '') = '' UNION ALL SELECT sample_id, 'error', 'media', 6 FROM checked WHERE media_error IS NOT NULL
 UNION ALL SELECT sample_id, 'warning', 'blank_text', 5 FROM checked WHERE blank_text UNION ALL SELECT sample_id, 'warning', band, 7 FROM checked WHERE band IN ('very_short', 'very_long') UNION ALL SELECT sample_id, 'warning', 'ref_missing', 8 FROM checked WHERE ref = 'missing')
"""
_OWN = len(oracle(_CHECKED))


def _over_lines(name: str) -> str:
    """What a query selects from `checked` and `found`, over lines."""
    return _LINES + ORACLE_SQL[name][_OWN:]


@query("p9_line_valid", _LINES + "SELECT sample_id, valid FROM checked", "raw_lines", "media")
def _(lines, a):
    return V.checked(spread(lines), a).select("sample_id", "valid")


@query("a1_line_summary", _over_lines("a1_validation_summary"), "raw_lines", "media")
def _(lines, a):
    return V.summary(V.checked(spread(lines), a))


@query("a2_line_findings_capped", _over_lines("a2_findings_capped"), "raw_lines", "media")
def _(lines, a):
    return V.findings_capped(V.findings(V.checked(spread(lines), a)))


@query("a5_line_report", _over_lines("a5_validation_report").replace("NOT blank_text", "text IS NOT NULL AND NOT blank_text"), "raw_lines", "media")
def _(lines, a):
    return V.report(V.checked(spread(lines), a))


@query("a5_line_full_report", _over_lines("a5_full_report").replace("NOT blank_text)", "text IS NOT NULL AND NOT blank_text)"), "raw_lines", "media")
def _(lines, a):
    return V.full_report(V.validate_manifest(spread(lines), a))


# Paths under a folder, and the first lines only.
_UNDER = _LINES.replace("LEFT JOIN media a ON l3.audio = a.path", "LEFT JOIN (SELECT concat('/data/', path) AS path, frames, sample_rate, readable, duration FROM media) a ON concat('/data/', l3.audio) = a.path").replace("raw_lines WHERE ", "raw_lines WHERE line_no <= 1000 AND ").replace("(SELECT DISTINCT path FROM media) r ON l3.ref_audio", "(SELECT DISTINCT concat('/data/', path) AS path FROM media) r ON concat('/data/', l3.ref_audio)")


@query("a1_manifest_summary", _UNDER + _LISTED + _SUMMARY, "raw_lines", "media")
def _(lines, a):
    return V.summary(V.validate_manifest(spread(lines), a.withColumn("path", F.concat(F.lit("/data/"), "path")), "/data", 1000))


@query("o1_line_top_findings", _over_lines("o1_top_findings"), "raw_lines", "media")
def _(lines, a):
    return V.top_findings(V.findings(V.checked(spread(lines), a)))


@query("st4_stream_validate_lines", _LINES + "SELECT sample_id, media_error, band, blank_text, ref, valid FROM checked", "raw_lines", "media")
def _(lines, a):
    """The lines as files of a folder, from which the stream numbers them; those of the files before are added afterwards."""
    spark, path = lines.sparkSession, _written(lines)
    out = streams.finished(streams.stream_validate(spark, path, a, settle=0)).withColumn("name", F.regexp_extract("file", "[^/]+$", 0))
    sizes = spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("n"))
    before = sizes.select("name", F.coalesce(F.sum("n").over(Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # a row per file
    return out.join(F.broadcast(before), "name").select((F.col("before") + F.col("sample_id")).alias("sample_id"), "media_error", "band", "blank_text", "ref", "valid")
