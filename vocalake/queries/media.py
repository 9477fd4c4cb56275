"""Signals, media files and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from vocalake.operators import signal as S
from vocalake.registry import query
from vocalake.sources.media import media_catalog, read_media_catalog, wav_bytes
from vocalake.sources.sidecars import by_parts_of_tree
from vocalake.streaming import streams
from vocalake.tables import stored


def _r(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("a13_peak_rms", "SELECT clip_id, round(max(abs(value)), 6) AS peak, round(sqrt(avg(value * value)), 6) AS rms FROM signal GROUP BY clip_id", "signal")
def _(s):
    return _r(S.peak_rms(s), "peak", "rms")


@query("g1_mixdown", "SELECT clip_id, idx // 2 AS idx, round(avg(value), 9) AS value FROM signal GROUP BY ALL", "signal")
def _(s):
    return S.mixdown(s.withColumn("idx", F.floor(F.col("idx") / 2))).withColumn("value", F.round("value", 9))


_PEAK = "SELECT s.clip_id, idx, round(CASE WHEN p > 0 THEN value / p * 0.9 ELSE value END, 6) AS value FROM signal s JOIN (SELECT clip_id, max(abs(value)) AS p FROM signal GROUP BY clip_id) m ON s.clip_id = m.clip_id"


@query("g2_peak_normalize", _PEAK, "signal")
def _(s):
    return _r(S.peak_normalize(s), "value").select("clip_id", "idx", "value")


@query("g3_apply_gain", "SELECT s.clip_id, idx, round(CASE WHEN m > 0 THEN value * pow(10, (-20 - 10 * log10(m)) / 20) ELSE value END, 6) AS value FROM signal s JOIN (SELECT clip_id, avg(value * value) AS m FROM signal GROUP BY clip_id) l ON s.clip_id = l.clip_id".replace("log10(m)", "log10(nullif(m, 0))"), "signal")
def _(s):
    return _r(S.apply_gain(s), "value").select("clip_id", "idx", "value")


@query("g4_chunk_signal", "SELECT clip_id, idx // 16 AS patch, count(*) AS samples, round(sum(value), 6) AS total FROM signal GROUP BY ALL", "signal")
def _(s):
    return _r(S.chunk_signal(s, 16), "total")


@query("g5_drop_context", "SELECT clip_id, idx, value FROM signal WHERE idx >= 24", "signal")
def _(s):
    return S.drop_context(s, 8, 3).select("clip_id", "idx", "value")


_ENERGY = """e0 AS (SELECT clip_id, idx, value, unnest(range(greatest(0, ceil((idx - 15) / 4e0))::BIGINT, idx // 4 + 1)) AS frame FROM signal), energy AS (SELECT clip_id, frame, sqrt(avg(value * value)) AS energy FROM e0 GROUP BY ALL HAVING count(*) = 16)"""


@query("w8_frame_energy", f"WITH {_ENERGY} SELECT clip_id, frame, round(energy, 6) AS energy FROM energy", "signal")
def _(s):
    return _r(S.frame_energy(s, 16, 4), "energy")


@query("w9_silence_trim", f"""WITH {_ENERGY}, z AS (SELECT clip_id, max(idx) + 1 AS n, max(abs(value)) AS p FROM signal GROUP BY clip_id),
v AS (SELECT e.clip_id, greatest(0, min(frame) * 4 - 2) AS a, least(max(n), least(max(n), (max(frame) + 1) * 4 + 12) + 2) AS b FROM energy e JOIN z ON e.clip_id = z.clip_id WHERE energy >= p * pow(10, -3 / 20e0) AND p > 0 GROUP BY e.clip_id)
SELECT s.clip_id, idx, value FROM signal s LEFT JOIN v ON s.clip_id = v.clip_id WHERE a IS NULL OR (idx >= a AND idx < b)""", "signal")
def _(s):
    return S.silence_trim(s, 10, 200, 3.0, 16, 4).select("clip_id", "idx", "value")


@query("w6_context_tail", "SELECT clip_id, idx, array_to_string(list_transform(list(value) OVER (PARTITION BY clip_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), lambda x: (round(x * 1000))::BIGINT::VARCHAR), ',') AS context FROM signal", "signal")
def _(s):
    return S.context_tail(s, 4).select("clip_id", "idx", F.array_join(F.transform("context", lambda x: F.round(x * 1000).cast("bigint").cast("string")), ",").alias("context"))


def _timed(s):
    """Items with the time at which they are heard, 16 a second; written once, as each batch of a replay reads them."""
    s = stored(s.select("clip_id", "idx", "value"))
    return s.select("clip_id", "idx", F.timestamp_micros((F.col("idx") * 62500).cast("bigint") + 1_000_000).alias("ts"), "value")


@query("st1_stream_context_tail", "SELECT clip_id, idx, array_to_string(list_transform(list(value) OVER (PARTITION BY clip_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), lambda x: (round(x * 1000))::BIGINT::VARCHAR), ',') AS context FROM signal", "signal")
def _(s):
    out = streams.replayed(_timed(s), lambda x: streams.stream_context_tail(x, 4), event_time="ts")
    return out.select("clip_id", "idx", F.array_join(F.transform("context", lambda x: F.round(x * 1000).cast("bigint").cast("string")), ",").alias("context"))


_CAUSAL = "SELECT clip_id, idx, round(coalesce(lag(value, 2) OVER w, 0) * 0.2 + coalesce(lag(value, 1) OVER w, 0) * 0.3 + value * 0.5, 9) AS value FROM signal WINDOW w AS (PARTITION BY clip_id ORDER BY idx)"


@query("st2_causal_window", _CAUSAL, "signal")
def _(s):
    return S.causal_window(s, [0.2, 0.3, 0.5]).withColumn("value", F.round("value", 9))


@query("st2_stream_causal_window", _CAUSAL, "signal")
def _(s):
    out = streams.replayed(_timed(s), lambda x: streams.stream_causal_window(x, [0.2, 0.3, 0.5]), event_time="ts")
    return out.withColumn("value", F.round("value", 9))


# A silent clip for each document.
_CLIPS = "SELECT concat('c', doc_id::VARCHAR) AS clip, (n_chars % 400)::BIGINT AS frames, CASE WHEN doc_id % 2 = 0 THEN 16000 ELSE 8000 END AS sample_rate, round((n_chars % 400) / (CASE WHEN doc_id % 2 = 0 THEN 16e3 ELSE 8e3 END), 6) AS duration, 44 + 2 * (n_chars % 400)::BIGINT AS bytes FROM documents"


def _clips(d):
    return d.select(F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("path"), wav_bytes(F.col("n_chars") % 400, F.when(F.col("doc_id") % 2 == 0, 16000).otherwise(8000)).alias("content"))


@query("s5_media_catalog", _CLIPS, "documents")
def _(d):
    out = media_catalog(_clips(d))
    return out.select(F.col("path").alias("clip"), "frames", "sample_rate", F.round("duration", 6).alias("duration"), "bytes")


@query("s5_listed_media", _CLIPS, "documents")
def _(d):
    """The clips as files in a tree, which is listed, and of which headers are read, part by part."""
    place = F.concat(F.substring(F.md5("path"), 1, 1), F.lit("/"), F.col("path"), F.lit(".wav"))
    files = _clips(d).select(place.alias("name"), F.col("content").alias("payload"))
    out = by_parts_of_tree(files, lambda path: read_media_catalog(d.sparkSession, path, "*.wav"))
    return out.select(F.regexp_extract("path", r"([^/]+)\.wav$", 1).alias("clip"), "frames", "sample_rate", F.round("duration", 6).alias("duration"), "bytes")
