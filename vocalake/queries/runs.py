"""Metric logs, losses, keys and artefacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vocalake.operators import runs as R
from vocalake.registry import query
from vocalake.sources.listing import artifact_files
from vocalake.sources.sidecars import by_parts_of_tree
from vocalake.streaming import streams
from vocalake.tables import shared_path


@query("s8_metrics_log", "SELECT split, micro_step AS step, key, round(value, 6) AS value FROM metrics UNION ALL SELECT split, micro_step, 'n', 1e0 FROM metrics", "metrics")
def _(m):
    items = F.array(F.struct("key", "value"), F.struct(F.lit("n").alias("key"), F.lit(1.0).alias("value")))
    lines = m.select(R.metric_line(F.col("split"), F.col("micro_step"), items, F.when(F.col("micro_step") % 2 == 0, F.lit(1.5))).alias("value"))
    return R.parse_metric_lines(lines)


_CAT = """d AS (SELECT DISTINCT dir FROM files WHERE name = 'weights.safetensors'), c AS (SELECT dir, min(body) AS body FROM files WHERE name = 'config.json' GROUP BY dir)
SELECT d.dir AS id, CASE WHEN body IS NOT NULL THEN coalesce(body->>'$.base_model', 'Unknown') END AS base_model FROM d LEFT JOIN c ON d.dir = c.dir"""


@query("s9_artifact_catalog", f"WITH {_CAT}", "files")
def _(f):
    return R.artifact_catalog(f)


@query("o2_catalogue_order", f"WITH x AS (WITH {_CAT}) SELECT id, base_model FROM x", "files")
def _(f):
    return R.artifact_catalog(f)


# The whole catalogue, with each row's place in the order.
@query("o2_catalogue_positions", f"WITH x AS (WITH {_CAT}) SELECT id, base_model, row_number() OVER (ORDER BY id DESC) - 1 AS position FROM x", "files")
def _(f):
    return R.catalogue_order(f)


# The same from a real tree: the files are written under their names, then listed by levels and read, and removed, part by part. Of rows that are one file, the last body counts.
_TREE = "tree AS (SELECT dir, name, max(coalesce(body, '')) AS body FROM files GROUP BY dir, name)"


def _tree(f):
    files = f.select(F.concat_ws("/", "dir", "name").alias("name"), F.coalesce("body", F.lit("")).alias("payload"))
    return by_parts_of_tree(files, lambda path: artifact_files(f.sparkSession, path).where("dir <> ''"))


@query("s9_listed_catalog", f"WITH {_TREE}, {_CAT.replace('FROM files', 'FROM tree')}", "files")
def _(f):
    return R.artifact_catalog(_tree(f))


_RUN = "regexp_extract(dir, '^([^/]+)/', 1)"
_N = r"TRY_CAST(regexp_extract(dir, '/step_(\d+)$', 1) AS BIGINT)"


@query("s10_resume_point", f"SELECT {_RUN} AS run, CASE WHEN bool_or(dir LIKE '%/latest') THEN coalesce(max(CASE WHEN dir LIKE '%/latest' AND name = 'training_state.json' THEN TRY_CAST(body->>'$.step' AS BIGINT) END), max({_N}), 0) ELSE 0 END AS step FROM files GROUP BY ALL", "files")
def _(f):
    return R.resume_point(f)


@query("s10_listed_resume_point", f"WITH {_TREE} SELECT {_RUN} AS run, CASE WHEN bool_or(dir LIKE '%/latest') THEN coalesce(max(CASE WHEN dir LIKE '%/latest' AND name = 'training_state.json' THEN TRY_CAST(body->>'$.step' AS BIGINT) END), max({_N}), 0) ELSE 0 END AS step FROM tree GROUP BY ALL", "files")
def _(f):
    return R.resume_point(_tree(f).where("dir like '%/%'"))


@query("o4_latest_step", f"SELECT {_RUN} AS run, max({_N}) AS step FROM files GROUP BY ALL HAVING max({_N}) IS NOT NULL", "files")
def _(f):
    return R.latest_step(f)


@query("a8_weighted_loss", "SELECT step, round(sum(value * CASE WHEN key = 'loss/view' THEN 0.5 ELSE 1 END) / 4, 6) AS loss FROM metrics WHERE key LIKE 'loss/%' GROUP BY step", "metrics")
def _(m):
    weights = m.select("key").distinct().where("key = 'loss/view'").withColumn("weight", F.lit(0.5))
    return R.weighted_loss(m, weights, 4).withColumn("loss", F.round("loss", 6))


@query("a8_last_values", "SELECT step, key, max_by(value, micro_step) AS value FROM metrics GROUP BY step, key", "metrics")
def _(m):
    return R.last_values(m)


@query("a9_validation_means", """WITH r AS (SELECT rank, key, value, row_number() OVER (PARTITION BY rank, key ORDER BY micro_step) AS k FROM metrics WHERE split = 'val'), p AS (SELECT rank, key, avg(value) AS v FROM r WHERE k <= 10 GROUP BY ALL)
SELECT key, round(avg(v), 6) AS value FROM p GROUP BY key""", "metrics")
def _(m):
    return R.validation_means(m).withColumn("value", F.round("value", 6))


@query("a10_masked_mean", "SELECT rank, round(sum(value * (micro_step % 2)) / greatest(sum(micro_step % 2), 1), 6) AS mean FROM metrics GROUP BY rank", "metrics")
def _(m):
    return m.groupBy("rank").agg(F.round(R.masked_mean(F.col("value"), F.col("micro_step") % 2), 6).alias("mean"))


@query("a11_epoch_progress", "SELECT round(100 * 8 * 2 * 4 / greatest(count(*), 1)::DOUBLE, 6) AS epoch FROM documents", "documents")
def _(d):
    return R.epoch_progress(d, 100, 8, 2, 4).withColumn("epoch", F.round("epoch", 6))


@query("w7_log_interval", "SELECT rank AS run, micro_step AS entry, round(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY rank ORDER BY ts, micro_step)), 3) AS seconds FROM metrics", "metrics")
def _(m):
    return R.log_interval(m.select(F.col("rank").alias("run"), F.col("micro_step").alias("entry"), "ts")).select("run", "entry", F.round("seconds", 3).alias("seconds"))


@query("j6_key_reconcile", """WITH k AS (SELECT DISTINCT state_key FROM param_keys) SELECT target_key, coalesce(a.state_key, b.state_key) AS matched, coalesce(a.state_key, b.state_key) IS NOT NULL AS loaded
FROM param_keys t LEFT JOIN k a ON t.target_key = a.state_key LEFT JOIN k b ON replace(t.target_key, '._orig_mod.', '.') = b.state_key""".replace("FROM param_keys t", "FROM (SELECT target_key FROM param_keys) t"), "param_keys")
def _(k):
    return R.key_reconcile(k, k.select("target_key"))


@query("st3_stream_metrics_tail", "SELECT split, micro_step AS step, key, round(value, 6) AS value FROM metrics", "metrics")
def _(m):
    path = shared_path(m.sparkSession)
    m.select(R.metric_line(F.col("split"), F.col("micro_step"), F.array(F.struct("key", "value")))).write.text(path)
    return streams.finished(streams.stream_metrics(m.sparkSession, path))


@query("st3_metrics_tail", "SELECT split, step, key, value FROM (SELECT split, micro_step AS step, key, round(value, 6) AS value, row_number() OVER (PARTITION BY split, key ORDER BY micro_step DESC) AS k FROM metrics) WHERE k <= 20", "metrics")
def _(m):
    path = shared_path(m.sparkSession)
    m.select(R.metric_line(F.col("split"), F.col("micro_step"), F.array(F.struct("key", "value")))).write.text(path)
    tails = streams.stream_metrics_tail(streams.stream_metrics(m.sparkSession, path, 1), 20)
    return streams.latest_tail(streams.finished(tails))
