"""Run bookkeeping: metric logs, losses, artefacts, resume points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalake.tables import in_blocks, numbered


def metric_line(split: Column, step: Column, values: Column, interval: Column | None = None) -> Column:
    """[split] step N: k: v, … of an array of struct<key, value>, sorted by key, with the log interval if there is one."""
    items = F.array_join(F.transform(F.array_sort(values), lambda x: F.concat(x["key"], F.lit(": "), F.format_string("%.6f", x["value"]))), ", ")
    line = F.concat(F.lit("["), split, F.lit("] step "), step.cast("string"), F.lit(": "), items)
    return line if interval is None else F.concat(line, F.when(interval.isNotNull(), F.concat(F.lit(", log interval: "), F.format_string("%.2fs", interval))).otherwise(""))


def parse_metric_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """split, step, key, value of such lines; values that aren't numbers, and the interval, are left out."""
    c, form = F.col(column), r"^\[([^\]]+)\] step (\d+): (.*)$"
    head = lines.where(c.rlike(form)).select(F.regexp_extract(c, form, 1).alias("split"), F.regexp_extract(c, form, 2).cast("bigint").alias("step"), F.explode(F.split(F.regexp_extract(c, form, 3), ", ")).alias("x"))
    return head.select("split", "step", F.regexp_extract("x", r"^(.*): ([^:]*)$", 1).alias("key"), F.regexp_extract("x", r"^(.*): ([^:]*)$", 2).try_cast("double").alias("value")).where("value is not null and key <> ''")


def weighted_loss(metrics: DataFrame, weights: DataFrame, accum: int) -> DataFrame:
    """step, loss: sum over keys that start with loss/ of value times weight (1 without one), over accumulation steps."""
    own = metrics.where(F.col("key").startswith("loss/")).join(weights, "key", "left")
    return own.groupBy("step").agg((F.sum(F.col("value") * F.coalesce("weight", F.lit(1.0))) / accum).alias("loss"))


def last_values(metrics: DataFrame) -> DataFrame:
    """step, key, value of the last micro step."""
    return metrics.groupBy("step", "key").agg(F.max_by("value", "micro_step").alias("value"))


def validation_means(metrics: DataFrame, most: int = 10) -> DataFrame:
    """key, value: mean of the first batches of each rank, then over ranks."""
    w = Window.partitionBy("rank", "key").orderBy("micro_step")
    first = metrics.where("split = 'val'").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most)
    return first.groupBy("rank", "key").agg(F.avg("value").alias("value")).groupBy("key").agg(F.avg("value").alias("value"))


def masked_mean(x: Column, mask: Column) -> Column:
    return F.sum(x * mask) / F.greatest(F.sum(mask), F.lit(1))


def epoch_progress(df: DataFrame, step: int, accum: int, batch: int, world: int) -> DataFrame:
    return df.agg((F.lit(float(step * accum * batch * world)) / F.greatest(F.count("*"), F.lit(1))).alias("epoch"))


def log_interval(log: DataFrame) -> DataFrame:
    """log (run, ts) with the seconds since the run's entry before."""
    rows, w = in_blocks(log, "run", "ts", "entry", before=1)
    last = F.when(F.lag("run").over(w).eqNullSafe(F.col("run")), F.lag("ts").over(w))
    rows = rows.withColumn("_last", last).where("_own")
    return rows.withColumn("seconds", F.col("ts").cast("timestamp").cast("double") - F.col("_last").cast("timestamp").cast("double")).select(*log.columns, "seconds")


def metrics_tail(metrics: DataFrame, n: int) -> DataFrame:
    """split, step, key, value of the last n steps of each split and key; Spark cuts each task's rows to n a key before they are shuffled."""
    w = Window.partitionBy("split", "key").orderBy(F.desc("step"))
    return metrics.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def loaded_keys(keys: DataFrame) -> DataFrame:
    """key: the target keys that are among the state keys."""
    return keys.select(F.col("target_key").alias("key")).join(keys.select(F.col("state_key").alias("key")), "key", "left_semi")


def skipped_keys(keys: DataFrame) -> DataFrame:
    """key: the target keys that are not."""
    return keys.select(F.col("target_key").alias("key")).join(keys.select(F.col("state_key").alias("key")), "key", "left_anti")


def key_reconcile(keys: DataFrame, targets: DataFrame) -> DataFrame:
    """target_key, matched (the state key that it loads, directly or without the wrapper's infix), loaded."""
    plain = F.replace("target_key", F.lit("._orig_mod."), F.lit("."))
    own = keys.select("state_key").distinct()
    out = targets.join(own.withColumnRenamed("state_key", "_d"), F.col("target_key") == F.col("_d"), "left").join(own.withColumnRenamed("state_key", "_s"), plain == F.col("_s"), "left")
    return out.select("target_key", F.coalesce("_d", "_s").alias("matched"), F.coalesce("_d", "_s").isNotNull().alias("loaded"))


def artifact_catalog(files: DataFrame, weights: str = "weights.safetensors", sidecar: str = "config.json") -> DataFrame:
    """id, base_model of the directories that hold weights, ids descending: Unknown where the sidecar lacks the key, null without a readable one."""
    dirs = files.where(F.col("name") == weights).select("dir").distinct()
    side = files.where(F.col("name") == sidecar).groupBy("dir").agg(F.min("body").alias("body"))
    model = F.when(F.try_parse_json("body").isNotNull(), F.coalesce(F.get_json_object("body", "$.base_model"), F.lit("Unknown")))
    return dirs.join(side, "dir", "left").select(F.col("dir").alias("id"), model.alias("base_model")).orderBy(F.desc("id"))


def catalogue_order(files: DataFrame, weights: str = "weights.safetensors", sidecar: str = "config.json") -> DataFrame:
    """The whole artifact catalogue: id, base_model and the position (from 0) in descending order of ids."""
    return numbered(artifact_catalog(files, weights, sidecar), F.desc("id"))


def resume_point(files: DataFrame) -> DataFrame:
    """run, step: 0 without `latest`, else its state's step, else the largest step directory, else 0."""
    run = F.regexp_extract("dir", r"^([^/]+)/", 1)
    latest, n = F.col("dir").endswith("/latest"), F.regexp_extract("dir", r"/step_(\d+)$", 1).try_cast("bigint")
    said = F.when(latest & (F.col("name") == "training_state.json"), F.get_json_object("body", "$.step").try_cast("bigint"))
    out = files.groupBy(run.alias("run")).agg(F.max(latest).alias("has"), F.max(said).alias("said"), F.max(n).alias("n"))
    return out.select("run", F.when(F.col("has"), F.coalesce("said", "n", F.lit(0).cast("bigint"))).otherwise(0).alias("step"))


def latest_step(files: DataFrame) -> DataFrame:
    return files.groupBy(F.regexp_extract("dir", r"^([^/]+)/", 1).alias("run")).agg(F.max(F.regexp_extract("dir", r"/step_(\d+)$", 1).try_cast("bigint")).alias("step")).where("step is not null")
