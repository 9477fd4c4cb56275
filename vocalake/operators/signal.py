"""Long-form signals as rows (clip_id, channel, idx, value): no clip has to fit in a row or a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalake.tables import in_blocks


def mixdown(signal: DataFrame) -> DataFrame:
    return signal.groupBy("clip_id", "idx").agg(F.avg("value").alias("value"))


def peak_rms(signal: DataFrame) -> DataFrame:
    return signal.groupBy("clip_id").agg(F.max(F.abs("value")).alias("peak"), F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms"))


def peak_normalize(signal: DataFrame, peak: float = 0.9) -> DataFrame:
    """A join with one aggregated row per clip, not a window, so that a long clip isn't one task's."""
    top = signal.groupBy("clip_id").agg(F.max(F.abs("value")).alias("_p"))
    return signal.join(top, "clip_id").withColumn("value", F.when(F.col("_p") > 0, F.col("value") / F.col("_p") * peak).otherwise(F.col("value"))).drop("_p")


def apply_gain(signal: DataFrame, target_db: float = -20.0) -> DataFrame:
    """To an RMS level; silence stays."""
    level = signal.groupBy("clip_id").agg(F.avg(F.col("value") * F.col("value")).alias("_m"))
    gain = F.when(F.col("_m") > 0, F.pow(F.lit(10.0), (F.lit(target_db) - 10 * F.log10("_m")) / 20)).otherwise(1.0)
    return signal.join(level, "clip_id").withColumn("value", F.col("value") * gain).drop("_m")


def chunk_signal(signal: DataFrame, patch: int) -> DataFrame:
    return signal.groupBy("clip_id", F.floor(F.col("idx") / patch).alias("patch")).agg(F.count("*").alias("samples"), F.sum("value").alias("total"))


def drop_context(signal: DataFrame, patch: int, context: int) -> DataFrame:
    return signal.where(F.col("idx") >= patch * context)


def frame_energy(signal: DataFrame, frame: int = 2048, hop: int = 512) -> DataFrame:
    """clip_id, frame, energy (RMS) of the full frames: a sample is sent to the few frames that hold it."""
    last = F.floor(F.col("idx") / hop)
    first = F.greatest(F.lit(0), F.ceil((F.col("idx") - frame + 1) / hop))
    each = signal.select("clip_id", "value", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("frame"))
    out = each.groupBy("clip_id", "frame").agg(F.count("*").alias("_n"), F.avg(F.col("value") * F.col("value")).alias("_e"))
    return out.where(F.col("_n") == frame).select("clip_id", "frame", F.sqrt("_e").alias("energy"))


def silence_trim(signal: DataFrame, rate: int, max_silence_ms: int = 200, top_db: float = 35.0, frame: int = 2048, hop: int = 512) -> DataFrame:
    """Samples from the first to the last voiced frame, and a margin; a clip that is all zero, or shorter than a frame, stays."""
    size = signal.groupBy("clip_id").agg((F.max("idx") + 1).alias("_size"), F.max(F.abs("value")).alias("_peak"))
    voiced = frame_energy(signal, frame, hop).join(size, "clip_id").where(F.col("energy") >= F.col("_peak") * 10 ** (-top_db / 20)).where("_peak > 0")
    margin = rate * max_silence_ms // 1000
    ends = voiced.groupBy("clip_id").agg(F.greatest(F.lit(0), F.min("frame") * hop - margin).alias("_a"), F.least(F.max("_size"), F.least(F.max("_size"), (F.max("frame") + 1) * hop + (frame - hop)) + margin).alias("_b"))
    return signal.join(ends, "clip_id", "left").where("_a is null or (idx >= _a and idx < _b)").drop("_a", "_b")


def context_tail(signal: DataFrame, k: int) -> DataFrame:
    """Each item with those before it, the last k in all."""
    rows, w = in_blocks(signal.select("clip_id", "idx", "value"), "clip_id", "idx", before=k - 1)
    rows = rows.withColumn("_x", F.collect_list(F.struct("clip_id", "value")).over(w.rowsBetween(-(k - 1), 0))).where("_own")
    return rows.select("clip_id", "idx", F.transform(F.filter("_x", lambda x: x["clip_id"].eqNullSafe(F.col("clip_id"))), lambda x: x["value"]).alias("context"))


def causal_window(signal: DataFrame, weights: list[float]) -> DataFrame:
    """Weighted sum of each item and those before it, the last weight for the item itself, zeros before the first."""
    rows, w = in_blocks(signal.select("clip_id", "idx", "value"), "clip_id", "idx", before=len(weights) - 1)
    ago = [len(weights) - 1 - i for i in range(len(weights) - 1)]
    same = lambda n: F.lag("clip_id", n).over(w).eqNullSafe(F.col("clip_id"))
    rows = rows.select("*", *[F.when(same(n), F.lag("value", n).over(w)).alias(f"_v{n}") for n in ago]).where("_own")
    total = F.lit(0.0)
    for x in [*(F.coalesce(f"_v{n}", F.lit(0.0)) * x for n, x in zip(ago, weights)), F.col("value") * weights[-1]]:
        total = total + x
    return rows.select("clip_id", "idx", total.alias("value"))
