"""Planning of batch synthesis: rules, modes, prompts, retries, ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalake.functions.text import strip


def _given(name: str) -> Column:
    return strip(F.coalesce(name, F.lit(""))) != ""


def violations() -> Column:
    """The rules that a request breaks, in order."""
    prompt = _given("prompt_text") | _given("prompt_file")
    audio, ref = _given("prompt_audio"), _given("reference_audio")
    rules = {
        "blank_text": ~_given("text"),
        "prompt_text_and_file": _given("prompt_text") & _given("prompt_file"),
        "prompt_audio_without_text": audio & ~prompt,
        "prompt_text_without_audio": prompt & ~audio,
        "control_with_prompt_text": _given("control") & prompt,
        "design_with_audio": (F.col("command") == "design") & (audio | ref),
        "clone_without_audio": (F.col("command") == "clone") & ~audio & ~ref,
        "reference_needs_v2": ref & (F.col("arch") == "v1"),
        "cfg_range": ~F.col("cfg").between(0.1, 10),
        "steps_range": ~F.col("steps").between(1, 100),
    }
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))


def request_findings(requests: DataFrame, files: DataFrame) -> DataFrame:
    """request_id, broken: the rules of `violations`, then those that need more than the request: `prompt_file_missing` (files: prompt_file) and, where the request has rank, alpha and dropout of an adapter, `adapter_range`."""
    known = files.where("prompt_file is not null").select(F.col("prompt_file").alias("_file")).distinct()
    more = [F.when(_given("prompt_file") & F.col("_file").isNull(), F.lit("prompt_file_missing"))]
    if {"rank", "alpha", "dropout"} <= set(requests.columns):
        more.append(F.when(~ranges_ok(F.col("rank"), F.col("alpha"), F.col("dropout")), F.lit("adapter_range")))
    key = F.coalesce("prompt_file", F.concat(F.lit("\0"), F.col("request_id").cast("string")))  # requests without a file don't gather in one task
    return requests.join(known, key == F.col("_file"), "left").select("request_id", F.concat(violations(), F.array_compact(F.array(*more))).alias("broken"))


def ranges_ok(rank: Column, alpha: Column, dropout: Column) -> Column:
    return (rank > 0) & (alpha > 0) & dropout.between(0, 1)


def resolve_prompt_text(requests: DataFrame, files: DataFrame) -> DataFrame:
    """requests with resolved: the inline text, else the file's (files: prompt_file, body), stripped; null where neither has any."""
    full = lambda c: F.nullif(strip(c), F.lit(""))
    return requests.join(files, "prompt_file", "left").withColumn("resolved", F.coalesce(full(F.col("prompt_text")), full(F.col("body")))).drop("body")


def generation_mode(ref: Column, prompt: Column) -> Column:
    return F.when(ref & prompt, "ref_continuation").when(ref, "reference").when(prompt, "continuation").otherwise("zero_shot")


def effective_text(mode: Column, prompt_text: Column, text: Column) -> Column:
    return F.when(mode.isin("continuation", "ref_continuation"), F.concat(F.coalesce(prompt_text, F.lit("")), text)).otherwise(text)


def length_budget(n: Column, most: int, ratio: float = 6.0) -> Column:
    return F.least((n * ratio + 10).cast("int"), F.lit(most))


def badcase(frames: Column, n: Column, ratio: float = 6.0, streaming: Column | None = None) -> Column:
    bad = frames >= n * ratio
    return bad if streaming is None else bad & ~streaming


def retry_guard(retry: Column, streaming: Column) -> Column:
    """retry as it takes effect, and a warning where streaming turns it off."""
    return F.struct((retry & ~streaming).alias("retry"), F.when(retry & streaming, "retry is off while streaming").alias("warning"))


def materialise_seed(seed: Column, key: Column) -> Column:
    """The low 32 bits of the seed; without one, a number made from the key."""
    return F.coalesce(seed.bitwiseAND(0xFFFFFFFF), F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"))


def clip_duration(samples: Column, rate: Column) -> Column:
    return samples / F.nullif(rate, F.lit(0))


def attach_prompt_cache(requests: DataFrame, caches: DataFrame) -> DataFrame:
    """requests with the prepared prompt of their voice; Spark broadcasts the caches if they are small."""
    return requests.join(caches, "voice_id", "left")


def attempt_resolution(attempts: DataFrame, most: int = 3, ratio: float = 6.0) -> DataFrame:
    """request_id, attempt, frames, bad of the attempt that counts: the first good one of the first `most`, else the last of them; with a column seed (of the first attempt, each later one has the next), also seed: that of this attempt."""
    tried = attempts.where(F.col("attempt") <= most).withColumn("bad", badcase(F.col("frames"), F.col("target_len"), ratio))
    seed = ["seed"] if "seed" in attempts.columns else []
    tried = tried.withColumns({c: F.col(c) + F.col("attempt") - 1 for c in seed})
    best = F.struct(F.when(F.col("bad"), 1).otherwise(0), F.when(F.col("bad"), -F.col("attempt")).otherwise(F.col("attempt")), "attempt", "frames", "bad", *seed)
    return tried.groupBy("request_id").agg(F.min(best).alias("x")).select("request_id", "x.attempt", "x.frames", "x.bad", *[F.col(f"x.{c}") for c in seed])


def merge_prompt_cache(turns: DataFrame) -> DataFrame:
    """Per turn, the texts so far as one prompt; the mode says whether there has been a reference. Grows with the square of turns, as it writes out each prompt: `prompts.merge_prompts` doesn't."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return turns.select("conv_id", "turn", F.array_join(F.collect_list("text").over(w), "").alias("prompt_text"), F.when(F.max(F.col("ref_audio").isNotNull()).over(w), "ref_continuation").otherwise("continuation").alias("mode"))


def batch_results(lines: DataFrame, made: DataFrame) -> DataFrame:
    """i, text, duration, error of the lines of a batch (i, text) by what was made of them (i, duration, error): a line that nothing was made of has failed, too, and no failure stops the others."""
    out = lines.join(made.withColumn("_made", F.lit(True)), "i", "left")
    error = F.when(F.col("_made").isNull(), "no result").otherwise(F.col("error"))
    return out.select("i", "text", F.when(error.isNull(), F.col("duration")).alias("duration"), error.alias("error"))


def batch_failures(results: DataFrame) -> DataFrame:
    """i, message of the lines that failed."""
    return results.where("error is not null").select("i", F.concat(F.lit("Failed on line "), F.col("i").cast("string"), F.lit(": "), "error").alias("message"))


def batch_ledger(results: DataFrame) -> DataFrame:
    """attempted, succeeded, failed: the counts of a batch; `batch_failures` has the failures themselves."""
    return results.agg(F.count("*").alias("attempted"), F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def output_name(i: Column, folder: str, override: Column | None = None) -> Column:
    made = F.concat(F.lit(folder.rstrip("/") + "/output_"), F.format_string("%03d", i), F.lit(".wav"))
    return made if override is None else F.coalesce(override, made)


def sidecar_name(path: Column) -> Column:
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(".timestamps.json"))


def default_by_position(rows: DataFrame, texts: DataFrame, fallback: str) -> DataFrame:
    """rows (i) with the text of the same number, or the fallback."""
    return rows.join(texts, "i", "left").withColumn("text", F.coalesce("text", F.lit(fallback)))
