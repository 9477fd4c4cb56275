"""Nested alignments to items and back."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalake.functions.text import strip
from vocalake.operators.hooks import PerWorker
from vocalake.operators.requests import sidecar_name
from vocalake.sources.sidecars import write_files

BACKENDS, LEVELS = ("stable_ts",), ("segment", "word", "char")
#: Aligners by name: (audio, text) -> items, or a `PerWorker` that makes one. Users add theirs.
ALIGNERS: dict[str, Callable[[str, str], list[dict]] | PerWorker] = {}
#: Characters of items, as JSON, that a task hands over at once (one row at least).
BATCH_CHARS = 4_000_000
ITEM = "array<struct<text:string,start:double,end:double,level:string>>"


def segment_items(segments: DataFrame) -> DataFrame:
    """audio, pos, text, start, end, level of segments (audio, pos, text, start, end): stripped, times 0 where null, blank ones dropped."""
    out = segments.select("audio", "pos", strip(F.coalesce("text", F.lit(""))).alias("text"), F.coalesce("start", F.lit(0.0)).alias("start"), F.coalesce("end", F.lit(0.0)).alias("end"), F.lit("segment").alias("level"))
    return out.where("text <> ''")


def word_items(segments: DataFrame) -> DataFrame:
    """Items of the words (array of struct<word, text, start, end>) of segments (audio, pos, words); `text` where `word` is null."""
    each = segments.select("audio", "pos", F.posexplode("words").alias("wpos", "w"))
    text = strip(F.coalesce("w.word", "w.text", F.lit("")))
    return each.select("audio", "pos", "wpos", text.alias("text"), F.coalesce("w.start", F.lit(0.0)).alias("start"), F.coalesce("w.end", F.lit(0.0)).alias("end"), F.lit("word").alias("level")).where("text <> ''")


def word_to_chars(items: DataFrame) -> DataFrame:
    """Characters of word items, each with an even share of the word's time."""
    n, span = F.length("text"), F.greatest(F.col("end") - F.col("start"), F.lit(0.0))
    each = items.where(strip(F.col("text")) != "").select("*", (span / n).alias("_d"), F.posexplode(F.split("text", "")).alias("cpos", "c"))
    kept = [c for c in items.columns if c not in ("text", "start", "end", "level")]
    return each.select(*kept, "cpos", F.col("c").alias("text"), (F.col("start") + F.col("_d") * F.col("cpos")).alias("start"), (F.col("start") + F.col("_d") * (F.col("cpos") + 1)).alias("end"), F.lit("char").alias("level"))


def alignment_record(items: DataFrame, backend: str, level: str, rate: int = 16000) -> DataFrame:
    """One row per audio: audio_path, sample_rate, backend, level, text, items, warning."""
    if backend not in BACKENDS or level not in LEVELS:
        raise ValueError(f"unknown backend or level: {backend}, {level}")
    order = [c for c in ("pos", "wpos", "cpos") if c in items.columns]
    listed = F.array_sort(F.collect_list(F.struct(*order, F.struct("text", "start", "end", "level").alias("item"))))
    out = items.groupBy("audio").agg(F.transform(listed, lambda x: x["item"]).alias("items"))
    return out.select(F.col("audio").alias("audio_path"), F.lit(rate).alias("sample_rate"), F.lit(backend).alias("backend"), F.lit(level).alias("level"), F.array_join(F.transform("items", lambda x: x["text"]), "" if level == "char" else " ").alias("text"), "items", F.lit(None).cast("string").alias("warning"))


def sidecar_json(record: DataFrame) -> Column:
    """The record as one JSON object; nulls kept, other scripts not escaped."""
    return F.to_json(F.struct(*record.columns), {"ignoreNullFields": "false"})


def write_sidecars(record: DataFrame, path: str) -> None:
    """Writes each record beside its audio, as `sidecar_name` says, as indented JSON; relative audio paths are under path.

    Of audios that share a sidecar, the record that sorts last counts. Files are whole or absent, also over failed tasks.
    """

    @F.pandas_udf("string")
    def indented(payload: pd.Series) -> pd.Series:
        return payload.map(lambda x: json.dumps(json.loads(x), ensure_ascii=False, indent=2) + "\n")

    write_files(record.select(sidecar_name(F.col("audio_path")).alias("name"), indented(sidecar_json(record)).alias("payload")), path)


def aligned(audio: DataFrame, aligner: str | Callable[[str, str], list[dict]] | PerWorker, strict: bool = False) -> DataFrame:
    """audio (audio, text) with the items of a user's aligner (a function, the name of one in `ALIGNERS`, or a `PerWorker` that makes one), run in the tasks; a failure is a warning, or, if strict, stops the job.

    An aligner that can't be made is no failure of an audio: it stops the job.
    """
    if isinstance(aligner, str):
        if aligner not in ALIGNERS:
            raise ValueError(f"unknown aligner {aligner}: one of {sorted(ALIGNERS)}")
        aligner = ALIGNERS[aligner]
    hook = aligner if isinstance(aligner, PerWorker) else PerWorker(lambda: aligner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are handed over as soon as their items have `BATCH_CHARS`: a worker holds these, however many texts come at once."""
        handed = lambda rows: pa.record_batch([pa.array(c, pa.string()) for c in zip(*rows)], ["audio", "items", "warning"])
        with hook as own:
            for batch in batches:
                rows, held = [], 0
                for a, t in zip(batch.column("audio"), batch.column("text")):
                    a, t = a.as_py(), t.as_py()
                    try:
                        rows.append((a, json.dumps(own(a, t)), None))
                    except Exception as e:
                        if strict:
                            raise
                        rows.append((a, "[]", str(e)))
                    held += len(rows[-1][1])
                    if held >= BATCH_CHARS:
                        yield handed(rows)
                        rows, held = [], 0
                if rows:
                    yield handed(rows)

    out = audio.select(F.col("audio").cast("string").alias("audio"), "text").mapInArrow(run, "audio string, items string, warning string")
    return out.select("audio", F.from_json("items", ITEM).alias("items"), "warning")
