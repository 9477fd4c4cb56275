"""Keyed state over streams, streamed metrics and validation.

State is bounded: a key holds its last items, and those that came while the watermark hadn't passed them. State expires
by event time (`idle`): that is an addition of this package. A key that comes again after that starts anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vocalake.operators.runs import parse_metric_lines
from vocalake.operators.validation import checked, from_lines, resolve_path
from vocalake.sources.arriving import arriving_lines
from vocalake.tables import shared_path

#: How late an item may come, and ms of event time after its last item in which a key is forgotten.
LATE, IDLE = "10 seconds", 3_600_000


def _with_tail(stream: DataFrame, keep: int, make: Callable[[list[float], list[float]], list], kind: str, name: str, late: str, idle: int) -> DataFrame:
    """Each item of a stream (clip_id, idx, ts, value) with what `make` gives of the key's last `keep` items and the new ones.

    Items wait until the watermark (the latest ts less `late`) has passed their ts, and are taken in order of idx then, so
    they may come in any order within that time. ts mustn't fall as idx grows, and is after 1970, where watermarks begin. Items that come later
    are left out.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tail, last, *held = state.get if state.exists else ([], 0, [], [], [])
        rows = list(zip(*map(list, held)))
        for batch in batches:  # most have few rows: plain arrays, as pandas' own work would be most of the time
            idx, ts, value = (batch[c].to_numpy() for c in ("idx", "ts", "value"))
            if idx.dtype.kind != "i":
                there = ~pd.isna(idx)
                idx, ts, value = idx[there].astype("int64"), ts[there], value[there]
            rows += zip(idx.tolist(), (ts.astype("datetime64[us]").astype("int64") // 1000).tolist(), value.tolist())
        if not rows and not state.exists:
            return
        passed = state.getCurrentWatermarkMs()
        rows.sort()
        ready = [r for r in rows if r[1] <= passed]
        waiting = [r for r in rows if r[1] > passed]
        tail, values = list(tail), [r[2] for r in ready]
        out = make(tail, values)
        last = max([last, *(r[1] for r in ready)])
        if not waiting and last + idle <= passed:
            state.remove()
        else:
            state.update(((tail + values)[-keep:] if keep else [], last, *([r[i] for r in waiting] for i in range(3))))
            state.setTimeoutTimestamp(min(r[1] for r in waiting) if waiting else last + idle)
        if ready:
            yield pd.DataFrame({"clip_id": pd.Series([key[0]] * len(ready), dtype="object"), "idx": [r[0] for r in ready], name: out})

    kept = "tail array<double>, last bigint, idx array<bigint>, at array<bigint>, value array<double>"
    stream = stream.select("clip_id", "idx", "ts", "value").withWatermark("ts", late)
    return stream.groupBy("clip_id").applyInPandasWithState(step, f"clip_id {dict(stream.dtypes)['clip_id']}, idx bigint, {name} {kind}", kept, "append", GroupStateTimeout.EventTimeTimeout)


def stream_context_tail(stream: DataFrame, k: int, late: str = LATE, idle: int = IDLE) -> DataFrame:
    """Each item with the k - 1 before it, as `signal.context_tail` gives."""

    def make(tail: list[float], values: list[float]) -> list[list[float]]:
        both = tail + values
        return [both[max(0, i + 1 - k) : i + 1] for i in range(len(tail), len(both))]

    return _with_tail(stream, k - 1, make, "array<double>", "context", late, idle)


def stream_causal_window(stream: DataFrame, weights: list[float], late: str = LATE, idle: int = IDLE) -> DataFrame:
    """A causal filter whose carried tail makes chunks give what the whole signal gives."""
    pad = len(weights) - 1

    def make(tail: list[float], values: list[float]) -> list[float]:
        both = [0.0] * (pad - len(tail)) + tail + values
        return [sum(w * x for w, x in zip(weights, both[i : i + pad + 1])) for i in range(len(values))]

    return _with_tail(stream, pad, make, "double", "value", late, idle)


def replayed(df: DataFrame, f: Callable[[DataFrame], DataFrame], key: str = "idx", batches: int = 3, event_time: str | None = None) -> DataFrame:
    """f over df as a stream of batches in order of the key, run to its end; the result as a table.

    Batches are cut by quantiles of the key, so each has about as many rows; nulls come first. The rows of a batch are
    written by all tasks, then the stream is run until it has caught up, from where it stopped before. With the name of
    an event time, a last row that has nothing but a time far ahead lets the watermark pass all others.
    """
    spark, source, sink, state = df.sparkSession, *(shared_path(df.sparkSession) for _ in range(3))
    cuts = df.approxQuantile(key, [i / batches for i in range(1, batches)], 0.01)
    of = sum(((F.col(key) > c).cast("int") for c in cuts), F.lit(0))
    parts = [df.where(F.coalesce(of, F.lit(0)) == i) for i in range(batches)]
    if event_time:
        parts.append(spark.range(1).select(*[(F.lit("2200-01-01 00:00:00") if c == event_time else F.lit(None)).cast(t).alias(c) for c, t in df.dtypes]))
    stream = None
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = stream or f(spark.readStream.schema(df.schema).parquet(source))
        caught_up(stream, sink, state)
    return spark.read.schema(stream.schema).parquet(sink)


def caught_up(stream: DataFrame, sink: str, state: str) -> list[dict]:
    """Runs a stream into a folder until it has taken what is there; its progress, batch by batch."""
    query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return list(query.recentProgress)


def finished(stream: DataFrame) -> DataFrame:
    """What a bounded stream gives, as a table."""
    spark, sink = stream.sparkSession, shared_path(stream.sparkSession)
    caught_up(stream, sink, shared_path(spark))
    return spark.read.schema(stream.schema).parquet(sink)


def stream_metrics(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """The metrics of a growing folder of logs, as a stream of split, step, key, value; at most so many files a batch."""
    return parse_metric_lines(spark.readStream.option("maxFilesPerTrigger", files).text(path))


def stream_metrics_tail(metrics: DataFrame, n: int) -> DataFrame:
    """The last n steps of each split and key of a stream (split, step, key, value), after each batch that had some of it: split, key, version, step, value.

    The state of a key is its n values and a version that grows by one each time, however long the log gets. `latest_tail`
    picks the last version of each key from what was written.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        version, steps, values = state.get if state.exists else (0, [], [])
        rows = list(zip(steps, values))
        for batch in batches:
            rows += zip(batch["step"].tolist(), batch["value"].tolist())
            rows = sorted(rows, reverse=True)[:n]
        state.update((version + 1, [r[0] for r in rows], [r[1] for r in rows]))
        yield pd.DataFrame({"split": key[0], "key": key[1], "version": version + 1, "step": [r[0] for r in rows], "value": [r[1] for r in rows]})

    return metrics.groupBy("split", "key").applyInPandasWithState(step, "split string, key string, version bigint, step bigint, value double", "version bigint, steps array<bigint>, values array<double>", "append", GroupStateTimeout.NoTimeout)


def latest_tail(tails: DataFrame) -> DataFrame:
    """split, step, key, value of the last version of each key that `stream_metrics_tail` wrote."""
    last = tails.groupBy("split", "key").agg(F.max("version").alias("version"))
    return tails.join(last, ["split", "key", "version"]).select("split", "step", "key", "value")


def stream_checked(manifest: DataFrame, media: DataFrame) -> DataFrame:
    """`validation.checked` over a stream of manifest rows or lines (line_no, raw): the media are a static side of the join."""
    return checked(manifest, media)


def stream_validate(spark: SparkSession, path: str, media: DataFrame, base: str = "", settle: float = 1) -> DataFrame:
    """The lines of manifests that arrive in a folder, checked as `validate_manifest` does, with their file; relative paths under base.

    Within a file, sample_id is the line's number. `validation.findings` and `summary` (by file) take this stream, too.
    """
    rows = from_lines(arriving_lines(spark, path, settle))
    if base:
        rows = rows.withColumns({c: resolve_path(F.col(c), base) for c in ("audio", "ref_audio")})
    return checked(rows, media)
