"""Streams against their batch twins: files that arrive, items out of order, state that stays bounded."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from vocalake.operators import runs, signal, validation
from vocalake.sources.arriving import ArrivingLinesReader, arriving_lines
from vocalake.sources.manifest import numbered_lines
from vocalake.streaming import streams

MEDIA = "path string, frames bigint, sample_rate int, readable boolean, duration double"


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def _state_rows(progress):
    return [p.stateOperators[0].numRowsTotal for p in progress if p.stateOperators]


@pytest.fixture()
def media(spark):
    return spark.createDataFrame([("/data/x.wav", 100, 16000, True, 1.0), ("/data/y.wav", 100, 8000, True, 1.0), ("/data/z.wav", 100, 16000, True, 40.0)], MEDIA)


FILES = {
    "b.jsonl": '{"text": "a b", "audio": "x.wav", "ref_audio": "y.wav"}\n\nnot json\r\n[1]\n{"text": "", "audio": "z.wav"}',
    "a.jsonl": '{"text": "é", "audio": "gone.wav"}\n' * 3 + "\n",
    "empty.jsonl": "",
    "c.jsonl": '{"text": "a"}\r{"text": 5, "audio": {"path": "/data/x.wav"}, "ref_audio": "none.wav"}\n{"audio": 7, "text": "t"}\n' * 40,
    ".hidden": "not json\n",
}


def _put(folder, name, at):
    """As a writer should: whole, then under its name."""
    (folder / f"_{name}").write_text(FILES[name], newline="")
    os.utime(folder / f"_{name}", (at, at))
    os.rename(folder / f"_{name}", folder / name)


def test_manifests_that_arrive_one_by_one(spark, tmp_path, media):
    folder, sink, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    taken = []
    for i, name in enumerate(FILES):
        _put(folder, name, 1_700_000_000 + i)
        progress = streams.caught_up(streams.stream_validate(spark, str(folder), media, "/data"), sink, state)  # a new query each time, from the checkpoint
        taken.append(sum(p.numInputRows for p in progress))
    assert taken == [FILES[n].replace("\r\n", "\n").replace("\r", "\n").count("\n") + (not FILES[n].endswith("\n") and FILES[n] != "") if n != ".hidden" else 0 for n in FILES]
    got = spark.read.parquet(sink)
    for name in ("a.jsonl", "b.jsonl", "c.jsonl"):
        own = got.where(F.col("file") == str(folder / name))
        expected = validation.validate_manifest(numbered_lines(spark, str(folder / name)), media, "/data")
        columns = ("sample_id", "text", "audio", "media_error", "band", "blank_text", "ref", "valid", "line_errors")
        assert _rows(own, *columns) == _rows(expected, *columns) and own.count()
        assert validation.summary(own).first() == validation.summary(expected).first()
    assert got.where(F.col("file").rlike("hidden|empty")).isEmpty()


def test_files_of_one_time_and_one_batch(spark, tmp_path, media):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in FILES:
        _put(folder, name, 1_700_000_000)
    got = streams.finished(streams.stream_validate(spark, str(folder), media, "/data"))
    assert {r["file"].rpartition("/")[2] for r in got.select("file").distinct().collect()} == {"a.jsonl", "b.jsonl", "c.jsonl"}
    assert got.count() == 3 + 4 + 120


def test_running_counts_by_file(spark, tmp_path, media):
    folder = tmp_path / "in"
    folder.mkdir()
    _put(folder, "a.jsonl", 1_700_000_000)
    _put(folder, "b.jsonl", 1_700_000_001)
    counts = validation.summary(streams.stream_validate(spark, str(folder), media, "/data"), "file")
    counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert {r["file"].rpartition("/")[2]: (r["total"], r["valid"], r["n_errors"]) for r in spark.table("counts").collect()} == {"a.jsonl": (3, 0, 3), "b.jsonl": (4, 2, 2)}


def test_young_files_wait_and_offsets_stay_small(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a").write_text("x\n")
    assert ArrivingLinesReader(str(folder), 60).latestOffset() == {"time": 0, "file": ""}
    reader = ArrivingLinesReader(str(folder), 0)
    for i in range(30):
        (folder / f"f{i:02d}").write_text("y\n")
        os.utime(folder / f"f{i:02d}", (1_700_000_000 + i // 10,) * 2)
    os.utime(folder / "a", (1_800_000_000 - 2**28,) * 2)
    end = reader.latestOffset()
    assert len(json.dumps(end)) < 200
    assert sum(len(p.paths) for p in reader.partitions(reader.initialOffset(), end)) == 31
    middle = {"time": 1_700_000_001 * 10**9, "file": str(folder / "f14")}
    names = lambda start, stop: [x.rpartition("/")[2] for p in reader.partitions(start, stop) for x in p.paths]
    assert names(reader.initialOffset(), middle) + names(middle, end) == names(reader.initialOffset(), end)
    assert ArrivingLinesReader(str(tmp_path / "none"), 0).latestOffset() == reader.initialOffset()
    assert arriving_lines(spark, str(folder)).columns == ["file", "line_no", "raw"]


def _items(spark, seed, clips=3, n=60):
    """Items of some clips, some seconds out of order and in three batches' worth of files."""
    rng = random.Random(seed)
    rows = [(c, i, i + 1, float(i * (c + 1) % 11)) for c in range(clips) for i in range(n)]
    return spark.createDataFrame(rows, "clip_id bigint, idx bigint, at bigint, value double").select("clip_id", "idx", F.timestamp_seconds("at").alias("ts"), "value"), rng


@pytest.mark.parametrize("late", ["0 seconds", "8 seconds"])
def test_items_out_of_order_give_the_batch_result(spark, late):
    rows, rng = _items(spark, 5)
    if late == "8 seconds":  # each batch holds items of up to 8 seconds before the last of the one before
        shuffled = rows.withColumn("arrives", F.col("idx") + F.floor(F.rand(3) * 8))
    else:
        shuffled = rows.withColumn("arrives", F.col("idx"))
    own = lambda f: lambda x: f(x.drop("arrives"))
    got = streams.replayed(shuffled, own(lambda x: streams.stream_context_tail(x, 4, late)), "arrives", 5, "ts")
    assert _rows(got, "clip_id", "idx", "context") == _rows(signal.context_tail(rows, 4), "clip_id", "idx", "context")
    got = streams.replayed(shuffled, own(lambda x: streams.stream_causal_window(x, [0.25, 0.5, 0.25], late)), "arrives", 5, "ts")
    assert _rows(got, "clip_id", "idx", "value") == _rows(signal.causal_window(rows, [0.25, 0.5, 0.25]), "clip_id", "idx", "value")


def test_idle_keys_are_forgotten_and_start_anew(spark, tmp_path):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "clip_id bigint, idx bigint, ts timestamp, value double"
    batches = [[(1, i, i, 1.0) for i in range(5)], [(2, i, 100 + i, 1.0) for i in range(5)], [(1, 5, 200, 1.0)], [(1, 6, 150, 1.0), (3, 0, 300, 1.0)]]
    seen = []
    for rows in batches:
        spark.createDataFrame([(c, i, t, v) for c, i, t, v in rows], "clip_id bigint, idx bigint, at bigint, value double").select("clip_id", "idx", F.timestamp_seconds("at").alias("ts"), "value").coalesce(1).write.mode("append").parquet(source)
        stream = streams.stream_context_tail(spark.readStream.schema(schema).parquet(source), 4, "1 second", 20_000)
        seen.append(_state_rows(streams.caught_up(stream, sink, state))[-1])
    assert seen == [1, 1, 1, 1]  # only the key that has items to come
    got = {(r["clip_id"], r["idx"]): r["context"] for r in spark.read.parquet(sink).collect()}
    assert got[1, 4] == [1.0] * 4 and got[1, 5] == [1.0]  # forgotten after 20 seconds
    assert (1, 6) not in got  # too late


def test_the_end_of_a_replay_leaves_no_state(spark, tmp_path):
    rows, _ = _items(spark, 1)
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    end = spark.sql("select cast(null as bigint) clip_id, cast(null as bigint) idx, timestamp'2200-01-01' ts, cast(null as double) value")
    rows.unionAll(end).write.parquet(source)
    stream = streams.stream_causal_window(spark.readStream.schema(rows.schema).parquet(source), [0.5, 0.5])
    assert _state_rows(streams.caught_up(stream, sink, state))[-1] == 0
    assert spark.read.parquet(sink).count() == 180


def test_a_long_log_keeps_a_bounded_tail(spark, tmp_path):
    folder, sink, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    step = 0
    for i in range(50):
        lines = []
        for _ in range(7):
            step += 1
            lines.append(f"[train] step {step}: loss/a: {step / 10:.6f}, lr: 0.100000" if step % 3 else f"[val] step {step}: loss/a: {step / 5:.6f}")
        (folder / f"{i:03d}.txt").write_text("\n".join(lines) + "\nnoise\n")
        os.utime(folder / f"{i:03d}.txt", (1_700_000_000 + i,) * 2)
    tails = streams.stream_metrics_tail(streams.stream_metrics(spark, str(folder), 1), 5)
    progress = streams.caught_up(tails, sink, state)
    assert len([p for p in progress if p.numInputRows]) == 50 and set(_state_rows(progress)) == {3}  # a row of five steps for each split and key
    written = spark.read.parquet(sink)
    assert written.groupBy("split", "key", "version").count().agg(F.max("count")).first()[0] == 5
    expected = runs.metrics_tail(runs.parse_metric_lines(spark.read.text(str(folder))), 5)
    assert _rows(streams.latest_tail(written), "split", "step", "key", "value") == _rows(expected, "split", "step", "key", "value")
