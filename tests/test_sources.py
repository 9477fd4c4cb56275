"""Listings, headers of media and sidecars on real files."""

import json
import os
import struct

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from vocalake.operators import alignment, runs
from vocalake.sources import media, sidecars
from vocalake.sources.listing import artifact_files, list_tree, with_bodies


def _wav(chunks: int, body: int = 3, seconds: int = 1) -> bytes:
    data = b"\0" * 32000 * seconds
    more = b"".join(b"LIST" + struct.pack("<I", body) + b"a" * body + b"\0" * (body % 2) for _ in range(chunks))
    return b"RIFF" + struct.pack("<I", 36 + len(more) + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16) + more + b"data" + struct.pack("<I", len(data)) + data


def test_only_headers_are_read():
    content = _wav(20, 50_001, 60)  # a megabyte of chunks before two of data
    read = []

    def some(at, n):
        read.append(len(content[at : at + n]))
        return content[at : at + n]

    assert media.header(some, len(content)) == (16000 * 60, 16000)
    assert sum(read) < 64_000 and len(read) <= 24


def test_headers_that_end_nowhere():
    own = lambda c: media.header(lambda at, n: c[at : at + n], len(c))
    assert own(b"") == own(b"RIFF....WAVE") == own(b"junk" * 9) == (None, None)
    assert own(_wav(3)[:100]) == (10, 16000)  # cut off within the data
    assert own(_wav(30)[:200]) == (None, 16000)
    empty = b"RIFF....WAVE" + b"LIST\0\0\0\0" * 100_000
    calls = []
    assert media.header(lambda at, n: calls.append(n) or empty[at : at + n], len(empty)) == (None, None)
    assert sum(calls) <= 8 * media.MOST_CHUNKS + 1024  # a stated number of chunks, not the whole file
    assert own(b"RIFF....WAVEdata\xff\xff\xff\xff") == (None, None)


def test_a_catalogue_of_a_tree(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"d{i % 3}" / "deep").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"d{i % 3}" / "deep" / f"é {i}.wav").write_bytes(_wav(i, i))
    (tmp_path / "top.wav").write_bytes(b"junk")
    (tmp_path / "notes.txt").write_text("x")
    got = {r["path"]: r for r in media.read_media_catalog(spark, str(tmp_path), "*.wav").collect()}
    assert len(got) == 13 and all(got[str(tmp_path / f"d{i % 3}" / "deep" / f"é {i}.wav")]["frames"] == 16000 for i in range(12))
    assert not got[str(tmp_path / "top.wav")]["readable"] and got[str(tmp_path / "top.wav")]["bytes"] == 4
    assert media.read_media_catalog(spark, str(tmp_path)).count() == 14
    assert media.read_media_catalog(spark, str(tmp_path / "none")).count() == 0
    same = media.media_catalog(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).select("path", "content"))
    facts = lambda rows: sorted((r["bytes"], r["frames"], r["duration"]) for r in rows if r["readable"])
    assert facts(same.collect()) == facts(got.values())


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    """Ten thousand files of runs, with the rows that a listing should have."""
    top, rows = tmp_path_factory.mktemp("tree"), []

    def put(d, name, body):
        os.makedirs(top / d, exist_ok=True)
        (top / d / name).write_text(body)
        rows.append((d, name, body if name.endswith(".json") else None))

    for run in range(100):
        for step in range(33):
            put(f"run_{run}/step_{step:07d}", "weights.safetensors", "w" * 10)
            if step % 3:
                put(f"run_{run}/step_{step:07d}", "config.json", "broken" if step % 7 == 0 else json.dumps({"base_model": f"m{run}"} if step % 2 else {"rank": 8}))
            put(f"run_{run}/step_{step:07d}", "training_state.json", json.dumps({"step": step}))
        if run % 2:
            put(f"run_{run}/latest", "training_state.json", json.dumps({"step": run} if run % 3 else {}))
        elif run % 4 == 0:
            os.makedirs(top / f"run_{run}" / "latest")
            rows.append((f"run_{run}/latest", None, None))
    assert len(rows) > 8000
    return top, rows


def test_a_listed_tree_answers_as_a_table(spark, tree):
    top, rows = tree
    files = artifact_files(spark, str(top)).cache()
    table = spark.createDataFrame(rows, "dir string, name string, body string")
    assert sorted(map(tuple, files.where("name is not null").collect()), key=repr) == sorted((r for r in rows if r[1]), key=repr)
    for f in (runs.artifact_catalog, runs.catalogue_order, runs.resume_point, runs.latest_step):
        own = f(files)
        assert sorted(map(tuple, own.where("run <> ''").collect() if "run" in own.columns else own.collect()), key=repr) == sorted(map(tuple, f(table).collect()), key=repr)
    assert {r["run"]: r["step"] for r in runs.resume_point(files).collect()}["run_4"] == 32  # an empty folder counts, too
    files.unpersist()


def test_bodies_have_bounds(spark, tmp_path):
    (tmp_path / "a.json").write_text("x" * 50)
    (tmp_path / "b.json").write_text("ok")
    (tmp_path / "c.json").write_bytes(b"\xff\xfe")
    (tmp_path / "d.bin").write_text("ok")
    os.makedirs(tmp_path / "e.json")
    got = {r["name"]: (r["is_dir"], r["bytes"], r["body"]) for r in with_bodies(list_tree(spark, str(tmp_path)), str(tmp_path), "name like '%.json'", 10).collect()}
    assert got == {"a.json": (False, 50, None), "b.json": (False, 2, "ok"), "c.json": (False, 2, None), "d.bin": (False, 2, None), "e.json": (True, None, None)}
    assert list_tree(spark, str(tmp_path / "none")).count() == 0


def _record(spark, audios):
    items = spark.createDataFrame([(a, 0, f"é {a}", 0.0, 1.5, "segment") for a in audios], "audio string, pos int, text string, start double, end double, level string")
    return alignment.alignment_record(items, "stable_ts", "segment")


def test_one_sidecar_for_each_audio(spark, tmp_path):
    out = tmp_path / "out"
    audios = [f"d{i % 3}/output_{i:03d}.wav" for i in range(40)] + [str(tmp_path / "elsewhere" / "x.y.mp3")]
    alignment.write_sidecars(_record(spark, audios).repartition(5), str(out))
    names = sorted(str(p.relative_to(out)) for p in out.rglob("*.json"))
    assert names == sorted(f"d{i % 3}/output_{i:03d}.timestamps.json" for i in range(40))
    text = (out / "d1" / "output_001.timestamps.json").read_text()
    assert json.loads(text) == {"audio_path": "d1/output_001.wav", "sample_rate": 16000, "backend": "stable_ts", "level": "segment", "text": "é d1/output_001.wav", "items": [{"text": "é d1/output_001.wav", "start": 0.0, "end": 1.5, "level": "segment"}], "warning": None}
    assert text.startswith('{\n  "audio_path"') and text.endswith("}\n") and "é" in text
    assert (tmp_path / "elsewhere" / "x.y.timestamps.json").is_file()
    assert json.loads((out / "_SUCCESS").read_text()) == {"files": 41} and not list(out.glob("_staging*"))


def test_audios_that_share_a_sidecar(spark, tmp_path):
    alignment.write_sidecars(_record(spark, ["a.wav", "a.mp3", "a.ogg"]), str(tmp_path))
    assert json.loads((tmp_path / "a.timestamps.json").read_text())["audio_path"] == "a.wav"


def _writer(tmp_path, monkeypatch, attempt=0):
    task = type("Task", (), {"partitionId": lambda s: 0, "attemptNumber": lambda s: attempt, "taskAttemptId": lambda s: 10 + attempt})()
    monkeypatch.setattr(TaskContext, "get", classmethod(lambda cls: task))
    return sidecars.SidecarWriter(str(tmp_path / "out"))


def test_a_task_that_fails_once_still_gives_each_file_once(tmp_path, monkeypatch):
    writer = _writer(tmp_path, monkeypatch)

    def broken():
        yield ("a.json", "one")
        yield ("sub/b.json", "two")
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(broken())
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()]  # neither whole nor half files
    first = writer.write(iter([("a.json", "one"), ("sub/b.json", "two")]))
    again = writer.write(iter([("a.json", "one"), ("sub/b.json", "two")]))  # a second copy of the same task
    writer.commit([first, None])
    assert again.files == 2 and sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["_SUCCESS", "a.json", "sub/b.json"]


def test_a_job_that_fails_leaves_no_file(spark, tmp_path, monkeypatch):
    writer = _writer(tmp_path, monkeypatch)
    done = writer.write(iter([("a.json", "one"), ("sub/b.json", "two")]))
    writer.abort([done, None])
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()] and not list((tmp_path / "out").glob("_staging*"))


def test_a_spark_job_that_fails_leaves_no_file(spark, tmp_path):
    rows = spark.range(40).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("name"), F.when(F.col("id") == 39, F.raise_error(F.lit("bad row"))).otherwise("x").alias("payload"))
    with pytest.raises(Exception, match="bad row"):
        sidecars.write_files(rows, str(tmp_path / "out"))
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()]
    sidecars.write_files(rows.where("id < 39"), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("f*"))) == 39


def test_names_of_artefacts_can_be_given(spark):
    files = spark.createDataFrame([("a", "own.bin", None), ("a", "own.json", '{"base_model": "m"}'), ("b", "weights.safetensors", None), ("c", "own.bin", None), ("c", "own.json", "{")], "dir string, name string, body string")
    assert list(map(tuple, runs.artifact_catalog(files, "own.bin", "own.json").collect())) == [("c", None), ("a", "m")]
    assert [r["id"] for r in runs.catalogue_order(files).collect()] == ["b"]
