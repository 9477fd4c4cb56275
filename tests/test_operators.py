import os
import random
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vocalake import tables
from vocalake.functions import nested
from vocalake.functions.text import pack_utterances, split_utterances
from vocalake.operators import alignment, hooks, lengths, prompts, requests, runs, signal, validation
from vocalake.operators.hooks import PerWorker
from vocalake.sources.manifest import manifest_error, read_manifest, read_text_lines
from vocalake.sources.media import media_catalog, read_media_catalog
from vocalake.streaming import streams


def test_lines_keep_their_numbers(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"text": "a", "audio": "x.wav"}\n\nnot json\n[1]\n{"text": "b"} x\n')
    got = validation.parsed(read_manifest(spark, str(tmp_path / "m.jsonl"))).orderBy("line_no")
    assert [(r["line_no"], r["class"]) for r in got.collect()] == [(1, "object"), (3, "invalid_json"), (4, "not_object(array)"), (5, "invalid_json")]
    assert [tuple(r) for r in read_text_lines(spark, str(tmp_path / "m.jsonl")).orderBy("i").select("i").collect()] == [(1,), (2,), (3,), (4,)]


def test_media_catalog(spark, tmp_path):
    import struct

    data = b"\0" * 32000
    (tmp_path / "a.wav").write_bytes(b"RIFF" + struct.pack("<I", 36 + 12 + len(data)) + b"WAVELIST" + struct.pack("<I", 3) + b"abc\0" + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16) + b"data" + struct.pack("<I", len(data)) + data)
    (tmp_path / "b.wav").write_bytes(b"junk")
    got = {r["path"].rsplit("/", 1)[1]: r for r in read_media_catalog(spark, str(tmp_path)).collect()}
    assert (got["a.wav"]["frames"], got["a.wav"]["sample_rate"], got["a.wav"]["duration"]) == (16000, 16000, 1.0)
    assert not got["b.wav"]["readable"]


def test_estimated_length(spark):
    row = spark.sql("SELECT 10 AS t, 3.5D AS d, cast(null AS double) AS n, 1.0D AS r")
    assert tuple(row.select(lengths.estimate_length(F.col("t"), F.col("d"), F.col("n")), lengths.estimate_length(F.col("t"), F.col("d"), F.col("r"))).first()) == (34, 43)


def test_upper_median(spark):
    for values, median in (([1.0, 2.0, 3.0, 4.0], 3.0), ([1.0, 2.0, 3.0], 2.0)):
        rows = spark.createDataFrame([(v, None) for v in values], "media_duration double, media_error string")
        assert validation.duration_stats(rows).first()["median_duration"] == median


def test_attempts(spark):
    rows = [(1, i + 1, f, 10) for i, f in enumerate([60, 61, 59])] + [(2, i + 1, 60, 10) for i in range(3)] + [(3, 1, 5, 10), (3, 2, 4, 10)]
    got = requests.attempt_resolution(spark.createDataFrame(rows, "request_id int, attempt int, frames int, target_len int"))
    assert {r["request_id"]: (r["attempt"], r["bad"]) for r in got.collect()} == {1: (3, False), 2: (3, True), 3: (1, False)}


def test_characters_share_a_words_time(spark):
    items = spark.createDataFrame([("a", 0, 0, "欢迎", 0.5, 0.9, "word"), ("a", 0, 1, " ", 1.0, 2.0, "word")], "audio string, pos int, wpos int, text string, start double, end double, level string")
    got = alignment.word_to_chars(items).orderBy("cpos").collect()
    assert [(r["text"], round(r["start"], 6), round(r["end"], 6), r["level"]) for r in got] == [("欢", 0.5, 0.7, "char"), ("迎", 0.7, 0.9, "char")]


def test_streams_equal_batches(spark):
    rows = spark.range(60).select((F.col("id") % 3).alias("clip_id"), F.floor(F.col("id") / 3).alias("idx"), (F.col("id") * 0.5).alias("value"))
    timed = rows.withColumn("ts", F.timestamp_seconds(F.col("idx") + 1))
    got = streams.replayed(timed, lambda x: streams.stream_causal_window(x, [0.25, 0.5, 0.25]), event_time="ts")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, signal.causal_window(rows, [0.25, 0.5, 0.25]).collect()))
    got = streams.replayed(timed, lambda x: streams.stream_context_tail(x, 4), event_time="ts")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, signal.context_tail(rows, 4).collect()))


def test_streamed_validation_and_metrics(spark, tmp_path):
    manifest = spark.createDataFrame([(1, "a", "x.wav", None), (2, " ", "y.wav", "x.wav")], "sample_id bigint, text string, audio string, ref_audio string")
    media = spark.createDataFrame([("x.wav", 100, 16000, True, 1.0)], "path string, frames bigint, sample_rate int, readable boolean, duration double")
    manifest.write.parquet(str(tmp_path / "in"))
    stream = streams.stream_checked(spark.readStream.schema(manifest.schema).parquet(str(tmp_path / "in")), media)
    stream.writeStream.format("memory").queryName("checked").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("checked").select("sample_id", "media_error", "ref", "valid").collect())) == sorted(map(tuple, validation.checked(manifest, media).select("sample_id", "media_error", "ref", "valid").collect()))
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.txt").write_text("[train] step 3: loss/a: 1.500000, lr: 0.1, log interval: 2.00s\nnoise\n")
    streams.stream_metrics(spark, str(tmp_path / "log")).writeStream.format("memory").queryName("tail").trigger(availableNow=True).start().awaitTermination()
    assert sorted(tuple(r) for r in spark.table("tail").collect()) == [("train", 3, "loss/a", 1.5), ("train", 3, "lr", 0.1)]


def test_broken_lines_are_errors(spark):
    raw = ['{"text": "a b", "audio": "x.wav", "ref_audio": {"path": "x.wav"}}', "not json", "[1]", '{"text": "a"}', "{}", '{"text": "a", "audio": 5, "ref_audio": "n.wav"}', '{"text": 5, "audio": {"path": 7}}', " ", '{"text": "", "audio": "y.wav"}']
    lines = spark.createDataFrame(list(enumerate(raw, 1)), "line_no bigint, raw string")
    media = spark.createDataFrame([("x.wav", 100, 16000, True, 1.0)], "path string, frames bigint, sample_rate int, readable boolean, duration double")
    rows = validation.checked(lines, media)
    assert sorted(tuple(r) for r in rows.select("sample_id", "valid").collect()) == [(i, i == 1) for i in (1, 2, 3, 4, 5, 6, 7, 9)]
    errors = [(2, "invalid_json"), (3, "not_object"), (4, "missing_key"), (5, "missing_key"), (5, "missing_key"), (6, "invalid_path"), (7, "invalid_path"), (9, "media")]
    warnings = [(6, "ref_missing"), (7, "blank_text"), (9, "blank_text")]
    found = validation.findings(rows).collect()
    assert [sorted((r["sample_id"], r["category"]) for r in found if r["severity"] == s) for s in ("error", "warning")] == [errors, warnings]
    assert validation.summary(rows).first().asDict() == {"total": 8, "valid": 1, "with_ref": 1, "n_errors": 8, "n_warnings": 3, "found_errors": 8, "found_warnings": 3, "is_valid": False}
    assert validation.text_length_stats(rows).first()["max_length"] == 3


def test_catalogue_is_whole_and_in_order(spark):
    files = spark.createDataFrame([(f"run/step_{i:04d}", "weights.safetensors", None) for i in range(60)], "dir string, name string, body string").repartition(5)
    assert sorted((r["position"], r["id"]) for r in runs.catalogue_order(files).collect()) == [(i, f"run/step_{59 - i:04d}") for i in range(60)]


def test_latents_lie_at_audio_positions(spark):
    packed = spark.createDataFrame([(1, [0, 1, 1, 0, 0, 1, 0]), (2, [0, 1])], "key bigint, audio_mask array<int>")
    latents = spark.createDataFrame([(1, i, [i + 1.0] * 64) for i in range(3)] + [(2, 0, [9.0] * 64)], "key bigint, patch int, values array<double>")
    got = sorted(map(tuple, lengths.latent_track(packed, latents).collect()))
    assert got == [(1, i, [v] * 64) for i, v in enumerate([0.0, 1.0, 2.0, 0.0, 0.0, 3.0, 0.0])] + [(2, 0, [0.0] * 64), (2, 1, [9.0] * 64)]


def _prompts(rows):
    """What a conversation's turns make, one after another."""
    out, state = [], {}
    for conv, turn, text, n, ref in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or "")):
        text_before, feats, had = state.get(conv, ("", 0, False))
        state[conv] = now = (text_before + (text or ""), feats + (n or 0), had or ref is not None)
        (a, _), (b, _) = prompts.text_digest(now[0])
        out.append((conv, turn, (a << 31) + b, len(now[0]), now[1], "ref_continuation" if now[2] else "continuation"))
    return sorted(out, key=repr)


def test_prompts_keep_all_turns(spark):
    rows = [(c, t, f"t{c}-{t} é漢" * (t % 4), t % 3, "r.wav" if c == 3 and t >= 5 else None) for c in (3, 4) for t in range(120)]
    rows += [(5, 0, None, None, None), (5, 1, "", 2, None), (5, 1, "b", 1, "r"), (5, 1, "a", 1, None), (None, 1, "x", 1, None), (None, 2, "y", 1, None), (6, 9, "z" * 5000, 7, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, text string, n_feats int, ref_audio string").repartition(7)
    assert sorted(map(tuple, prompts.merge_prompts(turns).collect()), key=repr) == _prompts(rows)
    assert prompts.merge_prompts(turns.limit(0)).collect() == []
    whole = requests.merge_prompt_cache(turns.where("conv_id in (3, 4)")).select("conv_id", "turn", "prompt_text", "mode").collect()
    lengths_of = {(r["conv_id"], r["turn"]): (r["prompt_chars"], r["mode"]) for r in prompts.merge_prompts(turns).collect()}
    assert all(lengths_of[r["conv_id"], r["turn"]] == (len(r["prompt_text"]), r["mode"]) for r in whole)


def test_digests_of_texts_do_not_depend_on_their_cuts():
    text = "a漢é🤦" * 300
    for (a, _), (b, m) in zip(prompts.text_digest(text), prompts.DIGEST):
        h = 0
        for c in text:
            h = (h * b + ord(c)) % m
        assert a == h
    for cut in (0, 1, 700, len(text)):
        for (a, p), (b, q), (c, r), (_, m) in zip(prompts.text_digest(text[:cut]), prompts.text_digest(text[cut:]), prompts.text_digest(text), prompts.DIGEST):
            assert (a * q + b) % m == c and p * q % m == r


def test_a_long_conversation_is_many_tasks(spark):
    turns = spark.range(200_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.concat(F.lit("turn "), F.col("id").cast("string")).alias("text"), (F.col("id") % 5).alias("n_feats"), F.when(F.col("id") == 150_000, "r.wav").alias("ref_audio"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a local run would have its small partitions in one task
    try:
        got = prompts.merge_prompts(turns)
        parts = got.where("turn % 50000 = 49999").orderBy("turn").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r["prompt_chars"] for r in parts] == [sum(5 + len(str(i)) for i in range(n)) for n in (50_000, 100_000, 150_000, 200_000)]
    assert [(r["prompt_feats"], r["mode"]) for r in parts] == [(2 * n, "ref_continuation" if n == 200_000 else "continuation") for n in (50_000, 100_000, 150_000, 200_000)]
    (a, _), (b, _) = prompts.text_digest("".join(f"turn {i}" for i in range(200_000)))
    assert parts[-1]["prompt_hash"] == (a << 31) + b
    assert got.select(F.spark_partition_id()).distinct().count() > 1


def test_features_lie_in_one_track(spark):
    turns = spark.createDataFrame([(1, 0, "a", 2, None), (1, 1, "b", 0, None), (1, 2, "c", 3, None), (2, 0, "d", 1, None)], "conv_id bigint, turn int, text string, n_feats int, ref_audio string")
    feats = spark.createDataFrame([(c, t, i, [float(10 * t + i)]) for c, t, n in ((1, 0, 2), (1, 2, 3), (2, 0, 1)) for i in range(n)], "conv_id bigint, turn int, i int, values array<double>")
    got = sorted(map(tuple, prompts.prompt_features(turns, feats).collect()))
    assert got == [(1, 0, [0.0]), (1, 1, [1.0]), (1, 2, [20.0]), (1, 3, [21.0]), (1, 4, [22.0]), (2, 0, [0.0])]


def _wav(chunks: int, seconds: int = 1) -> bytes:
    import struct

    data = b"\0" * 32000 * seconds
    more = b"".join(b"LIST" + struct.pack("<I", 3) + b"abc\0" for _ in range(chunks))
    return b"RIFF" + struct.pack("<I", 36 + len(more) + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16) + more + b"data" + struct.pack("<I", len(data)) + data


def test_media_headers_are_walked_to_the_end(spark):
    rows = [("a", bytearray(_wav(20))), ("b", bytearray(_wav(300, 2))), ("c", bytearray(_wav(20)[:200])), ("d", None), ("e", bytearray(b"RIFF....WAVE"))]
    got = {r["path"]: r for r in media_catalog(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert [(got[k]["frames"], got[k]["readable"]) for k in "abcde"] == [(16000, True), (32000, True), (None, False), (None, False), (None, False)]
    assert got["b"]["duration"] == 2.0 and got["d"]["bytes"] is None


MEDIA = "path string, frames bigint, sample_rate int, readable boolean, duration double"


def test_repeated_media_and_clashing_columns(spark):
    manifest = spark.createDataFrame([(1, "a", "x.wav", None, "p", 7, "v"), (2, "b", "x.wav", "x.wav", "q", 8, "w"), (3, "c", None, None, None, None, None)], "sample_id bigint, text string, audio string, ref_audio string, path string, frames bigint, valid string").drop("valid")
    media = spark.createDataFrame([("x.wav", 0, 16000, True, 0.0), ("x.wav", 100, 16000, True, 1.0), ("x.wav", 500, 8000, False, 1.0), (None, 1, 1, True, 1.0)], MEDIA)
    rows = validation.checked(manifest, media)
    assert sorted(tuple(r) for r in rows.select("sample_id", "valid", "ref", "path").collect()) == [(1, True, None, "p"), (2, True, "ok", "q"), (3, False, None, None)]
    assert validation.summary(rows).first()["total"] == 3
    assert validation.manifest_media_join(manifest, media).count() == 3 and validation.missing_media(manifest, media).count() == 1 and validation.rows_with_ref(manifest, media).count() == 1


def test_a_manifest_from_lines_to_report(spark):
    raw = ['{"text": "a b", "audio": "x.wav"}', "not json", '{"text": "a"}', *['{"text": "", "audio": "gone.wav"}'] * 30]
    lines = spark.createDataFrame(list(enumerate(raw, 1)), "line_no bigint, raw string")
    media = spark.createDataFrame([("/data/x.wav", 100, 16000, True, 1.0)], MEDIA)
    rows = validation.validate_manifest(lines, media, "/data")
    assert validation.summary(rows).first().asDict() == {"total": 33, "valid": 1, "with_ref": 0, "n_errors": 8, "n_warnings": 6, "found_errors": 32, "found_warnings": 30, "is_valid": False}
    capped = validation.findings_capped(validation.findings(rows)).where("more is not null").collect()
    assert sorted((r["category"], r["more"]) for r in capped) == [("blank_text", 25), ("media", 25)]
    full = validation.full_report(rows).collect()
    assert not [r for r in full if r["item"] == "omitted"]
    assert [(r["item"], r["sample_id"], r["value"]) for r in full if r["section"] == "error"] == [("invalid_json", 2, None), ("missing_key", 3, None), *[("media", i, None) for i in range(4, 9)], ("media", None, 25.0)]
    assert [(r["item"], r["sample_id"], r["value"]) for r in full if r["section"] == "warning"] == [*[("blank_text", i, None) for i in range(4, 9)], ("blank_text", None, 25.0)]
    assert {r["item"]: r["value"] for r in full if r["section"] == "report"}["mean_duration"] == 1.0
    assert validation.summary(validation.validate_manifest(lines, media, "/data", 2)).first()["total"] == 2
    none = validation.summary(validation.validate_manifest(lines.limit(0), media)).first()
    assert (none["total"], none["is_valid"]) == (0, False)


def test_vocabulary_is_looked_up_or_joined(spark):
    tokens = spark.createDataFrame([(1, ["a", "b", "zz", "a"]), (2, []), (3, None), (None, ["b"]), (4, ["b", None, ""]), (4, ["a"] * 50)], "key bigint, tokens array<string>").repartition(2)
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("", 9)], "token string, id int")
    expected = sorted([(1, [1, 2, 0, 1]), (2, []), (None, [2]), (4, [2, 0, 9]), (4, [1] * 50)], key=repr)
    for most, block in ((1000, 1_000_000), (1, 1_000_000), (1, 3), (1, 1)):
        got = [(r["key"], r["ids"]) for r in lengths.vocab_encode(tokens, vocab, 0, most, block).collect()]
        assert sorted([x for x in got if x[0] != 3], key=repr) == expected and [x[1] for x in got if x[0] == 3] == [[]]
    assert lengths.vocab_encode(tokens, vocab.limit(0)).where("key = 1").first()["ids"] == [0, 0, 0, 0]
    assert lengths.vocab_encode(tokens.limit(0), vocab, 0, 1).collect() == []


def test_a_hot_token_crosses_once_per_block(spark):
    words = [f"w{i}" for i in range(50)]
    tokens = spark.createDataFrame([(i, ["the"] * 500 + [words[i % 50], "never"]) for i in range(400)], "key bigint, tokens array<string>").repartition(4)
    vocab = spark.createDataFrame([("the", 7), *((w, 100 + i) for i, w in enumerate(words))], "token string, id int")
    got = lengths.vocab_encode(tokens, vocab, 0, 1, 20_000)
    assert sorted((r["key"], r["ids"]) for r in got.collect()) == [(i, [7] * 500 + [100 + i % 50, 0]) for i in range(400)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") == 2
    blocks = 400 * 502 // 20_000 + 4 + 1
    heads = [r for r in got._jdf.queryExecution().analyzed().toString().splitlines() if "Generate posexplode" in r]
    assert len(heads) == 1 and blocks < 20  # one row per block and distinct token meets the vocabulary


def test_budget_report(spark):
    df = spark.createDataFrame([("train", 5), ("train", 50), ("validation", 90)], "split string, length int")
    assert tuple(lengths.budget_report(df, 40, 4).first()) == (2, 1, 10) and tuple(lengths.budget_report(df, 0, 4).first()) == (2, 0, None)
    assert lengths.select_kept(df, 50).count() == 2


def test_aligners_by_name_and_strict(spark):
    audio = spark.createDataFrame([("1", "a b"), ("2", "c")], "audio string, text string")

    def fails(a, t):
        if a == "2":
            raise OSError("no audio")
        return [{"text": t, "start": 0.0, "end": 1.0, "level": "segment"}]

    alignment.ALIGNERS["own"] = fails
    try:
        got = {r["audio"]: (len(r["items"]), r["warning"]) for r in alignment.aligned(audio, "own").collect()}
        assert got == {"1": (1, None), "2": (0, "no audio")}
        with pytest.raises(Exception, match="no audio"):
            alignment.aligned(audio, "own", strict=True).collect()
        with pytest.raises(ValueError, match="unknown aligner"):
            alignment.aligned(audio, "other")
    finally:
        del alignment.ALIGNERS["own"]


def test_sidecars_are_written(spark, tmp_path):
    items = spark.createDataFrame([("a.wav", 0, "é", 0.0, 1.0, "segment")], "audio string, pos int, text string, start double, end double, level string")
    alignment.write_sidecars(alignment.alignment_record(items, "stable_ts", "segment"), str(tmp_path / "out"))
    assert spark.read.option("multiLine", "true").json(str(tmp_path / "out" / "a.timestamps.json")).first()["items"][0]["text"] == "é"


def test_streams_keep_null_keys(spark):
    rows = spark.createDataFrame([(None, "a", "x.wav", None), (1, "b", "y.wav", None), (2, "c", "x.wav", None)], "sample_id bigint, text string, audio string, ref_audio string")
    media = spark.createDataFrame([("x.wav", 100, 16000, True, 1.0)], MEDIA)
    got = streams.replayed(rows, lambda x: streams.stream_checked(x, media), "sample_id")
    assert sorted((str(r["sample_id"]), r["valid"]) for r in got.collect()) == [("1", False), ("2", True), ("None", True)]


def test_long_tail_without_a_mark_is_quick(spark):
    import time

    long = spark.range(1).select(F.concat(F.lit("A b. "), F.repeat(F.lit("word "), 200_000)).alias("x"))
    t = time.time()
    assert long.select(split_utterances(F.col("x"), "en").alias("u")).first()["u"] == ["A b."] and time.time() - t < 20


def test_rules_that_need_more_than_the_request(spark):
    row = ("hi", None, None, None, "p.txt", None, "auto", "v2", 2.0, 10, 0, 1.0, 0.5)
    schema = "request_id bigint, text string, control string, prompt_audio string, prompt_text string, prompt_file string, reference_audio string, command string, arch string, cfg double, steps int, rank int, alpha double, dropout double"
    r = spark.createDataFrame([(1, *row), (2, *row[:4], None, *row[5:10], 4, 1.0, 0.0)], schema)
    files = spark.createDataFrame([("other.txt",)], "prompt_file string")
    got = {x["request_id"]: x["broken"] for x in requests.request_findings(r, files).collect()}
    assert got == {1: ["prompt_text_without_audio", "prompt_file_missing", "adapter_range"], 2: []}


def test_windows_cross_blocks(spark, monkeypatch):
    rows = spark.range(97).select((F.col("id") % 2).alias("clip_id"), F.floor(F.col("id") / 2).alias("idx"), (F.col("id") * 0.5).alias("value")).repartition(5)
    own = tables.in_blocks
    monkeypatch.setattr(signal, "in_blocks", lambda df, *keys, before: own(df, *keys, before=before, size=7))
    values = {c: [v / 2 for v in range(c, 97, 2)] for c in (0, 1)}
    got = {(r["clip_id"], r["idx"]): r["context"] for r in signal.context_tail(rows, 4).collect()}
    assert got == {(c, i): values[c][max(0, i - 3) : i + 1] for c in values for i in range(len(values[c]))}
    sums = {(r["clip_id"], r["idx"]): r["value"] for r in signal.causal_window(rows, [0.25, 0.5, 1.0]).collect()}
    assert sums == {(c, i): sum(w * x for w, x in zip([0.25, 0.5, 1.0], ([0, 0] + values[c])[i : i + 3])) for c in values for i in range(len(values[c]))}


def test_manifests_that_are_absent_or_empty(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text("")
    (tmp_path / "m.jsonl").write_text("{}\n")
    assert [manifest_error(spark, str(tmp_path / x)) for x in ("no.jsonl", "e.jsonl", "m.jsonl")] == ["not_found", "empty", None]


def test_reports_list_in_order_and_count_what_is_left_out(spark):
    raw = [*['{"text": "a", "audio": "long.wav", "ref_audio": "no.wav"}'] * 8, *["{}"] * 12, '{"text": "", "audio": "gone.wav", "ref_audio": "no.wav"}']
    lines = spark.createDataFrame(list(enumerate(raw, 1)), "line_no bigint, raw string").repartition(3)
    media = spark.createDataFrame([("long.wav", 100, 16000, True, 31.0)], MEDIA)
    found = validation.findings(validation.checked(lines, media))
    got = validation.top_findings(found).collect()
    listed = [(r["severity"], r["sample_id"], r["category"]) for r in got if r["omitted"] is None]
    assert listed == [("error", i, "missing_key") for i in range(9, 19) for _ in range(2)] + [("warning", i, c) for i in range(1, 6) for c in ("very_long", "ref_missing")]
    assert [(r["severity"], r["omitted"]) for r in got if r["omitted"] is not None] == [("error", 5), ("warning", 8)]


def test_media_are_met_in_one_exchange_without_texts(spark, tmp_path):
    spark.createDataFrame([(i, f"text {i}", f"{i}.wav", f"{i + 1}.wav" if i % 2 else None) for i in range(50)], "sample_id bigint, text string, audio string, ref_audio string").write.parquet(str(tmp_path / "m"))
    manifest = spark.read.parquet(str(tmp_path / "m"))
    media = spark.createDataFrame([(f"{i}.wav", 100, 16000, True, 1.0) for i in range(0, 50, 3)], MEDIA)
    rows = validation.checked(manifest, media).select("sample_id", "media_error", "band", "blank_text", "ref", "valid")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len([x for x in exchanges if "_path#" in x and "_m_path" not in x]) == 1 and len([x for x in plan.splitlines() if "SortMergeJoin" in x]) == 1
    assert " text#" not in plan[: plan.index("Exchange hashpartitioning(_path#")]
    expected = {i: ("ok" if i % 3 == 0 else None) for i in range(50)}
    assert all((r["media_error"] is None) == (expected[r["sample_id"]] == "ok") and r["ref"] == (None if r["sample_id"] % 2 == 0 else "ok" if (r["sample_id"] + 1) % 3 == 0 and r["sample_id"] < 49 else "missing") for r in rows.collect())


def test_rows_that_share_an_id_are_checked_each(spark):
    manifest = spark.createDataFrame([(1, "a", "x.wav", "x.wav"), (1, "", "y.wav", None), (None, "c", None, "y.wav"), (None, "d", "x.wav", "")], "sample_id bigint, text string, audio string, ref_audio string")
    media = spark.createDataFrame([("x.wav", 100, 16000, True, 1.0)], MEDIA)
    got = sorted(map(tuple, validation.checked(manifest, media).select("text", "media_error", "blank_text", "ref", "valid").collect()))
    assert got == [("", "not_found", True, None, False), ("a", None, False, "ok", True), ("c", "not_found", False, "missing", False), ("d", None, False, None, True)]


def test_a_level_clip_is_all_voice_at_zero_decibels(spark):
    rows = spark.createDataFrame([(c, i, v) for c, v in ((1, 0.5), (2, 0.0)) for i in range(40)] + [(3, i, 0.0 if i < 20 else 0.5) for i in range(40)], "clip_id bigint, idx bigint, value double")
    got = signal.silence_trim(rows, 10, 0, 0.0, 4, 4).groupBy("clip_id").agg(F.min("idx"), F.max("idx"))
    assert sorted(map(tuple, got.collect())) == [(1, 0, 39), (2, 0, 39), (3, 20, 39)]


def test_the_seed_of_the_attempt_that_counts(spark):
    rows = [(1, i + 1, f, 10, 7) for i, f in enumerate([60, 61, 59])] + [(2, i + 1, 60, 10, 40) for i in range(3)] + [(3, 1, 5, 10, None)]
    got = requests.attempt_resolution(spark.createDataFrame(rows, "request_id int, attempt int, frames int, target_len int, seed bigint"))
    assert {r["request_id"]: (r["attempt"], r["seed"]) for r in got.collect()} == {1: (3, 9), 2: (3, 42), 3: (1, None)}


def test_a_batch_keeps_its_failures(spark):
    lines = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i bigint, text string")
    made = spark.createDataFrame([(1, 1.5, None), (3, None, "no audio")], "i bigint, duration double, error string")
    results = requests.batch_results(lines, made)
    assert tuple(requests.batch_ledger(results).first()) == (3, 1, 2)
    assert sorted(map(tuple, requests.batch_failures(results).collect())) == [(2, "Failed on line 2: no result"), (3, "Failed on line 3: no audio")]
    assert requests.batch_failures(results.limit(0)).collect() == []


def test_datasets_of_each_batch(spark):
    rows = spark.createDataFrame([(1, 0), (1, 4), (2, None), (3, -1), (4, 1)], "batch_id bigint, dataset_id int")
    assert {r["batch_id"]: r["n"] for r in lengths.dataset_count_by_batch(rows, 2).collect()} == {1: 5, 2: 2, 3: 2, 4: 2}
    assert {r["batch_id"]: r["n"] for r in lengths.dataset_count_by_batch(rows, 0).collect()} == {1: 5, 2: 1, 3: 1, 4: 2}


def test_texts_of_an_empty_file_are_an_error(spark, tmp_path):
    (tmp_path / "e.txt").write_text(" \n\n\t\n")
    with pytest.raises(ValueError, match="has no text"):
        read_text_lines(spark, str(tmp_path / "e.txt"))


def test_the_context_with_which_generation_begins(spark):
    rows = spark.createDataFrame([(1, [0, 1, 1, 0, 1, 1, 1]), (2, [0, 1, 1, 0]), (3, []), (4, None), (5, [1]), (6, [0, 0])], "key int, mask array<int>")
    got = {r["key"]: r["at"] for r in rows.select("key", nested.context_before(F.col("mask"), 4).alias("at")).collect()}
    assert got == {1: [4, 5, 6], 2: [], 3: [], 4: [], 5: [0], 6: []}
    assert rows.where("key = 1").select(nested.context_before(F.col("mask"), 6).alias("at")).first()["at"] == [1, 2, 4, 5, 6]
    assert rows.where("key = 1").select(nested.context_before(F.col("mask"), 1).alias("at")).first()["at"] == []


def _counted(folder):
    """A maker of things that leave a file for each time they are made and closed."""

    class Counted:
        def __init__(self):
            self.name = uuid.uuid4().hex
            (Path(folder) / f"made-{os.getpid()}-{self.name}").touch()

        def __call__(self, *args):
            return [[len(t)] for t in args[0]] if len(args) == 1 else [{"text": args[1], "start": 0.0, "end": 1.0, "level": "segment"}]

        def close(self):
            (Path(folder) / f"closed-{os.getpid()}-{self.name}").touch()

    return Counted


def test_a_hook_is_made_once_in_a_worker(spark, tmp_path):
    folder = str(tmp_path)
    texts = spark.range(400).select(F.col("id").cast("string").alias("audio"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text")).repartition(8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        hook = PerWorker(_counted(folder))
        for _ in range(2):
            assert {tuple(r["text_ids"]) for r in lengths.tokenized(texts, hook).collect()} == {(2,), (3,), (4,)}
        made = [p.name.split("-")[1] for p in tmp_path.glob("made-*")]
        assert 1 <= len(made) == len(set(made)) and not list(tmp_path.glob("closed-*"))  # however many batches, tasks and jobs
        assert alignment.aligned(texts, PerWorker(_counted(folder), keep=False)).where("warning is null").count() == 400
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(list(tmp_path.glob("made-*"))) - len(made) == len(list(tmp_path.glob("closed-*"))) == 8  # once a task


def test_hooks_are_closed_when_others_take_their_place(monkeypatch, tmp_path):
    monkeypatch.setattr(hooks, "_MADE", type(hooks._MADE)())
    own = [PerWorker(_counted(str(tmp_path))) for _ in range(hooks.MOST_MADE + 2)]
    for hook in own:
        with hook as a, hook as b:
            assert a is b
    assert len(list(tmp_path.glob("closed-*"))) == 2 and len(hooks._MADE) == hooks.MOST_MADE
    with pytest.raises(OSError), PerWorker(_counted(str(tmp_path)), keep=False):
        raise OSError("lost")
    assert len(list(tmp_path.glob("closed-*"))) == 4  # one more had to go, and the failed task's own
    hooks._close_all()
    assert len(list(tmp_path.glob("closed-*"))) == len(list(tmp_path.glob("made-*")))


def test_packs_of_utterances(spark):
    def packed(utts, max_n, min_n, merge_len):
        done, cur = [], ""
        for u in utts:
            if len(cur + u) > max_n and len(cur) > min_n:
                done.append(cur)
                cur = u
            else:
                cur += u
        if cur and len(cur) < merge_len and done:
            done[-1] += cur
        elif cur:
            done.append(cur)
        return done

    rng = random.Random(2)
    rows = [(i, ["x" * rng.randint(0, 12) for _ in range(rng.randint(0, 30))], ) for i in range(200)] + [(200, []), (201, [""]), (202, ["", ""]), (203, ["abc"])]
    df = spark.createDataFrame(rows, "key int, utts array<string>")
    for sizes in ((20, 10, 5), (8, 0, 3), (30, 25, 40)):
        got = {r["key"]: r["p"] for r in df.select("key", pack_utterances(F.col("utts"), F.length, *sizes).alias("p")).collect()}
        assert got == {k: packed(u, *sizes) for k, u in rows}
