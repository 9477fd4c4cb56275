"""A worker that aligns hands its rows over by the size of their items."""

import pyarrow as pa

from vocalake.operators import alignment as A


def test_items_are_handed_over_by_their_size(spark, monkeypatch):
    tasks = []
    frames = type(spark.range(1))
    real = frames.mapInArrow
    monkeypatch.setattr(frames, "mapInArrow", lambda self, f, schema: tasks.append(f) or real(self, f, schema))
    words = lambda audio, text: [{"text": w, "start": 0.0, "end": 1.0, "level": "word"} for w in text.split(" ")]
    A.aligned(spark.createDataFrame([("a", "b c")], "audio string, text string"), words)
    monkeypatch.setattr(A, "BATCH_CHARS", 10_000)
    batch = pa.record_batch([pa.array([str(i) for i in range(200)]), pa.array(["w " * 50] * 200)], ["audio", "text"])
    out = list(tasks[0](iter([batch])))
    assert sum(b.num_rows for b in out) == 200 and len(out) > 20
    assert [a for b in out for a in b.column("audio").to_pylist()] == [str(i) for i in range(200)]
    assert max(sum(map(len, b.column("items").to_pylist())) for b in out) < 20_000
