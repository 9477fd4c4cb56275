"""Media files: a catalogue read from RIFF headers, without the audio."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalake.sources.listing import list_tree, opened

#: Bytes that are read at once around a chunk's header, and chunks that are walked before the data: a file with more isn't readable.
WINDOW, MOST_CHUNKS = 512, 4096


def _reversed(b: Column) -> Column:
    return F.unhex(F.array_join(F.reverse(F.regexp_extract_all(F.hex(b), F.lit(".."), F.lit(0))), ""))


def header(read: Callable[[int, int], bytes], size: int) -> tuple[int | None, int | None]:
    """frames, sample_rate of a RIFF file of so many bytes: its chunks are walked by their sizes up to the data; nulls where that doesn't end well.

    read(at, n) gives n bytes at a place, fewer at the end. Only headers are read, `WINDOW` bytes at a time.
    """
    start, window = 0, b""

    def some(at: int, n: int) -> bytes:
        nonlocal start, window
        if not start <= at <= at + n <= start + len(window):
            start, window = at, read(at, max(n, WINDOW))
        return window[at - start : at - start + n]

    top = some(0, 12)
    if top[:4] != b"RIFF" or top[8:12] != b"WAVE":
        return None, None
    rate = align = None
    at = 12
    for _ in range(MOST_CHUNKS):
        if at + 8 > size:
            break
        name, n = (x := some(at, 8))[:4], int.from_bytes(x[4:8], "little")
        if name == b"fmt " and at + 24 <= size:
            fmt = some(at + 8, 16)
            rate, align = int.from_bytes(fmt[4:8], "little"), int.from_bytes(fmt[12:14], "little")
        if name == b"data":
            return (min(n, size - at - 8) // align if align else None), rate
        at += 8 + n + n % 2
    return None, rate


def _facts(rows: DataFrame) -> DataFrame:
    return rows.select("path", "bytes", "frames", F.col("sample_rate").cast("int").alias("sample_rate"), (F.col("frames") / F.nullif("sample_rate", F.lit(0))).alias("duration"), F.col("frames").isNotNull().alias("readable"))


_KINDS = "path string, bytes bigint, frames bigint, sample_rate bigint"


def _batch(paths: pa.Array, sizes: pa.Array, facts: list[tuple]) -> pa.RecordBatch:
    frames, rates = zip(*facts) if facts else ((), ())
    return pa.record_batch([paths, sizes, pa.array(frames, pa.int64()), pa.array(rates, pa.int64())], ["path", "bytes", "frames", "sample_rate"])


def media_catalog(files: DataFrame) -> DataFrame:
    """path, bytes, frames, sample_rate, duration, readable of files that a table holds (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column("content").to_pylist()
            yield _batch(batch.column("path"), batch.column("bytes"), [header(lambda at, n, c=c: c[at : at + n], len(c)) if c is not None else (None, None) for c in contents])

    return _facts(files.select("path", "content", F.octet_length("content").cast("bigint").alias("bytes")).mapInArrow(run, _KINDS))


def read_media_catalog(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The same of all files under a folder whose place in it fits the pattern (* also over folders): listed by levels, then only headers are read, in as many tasks as there are files.

    path is the folder's with the file's place in it. A file that can't be opened has null facts and isn't readable.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(path)

        def facts(place: str, size: int | None) -> tuple[int | None, int | None]:
            try:
                with store.open_input_file(f"{top.rstrip('/')}/{place}") as f:
                    return header(lambda at, n: f.read_at(max(0, min(n, f.size() - at)), at), size if size is not None else f.size())
            except OSError:
                return None, None

        for batch in batches:
            places, sizes = batch.column("place").to_pylist(), batch.column("bytes").to_pylist()
            own = [i for i, p in enumerate(places) if fnmatchcase(p, pattern)]
            yield _batch(pa.array([f"{path.rstrip('/')}/{places[i]}" for i in own], pa.string()), pa.array([sizes[i] for i in own], pa.int64()), [facts(places[i], sizes[i]) for i in own])

    place = F.concat_ws("/", F.nullif("dir", F.lit("")), "name").alias("place")
    return _facts(list_tree(spark, path).where("not is_dir").select(place, "bytes").repartition("place").mapInArrow(run, _KINDS))


def wav_bytes(frames: Column, rate: Column) -> Column:
    """A silent mono PCM16 file, made with byte expressions."""
    le = lambda n, k: _reversed(F.unhex(F.lpad(F.hex(n.cast("bigint")), 2 * k, "0")))
    lit = lambda b: F.lit(b)
    data = 2 * frames
    return F.concat(lit(b"RIFF"), le(data + 36, 4), lit(b"WAVEfmt "), le(F.lit(16), 4), le(F.lit(1), 2), le(F.lit(1), 2), le(rate, 4), le(rate * 2, 4), le(F.lit(2), 2), le(F.lit(16), 2), lit(b"data"), le(data, 4), F.unhex(F.repeat(F.lit("0"), (2 * data).cast("int"))))
