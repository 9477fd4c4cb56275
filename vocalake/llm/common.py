"""What the operators share: tables, the labelled split, durable intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalake.tables import stored  # noqa: F401  (for the operators, too)

#: ASCII white space: what separates words in every operator here.
SPACES = " \t\n\x0b\x0c\r"
SPACES_RE = r"[ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no label may be learned from: crc32 of the id as text, modulo 5, is 0. Not a null id, which no label has."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A batch's texts, null as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def by_parts(batches: Iterator[pa.RecordBatch], name: str = "text", most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text at most (or one row), so that memory stays bounded."""
    for batch in batches:
        lengths = [len(x) if x is not None else 0 for x in batch.column(name).cast(pa.binary()).to_pylist()] if batch.nbytes > most else [0] * batch.num_rows
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def groups(batches: Iterator[pa.RecordBatch], names: list[str], least: int, weight) -> Iterator[list[np.ndarray]]:
    """Columns of whole groups of the first name (rows come sorted by it), some groups at a time: `least` in weight, or what is left."""
    held: list[list] = []
    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
        total += weight(held[-1])
        if total >= least:
            rows = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))
            if cut:
                yield [c[:cut] for c in rows]
            held = [[c[cut:] for c in rows]]
            total = weight(held[0])
    if held:
        rows = [np.concatenate(c) for c in zip(*held)]
        if len(rows[0]):
            yield rows


def pieces(batches: Iterator[pa.RecordBatch], names: list[str], most: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    """As `groups`, about `most` rows at a time, but a group of more rows than that comes in pieces, which are marked."""
    held: list[np.ndarray] | None = None
    large = None

    def out(rows: list[np.ndarray], last: bool):
        nonlocal held, large
        if large is not None:
            end = int(np.searchsorted(rows[0], large, "right"))
            if end:
                yield [c[:end] for c in rows], True
            rows = [c[end:] for c in rows]
            large = large if not len(rows[0]) else None
        cut = len(rows[0]) if last else int(np.searchsorted(rows[0], rows[0][-1], "left")) if len(rows[0]) else 0
        if cut:
            yield [c[:cut] for c in rows], False
        held = [c[cut:] for c in rows]
        if len(held[0]) > most:
            large = held[0][0]
            yield held, True
            held = [c[:0] for c in held]

    waiting: list[list[np.ndarray]] = []
    total = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            total += batch.num_rows
        if total >= most:
            yield from out([np.concatenate(c) for c in zip(*([held] if held else []), *waiting)], False)
            waiting, total = [], 0
    if held or waiting:
        yield from out([np.concatenate(c) for c in zip(*([held] if held else []), *waiting)], True)


class Memo(dict):
    """A dict that fills itself by `make` and starts anew when it holds `most` entries; only a cache, results never depend on it."""

    def __init__(self, make, most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value
