"""Packing by shortest-pack-first over the length histogram.

Documents are tokenized and cut once, in their own tasks: whole sequences first, then what is left is cut at multiples
of `grain` so that it fits in with others. The histogram of piece lengths (at most `size` numbers) goes to the driver,
which places lengths longest first into the shortest open pack that has room, keeping only the number of packs of each
pattern. Pieces get their place by rank: rank among the pieces of one length -> range of a pattern -> sequence, offset.
Ranks come from counts by length and salt, so no task holds a length that a third of the pieces have.

Defined cases: a null or empty text is the end id alone; an empty table has no pieces; rows that share a doc_id are each
packed whole; ties go by doc_id, start, digest; what a text spells as a special token of the tokenizer is that token, as
the tokenizer has it by default; other columns are left alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vocalake.llm.common import Memo, by_parts, stored, table, texts

TOKENIZER, END_ID = "word_bpe_49k.json", 1
SIZE, GRAIN = 2048, 256
#: Rows for each rank counter, about.
ROWS_A_SALT = 1_000_000


class WordTokenizer:
    """Ids of whole texts. The tokenizer drops white space and joins nothing across it, so runs between spaces can be cached.

    Most runs are Latin letters with ASCII marks after them, which it always parts; the letters then go to its model as
    they are after its own steps (lower case, bytes as letters), and are cached without regard to case and marks. All
    other runs go through all of its steps.
    """

    simple = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)").fullmatch

    def __init__(self, path: str):
        with open(path) as f:
            self.spec = f.read()

    def __getstate__(self) -> dict:
        return {"spec": self.spec}

    def ready(self) -> WordTokenizer:
        if not hasattr(self, "chunks"):
            self.tokenizer = Tokenizer.from_str(self.spec)
            self.model = self.tokenizer.model
            # How byte-level tokenizers write bytes: printable Latin-1 as itself, the others in order from U+0100 on.
            shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
            self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
            self.chunks = Memo(self.of_chunk, 900_000)
        return self

    def of_any(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def of_word(self, word: str) -> bytes:
        spelt = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt)])

    def of_chunk(self, chunk: str) -> bytes:
        m = self.simple(chunk)
        if m is None:
            return self.of_any(chunk) if chunk else b""
        word, marks = m.groups()
        low = word.lower()
        if not marks:
            return self.of_word(low) if low == word else self.chunks[low]
        return self.chunks[low] + self.chunks[marks]

    def ids(self, text: str) -> bytes:
        """A text's ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


def cuts(n: int, size: int = SIZE, grain: int = GRAIN) -> list[int]:
    """Lengths of the pieces of a document of n ids: whole sequences, a multiple of the grain, the rest."""
    whole, rest = divmod(n, size)
    left = rest % grain
    return [size] * whole + [x for x in (rest - left, left) if x]


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE, grain: int = GRAIN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece."""
    tokenizer = docs.sparkSession.sparkContext.broadcast(WordTokenizer(path or public_tokenizers.path(TOKENIZER)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, end = tokenizer.value.ready(), END_ID.to_bytes(4, "little")
        for batch in by_parts(batches):
            rows = []
            for k, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                ids, start = t.ids(text) + end, 0
                for n in cuts(len(ids) // 4, size, grain):
                    rows.append((k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), len(ids) // 4))
                    start += n
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 5, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """(packs, lengths in one pack): shortest pack first. Open packs are kept by the room they have left."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    closed = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            free = max((r for r in room if r >= length), default=None)
            if free is None:
                packs, pattern = left, ()
            else:
                packs, pattern = room[free].pop()
                if packs > left:
                    room[free].append((packs - left, pattern))
                    packs = left
                if not room[free]:
                    del room[free]
            left -= packs
            rest = (size if free is None else free) - length
            if rest:
                room.setdefault(rest, []).append((packs, (*pattern, length)))
            else:
                closed.append((packs, (*pattern, length)))
    return closed + [x for xs in room.values() for x in xs]


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: the pieces of a length from that rank on go to consecutive sequences from that one on."""
    rows, used, sequence = [], {}, 0
    for packs, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + packs
            offset += length
        sequence += packs
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def ranked(rows: DataFrame, n: int) -> DataFrame:
    """rows (with _spread, a number that tells some copies of a row apart) with their rank (from 0) among those of the same length: counts by length and salt, then a window within each."""
    salts = max(64, n // ROWS_A_SALT)
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start", "_spread"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("length", "_salt").agg(F.count("*").alias("_n")).select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32")
    out = rows.withColumn("_rank", F.row_number().over(within) - 1).join(offsets, ["length", "_salt"])
    return out.withColumn("rank", F.col("_rank") + F.col("_before")).drop("_rank", "_before", "_salt", "_spread")


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, grain: int = GRAIN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece."""
    rows = stored(pieces(docs, path, size, grain).withColumn("_spread", F.pmod(F.monotonically_increasing_id(), F.lit(1024))))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    at = docs.sparkSession.sparkContext.broadcast(places(plan(histogram, size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, names = at.value, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        key = rows[:, 0] * (1 << 50) + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(key, length * (1 << 50) + rank, "right") - 1
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(rows[k, 2] + rank - rows[k, 1]), pa.array(rows[k, 3])], [*names, "sequence_id", "offset"])

    kinds = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ranked(rows, sum(histogram.values())).mapInArrow(run, kinds)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
