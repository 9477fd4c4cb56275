"""Byte-level BPE encoding and decoding by a two-tier lookup.

Tier one: a minimal perfect hash (hash and displace) over the vocabulary gives the one entry that a pre-token can equal,
and one comparison tells whether it does. Tier two: other pre-tokens are merged with a heap of adjacent pairs over a
linked list of their bytes. Vocabulary and hash are built on the driver from the file at `path` and broadcast; their size
is that of the file. Workers keep what they resolved for runs of text between single spaces in a bounded cache.

Defined cases: null and empty texts have no tokens; strings that look like special tokens are ordinary text; repeated
rows give repeated results; other columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from vocalake.llm.common import Memo, by_parts, table, texts

VOCABULARY = "byte_bpe_50k.tiktoken"


class PerfectHash:
    """Maps each of n distinct keys to its own number below n."""

    def __init__(self, keys: list[bytes]):
        self.n, self.m = len(keys), max(1, len(keys) // 3)
        buckets: list[list[int]] = [[] for _ in range(self.m)]
        for key in keys:
            h = xxhash.xxh3_64_intdigest(key)
            buckets[h % self.m].append(h)
        taken, self.shift = bytearray(self.n), [0] * self.m
        for b in sorted(range(self.m), key=lambda b: -len(buckets[b])):
            d = 0
            while buckets[b]:
                slots = {self._slot(h, d) for h in buckets[b]}
                if len(slots) == len(buckets[b]) and not any(taken[s] for s in slots):
                    for s in slots:
                        taken[s] = 1
                    break
                d += 1
            self.shift[b] = d

    def _slot(self, h: int, d: int) -> int:
        return (((h >> 20) * (2 * d + 1)) ^ (h >> 7) + d) % self.n

    def __call__(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        return self._slot(h, self.shift[h % self.m])


class Codec:
    """Ranks of a vocabulary; ids of a text as little-endian unsigned 32-bit integers, and back."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.pattern = pattern
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.hash = PerfectHash(list(self.ranks))
        self.slots: list[tuple[bytes, int]] = [(b"", -1)] * len(self.ranks)
        for key, rank in self.ranks.items():
            self.slots[self.hash(key)] = (key, rank)
        self.words = {rank: key for key, rank in self.ranks.items()}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("find", "chunks", "pieces")}

    def ready(self) -> Codec:
        """With what a worker keeps between batches."""
        if not hasattr(self, "find"):
            self.find = regex.compile(self.pattern).findall
            self.pieces = Memo(self.of_piece, 300_000)
            self.chunks = Memo(self.of_chunk, 500_000)
        return self

    def of_piece(self, piece: str) -> bytes:
        key = piece.encode()
        found, rank = self.slots[self.hash(key)]
        return rank.to_bytes(4, "little") if found == key else self.merged(key)

    def merged(self, key: bytes) -> bytes:
        """Tier two: the pair of lowest rank, leftmost first, is merged until no adjacent pair is in the vocabulary."""
        n, ranks = len(key), self.ranks
        end = list(range(1, n + 1))  # of the part that begins here; 0 where none begins
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(key[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(key[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := ranks.get(key[before[i] : stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[key[i : end[i]]].to_bytes(4, "little"))
            i = end[i]
        return b"".join(out)

    def of_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(chunk)))

    #: A space with white space on both sides; elsewhere, no match of the pattern crosses the place before a single space.
    unsafe = regex.compile(r"\s \s")

    def encode(self, text: str) -> bytes:
        if " " not in text or self.unsafe.search(text):
            return self.of_chunk(text)
        first, *rest = text.split(" ")
        return b"".join(map(self.chunks.__getitem__, [first, *map(" ".__add__, rest)]))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec(df: DataFrame, path: str | None, pattern: str | None):
    return df.sparkSession.sparkContext.broadcast(Codec(path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) of each document."""
    codec = _codec(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.value.ready()
        for batch in by_parts(batches):
            ids = [np.frombuffer(c.encode(x), "<u4").astype(np.int32) for x in texts(batch)]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of what `encode` gave; bytes that aren't UTF-8 become U+FFFD."""
    codec = _codec(encoded, path, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.value
        for batch in batches:
            out = [c.decode(np.asarray(x or [], "<u4").tobytes()).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(out, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes that they decode to."""
    codec = _codec(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.value.ready()
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in by_parts(batches):
            ids = [c.encode(x) for x in texts(batch)]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([sha(x) for x in ids], pa.string()), "decoded_sha256": pa.array([sha(c.decode(x)) for x in ids], pa.string()),
            })

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
