"""Fill-in-the-middle over chunks that are counted once.

A document is cut into a prefix, a middle and a suffix at places given in units (code points), and written with marks
around them. To find those places without walking through every text, its UTF-8 bytes are cut into chunks where a rolling
hash of the last bytes says so, so equal passages give equal chunks wherever they stand. What is known of a chunk is kept
in a bounded cache under its length and two of its rolling hashes, and used only if the bytes are the same: its number of
units, the bytes at its edges, and whether a mark is in it. A unit that two chunks share is counted by the one that has
its first byte; a mark that two chunks share shows in the bytes kept from their edges. Sums of the counts give the chunk
that holds a cut, and only that one is walked through.

Defined cases: a null or empty text has no units and stays plain, as an empty text; a text that has a mark in it stays
plain; rows that share an id are cut at the same hashes, each by its own length; a null id counts as the empty string; an
empty table gives no rows; other columns are left alone, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalake.llm.common import by_parts, table
from vocalake.tables import spread

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of a hundred documents: how many are rearranged, and how many of those with the suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20
#: Bits of the hash that are 0 where a chunk ends (about 1 kB apart), and bounds of its length in bytes.
ENDS, LEAST, MOST = 10, 256, 8192
#: Bytes of chunks that a task keeps.
KEPT = 64_000_000
_GEAR = np.random.default_rng(1).integers(0, 1 << 32, 256, np.uint32)
_EDGE = len(PREFIX) - 1


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash of the last 32 bytes at each byte (fewer at the start): sums of shifted numbers, doubled up from one byte to 32."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)
    return h


def chunk_ends(h: np.ndarray, ends: int = ENDS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of chunks of a text, by its rolling hashes: where the top bits are 0, at least `least` and at most `most` bytes apart."""
    out, start, n = [], 0, len(h)
    for end in (np.flatnonzero(h >> np.uint32(32 - ends) == 0) + 1).tolist():
        while end - start > most:
            start += most
            out.append(start)
        if end - start >= least:
            out.append(end)
            start = end
    while n - start > most:
        start += most
        out.append(start)
    return [*out, n] if n > start else out


class Chunks:
    """Summaries of chunks by content, at most `most` bytes of them: a cache, results never depend on it."""

    def __init__(self, most: int = KEPT):
        self.most, self.held, self.known, self.found, self.asked = most, 0, {}, 0, 0

    def summary(self, key: int, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        """(units that begin in the chunk, a mark lies in it, its first bytes, its last bytes); key: a hash of the chunk."""
        self.asked += 1
        known = self.known.get(key)
        if known is not None and known[0] == chunk:
            self.found += 1
            return known[1]
        out = (units(chunk), any(m in chunk for m in (PREFIX, SUFFIX, MIDDLE)), chunk[:_EDGE], chunk[-_EDGE:])
        if self.held + len(chunk) > self.most:
            self.known.clear()
            self.held = 0
        self.held += len(chunk) - (len(known[0]) if known is not None and self.held else 0)
        self.known[key] = (chunk, out)
        return out


def units(chunk: bytes) -> int:
    """Code points whose first byte is in the chunk."""
    return len(chunk) if chunk.isascii() else int(np.count_nonzero(np.frombuffer(chunk, np.uint8) & 0xC0 != 0x80))


def place_of(chunk: bytes, unit: int) -> int:
    """Place of the first byte of a unit (from 0) that begins in the chunk."""
    return unit if chunk.isascii() else int(np.flatnonzero(np.frombuffer(chunk, np.uint8) & 0xC0 != 0x80)[unit])


class Counted:
    """A text's chunks with running counts."""

    def __init__(self, text: bytes, chunks: Chunks):
        self.text, self.marked = text, False
        h = rolling(np.frombuffer(text, np.uint8))
        self.ends = chunk_ends(h)
        counts, start, tail = [], 0, b""
        for end in self.ends:
            # The last hash of a chunk covers its last 32 bytes; with length and a hash in its middle it rarely stands for two chunks.
            key = int(h[end - 1]) << 32 | int(h[(start + end) // 2]) ^ (end - start)
            n, marked, first, last = chunks.summary(key, text[start:end])
            counts.append(n)
            self.marked |= marked or any(m in tail + first for m in (PREFIX, SUFFIX, MIDDLE))
            tail, start = (tail + last)[-_EDGE:], end
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        self.n = int(self.before[-1])

    def place(self, unit: int) -> int:
        """Bytes before a unit; the text's length for the one after the last."""
        if unit >= self.n:
            return len(self.text)
        k = int(np.searchsorted(self.before, unit, "right")) - 1
        start = self.ends[k - 1] if k else 0
        return start + place_of(self.text[start : self.ends[k]], unit - int(self.before[k]))


def form(text: bytes, doc_id, chunks: Chunks) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, units of the prefix and of the middle, the text in that form)."""
    if not text:
        return 0, "plain", None, None, text
    c = Counted(text, chunks)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))
    if c.marked or h3 % 100 >= REARRANGED:
        return c.n, "plain", None, None, text
    a, b = sorted((h1 % (c.n + 1), h2 % (c.n + 1)))
    i, j = c.place(a), c.place(b)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if h4 % 100 < SUFFIX_FIRST:
        return c.n, "spm", a, b - a, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return c.n, "psm", a, b - a, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output (the text in that form) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, names = Chunks(), ("n", "form", "prefix_chars", "middle_chars", "output")
        for batch in by_parts(batches):
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            rows = [form(t or b"", k, chunks) for k, t in zip(batch.column("doc_id").to_pylist(), raw, strict=True)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds, strict=True)]
            yield pa.record_batch([batch.column("doc_id"), *columns[:4], columns[4].cast(pa.string())], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that was brought in this form: no rearranged text has marks of its own."""
    part = F.split(output, "<[PSM]>")
    return F.when(F.col(form) == "psm", F.concat(part[1], part[3], part[2])).when(F.col(form) == "spm", F.concat(part[2], part[3], part[1])).otherwise(F.col(output))


def op11_fill_middle(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, text, length(text)::BIGINT AS n, [('0x' || h[1 + 8 * i : 8 + 8 * i])::BIGINT FOR i IN range(4)] AS h FROM h),
f AS (SELECT *, CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b FROM u),
p AS (SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m, substring(text, b + 1, n - b) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
 sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""
