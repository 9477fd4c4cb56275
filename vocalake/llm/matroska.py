"""Media columns: Matroska files as packet tables.

`packets` parses files held in a binary column: variable-length EBML elements, clusters (of known and unknown size),
simple blocks and block groups, Xiph, EBML and fixed-size lacing, and gives one row per packet with track, timestamp and
byte range; `cues` gives the index. `mux` writes 8-bit PCM samples as such a file. Each file is handled within its task;
only tables of packets leave it.

Defined cases: a null file is an empty one; a file that ends within an element gives the packets before it and `damaged`
true; frames of one lace share the timestamp of their block; null and empty texts have the payload of 64 zero bytes; equal
texts give equal files; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vocalake.llm.common import by_parts, table, texts

# Fixed values of the format: element ids.
EBML, SEGMENT, INFO, TIMESTAMP_SCALE, TRACKS, TRACK_ENTRY = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x2AD7B1, 0x1654AE6B, 0xAE
TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, AUDIO, RATE, CHANNELS, DEPTH = 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
VERSIONS = ((0x4286, 1), (0x42F7, 1), (0x42F2, 4), (0x42F3, 8))
DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ = 0x4282, 0x4287, 0x4285
SEGMENT_PARTS = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367, 0xEC, 0xBF}

SAMPLE_RATE, FRAME, LACED, BLOCKS = 8000, 1024, 8, 16


def _size(n: int) -> bytes:
    width = next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * width).to_bytes(width, "big")


def _element(kind: int, body: bytes | int | float | str) -> bytes:
    if isinstance(body, int):
        body = body.to_bytes(max(1, (body.bit_length() + 7) // 8), "big")
    elif isinstance(body, float):
        body = struct.pack(">d", body)
    elif isinstance(body, str):
        body = body.encode("ascii")
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + _size(len(body)) + body


def _lace(frames: list[bytes]) -> tuple[int, bytes]:
    """Flags and content of a block: fixed-size lacing for frames of one length, EBML lacing for others."""
    if len(frames) == 1:
        return 0, frames[0]
    head = bytes([len(frames) - 1])
    if len({len(f) for f in frames}) == 1:
        return 0x04, head + b"".join(frames)
    sizes = _size(len(frames[0]))
    for a, b in zip(frames, frames[1:-1]):
        d = len(b) - len(a)
        width = next(w for w in range(1, 9) if abs(d) < 1 << 7 * w - 1)
        sizes += (d + (1 << 7 * width - 1) - 1 | 1 << 7 * width).to_bytes(width, "big")
    return 0x06, head + sizes + b"".join(frames)


def mux(samples: bytes) -> bytes:
    """A file with one track of unsigned 8-bit mono PCM, and a cue for each cluster."""
    head = b"".join(_element(k, v) for k, v in VERSIONS) + _element(DOC_TYPE, "matroska") + _element(DOC_TYPE_VERSION, 4) + _element(DOC_TYPE_READ, 2)
    audio = _element(RATE, float(SAMPLE_RATE)) + _element(CHANNELS, 1) + _element(DEPTH, 8)
    track = _element(TRACK_NUMBER, 1) + _element(TRACK_UID, 1) + _element(TRACK_TYPE, 2) + _element(CODEC_ID, "A_PCM/INT/LIT") + _element(AUDIO, audio)
    parts = [_element(INFO, _element(TIMESTAMP_SCALE, 1_000_000)), _element(TRACKS, _element(TRACK_ENTRY, track))]
    position, points, step = sum(map(len, parts)), [], FRAME * LACED
    for first in range(0, len(samples), step * BLOCKS):
        began = first * 1000 // SAMPLE_RATE
        cluster = [_element(TIMESTAMP, began)]
        for at in range(first, min(first + step * BLOCKS, len(samples)), step):
            flags, body = _lace([samples[i : i + FRAME] for i in range(at, min(at + step, len(samples)), FRAME)])
            cluster.append(_element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", at * 1000 // SAMPLE_RATE - began, 0x80 | flags) + body))
        points.append(_element(CUE_POINT, _element(CUE_TIME, began) + _element(CUE_POSITIONS, _element(CUE_TRACK, 1) + _element(CUE_CLUSTER, position))))
        parts.append(_element(CLUSTER, b"".join(cluster)))
        position += len(parts[-1])
    return _element(EBML, head) + _element(SEGMENT, b"".join([*parts, _element(CUES, b"".join(points))]))


class Cut(ValueError):
    """The file ends within an element."""


def _number(data: bytes, at: int, keep: bool = False) -> tuple[int, int, int]:
    """Value, width and place after a variable-length number; keep: with its length marker (an id)."""
    if at >= len(data) or not data[at]:
        raise Cut
    width = 9 - data[at].bit_length()
    if at + width > len(data):
        raise Cut
    n = int.from_bytes(data[at : at + width], "big")
    return (n if keep else n & (1 << 7 * width) - 1), width, at + width


def elements(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(id, place of the element, begin and end of its content) within the range; unknown sizes end at the next part of a segment, or with the range."""
    while at < end:
        kind, _, a = _number(data, at, keep=True)
        n, width, a = _number(data, a)
        if n == (1 << 7 * width) - 1:
            b = end
            if kind == CLUSTER:
                for k, place, _, _ in elements(data, a, end):
                    if k in SEGMENT_PARTS - {0xEC, 0xBF}:
                        b = place
                        break
        else:
            b = a + n
        if b > len(data):
            yield kind, at, a, len(data)
            raise Cut
        yield kind, at, a, b
        at = b


def frames(data: bytes, a: int, b: int) -> tuple[int, int, bool, list[tuple[int, int]]]:
    """Track, relative timestamp, key frame, and the byte range (begin, length) of each frame of a block."""
    track, _, at = _number(data, a)
    if at + 3 > b:
        raise Cut
    relative, flags = struct.unpack_from(">hB", data, at)
    at += 3
    lacing, n = flags & 0x06, 1
    if lacing:
        n, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if lacing == 0x02:
        for _ in range(n - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    elif lacing == 0x06:
        for i in range(n - 1):
            v, width, at = _number(data, at)
            sizes.append(sizes[-1] + v - (1 << 7 * width - 1) + 1 if i else v)
    elif lacing == 0x04:
        sizes = [(b - at) // n] * (n - 1)
    sizes.append(b - at - sum(sizes))
    if min(sizes) < 0:
        raise Cut
    out = []
    for s in sizes:
        out.append((at, s))
        at += s
    return track, relative, bool(flags & 0x80), out


def parse(data: bytes) -> tuple[list[tuple], list[tuple], bool]:
    """Packets (track, timestamp in ns, key frame, offset, length, lace, cluster offset), cues (timestamp in ns, track, cluster offset), damaged."""
    packets: list[tuple] = []
    cues: list[tuple] = []
    uint = lambda a, b: int.from_bytes(data[a:b], "big")
    scale = 1_000_000
    try:
        for kind, _, a0, b0 in elements(data, 0, len(data)):
            if kind != SEGMENT:
                continue
            for kind, at, a, b in elements(data, a0, b0):
                if kind == INFO:
                    scale = next((uint(x, y) for k, _, x, y in elements(data, a, b) if k == TIMESTAMP_SCALE), scale)
                elif kind == CUES:
                    for _, _, x, y in elements(data, a, b):
                        point = list(elements(data, x, y))
                        when = next((uint(p, q) for k, _, p, q in point if k == CUE_TIME), 0)
                        for k, _, p, q in point:
                            if k == CUE_POSITIONS:
                                found = {k: uint(u, v) for k, _, u, v in elements(data, p, q)}
                                cues.append((when * scale, found.get(CUE_TRACK, 0), a0 + found.get(CUE_CLUSTER, 0)))
                elif kind == CLUSTER:
                    began = 0
                    for k, _, x, y in elements(data, a, b):
                        if k == TIMESTAMP:
                            began = uint(x, y)
                        for p, q in [(x, y)] if k == SIMPLE_BLOCK else [(p, q) for k, _, p, q in elements(data, x, y) if k == BLOCK] if k == BLOCK_GROUP else ():
                            track, relative, key, found = frames(data, p, q)
                            packets += [(track, (began + relative) * scale, key, u, n, i, at) for i, (u, n) in enumerate(found)]
    except (Cut, IndexError, struct.error):
        return packets, cues, True
    return packets, cues, False


PACKETS = "track int, timestamp_ns bigint, key_frame boolean, offset bigint, length bigint, lace int, cluster_offset bigint"


def _exploded(files: DataFrame, key: str, media: str, which: int, schema: str) -> DataFrame:
    kind = files.schema[key].dataType
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x in zip(batch.column(0), batch.column(1), strict=True):
                got = parse(x.as_py() or b"")
                if got[which]:
                    rows = list(zip(*got[which], strict=True))
                    yield pa.record_batch([pa.array([k.as_py()] * len(rows[0]), batch.column(0).type), *(pa.array(c) for c in rows), pa.array([got[2]] * len(rows[0]))], [key, *names, "damaged"]).cast(
                        pa.schema([(key, batch.column(0).type), *((n, {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}[t.split()[1]]) for n, t in zip(names, schema.split(", "))), ("damaged", pa.bool_())])
                    )

    return files.select(key, media).mapInArrow(run, f"`{key}` {kind.simpleString()}, {schema}, damaged boolean")


def packets(files: DataFrame, key: str = "path", media: str = "content") -> DataFrame:
    """One row per packet of each file (such as Spark's binaryFile source gives)."""
    return _exploded(files, key, media, 0, PACKETS)


def cues(files: DataFrame, key: str = "path", media: str = "content") -> DataFrame:
    """One row per cue: timestamp, track, and the place of its cluster in the file."""
    return _exploded(files, key, media, 1, "timestamp_ns bigint, track int, cluster_offset bigint")


def stored_text(text: str) -> tuple[int, bytes]:
    """Length in UTF-8, and the text with zero bytes up to a positive multiple of 64."""
    raw = text.encode()
    return len(raw), raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")


def digests(docs: DataFrame) -> DataFrame:
    """Texts stored as samples of a file each, read back by its packet table; digests and features of what was read."""

    def one(text: str) -> tuple:
        n, payload = stored_text(text)
        media = mux(payload)
        rows, index, damaged = parse(media)
        if damaged:
            raise ValueError("a file that was just written can't be read")
        back = b"".join(media[r[3] : r[3] + r[4]] for r in rows)
        samples = np.frombuffer(back, np.uint8)
        level = np.abs(samples.astype(np.int16) - 128)
        feature = f"packets={len(rows)};clusters={len({r[6] for r in rows})};cues={len(index)};last_ms={rows[-1][1] // 1_000_000};mean={samples.mean():.4f};peak={level.max()};level={level.mean():.4f}"
        return n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = zip(*(x.split() for x in DIGESTS.split(", ")[1:]), strict=True)
        for batch in by_parts(batches):
            columns = zip(*map(one, texts(batch)), strict=True)
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64() if t == "bigint" else pa.string()) for c, t in zip(columns, kinds))], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, DIGESTS)


DIGESTS = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def op10_matroska(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
