"""Removal of long repeated byte strings with a run-length index.

A byte goes if a string of `LENGTH` bytes that covers it also starts earlier: in a document of smaller id, or earlier in
the same one. Steps:

1. `strings`: every window of LENGTH bytes is filed under its minimizer (the smallest hash of its 32-grams); maximal
   runs of windows with one minimizer are strings of about 140 bytes. Equal windows have equal minimizers, so they meet.
   Of equal strings a task sends on `FEW` between two looks, the earliest, and reports the others as repeats itself.
2. `sorted_out`: strings are dealt by minimizer. All of a minimizer that has several are asked for. Of minimizers with
   more than `HOT` strings nothing is decided here: they pass through, never held at once.
3. `index_repeats`: the strings asked for are dealt by minimizer. Over about a megabyte of them at a time, a
   Burrows-Wheeler transform is built from the dictionary of their distinct strings and run-length compressed (strings
   equal as a whole share an entry, so equality joins them, and the transform finds what differing strings share). The ends
   of its runs are sampled: a place in the text, its lexicographic predecessor, and their common prefix. From these
   samples alone, matching statistics of the text are streamed: of each place, the predecessor and the length of the
   match with it (one less for each step from the sample on). Matches of LENGTH or more chain equal windows; a class's
   first place is the earliest over all strings that the dictionary's entries stand for, and all others are removals.
   Strings of hot minimizers are dealt anew, window by window, by the window's own hash: equal windows still meet, of
   which a task sends on the first of each batch only, so a group has a row per batch at most.
4. `with_removals`: back to the documents.

With `whole_first`, strings that repeat as a whole are settled by their hashes in steps 1 and 2 and only the others are
asked for: less to move and to index, and the same results.

Defined cases: null and empty texts have no bytes; texts shorter than LENGTH keep theirs; a null id comes before all
others; rows that share an id count as one document with several texts: only a smaller id, or an earlier start, is
"earlier", and each text keeps its own marks (32 bits of a hash tell texts of one id apart); the id -2^63 counts as null;
other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vocalake.llm.common import by_parts, groups, pieces, stored, table

LENGTH, GRAM = 100, 32
#: Bytes of text in one numpy pass, of strings in one index, strings between two looks for repeats in a task.
PASS, INDEX, LOOK = 1_500_000, 1_000_000, 1_500_000
#: Strings under one minimizer (about a megabyte) beyond which it is split; bytes of a window's hash; rows in one look at sorted strings.
HOT, DIGEST, ROWS = 7_000, 16, 200_000
#: Equal strings that a task sends on of those between two looks; it reports the others itself, so that no minimizer is dealt a large share of all rows.
FEW = 16
#: A place is 31 bits of position (no text is longer in Spark), and above them 32 bits that tell texts of one id apart.
PLACE = (1 << 31) - 1


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """doc, twin, text and the columns."""
    twin = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 32)
    return docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), twin.alias("twin"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"), *columns)


def _minimizers(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram at each place, and for each of the window starts, the place of the leftmost smallest one in it."""
    h, step, power = data.astype(np.uint64), 1, np.array([0x9E3779B97F4A7C15], np.uint64)
    while step < GRAM:
        h = h[:-step] * power + h[step:]
        step, power = step * 2, power * power
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    low = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    width, have = LENGTH - GRAM + 1, 1
    while have < width:
        step = min(have, width - have)
        low, have = np.minimum(low[:-step], low[step:]), have + step
    return h, (low[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)


def _runs(batch: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of the strings of some texts: owner, position in it, windows, minimizer hash, hash of the string."""
    parts = [(i, a, t[a : a + (8 << 20) + LENGTH - 1]) for i, t in enumerate(batch) for a in range(0, len(t) - LENGTH + 1, 8 << 20)]
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    out = []
    group: list[tuple[int, int, bytes]] = []
    for k, part in enumerate(parts):
        group.append(part)
        if k + 1 == len(parts) or sum(len(x) for _, _, x in group) + len(parts[k + 1][2]) > PASS:
            lengths = np.array([len(x) for _, _, x in group])
            ends = np.cumsum(lengths)
            raw = b"".join(x for _, _, x in group)
            windows = lengths - LENGTH + 1
            first = np.repeat(ends - lengths, windows)
            offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            h, place = _minimizers(np.frombuffer(raw, np.uint8), first + offset)
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (offset[1:] == 0)
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(place)))
            a = (first + offset)[at]
            of = np.repeat(np.arange(len(group)), windows)[at]
            whole = [xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(a.tolist(), (a + n + LENGTH - 1).tolist())]
            owner, base = np.array([g[0] for g in group]), np.array([g[1] for g in group])
            out.append((owner[of], base[of] + offset[at], n, h[place[at]].view(np.int64), np.array(whole, np.uint64).view(np.int64)))
            group = []
    return tuple(np.concatenate(c) for c in zip(*out))


def _first_of(keys: list[np.ndarray]) -> np.ndarray:
    """Whether a row differs from the one before in any of the (sorted) keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _chained(doc: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings, those that follow one another without a gap as one: a text of one repeated letter isn't a row for each of them."""
    order = np.lexsort((place, doc))
    doc, place, n = doc[order], place[order], n[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + n[:-1])
    at = np.flatnonzero(new)
    last = np.append(at, len(doc))[1:] - 1
    return doc[at], place[at], place[last] + n[last] - place[at]


FOUND = "doc bigint, place bigint, windows int, mini bigint, whole bigint, again boolean"


def strings(docs: DataFrame, whole_first: bool = False) -> DataFrame:
    """One row per string: doc, place, windows, minimizer, hash, and whether the task holds an earlier one (then the minimizer only spreads rows; only if `whole_first`)."""

    def settle(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, place, n, mini, whole = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((place, place & PLACE, doc, whole, mini))
        doc, place, n, mini, whole = (c[order] for c in (doc, place, n, mini, whole))
        head = np.maximum.accumulate(np.where(_first_of([mini, whole]), np.arange(len(doc)), 0))
        again = (np.arange(len(doc)) - head >= (1 if whole_first else FEW)) & ((doc != doc[head]) | (place & PLACE != place[head] & PLACE))
        d, p, k = _chained(doc[again], place[again], n[again])
        on = ~again
        rows = zip((doc[on], place[on], n[on], mini[on], whole[on]), (d, p, k, d * 31 + p, np.zeros_like(d)))
        rows = [np.concatenate(c) for c in rows]
        rows[2] = rows[2].astype(np.int32)
        return pa.record_batch([*map(pa.array, rows), pa.array(np.arange(len(rows[0])) >= on.sum())], ["doc", "place", "windows", "mini", "whole", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in by_parts(batches):
            owner, at, n, mini, whole = _runs(batch.column("text").to_pylist())
            if len(owner):
                doc, twin = (batch.column(c).to_numpy()[owner] for c in ("doc", "twin"))
                held.append((doc, twin << 31 | at, n, mini, whole))
                count += len(owner)
            if count >= LOOK:
                yield settle(held)
                held, count = [], 0
        if held:
            yield settle(held)

    return keyed(docs).mapInArrow(run, FOUND)


def _pieces(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[list[np.ndarray], bool]]:
    return pieces(batches, names, ROWS)


def sorted_out(found: DataFrame, whole_first: bool = False) -> DataFrame:
    """doc, place, windows, mini, remove: removals (whole strings seen earlier, if `whole_first`), strings asked for, and those of hot minimizers (remove is null)."""
    names = ["mini", "doc", "place", "windows", "whole", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (mini, doc, place, n, whole, again), large in _pieces(batches, names):
            _, group, count = np.unique(mini, return_inverse=True, return_counts=True)
            hot = ~again & (large | (count[group] > HOT))
            done, rest = again, ~again & ~hot
            rows = [c[rest] for c in (mini, whole, doc, place, n)]
            order = np.lexsort((rows[3], rows[3] & PLACE, rows[2], rows[1], rows[0]))
            m, w, d, p, k = (c[order] for c in rows)
            new = _first_of([m, w]) if whole_first else np.ones(len(m), bool)
            head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0)) if len(new) else np.zeros(0, np.int64)
            later = (d != d[head]) | (p & PLACE != p[head] & PLACE)
            group = np.cumsum(_first_of([m])) - 1 if len(m) else m
            kinds = np.bincount(group, weights=new) if len(m) else np.zeros(0)
            ask = ~later & (kinds[group] > 1) if len(m) else new[:0]
            out = [np.concatenate([a[done], b[later], b[ask], a[hot]]) for a, b in ((doc, d), (place, p), (n, k), (mini, m))]
            kind = np.repeat(np.arange(3), [len(out[0]) - int(ask.sum()) - int(hot.sum()), int(ask.sum()), int(hot.sum())])
            yield pa.record_batch([*(pa.array(c) for c in out), pa.array(kind == 0, mask=kind == 2)], ["doc", "place", "windows", "mini", "remove"])

    return found.repartition("mini").sortWithinPartitions("mini").select(*names).mapInArrow(run, "doc bigint, place bigint, windows int, mini bigint, remove boolean")


class RunLengthIndex:
    """Samples at the ends of the runs of a text's Burrows-Wheeler transform."""

    def __init__(self, text: bytes, least: int = LENGTH):
        """least: matches shorter than that need not be told from none."""
        n = self.n = len(text)
        padded = np.frombuffer(text + b"\0" * 8, np.uint8)
        key = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(">u8").ravel().astype(np.uint64)
        order = np.argsort(key)
        head = _first_of([key[order]])
        place = np.empty(n, np.int64)
        place[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        levels, step = [], 8
        while True:  # suffixes that agree so far are told apart by what follows `step` bytes on
            tied = np.flatnonzero(~(head & np.append(head[1:], True)))
            if not len(tied):
                break
            levels.append((step, place.copy()))
            own = order[tied]
            further = own + step
            after = np.where(further < n, place[np.minimum(further, n - 1)], n - 1 - further)  # what ends is smaller, and sooner smaller still
            group = place[own]
            by = np.argsort(group * (2 * n + 1) + after + n)
            own, after = own[by], after[by]
            order[tied] = own
            head[tied] |= _first_of([group, after])
            place[own] = np.maximum.accumulate(np.where(head[tied], tied, 0))
            step *= 2
        before = padded[order - 1].astype(np.int16)
        before[order == 0] = -1
        heads = np.flatnonzero(_first_of([before]))
        self.runs = len(heads)
        #: Of each run's first suffix: its place, that of the suffix sorted before it, and their common prefix (0 if below `least`).
        self.place, self.previous, self.common = order[heads], order[heads - 1], np.zeros(len(heads), np.int64)
        rough = max((x for x in levels if x[0] <= least), key=lambda x: x[0], default=None)
        if rough:
            long = np.flatnonzero((rough[1][self.place] == rough[1][self.previous]) & (heads > 0))
            a, b, common = self.place[long], self.previous[long], np.zeros(len(long), np.int64)
            for step, at in [*reversed(levels), *[(1, padded)] * 8]:
                same = (a < n) & (b < n)
                same[same] = at[a[same]] == at[b[same]]
                a[same] += step
                b[same] += step
                common[same] += step
                if step == 1:
                    a[~same] = n
            self.common[long] = np.where(common >= least, common, 0)

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each place of the text: where the suffix sorted before it begins, and the length of the match with it (exact from `least` on)."""
        sample = np.zeros(self.n, np.int64)
        at = np.full(self.n, -1)
        at[self.place] = np.arange(len(self.place))
        began = np.maximum.accumulate(np.where(at >= 0, np.arange(self.n), 0))
        sample = at[began]
        gone = np.arange(self.n) - began
        return self.previous[sample] + gone, self.common[sample] - gone


def repeats(texts: list[bytes], doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of all places of the texts, joined with a zero byte after each: whether a window begins there that an earlier text or place has.

    Equal texts have one entry in the dictionary that the index is built of, as their suffixes would lie side by side in its runs: of them all, the
    first in order (doc, place) says how early a window is."""
    seen: dict[bytes, int] = {}
    entry = np.array([seen.setdefault(t, len(seen)) for t in texts])
    where = place & PLACE
    order = np.lexsort((where, doc, entry))
    first = order[_first_of([entry[order]])]  # of each entry
    sizes = np.array([len(t) + 1 for t in seen])
    starts = np.cumsum(sizes) - sizes
    back, match = RunLengthIndex(b"\0".join(seen) + b"\0").statistics()
    n = int(sizes.sum())
    owner = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(n) - starts[owner]
    # Classes of equal windows: matches chain each window to those sorted before it.
    link = np.arange(n)
    long = np.flatnonzero(match >= LENGTH)
    link[long] = back[long]
    while len(long):
        further = link[link[long]]
        if (further == link[long]).all():
            break
        link[long] = further
    met = np.union1d(long, link[long])
    met = met[offset[met] <= sizes[owner[met]] - 1 - LENGTH]  # a text may hold zero bytes, so that a match may run over an end
    own = first[owner[met]]
    by = np.lexsort((where[own] + offset[met], doc[own], link[met]))
    met = met[by]
    new = _first_of([link[met]])
    head = np.arange(n)
    head[met] = met[np.maximum.accumulate(np.where(new, np.arange(len(met)), 0))] if len(met) else met
    # Back to all texts.
    lengths = sizes[entry]
    ends = np.cumsum(lengths)
    text = np.repeat(np.arange(len(texts)), lengths)
    inner = np.arange(len(text)) - (ends - lengths)[text]
    valid = inner <= lengths[text] - 1 - LENGTH
    text, inner = text[valid], inner[valid]
    earliest = head[starts[entry[text]] + inner]
    source = first[owner[earliest]]
    out = np.zeros(len(valid), bool)
    out[valid] = (doc[source] != doc[text]) | (where[source] + offset[earliest] != where[text] + inner)
    return out


def _hot_windows(rows: list[tuple[int, int, bytes]]) -> tuple:
    """Of the windows of some strings (doc, place, bytes): mini (of the hash), doc, place, hash of the first of equal ones, and those that repeat one, as runs with an empty hash."""
    n = np.array([len(t) - LENGTH + 1 for _, _, t in rows])
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    doc, place = np.repeat([r[0] for r in rows], n), np.repeat([r[1] for r in rows], n) + offset
    digest = np.array([xxhash.xxh3_128_digest(t[i : i + LENGTH]) for _, _, t in rows for i in range(len(t) - LENGTH + 1)], f"V{DIGEST}")
    first, again = _first_windows(digest.view(">u8").reshape(-1, 2), doc, place)
    d, p, k = _spans(doc[again], place[again])
    key = digest[first].view("<i8")[::2]
    joined = (np.concatenate(c) for c in ((key, d * 31 + p), (doc[first], d), (place[first], p)))
    return *joined, [*map(bytes, digest[first]), *[b""] * len(d)], np.concatenate([np.ones(len(first), np.int64), k])


def _first_windows(key: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of windows that come first among those of equal key (as do all that begin at the same place), and of the others."""
    order = np.lexsort((place, place & PLACE, doc, key[:, 1], key[:, 0]))
    k, d, p = key[order], doc[order], place[order] & PLACE
    head = np.maximum.accumulate(np.where(_first_of([k[:, 0], k[:, 1]]), np.arange(len(k)), 0))
    again = (d != d[head]) | (p != p[head])
    return order[~again], order[again]


def _spans(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, place, windows of runs of windows, each beginning a byte after the one before."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > 1)
    at = np.flatnonzero(new)
    last = np.append(at, len(doc))[1:] - 1
    return doc[at], place[at], place[last] - place[at] + 1


def index_repeats(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """doc, place, windows of further removals, from the strings asked for and those of hot minimizers."""
    wanted = asked.withColumn("twin", F.shiftright("place", 31)).groupBy("doc", "twin").agg(F.collect_list(F.struct("place", "windows", "mini", F.col("remove").isNull().alias("hot"))).alias("asked"))
    kind = "mini bigint, doc bigint, place bigint, bytes binary, windows int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(columns) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()))], ["mini", "doc", "place", "bytes", "windows"])

        for batch in by_parts(batches):
            rows, hot = [], []
            for d, t, x in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "asked"))):
                for q in x:
                    own = t[(a := q["place"] & PLACE) : a + q["windows"] + LENGTH - 1]
                    if q["hot"]:
                        hot.append((d, q["place"], own))
                    else:
                        rows.append((q["mini"], d, q["place"], own, q["windows"]))
            if rows:
                yield packed(zip(*rows))
            for i in range(0, len(hot), HOT):
                yield packed(_hot_windows(hot[i : i + HOT]))

    cuts = keyed(docs).join(wanted, ["doc", "twin"]).select("doc", "text", "asked").mapInArrow(cut, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(*columns) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32()))], ["doc", "place", "windows"])

        for mini, doc, place, text, n in groups(batches, ["mini", "doc", "place", "bytes", "windows"], INDEX, lambda c: sum(map(len, c[3])) + DIGEST * len(c[3])):
            size = np.array([len(t) for t in text])
            if (size == 0).any():
                yield packed(doc[size == 0], place[size == 0], n[size == 0])
            own = size == DIGEST
            if own.any():
                d, p = doc[own], place[own]
                _, again = _first_windows(np.frombuffer(b"".join(text[own]), ">u8").reshape(-1, 2), d, p)
                yield packed(*_spans(d[again], p[again]))
            mini, doc, place, text = (c[size >= LENGTH] for c in (mini, doc, place, text))
            if not len(text):
                continue
            order = np.lexsort((place, place & PLACE, doc, mini))
            doc, place, text = doc[order], place[order], text[order]
            marked = repeats(text.tolist(), doc, place)
            lengths = np.array([len(t) + 1 for t in text])
            starts = np.cumsum(lengths) - lengths
            edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.view(np.int8), [0]])))
            a, b = edge[::2], edge[1::2]
            of = np.searchsorted(starts, a, "right") - 1
            yield packed(doc[of], place[of] + a - starts[of], (b - a).astype(np.int32))

    return cuts.repartition("mini").sortWithinPartitions("mini").mapInArrow(run, "doc bigint, place bigint, windows int")


def with_removals(docs: DataFrame, *columns: str, whole_first: bool = False) -> DataFrame:
    """doc, twin, text (bytes), removed (array of place and windows; null if none) and the columns, for each row of docs.

    whole_first: whether strings that repeat as a whole are settled by their hashes before the index sees them; results are the same."""
    known = stored(sorted_out(strings(docs, whole_first), whole_first))
    more = stored(index_repeats(docs, known.where("remove is null or not remove")))
    marks = known.where("remove").select("doc", "place", "windows").unionByName(more)
    grouped = marks.withColumn("twin", F.shiftright("place", 31)).groupBy("doc", "twin").agg(F.collect_list(F.struct(F.col("place").bitwiseAND(PLACE).alias("at"), "windows")).alias("removed"))
    return keyed(docs, *columns).join(grouped, ["doc", "twin"], "left")


def spans(removed: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal removed ranges of bytes."""
    out: list[list[int]] = []
    for a, b in sorted((r["at"], r["at"] + r["windows"] + LENGTH - 1) for r in removed or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(text: bytes, cut: list[tuple[int, int]]) -> bytes:
    ends = [0, *(x for s in cut for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))


def _whole_characters(text: bytes, cut: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges without characters that they cover in part."""
    out = []
    for a, b in cut:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with what repeats removed from text (whole characters only); a text of which nothing is left stays as an empty one, a null one stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_parts(batches):
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "removed", "_null")))
            out = [None if null else without(t, _whole_characters(t, spans(r))).decode("utf-8", "replace") for t, r, null in rows]
            yield pa.record_batch([batch.column("_row"), pa.array(out, pa.string())], ["_row", "text"])

    row = docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("_row"), F.col("text").isNull().alias("_null"))
    out = with_removals(row, "_row", "_null").select("_row", "text", "removed", "_null")
    kind = StructType([out.schema["_row"], StructField("text", StringType())])
    return out.mapInArrow(run, kind).select(*["text" if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])


def op7_run_length_index(spark, sf_dir: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_parts(batches):
            rows = []
            for k, t, r in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "removed"))):
                cut = spans(r)
                rows.append((k, len(t), sum(b - a for a, b in cut), len(cut), hashlib.sha256(without(t, cut)).hexdigest()))
            if rows:
                yield pa.record_batch([pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(zip(*rows))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    out = with_removals(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text", "removed")
    return out.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
