"""Exact similarity join of documents by the Jaccard similarity of their word n-grams.

Steps, each a Spark job whose result is a table:

1. `profiles`: size and a 128-bit signature of each document's set. Documents with equal sets are one class; from here
   on one representative stands for each class, so copies are never paired.
2. `frequencies`: how often each n-gram occurs, folded to a bounded number of cells (a byte each, broadcast). It orders
   n-grams, rarest first; any total order gives the same links, a good one gives short lists.
3. `prefixes`, `candidates`: by the prefix filter, two linked sets share an n-gram among the rarest few of each. Sets
   meet in the lists of these n-grams, where pairs must pass the length, positional and suffix filters (the suffix filter
   compares counts of both sets within fixed ranges of hashes). What passes is united in the task, and only a forest of
   each list leaves it. Sets that the forests connect are a cluster: linked sets always are, most documents have none.
4. `joined`: the sets of a cluster of at most `BLOCK` members meet in one task; there, pairs that share a prefix n-gram
   pass the same filters, and each is verified once on whole sets, unless both are known to be connected already. Again
   a forest leaves the task, never all pairs of a group. Larger clusters are dealt by a hash into blocks of about that
   size, by bands of sizes, of which only neighbours can link. First each block by itself, and a few members of each,
   which connects what is alike without pairs of blocks; what is still apart after that meets in pairs of blocks, but
   never two blocks of one component. So no link is lost, and near copies in great numbers cost as
   many blocks as they fill.
5. Components of the links, and back to all documents by class. Classes, not ids, are what is linked, so an id may have
   several texts.

Defined cases: a null or empty text, or one without words, has an empty set and is its own component; a text with fewer
words than n has its whole sequence as its one n-gram; repeated rows and equal sets are one class; words are
compared as bytes after lower-casing A-Z; other columns are left alone; a null id is a document of its own, not linked.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalake.llm.common import by_parts, pieces, stored, table, texts
from vocalake.llm.graph import components
from vocalake.llm.hashing import scrambled, word_hashes

CELLS, CHUNK = 1 << 27, 1 << 16
BLOCK, SALTS, LIST, SIDE = 512, 64, 100_000, 512
_EDGES = np.arange(16, dtype=np.uint64) << np.uint64(60)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingles(batch: list[str], n: int) -> list[np.ndarray]:
    """For each text its distinct n-grams as 64-bit hashes, sorted."""
    flat, sizes = word_hashes(batch)
    h = flat[: max(0, len(flat) - n + 1)] * _MIX[0]
    for k in range(1, n):
        h = scrambled(h + flat[k : k + len(h)] * _MIX[k])
    out, at = [], 0
    for size in sizes.tolist():
        if size >= n:
            own = np.sort(h[at : at + size - n + 1])
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            out.append(own[new])
        elif size:  # the whole sequence; the number of words keeps lengths apart
            own = np.zeros(1, np.uint64)
            for k in range(size):
                own = scrambled(own + flat[at + k : at + k + 1] * _MIX[k])
            out.append(scrambled(own + np.uint64(size)))
        else:
            out.append(flat[:0])
        at += size
    return out


def _signature(own: np.ndarray) -> tuple[int, int]:
    mark = xxhash.xxh3_128_digest(own)
    return int.from_bytes(mark[:8], "little", signed=True), int.from_bytes(mark[8:], "little", signed=True)


def profiles(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, s1, s2: size and signature of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_parts(batches):
            sets = shingles(texts(batch), n)
            marks = [_signature(x) for x in sets]
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in ([len(x) for x in sets], [m[0] for m in marks], [m[1] for m in marks]))], ["doc_id", "n_shingles", "s1", "s2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint")


def _cells(h: np.ndarray, often: np.ndarray) -> np.ndarray:
    return (h & np.uint64(len(often) - 1)).astype(np.int64)


def _added(total: np.ndarray, cells: np.ndarray, counts: np.ndarray) -> None:
    total[cells] = np.minimum(total[cells].astype(np.int64) + counts, 255)


def frequencies(docs: DataFrame, n: int) -> np.ndarray:
    """Occurrences of n-grams in sets, up to 255, by cell of their hash: about eight n-grams a cell, `CELLS` cells at most.

    Each task counts all cells in a byte each; the counts are added up by chunks of cells, first over some tasks, then over all.
    """
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    cells = min(CELLS, max(CHUNK, 1 << max(0, size // 48 - 1).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint8)
        for batch in by_parts(batches):
            if batch.num_rows:
                _added(total, *np.unique(_cells(np.concatenate(shingles(texts(batch), n)), total), return_counts=True))
        for k in range(0, cells, CHUNK):
            if (part := total[k : k + CHUNK]).any():
                yield pa.record_batch([pa.array([k // CHUNK], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                own = held.setdefault(k, np.zeros(CHUNK, np.uint8))
                np.minimum(own.astype(np.int16) + np.frombuffer(zlib.decompress(x), np.uint8), 255, out=own, casting="unsafe")
        for k, x in held.items():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], ["chunk", "counts"])

    kind = "chunk int, counts binary"
    first = docs.select("text").mapInArrow(count, kind).withColumn("salt", F.floor(F.spark_partition_id() / 512))
    added = first.repartition("chunk", "salt").select("chunk", "counts").mapInArrow(add, kind).repartition("chunk").mapInArrow(add, kind)
    out = np.zeros(cells, np.uint8)
    for r in added.toLocalIterator():
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["counts"]), np.uint8)
    return out


def _ordered(own: np.ndarray, often: np.ndarray) -> np.ndarray:
    """A set's n-grams, rarest first; ties by hash."""
    return own[np.argsort(often[_cells(own, often)], kind="stable")]


def prefix_size(n, percent: int):
    """Of a set of n, so many of the first n-grams hold one of every set that it links with."""
    return n - -(-percent * n // 100) + 1


def _ranges(own: np.ndarray) -> np.ndarray:
    """Counts of a set's n-grams within 16 equal ranges of hashes, up to 255."""
    return np.minimum(np.diff(np.searchsorted(own, _EDGES), append=len(own)), 255).astype(np.uint8)


def prefixes(docs: DataFrame, n: int, percent: int, often) -> DataFrame:
    """gram, s1, size, place, r1, r2: the first n-grams of each set, and its counts by range; `often` is a broadcast of `frequencies`. Equal sets of a task appear once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in by_parts(batches):
            rows = []
            for own in shingles(texts(batch), n):
                mark = _signature(own)[0]
                if len(own) and mark not in seen:
                    seen.add(mark)
                    rows.append((_ordered(own, often.value)[: prefix_size(len(own), percent)], mark, len(own), _ranges(own).view(np.int64)))
            if rows:
                sizes = np.array([len(r[0]) for r in rows])
                each = lambda x, t: pa.array(np.repeat(np.array(x, t), sizes))
                place = np.arange(sizes.sum(), dtype=np.int32) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.int32)
                grams = pa.array(np.concatenate([r[0] for r in rows]).view(np.int64))
                yield pa.record_batch([grams, each([r[1] for r in rows], np.int64), each([r[2] for r in rows], np.int32), pa.array(place), *(each([r[3][k] for r in rows], np.int64) for k in (0, 1))], ["gram", "s1", "size", "place", "r1", "r2"])

    return docs.select("text").mapInArrow(run, "gram bigint, s1 bigint, size int, place int, r1 bigint, r2 bigint")


def _width(percent: int) -> float:
    """Of bands of sizes on a logarithmic scale: sizes that link have a ratio of percent/100 at least, and bands are a little wider than that, so only neighbours can."""
    return max(math.log(100 / percent), 1e-9) * 1.000001


def _top(up: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Roots of x in a forest; what was walked through is hung below them."""
    root = up[x]
    while True:
        higher = up[root]
        if np.array_equal(higher, root):
            up[x] = root
            return root
        root = higher


def united(gram: np.ndarray, size: np.ndarray, place: np.ndarray, ranges: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of a forest of the pairs that pass the filters, within lists of equal grams (rows come by gram and size).

    Short lists meet row by row at growing distances. Long ones meet by squares of `SIDE` rows: pairs that are connected
    already drop out first, then filters follow by cost, the counts by range at first in eight sums. So a list costs some ns
    a pair where sets differ, and close to nothing where they are alike.
    """
    up, out = np.arange(len(gram)), []
    needed = -(-percent * np.arange(2 * int(size.max()) + 1 if len(size) else 1) // (100 + percent))  # by the sum of both sizes
    room = (np.arange(len(needed)) - 2 * needed).astype(np.int32)
    coarse = ranges.reshape(len(ranges), 8, 2).sum(2).astype(np.int16)
    far, more = np.empty((2, SIDE, SIDE), np.int16)

    def unite(x: np.ndarray, y: np.ndarray) -> None:
        """Joins what pairs connect: of the pairs that hang a root below a smaller one, one for each root at a time."""
        while len(x):
            a, b = _top(up, x), _top(up, y)
            apart = a != b
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            high, at = np.unique(np.maximum(a, b), return_index=True)
            up[high] = np.minimum(a, b)[at]
            out.append((x[at], y[at]))

    def passes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        both = size[x] + size[y]
        ok = (100 * np.minimum(size[x], size[y]).astype(np.int64) >= percent * np.maximum(size[x], size[y]).astype(np.int64)) & (np.minimum(size[x] - place[x], size[y] - place[y]) >= needed[both])
        ok[ok] = np.abs(ranges[x[ok]] - ranges[y[ok]]).sum(1) <= room[both[ok]]
        return ok

    starts = np.flatnonzero(np.diff(gram, prepend=gram[:1] - 1)) if len(gram) else np.zeros(0, np.int64)
    sizes = np.diff(starts, append=len(gram))
    active, step = np.flatnonzero(np.repeat(sizes <= SIDE, sizes)), 0
    while len(active):  # short lists: pairs of rows that lie `step` apart, as long as the length filter holds
        step += 1
        active = active[active + step < len(gram)]
        active = active[(gram[active] == gram[active + step]) & (100 * size[active].astype(np.int64) >= percent * size[active + step].astype(np.int64))]
        x = active[_top(up, active) != _top(up, active + step)] if step > 1 else active
        ok = passes(x, x + step)
        unite(x[ok], x[ok] + step)
    for start, n in zip(starts[sizes > SIDE].tolist(), sizes[sizes > SIDE].tolist()):
        squares = [np.arange(k, min(k + SIDE, start + n)) for k in range(start, start + n, SIDE)]
        for own in (True, False):  # each square with itself at first, which connects what is alike
            for i, a in enumerate(squares):
                for b in squares[i : i + 1] if own else squares[i + 1 :]:
                    if 100 * int(size[a[-1]]) < percent * int(size[b[0]]):
                        break
                    p, q = _top(up, a), _top(up, b)
                    if not own and p.min() == p.max() == q.min() == q.max():
                        continue
                    left = far[: len(a), : len(b)]
                    np.abs(np.subtract(coarse[a, None, 0], coarse[b, 0], out=left), out=left)
                    for k in range(1, 8):
                        part = more[: len(a), : len(b)]
                        left += np.abs(np.subtract(coarse[a, None, k], coarse[b, k], out=part), out=part)
                    most = room[2 * int(size[a[0]])] if size[a[0]] == size[b[-1]] else room[size[a, None] + size[b]]
                    x, y = np.nonzero(left <= most)
                    apart = (p[x] != q[y]) if not own else x < y
                    x, y = a[x[apart]], b[y[apart]]
                    ok = passes(x, y)
                    unite(x[ok], y[ok])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out))


def candidates(prefix: DataFrame, percent: int) -> DataFrame:
    """a, b (values of s1): within each n-gram's list, a forest of the pairs that pass the filters.

    A list of more than `LIST` sets isn't held: there, sets of one band of sizes, and of neighbouring ones, are united as they
    come. That may unite more than can link, never less.
    """
    names, most, width = ["gram", "s1", "size", "place", "r1", "r2"], LIST, _width(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, first = None, {}
        for (gram, s1, size, place, r1, r2), large in pieces(batches, names, most):
            if large:
                if gram[0] != of:
                    of, first = gram[0], {}
                bands = np.floor(np.log(size) / width).astype(np.int64)
                kinds, at, inverse = np.unique(bands, return_index=True, return_inverse=True)
                heads = np.array([first.setdefault(b, s1[i]) for b, i in zip(kinds.tolist(), at.tolist())])
                near = [(x, first[b + 1]) for b, x in first.items() if b + 1 in first]
                ends = [np.concatenate([x, np.array(y, np.int64)]) for x, y in zip((s1, heads[inverse]), zip(*near) if near else ((), ()))]
                yield pa.record_batch([pa.array(x) for x in ends], ["a", "b"])
                continue
            order = np.lexsort((s1, size, gram))
            gram, s1, size, place, r1, r2 = (c[order] for c in (gram, s1, size, place, r1, r2))
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (s1[1:] != s1[:-1])  # copies in other tasks are neighbours
            gram, s1, size, place, r1, r2 = (c[new] for c in (gram, s1, size, place, r1, r2))
            i, j = united(gram, size.astype(np.int32), place.astype(np.int32), np.stack([r1, r2], 1).view(np.uint8).astype(np.int16), percent)
            if len(i):
                yield pa.record_batch([pa.array(s1[i]), pa.array(s1[j])], ["a", "b"])

    return prefix.repartition("gram").sortWithinPartitions("gram").select(*names).mapInArrow(run, "a bigint, b bigint")


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i


def forest(ids: list[int], sets: list[np.ndarray], block: list[int], percent: int, known: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect what is linked among the given sets (rarest n-gram first); with two blocks, pairs across them only. known: what is connected already has equal numbers."""
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    sizes = np.array([len(s) for s in sets])
    counts = np.array([_ranges(np.sort(s)) for s in sets], np.int16)
    lists: dict[int, list[tuple[int, int]]] = defaultdict(list)
    across = len(set(block)) > 1
    whole: dict[int, set[int]] = {}
    tree, out = Forest(len(ids)), []
    first: dict[int, int] = {}
    for i, c in enumerate(known or ()):
        tree.up[tree.root(i)] = tree.root(first.setdefault(c, i))
    for x in order:
        prefix = sets[x][: prefix_size(len(sets[x]), percent)].tolist()
        met: dict[int, tuple[int, int]] = {}
        for p, g in enumerate(prefix):
            for y, q in lists[g]:
                met.setdefault(y, (p, q))
            lists[g].append((x, p))
        if met:
            ys = np.array(list(met))
            p, q = np.array(list(met.values())).T
            need = -(-percent * (sizes[ys] + sizes[x]) // (100 + percent))  # the overlap that a link needs
            ok = 100 * sizes[ys] >= percent * sizes[x]  # length
            ok &= 1 + np.minimum(sizes[x] - p - 1, sizes[ys] - q - 1) >= need  # position
            ok &= np.abs(counts[ys] - counts[x]).sum(1) <= sizes[ys] + sizes[x] - 2 * need  # suffix
            if across:
                ok &= np.array([block[y] != block[x] for y in met])
            for y, least in zip(ys[ok].tolist(), need[ok].tolist()):
                a, b = tree.root(x), tree.root(y)
                if a != b:
                    for i in (x, y):
                        if i not in whole:
                            whole[i] = set(sets[i].tolist())
                    if len(whole[x] & whole[y]) >= least:
                        tree.up[a] = b
                        out.append((ids[x], ids[y]))
    return out


_DEAL = ("c", "i", "j", "own", "known")


def sets_of(docs: DataFrame, classes: DataFrame, n: int, often) -> DataFrame:
    """classes (s1, s2, first: an id that has the text, and more columns) with grams: their sets, rarest n-gram first. A class may come once from each task."""
    more = [c for c in classes.columns if c not in ("s1", "s2", "first")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in by_parts(batches):
            keep, grams = [], []
            for i, (own, row) in enumerate(zip(shingles(texts(batch), n), zip(*(batch.column(c).to_pylist() for c in ("s1", "s2", *more))))):
                if row not in seen and row[:2] == _signature(own):  # the id may have other texts too
                    seen.add(row)
                    keep.append(i)
                    grams.append(_ordered(own, often.value).tobytes())
            if keep:
                yield pa.record_batch([*(batch.column(c).take(pa.array(keep)) for c in ("s1", *more)), pa.array(grams, pa.binary())], ["s1", *more, "grams"])

    asked = docs.select("doc_id", "text").join(classes.withColumnRenamed("first", "doc_id").hint("merge"), "doc_id")
    kinds = dict(classes.dtypes)
    return asked.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in ("s1", *more)) + ", grams binary")


def joined(dealt: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect what is linked within each deal. dealt: s1, grams, known (its component so far), and c, i, j, own: those of one (c, i, j) meet; where i and j differ, those whose own is i with those whose own is j."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            one = {r[0]: r for r in rows}  # equal sets of several tasks
            ids, sets, own, known = zip(*one.values())
            found = forest(list(ids), [np.frombuffer(x, np.uint64) for x in sets], list(own), percent, list(known))
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

        for batch in batches:
            for *k, s1, grams, own, known in zip(*(batch.column(x).to_pylist() for x in ("c", "i", "j", "s1", "grams", "own", "known"))):
                if k != key:
                    yield from done() if rows else ()
                    key, rows = k, []
                rows.append((s1, grams, own, known))
        yield from done() if rows else ()

    keys = ["c", "i", "j"]
    rows = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return rows.select(*keys, "s1", "grams", "own", "known").mapInArrow(join, "a bigint, b bigint")


def _counted(rows: DataFrame, *keys: str) -> DataFrame:
    """rows (with s1) with blocks: how many of `BLOCK` the rows that agree in the keys fill. Only large groups have a row to be joined, `SALTS` times, so their members are in as many tasks."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).where("blocks > 1")
    counts = counts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("s1"), F.lit(SALTS)))
    return salted.join(counts, [*keys, "_salt"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).drop("_salt")


def _blocks(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with own: a block of about `BLOCK` of those that agree in the keys, by a hash of the set."""
    return _counted(rows, *keys).withColumn("own", F.xxhash64(*keys, F.pmod(F.xxhash64("s1", F.lit("block")), F.col("blocks")))).drop("blocks")


def _labelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with known: their components by what is found so far."""
    return rows.join(found.select(F.col("node").alias("s1"), F.col("component").alias("_c")), "s1", "left").withColumn("known", F.coalesce("_c", "s1")).drop("_c")


def links(docs: DataFrame, members: DataFrame, n: int, percent: int, often) -> DataFrame:
    """node, component of the classes that links connect. members: s1, s2, first (an id), n_shingles, cluster."""
    width = _width(percent)
    placed = stored(_counted(members, "cluster").withColumn("band", F.floor(F.log("n_shingles") / width)).withColumn("known", F.col("s1")))
    zero = F.lit(0).cast("bigint")
    whole = lambda rows, own: rows.withColumns({"c": F.col("cluster"), "i": own, "j": own, "own": own})
    sets = stored(sets_of(docs, placed.select("s1", "s2", "first", "cluster", "blocks", "known"), n, often))
    small, large = whole(sets.where("blocks = 1"), zero).select("s1", *_DEAL, "grams"), placed.where("blocks > 1").drop("blocks")
    if large.isEmpty():
        return components(joined(small, percent))
    sets = sets.where("blocks > 1").select("s1", "grams")
    blocked = stored(_blocks(large, "cluster", "band"))
    # Each block by itself; and a few members of each, over all bands.
    few = blocked.groupBy("cluster", "own").agg(F.array_distinct(F.array(F.min("s1"), F.max("s1"), F.min_by("s1", F.xxhash64("s1")), F.max_by("s1", F.xxhash64("s1")))).alias("s1"))
    few = _blocks(few.select("cluster", F.explode("s1").alias("s1")), "cluster").withColumn("known", F.col("s1"))
    deals = whole(blocked, F.col("own")).select("s1", *_DEAL).unionByName(whole(few, F.col("own")).select("s1", *_DEAL))
    edges = stored(joined(small.unionByName(sets.join(deals, "s1")), percent))
    # What is still apart: blocks of one component each where it fills one, of several otherwise.
    now = stored(_labelled(large.drop("known"), components(edges)))
    apart = now.groupBy("cluster").agg(F.min("known").alias("_a"), F.max("known").alias("_b")).where("_a <> _b").select("cluster")
    apart = stored(_counted(now.join(apart, "cluster", "left_semi"), "cluster", "band", "known"))
    if apart.isEmpty():
        return components(edges)
    apart = apart.withColumn("of", F.when(F.col("blocks") > 1, F.col("known")).otherwise(0)).drop("blocks")
    apart = stored(_blocks(apart, "cluster", "band", "of"))
    spans = apart.select("cluster", "band", "of", "own").distinct()
    other = spans.select("cluster", *[F.col(c).alias(c + "2") for c in ("band", "of", "own")])
    pairs = spans.join(other, "cluster").where("(band2 = band and own <= own2) or band2 = band + 1").where("of = 0 or of2 = 0 or of <> of2")
    deals = pairs.select("cluster", F.col("own").alias("i"), F.col("own2").alias("j"), F.explode(F.array_distinct(F.array("own", "own2"))).alias("own"))
    deals = apart.select("s1", "cluster", "own", "known").join(deals, ["cluster", "own"]).withColumnRenamed("cluster", "c")
    return components(edges.unionAll(joined(sets.join(deals, "s1"), percent)))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links of at least `percent` hundredths) for each row of docs."""
    spark = docs.sparkSession
    known = stored(profiles(docs, n))
    classes = stored(known.where("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n_shingles")))
    often = spark.sparkContext.broadcast(frequencies(docs, n))
    near = components(candidates(prefixes(docs, n, percent, often), percent))
    members = stored(classes.join(near.select(F.col("node").alias("s1"), F.col("component").alias("cluster")), "s1"))
    found = links(docs, members, n, percent, often)
    labelled = stored(_labelled(classes, found))
    least = labelled.groupBy("known").agg(F.min("first").alias("component_id"))
    grouped = stored(labelled.join(least, "known").select("s1", "s2", "component_id"))
    out = known.join(grouped, ["s1", "s2"], "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("component_id"))
    return out.withColumn("component_id", F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id")))


def without_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each component: that of the smallest id. Rows equal in id and text are one; rows without an id stay."""
    found = near_duplicates(docs, n, percent)
    kept = stored(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_rows")))
    out = docs.join(kept, docs["doc_id"] == kept["doc_id"], "left_semi")
    if not kept.where("_rows > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "text"])
    return out.unionByName(docs.where("doc_id is null"))


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 90)
