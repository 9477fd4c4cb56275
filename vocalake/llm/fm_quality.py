"""Quality classifier: a factorisation machine.

A document is a sparse vector of hashed words (log counts, unit length), structure statistics and metadata (its stated
length), each statistic as one of a few bins. Score: sigmoid of bias + linear terms + all pairwise interactions of rank
`RANK`, the latter in linear time: half of the squares of sums less the sums of squares, per factor. It is trained on a
bounded sample of labelled rows (`SAMPLE` at most), whose vectors are made on the executors, words of one bucket merged, and
have at most `LEARNED` words each when they come to the driver (some 100 MB in all); every text is scored whole.

Defined cases: null and empty texts have no words, and are scored by their statistics; a null stated length, or none in
the table, has a bin of its own; a null id is not held out; repeated rows get equal scores; without labels, or with one kind only, the score is the smoothed share of label 1;
other columns are left alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalake.llm.common import Memo, by_parts, held_out, table
from vocalake.llm.sampling import kept_slots, labelled_sample

SAMPLE, RANK, EPOCHS, BATCH, RATE, DECAY = 12_000, 8, 6, 128, 0.02, 1e-4
BUCKETS, STATS, BINS = 1 << 15, 12, 24
#: Words of a row that is learned from; of one that has more, the ones left out are chosen by a hash.
LEARNED = 1024
SLOTS = BUCKETS + STATS * BINS
_bucket: Memo | None = None
_drop_letters = dict.fromkeys(map(ord, "abcdefghijklmnopqrstuvwxyz"))


def _bin(x: float) -> int:
    return min(BINS - 1, max(0, int(x)))


def vector(text: str, stated: int | None) -> tuple[list[int], list[float]]:
    """Slots and values of a document."""
    global _bucket
    if _bucket is None:
        _bucket = Memo(lambda w: zlib.crc32(w.encode()) % BUCKETS, 300_000)
    words = text.split()
    n, size = len(words), len(text)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    low = text.lower()
    letters = sum(map(len, words)) or 1
    capital = sum(map(str.isupper, words))
    marked = sum(not w[-1].isalnum() for w in counts)
    symbols = sum(text.count(c) for c in "#*$%&|<>!")
    digits = sum(text.count(c) for c in "0123456789")
    stats = (
        np.log2(n + 1), letters / max(n, 1), 20 * symbols / (letters + 1) + (symbols > 0), 23 * len(counts) / max(n, 1),
        40 * sum(map(eq, words, words[1:])) / max(n, 1), 23 * (1 - len(set(lines)) / max(len(lines), 1)), np.log2(n / max(len(lines), 1) + 1), 23 * capital / max(n, 1),
        23 * marked / max(len(counts), 1), 40 * digits / letters, 0 if stated is None else 1 + np.log2(max(stated, 0) + 1), 0 if stated is None else 1 + (stated == size) + (low == text),
    )
    tf = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    tf /= np.sqrt((tf**2).sum()) or 1
    return [*map(_bucket.__getitem__, counts), *(BUCKETS + i * BINS + _bin(x) for i, x in enumerate(stats))], [*tf.tolist(), *[0.5] * STATS]


class Machine:
    def __init__(self, bias: float, seed: int = 1):
        self.bias = bias
        self.w = np.zeros(SLOTS, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.01, (SLOTS, RANK)).astype(np.float32)

    def logits(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of documents laid end to end, none empty; also the sums per factor."""
        vx = self.v[slots] * values[:, None]
        sums = np.add.reduceat(vx, starts)
        pairs = (sums**2 - np.add.reduceat(vx**2, starts)).sum(1) / 2
        return self.bias + np.add.reduceat(self.w[slots] * values, starts) + pairs, sums

    def gradient(self, slots: np.ndarray, values: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Of the mean logistic loss of documents laid end to end: the slots that occur, the derivatives by each one's weight and factors, and that by the bias."""
        z, sums = self.logits(slots, values, np.cumsum(sizes) - sizes)
        error = (1 / (1 + np.exp(-z)) - labels) / len(labels)
        per = (np.repeat(error, sizes) * values)[:, None]
        each = np.hstack([per, per * (np.repeat(sums, sizes, 0) - self.v[slots] * values[:, None])])
        seen, inverse = np.unique(slots, return_inverse=True)
        return seen, np.stack([np.bincount(inverse, each[:, k], len(seen)) for k in range(1 + RANK)], 1).astype(np.float32), float(error.sum())

    def train(self, docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        """Adam on the logistic loss."""
        rng, t = np.random.default_rng(2), 0
        state = [np.zeros((SLOTS, 1 + RANK), np.float32) for _ in range(2)]
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                slots, values = (np.concatenate([docs[i][k] for i in rows]) for k in (0, 1))
                sizes = np.array([len(docs[i][0]) for i in rows])
                seen, g, bias = self.gradient(slots, values, sizes, labels[rows])
                t += 1
                for s, x, decay in zip(state, (g, g * g), (0.9, 0.999)):
                    s[seen] = decay * s[seen] + (1 - decay) * x
                move = RATE * (state[0][seen] / (1 - 0.9**t)) / (np.sqrt(state[1][seen] / (1 - 0.999**t)) + 1e-8)
                self.w[seen] -= move[:, 0] + RATE * DECAY * self.w[seen]
                self.v[seen] -= move[:, 1:] + RATE * DECAY * self.v[seen]
                self.bias -= RATE * bias


def learned(slots: list[int], values: list[float], most: int = LEARNED) -> tuple[np.ndarray, np.ndarray]:
    """A vector as it is learned from: at most so many word slots, of unit length again, and all statistics."""
    words, size = np.array(slots[:-STATS], np.int32), np.array(values[:-STATS], np.float32)
    if len(words) > most:
        words, inverse = np.unique(words, return_inverse=True)
        size = np.bincount(inverse, size).astype(np.float32)
        keep = kept_slots(words, most)
        words, size = words[keep], size[keep] / np.sqrt((size[keep] ** 2).sum())
    return np.concatenate([words, np.array(slots[-STATS:], np.int32)]), np.concatenate([size, np.array(values[-STATS:], np.float32)])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_parts(batches):
        if batch.num_rows:
            got = [learned(*vector(t or "", n)) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())]
            yield pa.record_batch([pa.array([x for x, _ in got], pa.list_(pa.int32())), pa.array([x for _, x in got], pa.list_(pa.float32())), batch.column("label")], ["slots", "vals", "label"])


def _stated(docs: DataFrame) -> Column:
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("bigint").alias("n_chars")


def fit(sample: DataFrame) -> Machine:
    """A machine trained on the rows of `labelled_sample`; their vectors come to the driver, at most SAMPLE of them."""
    rows = sample.select("text", _stated(sample), "label").mapInArrow(_vectors, "slots array<int>, vals array<float>, label int").toArrow()
    labels = np.array(rows.column("label").to_pylist(), np.float64)
    share = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(float(np.log(share / (1 - share))))
    if 0 < labels.sum() < len(labels):
        docs = [(np.asarray(a.values), np.asarray(b.values)) for c, d in zip(rows.column("slots").chunks, rows.column("vals").chunks) for a, b in zip(c, d)]
        machine.train(docs, labels)
    else:
        machine.v[:] = 0
    return machine


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score of every row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_parts(batches):
            if batch.num_rows:
                got = [vector(t or "", n) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist())]
                sizes = np.array([len(x) for x, _ in got])
                z, _ = held.value.logits(np.concatenate([x for x, _ in got]).astype(np.int64), np.concatenate([x for _, x in got]), np.cumsum(sizes) - sizes)
                yield pa.record_batch([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text", _stated(docs)).mapInArrow(run, "doc_id bigint, score double")


def op1_fm_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", SAMPLE))
    out = score(docs, machine)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
