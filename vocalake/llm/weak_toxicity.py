"""Toxicity by weak supervision.

Voters are lexicons of four languages, words and word beginnings mined from labelled rows, and patterns; each votes or
abstains. A generative label model says how votes arise given the unknown class: every voter has a rate of voting in each
class that depends on at most one other voter, so its parameters are accuracies and pairwise correlations, and its
likelihood is exact. Which pairs are tied is read from the votes (a forest of the largest mutual informations within
classes that are beyond chance). The labels of the sample calibrate the model: they give the share of the classes and
the parameters to start from; then it is fitted by expectation and maximisation to the votes alone, of labelled and of
unlabelled rows, so voters overrule labels that are wrong. Its posteriors train a linear classifier on hashed words and
word beginnings, which scores every text whole. The sample has at most `SAMPLE` labelled rows (of those that may be
learned from) and `UNLABELLED` others, each with at most `LEARNED` hashed tokens (some 130 MB in all).

Defined cases: null and empty texts have no words and the score of the bias; repeated rows get equal scores; without
labels, or with one kind only, the score is the smoothed share of label 1; a null id is not held out; other columns are
left alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalake.llm.common import Memo, by_parts, held_out, table, texts
from vocalake.llm.sampling import kept_slots, labelled_sample, unlabelled_sample

SAMPLE, UNLABELLED, MINED, FEATURES, BUCKETS, ROUNDS = 12_000, 4_000, 120, 4096, 1 << 20, 10
#: Hashed tokens of a row that is learned from; of one that has more, the ones left out are chosen by a hash.
LEARNED = 2048
#: A statistic with one degree of freedom that chance reaches once in about two million tokens.
SURE = 25.0
LEXICONS = {
    "en": ("idiot", "moron", "stupid", "loser", "pathetic", "scum", "worthless", "trash", "clown", "disgusting"),
    "de": ("idiot", "dummkopf", "trottel", "depp", "versager", "abschaum", "wertlos", "armselig", "widerlich", "blödmann"),
    "fr": ("idiot", "imbécile", "crétin", "abruti", "minable", "ordure", "débile", "pathétique", "dégoûtant", "connard"),
    "es": ("idiota", "imbécil", "estúpido", "tonto", "basura", "patético", "inútil", "asqueroso", "escoria", "payaso"),
}
SEEDS = tuple(dict.fromkeys(w for words in LEXICONS.values() for w in words))
PATTERNS = (r"\byou\s+(?:are\s+)?(?:an?\s+)?\w*(?:idiot|moron|loser|clown)", r"!{2,}", r"\b[A-Z]{4,}\b(?:\s+\b[A-Z]{4,}\b){2}", r"\b(\w{4,})\b[\s,]+\1\b")
EDGE = ".,;:!?\"'()[]{}*#%$&|<>"


def _parts(word: str) -> list[str]:
    """A word in lower case without marks around it, and its beginnings of 4 to 6 letters, marked as such."""
    w = word.lower().strip(EDGE)
    return [w, *(w[:k] + "~" for k in (4, 5, 6) if len(w) > k)] if w else []


def tokens(text: str) -> set[str]:
    return set(chain.from_iterable(map(_parts, set(text.split()))))


def mine(sample: DataFrame, most: int = MINED) -> list[str]:
    """The tokens that speak most clearly for label 1: by the difference of shares, among those at least eight times as common there, by more than chance gives among all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_parts(batches):
            rows = [(w, y) for t, y in zip(texts(batch), batch.column("label").to_pylist()) for w in tokens(t)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32()))], ["token", "label"])

    total = sample.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
    p = total["p"] or 0
    n = total["n"] - p
    if not p or not n:
        return []
    counts = sample.select("text", "label").mapInArrow(run, "token string, label int").groupBy("token").agg(F.sum("label").alias("p"), F.count("*").alias("a"))
    share, other = F.col("p") / p, (F.col("a") - F.col("p") + 0.5) / (n + 1)
    xlogx = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    gain = 2 * (xlogx(F.col("p"), F.col("a") * p / (p + n)) + xlogx(F.col("a") - F.col("p"), F.col("a") * n / (p + n)))
    clear = counts.where((F.col("p") >= max(3, p // 200)) & (share >= 8 * other) & (gain >= SURE))
    return [r["token"] for r in clear.orderBy((share - other).desc(), "token").limit(most).collect()]


def votes(text: str, found: set[str], lexicon: list[str]) -> list[bool]:
    hits = [w in found for w in lexicon]
    return [*hits, sum(hits) >= 2, not any(hits), *(re.search(p, text) is not None for p in PATTERNS)]


class LabelModel:
    """Votes given the class: `rate[y, b, j]` is the probability that voter j votes in class y, where its `parent` (-1: none) votes (b = 1) or not."""

    def fit(self, v: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
        """v: 0/1 votes, a row per document; labels: 1, 0, or nan where there is none. Returns the posterior of class 1 per row, by the votes alone."""
        known = ~np.isnan(labels)
        self.prior = (labels[known].sum() + 1) / (known.sum() + 2)
        self._maximise(v[known], labels[known])
        self.likelihood = []
        for i in range(rounds):  # ties are read anew while classes settle, then kept
            q = self.posterior(v)
            if 2 * i >= rounds:
                self.likelihood.append(self.total)
            self._maximise(v, q, self.parent if 2 * i >= rounds else None)
        return self.posterior(v)

    def _maximise(self, v: np.ndarray, q: np.ndarray, parent: np.ndarray | None = None) -> None:
        m = v.shape[1]
        weights = (1 - q, q)
        both = np.stack([v.T @ (v * w[:, None]) for w in weights])  # votes of j and k together, by class
        own, total = np.diagonal(both, axis1=1, axis2=2), np.array([w.sum() for w in weights])
        self.parent = self._forest(both, own, total) if parent is None else parent
        self.rate = np.empty((2, 2, m))
        j = np.arange(m)
        for y in (0, 1):
            alone = (own[y] + 0.1) / (total[y] + 1)
            up = np.where(self.parent >= 0, self.parent, j)
            with_parent, parents = both[y, j, up], own[y, up]
            tied = np.stack([(own[y] - with_parent + alone) / (total[y] - parents + 1), (with_parent + alone) / (parents + 1)])
            self.rate[y] = np.where(self.parent >= 0, tied, alone)
        self.rate = np.clip(self.rate, 1e-5, 1 - 1e-5)
        #: Of each voter: the share of class 1 where it votes; and its correlation with its parent within classes.
        self.accuracy = (own[1] + self.prior) / (own.sum(0) + 1)
        self.correlation = self._correlations(both, own, total)

    @staticmethod
    def _correlations(both: np.ndarray, own: np.ndarray, total: np.ndarray) -> np.ndarray:
        joint = sum(both[y] - np.outer(own[y], own[y]) / max(total[y], 1e-9) for y in (0, 1))
        scale = np.sqrt(np.maximum(np.diag(joint), 1e-9))
        return joint / np.outer(scale, scale)

    @staticmethod
    def _forest(both: np.ndarray, own: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Each voter's parent in a forest that ties as much mutual information within classes as it can, of that beyond chance (Chow and Liu)."""
        m = both.shape[1]
        gain = np.zeros((m, m))
        for y in (0, 1):
            n, a, b = max(total[y], 1e-9), own[y][:, None], own[y][None, :]
            for seen, left, right in ((both[y], a, b), (a - both[y], a, n - b), (b - both[y], n - a, b), (n - a - b + both[y], n - a, n - b)):
                seen, expected = np.maximum(seen, 0), np.maximum(left * right / n, 1e-12)
                gain += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / expected), 0)
        np.fill_diagonal(gain, 0)
        parent, inside = np.full(m, -1), np.zeros(m, bool)
        best, by = np.zeros(m), np.full(m, -1)
        for _ in range(m):
            j = int(np.argmax(np.where(inside, -1, best)))
            inside[j] = True
            parent[j] = by[j] if best[j] >= SURE else -1
            closer = ~inside & (gain[j] > best)
            best[closer], by[closer] = gain[j][closer], j
        return parent

    def posterior(self, v: np.ndarray) -> np.ndarray:
        up = v[:, np.maximum(self.parent, 0)] * (self.parent >= 0)
        log = []
        for y in (0, 1):
            off, on = self.rate[y]
            rate = off + up * (on - off)
            log.append(np.log(np.where(v > 0, rate, 1 - rate)).sum(1) + np.log(self.prior if y else 1 - self.prior))
        self.total = float(np.logaddexp(*log).sum())
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


class Linear:
    """Logistic regression on the presence of selected hashed tokens."""

    def __init__(self, bias: float):
        self.bias, self.weight = bias, {}

    def fit(self, tokens: pa.ListArray, q: np.ndarray) -> None:
        """tokens: distinct hashed tokens of each row, as they came; rows are taken a thousand at a time, so that no copy of all is made."""
        n, flat, ends = len(tokens), tokens.values.to_numpy(), tokens.offsets.to_numpy()
        parts = [(a, min(a + 1000, n)) for a in range(0, n, 1000)]
        df, pos = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for a, b in parts:
            own = flat[ends[a] : ends[b]]
            df += np.bincount(own, minlength=BUCKETS)
            pos += np.bincount(own, np.repeat(q[a:b], np.diff(ends[a : b + 1])), BUCKETS)
        expected = df * q.mean()
        chi = np.where(df >= 3, (pos - expected) ** 2 / np.maximum(expected * (1 - df / n) * (1 - q.mean()), 1e-9), 0)
        chosen = np.sort(np.argsort(-chi, kind="stable")[:FEATURES])
        chosen = chosen[chi[chosen] >= SURE]
        number = np.full(BUCKETS, -1, np.int32)
        number[chosen] = np.arange(len(chosen))
        found = []
        for a, b in parts:
            at = number[flat[ends[a] : ends[b]]]
            found.append((at[at >= 0], np.repeat(np.arange(a, b), np.diff(ends[a : b + 1]))[at >= 0]))
        columns, owner = (np.concatenate(c) for c in zip(*found))
        w, m, s = (np.zeros(len(chosen) + 1) for _ in range(3))
        w[-1] = self.bias
        for t in range(1, 301):  # Adam on all rows at once
            z = np.bincount(owner, w[columns], n) + w[-1]
            e = (1 / (1 + np.exp(-z)) - q) / n
            g = np.append(np.bincount(columns, e[owner], len(chosen)) + 1e-5 * w[:-1], e.sum())
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-9)
        self.bias, self.weight = float(w[-1]), dict(zip(chosen.tolist(), w[:-1].tolist()))


def _hash(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


def fit(sample: DataFrame, others: DataFrame | None = None) -> Linear:
    """The classifier, from a sample of labelled rows and others without a label: their votes and hashed tokens come to the driver."""
    seeds = [*SEEDS]
    lexicon = seeds + [w for w in mine(sample) if w not in seeds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_parts(batches):
            if batch.num_rows:
                found = [(t, tokens(t)) for t in texts(batch)]
                hashed = [np.array(sorted({_hash(w) for w in x}), np.int32) for _, x in found]
                hashed = pa.array([x[kept_slots(x, LEARNED)] for x in hashed], pa.list_(pa.int32()))
                yield pa.record_batch([pa.array([votes(t, x, lexicon) for t, x in found], pa.list_(pa.bool_())), hashed, batch.column("label")], ["votes", "tokens", "label"])

    rows = sample.select("text", "label")
    if others is not None:
        rows = rows.unionAll(others.select("text", F.lit(None).cast("int").alias("label")))
    rows = rows.mapInArrow(run, "votes array<boolean>, tokens array<int>, label int").toArrow()
    labels = np.array([np.nan if x is None else x for x in rows.column("label").to_pylist()], float)
    known = labels[~np.isnan(labels)]
    share = (known.sum() + 1) / (len(known) + 2)
    out = Linear(float(np.log(share / (1 - share))))
    if 0 < known.sum() < len(known):
        v = rows.column("votes").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(labels), -1).astype(np.float32)
        out.fit(rows.column("tokens").combine_chunks(), LabelModel().fit(v, labels))
    return out


def learned(docs: DataFrame, labels: DataFrame) -> Linear:
    return fit(labelled_sample(docs, labels, "toxic", SAMPLE), unlabelled_sample(docs, labels, UNLABELLED))


def _scorer(model: Linear):
    weight = model.weight
    known = Memo(lambda w: tuple(h for p in _parts(w) if (h := _hash(p)) in weight), 400_000)

    def scores(batch: pa.RecordBatch) -> np.ndarray:
        z = [sum(map(weight.__getitem__, set(chain.from_iterable(map(known.__getitem__, set(t.split())))))) for t in texts(batch)]
        return 1 / (1 + np.exp(-np.clip(np.array(z, float) + model.bias, -50, 50)))

    return scores


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(learned(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(held.value)
        for batch in by_parts(batches):
            yield pa.record_batch([batch.column("doc_id"), pa.array(scores(batch), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def clean(docs: DataFrame, labels: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """The rows that score below the cutoff, with all their columns; each row is judged by its own text, where it lies."""
    held = docs.sparkSession.sparkContext.broadcast(learned(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(held.value)
        for batch in by_parts(batches):
            yield batch.filter(pa.array(scores(batch) < cutoff))

    return docs.mapInArrow(run, docs.schema)


def op5_weak_toxicity(spark, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
