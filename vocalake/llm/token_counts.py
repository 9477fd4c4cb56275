"""Token counts by rank-synchronous merging in ragged arrays.

The vocabulary is one of pieces with byte fallback, whose encoder merges the pair of the best piece first, from the left.
A text is cut where no piece can reach across (before a run of blanks, at characters that no longer piece has), and each
cut is counted once per task as long as a bounded cache holds it. What the cache lacks is merged for a whole batch at
once: symbols of all cuts lie in one flat array, every sequence finds its best pair, and all sequences apply theirs in
the same step. All places of that pair go at once where nothing they make is as good as the pair itself (else only those
up to the first such place), so the order is the encoder's. Long cuts are parted again at neighbours that no piece has.

Defined cases: a null or empty text has no tokens; repeated rows are each counted; ties between pieces of one score go to
the left; an empty table gives no rows; other columns are left alone, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from vocalake.llm.common import by_parts, table, texts
from vocalake.tables import spread

MODEL, LIMIT = "piece_bpe_32k.model", 4096
BLANK = "▁"
_NONE = np.iinfo(np.int32).max
#: Cuts kept by a task; longer ones than this many characters are counted each time.
MOST_KEPT, LONGEST_KEPT = 500_000, 64


class PieceCounter:
    """Numbers of tokens of whole texts, by the pieces and scores of a model file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, "rb") as f:
            self.model = f.read()

    def __getstate__(self) -> dict:
        return {"path": self.path, "model": self.model}

    def ready(self) -> PieceCounter:
        if hasattr(self, "kept"):
            return self
        model = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        every = range(model.get_piece_size())
        if not any(map(model.is_byte, every)) or any(map(model.is_unused, every)) or model.normalize(" ﬁ a  b ") != f"{BLANK * 2}ﬁ{BLANK}a{BLANK * 2}b{BLANK}":
            raise ValueError(f"{self.path} has no byte fallback, has unused pieces, or changes texts other than by blanks")
        score = {model.id_to_piece(i): model.get_score(i) for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        long = [p for p in score if len(p) > 1]
        if any(BLANK in p.lstrip(BLANK) for p in long):
            raise ValueError(f"{self.path} has pieces over more than one word")
        symbols = list(dict.fromkeys([*score, *(c for p in long for c in p)]))
        number = {s: i for i, s in enumerate(symbols, 1)}  # 0: characters of no piece
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = np.array([_NONE, *(order[score[s]] if s in score else _NONE for s in symbols)], np.int32)
        self.of_char = np.zeros(0x110000, np.int32)
        self.single = np.zeros(0x110000, bool)
        for s in symbols:
            if len(s) == 1:
                self.of_char[ord(s)], self.single[ord(s)] = number[s], s in score
        splits = {(number[p[:i]], number[p[i:]]): number[p] for p in long for i in range(1, len(p)) if p[:i] in number and p[i:] in number}
        self.pairs = np.array(sorted((a << 32 | b, p) for (a, b), p in splits.items()), np.int64).reshape(-1, 2).T.copy()
        self.neighbours = np.array(sorted({number[a] << 32 | number[b] for p in long for a, b in zip(p, p[1:])}), np.int64)
        parts = "".join(re.escape(c) for c in "\n\t\r" if not any(c in p for p in long))
        self.cut = re.compile(f" *[^ {parts}]+| +" + (f"|[{parts}]" if parts else "")).findall
        self.period = self._period(score, long)
        self.kept: dict[str, int] = {}
        return self

    def _period(self, score: dict[str, float], long: list[str]) -> int:
        """Blanks after which a long run of them starts anew with one token more; 0 if pieces of blanks aren't merged last and from the left."""
        blanks = [p for p in long if p.startswith(BLANK * 2)]
        if not blanks or any(p.strip(BLANK) or score[p] > min(score.values()) for p in blanks):
            return 0
        n = max(map(len, blanks))
        counts = self.merged([" " * k for k in range(1, 5 * n)])
        return n if (counts[n:] == counts[:-n] + 1).all() else 0

    def _piece(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Symbols of pairs of symbols, 0 where they make no piece."""
        keys, pieces = self.pairs
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, pieces[at], 0)

    def merged(self, cuts: list[str]) -> np.ndarray:
        """Numbers of tokens of cuts (blanks as spaces), all merged in step."""
        out = np.zeros(len(cuts), np.int64)
        point = np.frombuffer("".join(cuts).replace(" ", BLANK).encode("utf-32-le"), "<u4")
        if not len(point):
            return out
        owner = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
        symbol = self.of_char[point]
        tokens = np.where(self.single[point], 1, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))
        key = symbol[:-1].astype(np.int64) << 32 | symbol[1:]
        at = np.minimum(np.searchsorted(self.neighbours, key), len(self.neighbours) - 1)
        apart = (self.neighbours[at] != key) | (owner[1:] != owner[:-1])
        sequence = np.concatenate([[0], np.cumsum(apart)])
        owner = owner[np.concatenate([[True], apart])]
        made = np.concatenate([np.where(apart, 0, self._piece(symbol[:-1], symbol[1:])), [0]])
        while True:
            first = np.flatnonzero(np.diff(sequence, prepend=-1))
            rank = self.rank[made]
            best = np.minimum.reduceat(rank, first)
            size = np.diff(first, append=len(sequence))
            done = best == _NONE
            if done.any():
                np.add.at(out, owner[done], np.add.reduceat(tokens, first)[done])
                live = ~np.repeat(done, size)
                owner, best, size = owner[~done], best[~done], size[~done]
                if not len(owner):
                    return out
                symbol, tokens, made, rank = symbol[live], tokens[live], made[live], rank[live]
                sequence = np.repeat(np.arange(len(owner)), size)
            best = best[sequence]
            place = np.flatnonzero(rank == best)
            new_run = np.diff(place, prepend=-2) != 1
            place = place[(np.arange(len(place)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]) % 2 == 0]  # of places that overlap, every other one
            place = self._together(place, symbol, sequence, made, best)
            symbol[place], tokens[place] = made[place], 1
            keep = np.ones(len(symbol), bool)
            keep[place + 1] = False
            place -= np.arange(len(place))
            symbol, tokens, sequence, made = symbol[keep], tokens[keep], sequence[keep], made[keep]
            touched = np.zeros(len(symbol) + 1, bool)
            touched[place] = touched[place - 1] = True  # the last one is of no symbol
            changed = np.flatnonzero(touched[:-1])
            after = np.minimum(changed + 1, len(symbol) - 1)
            made[changed] = np.where((after > changed) & (sequence[after] == sequence[changed]), self._piece(symbol[changed], symbol[after]), 0)

    def _together(self, place: np.ndarray, symbol: np.ndarray, sequence: np.ndarray, made: np.ndarray, best: np.ndarray) -> np.ndarray:
        """The places that can be merged at once: in each sequence those up to the first that makes a pair as good as the best."""
        new, of = made[place], sequence[place]
        before, after = np.maximum(place - 1, 0), np.minimum(place + 2, len(symbol) - 1)
        left = symbol[before]
        joined = np.concatenate([[False], place[1:] - place[:-1] == 2])  # the neighbour has just been merged, too
        left[joined] = new[np.flatnonzero(joined) - 1]
        a = np.where((place > 0) & (sequence[before] == of), self.rank[self._piece(left, new)], _NONE)
        b = np.where((after == place + 2) & (sequence[after] == of), self.rank[self._piece(new, symbol[after])], _NONE)
        ends = np.minimum(a, b) <= best[place]
        earlier = np.cumsum(ends) - ends
        start = np.diff(of, prepend=-1) != 0
        return place[earlier == earlier[start][np.cumsum(start) - 1]]

    def counts(self, batch: list[str]) -> list[int]:
        """Numbers of tokens of texts."""
        kept = self.kept
        cuts = [self.cut(f" {x.replace(BLANK, ' ')}") if x else [] for x in batch]
        missing = list(set().union(*cuts).difference(kept))
        if len(kept) + len(missing) > MOST_KEPT:
            kept.clear()
            missing = list(set().union(*cuts))
        short, more = missing, [0] * len(missing)
        if self.period:
            blanks = [len(c) - len(c.lstrip(" ")) for c in missing]
            more = [max(0, n // self.period - 2) for n in blanks]
            short = [c[k * self.period :] if k else c for c, k in zip(missing, more)]
        kept.update(zip(missing, (self.merged(short) + np.array(more, np.int64)).tolist()))
        out = [sum(map(kept.__getitem__, c)) for c in cuts]
        for c in missing:
            if len(c) > LONGEST_KEPT:
                del kept[c]
        return out


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes (of UTF-8), n_tokens of each document."""
    counter = docs.sparkSession.sparkContext.broadcast(PieceCounter(path or public_tokenizers.path(MODEL)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter.value.ready()
        for batch in by_parts(batches):
            rows = texts(batch)
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(x.encode()) for x in rows], pa.int64()), pa.array(c.counts(rows), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {LIMIT} as over_limit")
