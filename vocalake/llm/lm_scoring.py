"""Stupid-backoff language-model scores of all documents under counts of the whole corpus: tables, joins and sums.

1. `blocks`: the documents with a block: about `BLOCK` characters that lie together, stored, so that it is settled.
2. `grams`: block, gram, n: the different words and word pairs of each block, counted. However often a block has a gram, it
   is one row, so no gram is dealt more rows than there are blocks.
3. `answers`: block, gram, total: counts of all by gram, beside the rows of the blocks, in one exchange by gram (a window).
   Grams that no other block has are left out, as their block has counted them itself, and pairs below `LEAST`. Grams with at
   least a 2^-20 share of all words (2^20 words and 2^20 pairs at most, whatever the corpus) are answered once, and broadcast.
4. `scored`: each block's documents meet its answers, by block.

`SLICES` of the grams are counted, and of the blocks scored, one after another, so that only one slice's exchange is on the
disks at a time.

Score of a word after another: count of the pair over count of the first word, if the pair occurs at least `LEAST` times
in the corpus; otherwise `BACKOFF` times the share of the second word. The first word of a text has its share.

Words are runs without ASCII white space, A-Z lower-cased. Defined cases: a text that is null, empty or without words has
no words, log_score 0 and a null mean; repeated rows count as often as they occur and get equal scores, one for each row,
also under a null id; rows that share an id and differ in text are scored apart; other columns are left alone. Words and
pairs are told apart by hashes of 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vocalake.llm.common import by_parts, stored, table, texts
from vocalake.llm.hashing import scrambled, word_hashes, word_number

LEAST, BACKOFF = 2, 0.4
#: A word or pair is common from a share of one in so many.
COMMON = 1 << 20
#: Characters of a block; parts of the grams, and of the blocks, that are exchanged one after another.
BLOCK, SLICES = 8_000_000, 2
_PAIR = np.uint64(0x9E3779B97F4A7C15)
#: The leading bit of a gram: a hashed word, else a hashed pair.
_WORD = np.uint64(1 << 63)


def _word(flat: np.ndarray) -> np.ndarray:
    return flat >> np.uint64(1) | _WORD


def _pair(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Grams of the pairs that end at the given places."""
    return scrambled(flat[at - 1] * _PAIR + flat[at]) >> np.uint64(1)


def _inner(sizes: np.ndarray) -> np.ndarray:
    """Places of words that follow another in their text."""
    inner = np.ones(int(sizes.sum()), bool)
    inner[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
    return np.flatnonzero(inner)


def blocks(docs: DataFrame, most: int = BLOCK) -> DataFrame:
    """doc_id, text, words, block: rows of about `most` characters (or one row) that a task reads one after another. words: a batch's, in its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in by_parts(batches, most=min(most, 4_000_000)):
            own = texts(batch)
            size = sum(map(len, own))
            if held and held + size > most:
                block, held = block + 1, 0
            held += size
            words = np.zeros(len(own), np.int64)
            words[:1] = word_number(own)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text"), pa.array(words), pa.array(np.full(len(own), block))], ["doc_id", "text", "words", "block"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string, words bigint, block bigint")


def grams(dealt: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """block, gram, n: the different grams of each block that are in a slice of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> pa.RecordBatch:
            gram, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch([pa.array(np.full(len(gram), now)), pa.array(gram.view(np.int64)), pa.array(n)], ["block", "gram", "n"])

        for batch in by_parts(batches):
            block = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for start, end in zip(cuts, cuts[1:]):
                if end > start and block[start] != now:
                    if held:
                        yield done()
                    now, held = block[start], []
                flat, sizes = word_hashes(texts(batch.slice(start, end - start)))
                for x in (_word(flat), _pair(flat, _inner(sizes))):
                    held.append(x[x % np.uint64(parts) == part])
        if held:
            yield done()

    return dealt.select("text", "block").mapInArrow(run, "block bigint, gram bigint, n bigint")


def answers(rows: DataFrame, least: int, edge: float) -> DataFrame:
    """block, gram, total: each block's grams that others have too, with their number in all; pairs from `least`, and grams from `edge` on for one block only."""
    gram = Window.partitionBy("gram")  # a row for each block at most
    counted = rows.select("*", F.sum("n").over(gram).alias("total"), F.min("block").over(gram).alias("first")).where((F.col("gram") < 0) | (F.col("total") >= least))
    return counted.where(F.col("total") > F.col("n")).where((F.col("total") < edge) | (F.col("block") == F.col("first"))).select("block", "gram", "total")


class Totals:
    """Numbers by gram; 0 for others."""

    def __init__(self, rows: pa.Table):
        gram = np.array(rows.column("gram").to_numpy()).view(np.uint64)
        order = np.argsort(gram)
        self.grams, self.totals = gram[order], rows.column("total").to_numpy()[order]

    def of(self, x: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(x), np.int64)
        at = np.minimum(np.searchsorted(self.grams, x), len(self.grams) - 1)
        return np.where(self.grams[at] == x, self.totals[at], 0)


def scored(dealt: DataFrame, rows: DataFrame, common, total: int, least: int, backoff: float) -> DataFrame:
    """doc_id, n_words, n_backoff, log_score of the rows of whole blocks; `common` is a broadcast of Totals."""

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        answered = Totals(found)

        def totals(gram: np.ndarray) -> np.ndarray:
            each, place, n = np.unique(gram, return_inverse=True, return_counts=True)
            return np.maximum(n, np.maximum(answered.of(each), common.value.of(each)))[place]

        flat, sizes = word_hashes(texts(docs))
        owner, at = np.repeat(np.arange(len(sizes)), sizes), _inner(sizes)
        one, two = np.log(totals(_word(flat))), totals(_pair(flat, at))
        x, known = one - np.log(total), two >= least
        x[at[~known]] += np.log(backoff)
        x[at[known]] = np.log(two[known]) - one[at[known] - 1]
        back, score = np.bincount(owner[at[~known]], minlength=len(sizes)), np.bincount(owner, x, len(sizes)).astype(float)  # integers without words
        return pa.table([docs.column("doc_id"), pa.array(sizes), pa.array(back), pa.array(score)], ["doc_id", "n_words", "n_backoff", "log_score"])

    both = dealt.select("block", "doc_id", "text").groupBy("block").cogroup(rows.groupBy("block"))
    return both.applyInArrow(run, "doc_id bigint, n_words bigint, n_backoff bigint, log_score double")


def scores(docs: DataFrame, least: int = LEAST, backoff: float = BACKOFF, common: int = COMMON, slices: int = SLICES, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_backoff (words scored by their share), log_score, mean of each row of docs. common: at most 2^20."""
    if not 1 <= common <= COMMON:
        raise ValueError(f"common must be from 1 to {COMMON}")
    dealt, found, out = stored(blocks(docs, block)), None, None
    total = dealt.agg(F.sum("words")).first()[0] or 0
    edge = total / common
    for part in range(slices):
        rows = stored(answers(grams(dealt, part, slices), least, edge))
        found = rows if found is None else found.unionAll(rows)
    held = docs.sparkSession.sparkContext.broadcast(Totals(found.where(F.col("total") >= edge).select("gram", "total").toArrow()))
    of = F.pmod(F.xxhash64("block"), F.lit(slices))
    for part in range(slices):
        rows = stored(scored(dealt.where(of == part), found.where((F.col("total") < edge) & (of == part)), held, total, least, backoff))
        out = rows if out is None else out.unionAll(rows)
    return out.withColumn("mean", F.col("log_score") / F.nullif("n_words", F.lit(0)))


def _rounded(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_words", "n_backoff", F.round("log_score", 4).alias("log_score"), F.round("mean", 6).alias("mean"))


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return _rounded(scores(table(spark, sf_dir, "documents")))


def lm_scoring_joined(spark, sf_dir: str) -> DataFrame:
    """The same with so few common words and pairs that on tables of any size nearly all are met in the join."""
    return _rounded(scores(table(spark, sf_dir, "documents"), common=100))


SQL = r"""
WITH w AS (SELECT doc_id, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents)),
p AS (SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM w),
c1 AS (SELECT w, count(*) AS c FROM w GROUP BY w), c2 AS (SELECT v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY v, w HAVING count(*) >= 2), t AS (SELECT count(*) AS n FROM w),
s AS (SELECT p.doc_id, p.v IS NOT NULL AND c2.c IS NULL AS backed, CASE WHEN p.v IS NULL THEN ln(a.c / t.n::DOUBLE) WHEN c2.c IS NOT NULL THEN ln(c2.c / b.c::DOUBLE) ELSE ln(0.4::DOUBLE * a.c / t.n) END AS x
 FROM p JOIN c1 a ON p.w = a.w LEFT JOIN c1 b ON p.v = b.w LEFT JOIN c2 ON p.v = c2.v AND p.w = c2.w, t),
g AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (backed) AS n_backoff, sum(x) AS y FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_backoff, 0) AS n_backoff, coalesce(round(y, 4), 0) AS log_score, round(y / n_words, 6) AS mean FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""
