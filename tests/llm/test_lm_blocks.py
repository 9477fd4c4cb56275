"""Language-model scores: blocks of documents ask for each n-gram once."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vocalake.llm import hashing, lm_scoring


def _texts(n, words, vocabulary, seed=3):
    rng = random.Random(seed)
    return [" ".join(f"w{int(vocabulary * rng.random() ** 3)}" for _ in range(words)) for _ in range(n)]


def _plain(texts, least=2, backoff=0.4):
    """n_words, n_backoff, log_score of each text."""
    words = [(t or "").encode().lower().split() for t in texts]
    one, two = Counter(w for x in words for w in x), Counter(p for x in words for p in zip(x, x[1:]))
    total, out = sum(one.values()), []
    for x in words:
        known = [k > 0 and two[x[k - 1], x[k]] >= least for k in range(len(x))]
        s = [math.log(two[x[k - 1], w] / one[x[k - 1]]) if known[k] else math.log((backoff if k else 1) * one[w] / total) for k, w in enumerate(x)]
        out.append((len(x), len(x) - sum(known) - bool(x), sum(s)))
    return out


def _frame(spark, texts, parts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(parts, "doc_id")


def test_rows_dealt_follow_the_different_grams_of_blocks(spark):
    texts = _texts(400, 200, 30)
    docs = _frame(spark, texts, 4)
    spark.sparkContext.setJobGroup("lm_blocks", "")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables of any size
    try:
        assert lm_scoring.scores(docs, common=1).count() == len(texts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sparkContext.setJobGroup("other", "")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    tracker, store = spark.sparkContext.statusTracker(), spark.sparkContext._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup("lm_blocks") for s in tracker.getJobInfo(j).stageIds}
    dealt = sum(store.lastStageAttempt(s).shuffleWriteRecords() for s in stages)
    assert 0 < dealt < sum(len(x.split()) for x in texts) / 4  # 80,000 words, as many pairs; 930 different ones


@pytest.mark.parametrize("block, slices, common, least", [(1, 1, 1 << 20, 2), (700, 3, 1, 3), (700, 2, 100, 1), (8_000_000, 2, 20, 2)])
def test_scores_whatever_the_blocks(spark, block, slices, common, least):
    texts = [*_texts(60, 40, 300), *_texts(3, 40, 300), None, "", " \n", "Alone", "x" * 3000 + " y"]
    got = {r["doc_id"]: r for r in lm_scoring.scores(_frame(spark, texts, 3), least=least, common=common, slices=slices, block=block).collect()}
    assert len(got) == len(texts)
    for i, (n, back, score) in enumerate(_plain(texts, least)):
        r = got[i]
        assert (r["n_words"], r["n_backoff"]) == (n, back) and abs(r["log_score"] - score) < 1e-9 * max(1, abs(score))
        assert r["mean"] is None if not n else abs(r["mean"] - score / n) < 1e-9


def test_blocks_that_are_read_in_pieces_count_the_same(spark):
    """A block's rows may be read by two tasks, or beside those of other blocks."""
    texts = _texts(40, 30, 100)
    dealt = lm_scoring.blocks(_frame(spark, texts, 1), 700)
    assert dealt.select("block").distinct().count() > 3 and dealt.agg(F.sum("words")).first()[0] == 1200
    whole = {(r["block"], r["gram"]): r["total"] for r in lm_scoring.answers(lm_scoring.grams(dealt), 2, 1e9).collect()}
    pieces = Counter()
    for part in range(2):
        for r in lm_scoring.grams(dealt.withColumn("_at", F.monotonically_increasing_id()).repartition(3, "_at").drop("_at"), part, 2).collect():
            pieces[r["block"], r["gram"]] += r["n"]
    total = Counter()
    for (_, gram), n in pieces.items():
        total[gram] += n
    assert whole == {k: total[k[1]] for k, n in pieces.items() if total[k[1]] > n and (k[1] < 0 or total[k[1]] >= 2)}


def test_words_are_numbered():
    texts = ["", "a", " a  b\n", " x y", "é \x0b f\tG", "  "]
    assert hashing.word_number(texts) == 0 + 1 + 2 + 2 + 3 == int(np.sum(hashing.word_hashes(texts)[1]))
    assert hashing.word_number([]) == 0
