"""Empty tables, clashing columns and nulls for the operators that lacked them; the quality vector against a plain count."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vocalake.llm import byte_bpe, fm_quality, lm_scoring, matroska, packing, quality_rules, url_filter
from vocalake.llm.sampling import labelled_sample

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TEXTS = [None, "", "One line\nOne line\n", "a b c " * 40, "Some WORDS, with marks! 42 #", "naïve café " * 9, "x" * 3000, *[f"plain text number {i} of a few" for i in range(40)]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None if i % 3 == 0 else "en", None, len(t or "") if i % 2 else None) for i, t in enumerate(TEXTS)] + [(None, "no id", "en", "s", 5), (4, TEXTS[4], "en", "s", 1)], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 5 == 0 and 1 or 0) for i in range(45)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")


NAMES = ("score", "label", "slots", "vals", "levels", "stratum", "rule", "host", "path", "verdict", "kept_out", "listed", "length", "rank", "ids", "gram", "x", "sums", "kept", "n_words", "_salt", "payload")


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.select("*", *[F.lit("x").alias(n) for n in NAMES])


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_quality_scores_of_clashing_and_empty_tables(spark, docs, clashing, labels):
    machine = fm_quality.fit(labelled_sample(docs, labels, "quality", 1000))
    assert _rows(fm_quality.score(clashing, machine)) == _rows(fm_quality.score(docs, machine)) and fm_quality.score(docs, machine).count() == docs.count()
    same = fm_quality.fit(labelled_sample(clashing, labels, "quality", 1000))
    assert abs(same.bias - machine.bias) < 1e-9
    none = docs.limit(0)
    assert fm_quality.score(none, machine).collect() == []
    for sample in (labelled_sample(none, labels, "quality", 10), labelled_sample(docs, labels.limit(0), "quality", 10)):
        assert {round(r["score"], 9) for r in fm_quality.score(docs, fm_quality.fit(sample)).collect()} == {0.5}


def test_quality_vectors_are_those_of_a_plain_count():
    for text, stated in (("a b a", 5), ("", None), ("One, two\nOne, two\n\nTHREE 42 #", 30), ("x y " * 50, -3)):
        slots, values = fm_quality.vector(text, stated)
        words = text.split()
        counts = Counter(words)
        norm = math.sqrt(sum(math.log(1 + n) ** 2 for n in counts.values())) or 1
        expected = sorted((zlib.crc32(w.encode()) % fm_quality.BUCKETS, round(math.log(1 + n) / norm, 6)) for w, n in counts.items())
        assert sorted((s, round(v, 6)) for s, v in zip(slots[: -fm_quality.STATS], values)) == expected
        bins = [s - fm_quality.BUCKETS - i * fm_quality.BINS for i, s in enumerate(slots[-fm_quality.STATS :])]
        assert all(0 <= b < fm_quality.BINS for b in bins) and values[-fm_quality.STATS :] == [0.5] * fm_quality.STATS
        lines = [x for x in text.split("\n") if x]
        assert bins[0] == int(math.log2(len(words) + 1))  # size
        assert bins[3] == int(23 * len(counts) / max(len(words), 1))  # different words
        assert bins[5] == int(23 * (1 - len(set(lines)) / max(len(lines), 1)))  # repeated lines
        assert bins[7] == int(23 * sum(w.isupper() for w in words) / max(len(words), 1))
        assert bins[10] == (0 if stated is None else int(1 + math.log2(max(stated, 0) + 1)))


def test_quality_rules_of_clashing_and_empty_tables(docs, clashing, labels):
    columns = ("doc_id", "base_failed", "kept")
    plain = _rows(quality_rules.judge(docs, labels).select(*columns))
    assert _rows(quality_rules.judge(docs.withColumn("extra", F.lit(1)), labels).select(*columns)) == plain
    assert quality_rules.judge(docs.limit(0), labels).collect() == []
    assert _rows(quality_rules.judge(docs, labels.limit(0)).select(*columns)) == sorted([(r[0], r[1], not r[1]) for r in plain], key=repr)
    kept = quality_rules.apply_rules(clashing, labels)
    assert kept.columns == clashing.columns and kept.where("score <> 'x' or kept <> 'x'").isEmpty() and kept.count() < docs.count()
    assert quality_rules.apply_rules(clashing.limit(0), labels).collect() == []


def test_urls_of_clashing_and_empty_tables(spark):
    urls = [None, "", "no scheme", "http://a.example.com/en/7/x?q#f", "https://EXAMPLE.net/de/8", "ftp://b.org/es/1", "http://example.com", "x://y://z/p", *[f"http://s{i % 7}.com/en/{i}" for i in range(60)], *[f"http://s{i % 7}.net/de/{i}" for i in range(60)]]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(None, urls[3], "h"), (3, urls[4], "h")], "page_id bigint, url string, html string").repartition(3)
    plain = _rows(url_filter.judge(pages))
    more = pages.select("*", *[F.lit("x").alias(n) for n in ("host", "path", "rule", "score", "verdict", "listed", "kept_out", "cell", "bin")])
    assert _rows(url_filter.judge(more)) == plain and len(plain) == pages.count()
    assert url_filter.judge(more.limit(0)).collect() == []
    assert {r[5] for r in plain} <= {"allow", "block"}


def test_other_operators_leave_clashing_columns_alone(docs, clashing):
    assert _rows(packing.pieces(clashing)) == _rows(packing.pieces(docs))
    assert packing.pack(clashing).count() == packing.pack(docs).count()
    assert _rows(byte_bpe.digests(clashing)) == _rows(byte_bpe.digests(docs))
    assert _rows(matroska.digests(clashing)) == _rows(matroska.digests(docs))
    rounded = lambda df: _rows(df.select("doc_id", "n_words", "n_backoff", F.round("log_score", 6)))
    assert rounded(lm_scoring.scores(clashing)) == rounded(lm_scoring.scores(docs))
    for f in (packing.pack, byte_bpe.digests, matroska.digests, lm_scoring.scores):
        assert f(docs.limit(0)).collect() == []
