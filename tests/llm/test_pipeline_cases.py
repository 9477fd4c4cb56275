"""The stages of the pipeline on rows that are null, empty, repeated, long or have more columns, and on empty tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(2000)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = some(60)
    clean = [some(rng.randint(20, 90)) for _ in range(300)]
    rows = [(i, t, None if i % 7 == 0 else "en", "s", len(t)) for i, t in enumerate(clean)]
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), (None, clean[3], "en", "s", 1), (1002, some(60_000), "en", "s", 1), (5, clean[5], "en", "s", 1), (6, some(40), "en", "s", 1)]
    rows += [(2000 + i, some(40) + " " + passage + " " + some(40), "en", "s", 1) for i in range(6)] + [(3000, clean[10], "en", "s", 1), (3001, "idiot " + clean[11] + " scum", "en", "s", 1), (3002, clean[12].replace(" ", " \n") + " end", "en", "s", 1)]
    toxic = [(4000 + i, some(30) + " idiot " + some(5) + " scum", "en", "s", 1) for i in range(60)]
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows + toxic, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 300)] + [(4000 + i, 1, 1) for i in range(60)] + [(None, 1, 1), (9999, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, rows, toxic, passage


def _stages(spark, docs, at):
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, at))
        out.append(docs)
    return out


def test_stages_on_hard_rows(spark, folder):
    at, rows, toxic, passage = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    more = docs.select("*", *[F.lit("x").alias(c) for c in ("_id", "score", "known", "own", "cluster", "removed", "label", "_row", "s1")])
    plain, wide = _stages(spark, docs, at), _stages(spark, more, at)
    for a, b in zip(plain[:-1], wide[:-1]):
        assert a.columns == docs.columns and b.columns == more.columns and sorted(map(str, a.collect())) == sorted(map(str, b.select(*docs.columns).collect()))
    quality, tox, near, repeats, packed = plain
    ids = [{r["doc_id"] for r in x.collect()} for x in plain]
    assert not ids[0] & {1000, 1001} and {i for i in range(300)} - {5, 6} <= ids[0]  # without words they go; clean ones stay
    assert not ids[1] & {r[0] for r in toxic} and 3001 not in ids[1] and len(ids[1] & set(range(300))) >= 297
    assert 3000 not in ids[2] and 10 in ids[2] and 3002 not in ids[2] and 12 in ids[2] and {2000, 2001, 2005, 1002, None} <= ids[2]
    assert near.where("doc_id = 5").count() <= 1
    kept = {r["doc_id"]: r["text"] for r in repeats.collect()}
    assert sum(passage in (t or "") for t in kept.values()) == 1 and passage in kept[2000]
    assert all(r["n_chars"] == len(r["text"] or "") for r in repeats.collect())
    totals = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).collect()
    assert {r["doc_id"] for r in totals} == ids[3]


def test_stages_on_empty_tables(spark, folder):
    at = folder[0]
    docs = spark.createDataFrame([], SCHEMA)
    assert [x.count() for x in _stages(spark, docs, at)] == [0] * 5


def test_stages_keep_missing_columns_missing(spark, folder):
    at = folder[0]
    docs = spark.read.parquet(f"{at}/documents.parquet").drop("n_chars", "source")
    assert corpus_pipeline.repeats(spark, docs, at).columns == docs.columns
    nulls = spark.createDataFrame([(1, None), (2, "a")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.repeats(spark, nulls, at).collect()} == {1: None, 2: "a"}
