"""Each stage of the pipeline on the smallest tables, against what its contract says of its own input."""

import __spark_entry__
import corpus_pipeline
from vocalake.llm import quality_rules, weak_toxicity
from vocalake.llm.common import stored, table

DIR = "/root/testdata/sf0.001"


def _sets(rows):
    out = {}
    for r in rows:
        w = r["text"].encode().lower().split()
        out[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    return out


def test_stages(spark):
    docs = table(spark, DIR, "documents")
    columns, before = docs.columns, docs
    made = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, DIR))
        made.append(docs)
    quality, toxicity, near, repeats, packed = made
    assert all(x.columns == columns for x in made[:-1])
    kept = {r["doc_id"] for r in quality_rules.judge(before, table(spark, DIR, "labels")).where("kept").collect()}
    assert {r["doc_id"] for r in quality.collect()} == kept
    scores = weak_toxicity.judge(quality, table(spark, DIR, "labels"))
    assert {r["doc_id"] for r in toxicity.collect()} == {r["doc_id"] for r in scores.where("score < 0.5").collect()}
    sets, left = _sets(toxicity.collect()), {r["doc_id"] for r in near.collect()}
    up = {k: k for k in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    assert left == {k for k in sets if root(k) == k}
    seen = set()
    for r in sorted(repeats.collect(), key=lambda r: r["doc_id"]):
        assert r["n_chars"] == len(r["text"])
    inputs = {r["doc_id"]: r["text"] for r in near.collect()}
    for k in sorted(inputs):
        raw = inputs[k].encode()
        own = [raw[i : i + 100] for i in range(len(raw) - 99)]
        fresh = all(w not in seen for w in own) and len(set(own)) == len(own)
        seen.update(own)
        if fresh:
            assert repeats.where(f"doc_id = {k}").first()["text"] == inputs[k]
    totals = packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r["doc_id"] for r in totals} == set(inputs) and all(r["sum(length)"] == r["max(doc_tokens)"] for r in totals)


def test_pipeline_is_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert set(corpus_pipeline.run(spark, DIR).columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}
