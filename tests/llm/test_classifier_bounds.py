"""The classifiers' samples stay bounded; the label model and the linear fit against plain versions."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from vocalake.llm import fm_quality, weak_toxicity
from vocalake.llm.sampling import kept_slots


def test_long_rows_are_learned_from_in_part_and_short_ones_whole():
    text = " ".join(f"w{i}" for i in range(30_000))
    slots, values = fm_quality.vector(text, None)
    few, sizes = fm_quality.learned(slots, values)
    assert len(few) == fm_quality.LEARNED + fm_quality.STATS and len(set(few.tolist())) == len(few) and set(few.tolist()) <= set(slots)
    assert abs((sizes[: fm_quality.LEARNED] ** 2).sum() - 1) < 1e-4 and few[-fm_quality.STATS :].tolist() == slots[-fm_quality.STATS :]
    assert few[: fm_quality.LEARNED].max() > 0.9 * fm_quality.BUCKETS and few.min() < 0.1 * fm_quality.BUCKETS  # from all over
    slots, values = fm_quality.vector("a b c a", 7)
    few, sizes = fm_quality.learned(slots, values)
    assert few.tolist() == slots and np.allclose(sizes, values)


def test_rows_leave_out_different_slots():
    a, b = (kept_slots(np.arange(n), 1000) for n in (5000, 5001))
    assert len(a) == len(b) == 1000 and a.tolist() == sorted(set(a.tolist())) and len({*a.tolist()} & {*b.tolist()}) < 500
    assert kept_slots(np.arange(10), 10).tolist() == list(range(10)) and kept_slots(np.zeros(0, np.int32), 5).tolist() == []


def test_samples_of_long_texts_are_bounded(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    sample = spark.createDataFrame([(1, long + " idiot", 5, 1), (2, long, 5, 0), (3, "", None, 0), (4, None, None, 1)], "doc_id bigint, text string, n_chars bigint, label int")
    rows = sample.select("text", "n_chars", "label").mapInArrow(fm_quality._vectors, "slots array<int>, vals array<float>, label int").collect()
    assert max(len(r["slots"]) for r in rows) == fm_quality.LEARNED + fm_quality.STATS
    assert weak_toxicity.fit(sample.select("doc_id", "text", "label")).bias is not None
    assert fm_quality.fit(sample).bias is not None


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(4)
    n, m = 3000, 6
    y = rng.random(n) < 0.3
    v = rng.random((n, m)) < np.where(y[:, None], 0.5, 0.1)
    v[:, 4] = np.where(rng.random(n) < 0.9, v[:, 1], v[:, 4])
    v[:, 5] = np.where(rng.random(n) < 0.9, v[:, 4], v[:, 5])
    out = weak_toxicity.LabelModel()
    labels = y.astype(float)
    labels[1000:] = np.nan
    out.fit(v.astype(float), labels, 6)
    return out


def _probability(model, y, row):
    """Of a row of votes in class y: the product over voters, each given its parent's vote."""
    p = model.prior if y else 1 - model.prior
    for j, vote in enumerate(row):
        parent = model.parent[j]
        rate = model.rate[y, int(row[parent]) if parent >= 0 else 0, j]
        p *= rate if vote else 1 - rate
    return p


def test_likelihood_and_posterior_equal_enumeration(model):
    assert (model.parent >= 0).any()
    rows = np.array(list(itertools.product((0.0, 1.0), repeat=6)))
    both = np.array([[_probability(model, y, row) for y in (0, 1)] for row in rows])
    assert math.isclose(both.sum(), 1, rel_tol=1e-9)  # a distribution over all votes and classes
    assert np.allclose(model.posterior(rows), both[:, 1] / both.sum(1))
    assert math.isclose(model.total, np.log(both.sum(1)).sum(), rel_tol=1e-9)


def test_the_forest_has_no_circle_and_the_largest_ties(model):
    rng = np.random.default_rng(6)
    v, q = (rng.random((800, 5)) < 0.4).astype(float), rng.random(800)
    v[:, 3] = np.where(rng.random(800) < 0.8, v[:, 0], v[:, 3])
    v[:, 2] = np.where(rng.random(800) < 0.6, v[:, 3], v[:, 2])

    def tie(j, k):
        """Twice the mutual information of two voters within classes, in weights of rows."""
        out = 0.0
        for w in (1 - q, q):
            for a, b in itertools.product((0, 1), repeat=2):
                seen, left, right = w[(v[:, j] == a) & (v[:, k] == b)].sum(), w[v[:, j] == a].sum(), w[v[:, k] == b].sum()
                out += 2 * seen * math.log(seen * w.sum() / (left * right)) if seen else 0
        return out

    ties = {(j, k): tie(j, k) for j, k in itertools.combinations(range(5), 2)}
    best = max((sum(ties[e] for e in edges), edges) for r in range(5) for edges in itertools.combinations([e for e in ties if ties[e] >= weak_toxicity.SURE], r) if _is_forest(edges))
    got = weak_toxicity.LabelModel()
    got.prior = 0.5
    got._maximise(v, q)
    assert {tuple(sorted((j, int(p)))) for j, p in enumerate(got.parent) if p >= 0} == set(best[1])


def _is_forest(edges):
    up = {}
    root = lambda i: root(up[i]) if i in up else i
    for a, b in edges:
        if root(a) == root(b):
            return False
        up[root(a)] = root(b)
    return True


def test_the_linear_fit_equals_a_plain_one():
    rng = np.random.default_rng(8)
    rows = [sorted({int(x) for x in rng.integers(0, 60, rng.integers(0, 12))}) for _ in range(400)]
    q = np.array([0.9 if 3 in r or 7 in r else 0.1 for r in rows])
    out = weak_toxicity.Linear(0.3)
    out.fit(pa.array(rows, pa.list_(pa.int32())), q)
    df = [sum(k in r for r in rows) for k in range(60)]
    chi = {}
    for k in range(60):
        pos, expected = sum(x for x, r in zip(q, rows) if k in r), df[k] * q.mean()
        chi[k] = (pos - expected) ** 2 / (expected * (1 - df[k] / 400) * (1 - q.mean())) if df[k] >= 3 else 0
    chosen = sorted(k for k in chi if chi[k] >= weak_toxicity.SURE)
    assert sorted(out.weight) == chosen and {3, 7} <= set(chosen)
    w, m, s = ({k: 0.0 for k in [*chosen, -1]} for _ in range(3))
    w[-1] = 0.3
    for t in range(1, 301):
        g = {k: 1e-5 * w[k] if k >= 0 else 0.0 for k in w}
        for r, target in zip(rows, q):
            own = [k for k in r if k in w] + [-1]
            e = (1 / (1 + math.exp(-sum(w[k] for k in own))) - target) / 400
            for k in own:
                g[k] += e
        for k in w:
            m[k], s[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * s[k] + 0.001 * g[k] ** 2
            w[k] -= 0.1 * (m[k] / (1 - 0.9**t)) / (math.sqrt(s[k] / (1 - 0.999**t)) + 1e-9)
    assert abs(out.bias - w[-1]) < 1e-6 and all(abs(out.weight[k] - w[k]) < 1e-6 for k in chosen)


def test_mined_tokens_equal_a_plain_count(spark):
    rng = np.random.default_rng(9)
    rows = [(" ".join(f"v{i}" for i in rng.integers(0, 80, 12)) + (" vile" if y and rng.random() < 0.8 else ""), int(y)) for y in rng.random(600) < 0.3]
    sample = spark.createDataFrame(rows, "text string, label int")
    p = sum(y for _, y in rows)
    n = len(rows) - p
    clear = {}
    found = [(weak_toxicity.tokens(t), y) for t, y in rows]
    for w in set().union(*(x for x, _ in found)):
        a, b = sum(y for x, y in found if w in x), sum(1 - y for x, y in found if w in x)
        share, other = a / p, (b + 0.5) / (n + 1)
        gain = 2 * sum(x * math.log(x / e) for x, e in ((a, (a + b) * p / (p + n)), (b, (a + b) * n / (p + n))) if x > 0)
        if a >= max(3, p // 200) and share >= 8 * other and gain >= weak_toxicity.SURE:
            clear[w] = share - other
    assert clear and weak_toxicity.mine(sample) == sorted(clear, key=lambda w: (-clear[w], w))
