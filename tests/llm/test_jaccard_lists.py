"""Lists of one n-gram: what is united in them against all pairs, for short and long lists, alike and unlike sets."""

import time

import numpy as np
import pytest

from vocalake.llm import jaccard_join


def _roots(n, pairs, forest=False):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        assert not forest or root(a) != root(b)
        up[root(a)] = root(b)
    out = {}
    return [out.setdefault(root(i), i) for i in range(n)]


def _all_pairs(gram, size, place, ranges, percent):
    for i in range(len(gram)):
        for j in range(i + 1, len(gram)):
            a, b = int(size[i]), int(size[j])
            need = -(-percent * (a + b) // (100 + percent))
            if gram[i] == gram[j] and 100 * min(a, b) >= percent * max(a, b) and min(a - place[i], b - place[j]) >= need and np.abs(ranges[i] - ranges[j]).sum() <= a + b - 2 * need:
                yield i, j


def _lists(rng, n, grams, high, kinds):
    gram = np.sort(rng.integers(0, grams, n))
    size = rng.integers(5, high, n).astype(np.int32)
    order = np.lexsort((size, gram))
    gram, size = gram[order], size[order]
    shares = [rng.multinomial(1000, np.ones(16) / 16) / 1000 for _ in range(kinds)]
    ranges = np.stack([np.minimum(255, np.round(shares[rng.integers(kinds)] * s + rng.normal(0, 1.2, 16))).clip(0) for s in size]).astype(np.int16)
    return gram, size, (rng.random(n) * 0.25 * size).astype(np.int32), ranges


@pytest.mark.parametrize("side", [4, 16, 512])
@pytest.mark.parametrize("percent", [80, 90])
def test_lists_are_united_as_all_pairs_would(monkeypatch, side, percent):
    monkeypatch.setattr(jaccard_join, "SIDE", side)
    rng = np.random.default_rng(side + percent)
    for _ in range(25):
        lists = _lists(rng, int(rng.integers(1, 120)), int(rng.integers(1, 5)), int(rng.integers(6, 90)), int(rng.integers(1, 9)))
        a, b = jaccard_join.united(*lists, percent)
        n = len(lists[0])
        assert _roots(n, zip(a.tolist(), b.tolist()), forest=True) == _roots(n, _all_pairs(*lists, percent))


def test_an_empty_list():
    none = np.zeros(0, np.int64)
    assert [len(x) for x in jaccard_join.united(none, none.astype(np.int32), none.astype(np.int32), np.zeros((0, 16), np.int16), 80)] == [0, 0]


@pytest.mark.parametrize("alike", [True, False])
def test_eight_thousand_sets_of_one_size_are_quick(alike):
    rng, n = np.random.default_rng(0), 8000
    size = np.full(n, 200, np.int32)
    ranges = (np.tile(rng.multinomial(200, np.ones(16) / 16), (n, 1)) if alike else rng.multinomial(200, np.ones(16) / 16, n)).astype(np.int16)
    t = time.thread_time()
    a, _ = jaccard_join.united(np.zeros(n, np.int64), size, rng.integers(0, 10, n).astype(np.int32), ranges, 90)
    assert time.thread_time() - t < 10 and (len(a) == n - 1) == alike
