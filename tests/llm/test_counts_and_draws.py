"""Token counts, fill-in-the-middle and importance resampling against plain versions, on small tables with hard rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from vocalake.llm import fill_middle, resampling, token_counts
from vocalake.llm import queries as llm_queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
RNG = random.Random(7)
PASSAGE = " ".join("".join(RNG.choice("abcdeé") for _ in range(RNG.randint(1, 9))) for _ in range(900))
TEXTS = [
    None, "", " ", " \n\t ", "One", "one", "a" * 5000, " " * 700, "x" + " " * 95, "漢字" * 900, "a\x00b\x01 <0x0A> </s> ▁▁ x▁y", "has <P> a mark", "ends in <S", "<M>", "🤦‍♂️ ﬁ① é", PASSAGE, PASSAGE + "!", "é" + PASSAGE, PASSAGE,
    "der der der " * 3000, "".join(RNG.choice("abcdefghijklmnop") for _ in range(60000)), "B2 b2 B-2 ünï ÜNÏ",
]
TEXTS += [" ".join(RNG.choice(PASSAGE.split()) for _ in range(RNG.randint(1, 60))) for _ in range(150)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else "s", None) for i, t in enumerate(TEXTS)]
    rows += [rows[15], (15, "another text", "en", "s", 1), (None, "a null id " * 12, None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def clashing(docs):
    names = ("n", "form", "output", "rank", "score", "weight", "n_words", "n_bytes", "n_tokens", "position", "_id", "_part", "_row", "bucket", "_down", "_null")
    return docs.select("*", *[F.lit("x").alias(c) for c in names])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# -- token counts


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def counter():
    return token_counts.PieceCounter(public_tokenizers.path("piece_bpe_32k.model")).ready()


def test_token_counts_of_random_texts(model, counter):
    rng = random.Random(3)
    letters = ["abcdefghij klmnopqrst uvwxyz  ", "re ", " \n\t\r ▁ab", "éüñ漢字かな🤦‍♂️ ab", "=-_/. <s></s>0123", "\x00\x01 \x7f\x80", "compareShopsMrHarDecade "]
    pieces = [model.id_to_piece(i).replace("▁", " ") for i in range(3, 32000)]
    some = ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    some += ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    some += [rng.choice([" ", "a", "ab", "=", "é", "\n", "re", "0"]) * rng.randint(0, 300) + rng.choice(["", "x", " y"]) for _ in range(500)]
    assert counter.counts(some) == [len(x) for x in model.encode(some)]


def test_pieces_that_are_better_than_their_parts_are_merged_one_by_one(counter, model):
    """In some merges the new symbol makes a better pair than the one just merged: then places of the pair can't all go at once."""
    rank = {model.id_to_piece(i): model.get_score(i) for i in range(259, 32000)}
    odd = [p for p in rank if len(p) > 3 and not p.startswith("▁") and any(rank.get(p[:i], 1) < rank[p] for i in range(2, len(p)))]
    some = ["".join(random.Random(i).choices(odd[i : i + 3], k=30)) for i in range(0, min(len(odd), 3000), 3)]
    assert odd and counter.counts(some) == [len(x) for x in model.encode(some)]


def test_a_cache_that_overflows_changes_nothing(counter, model, monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_KEPT", 20)
    for i in range(0, len(TEXTS), 10):
        some = [t or "" for t in TEXTS[i : i + 10]]
        assert counter.counts(some) == [len(x) for x in model.encode(some)]


def test_token_counts_of_a_table(docs, clashing, empty, model):
    expected = sorted([(r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in docs.collect()], key=repr)
    for table in (docs, clashing):
        assert _rows(token_counts.token_counts(table), "doc_id", "n_bytes", "n_tokens") == expected
    assert token_counts.token_counts(empty).collect() == []


def test_a_file_that_is_missing_is_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        token_counts.PieceCounter(str(tmp_path / "none.model"))


# -- fill in the middle


def _cut(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle_of_a_table(docs, clashing, empty):
    expected = sorted((_cut(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}
    for table in (docs, clashing):
        out = fill_middle.fill_in_middle(table)
        assert _rows(out, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == expected
        back = out.select("doc_id", fill_middle.restored().alias("text"))
        assert _rows(back, "doc_id", "text") == sorted([(r.doc_id, r.text or "") for r in docs.collect()], key=repr)
    assert fill_middle.fill_in_middle(empty).collect() == []


def test_rolling_hash_and_chunks_against_plain_versions():
    data = PASSAGE.encode()[:3000]
    h = fill_middle.rolling(np.frombuffer(data, np.uint8))
    for i in (0, 1, 5, 31, 32, 700, 2999):
        assert int(h[i]) == sum(int(fill_middle._GEAR[data[i - k]]) << k for k in range(min(32, i + 1))) % (1 << 32)
    for least, most in ((1, 40), (64, 64), (100, 700)):
        ends, start = [], 0
        for i in range(len(data)):
            if (int(h[i]) >> 26 == 0 and i + 1 - start >= least) or i + 1 - start == most:
                ends.append(i + 1)
                start = i + 1
        ends += [len(data)] if start < len(data) else []
        assert fill_middle.chunk_ends(h, 6, least, most) == ends


def test_shared_passages_share_chunks_and_equal_keys_do_not_mix_contents():
    chunks = fill_middle.Chunks()
    big = (PASSAGE * 3).encode()
    fill_middle.Counted(big, chunks)
    before = chunks.found
    fill_middle.Counted(b"other beginning " + big, chunks)
    assert chunks.found - before >= 0.7 * len(fill_middle.Counted(big, chunks).ends)
    a, b = chunks.summary(5, "éé".encode()), chunks.summary(5, b"<P>abc")
    assert a[:2] == (2, False) and b[:2] == (6, True) and chunks.summary(5, "éé".encode()) == a
    small = fill_middle.Chunks(50)
    assert [small.summary(i, bytes([65 + i % 20]) * 20)[0] for i in range(100)] == [20] * 100 and small.held <= 50


def test_units_and_marks_over_chunk_edges(monkeypatch):
    """With tiny chunks every character and mark is on an edge somewhere."""
    monkeypatch.setattr(fill_middle, "chunk_ends", lambda h: [*range(2, len(h), 2), len(h)])
    for text in ("é漢🤦ab" * 9, "aé<P>", "<M", "x<S>y", "<P", "a<", "<<M>", "<" * 9):
        c = fill_middle.Counted(text.encode(), fill_middle.Chunks())
        assert c.n == len(text) and c.marked == bool(re.search("<[PSM]>", text))
        assert [c.place(i) for i in range(len(text) + 1)] == [len(text[:i].encode()) for i in range(len(text) + 1)]


# -- resampling


def _drawn(rows, target, longest, percent, least, buckets, seed):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    source, aim = Counter(), Counter()
    for r in rows:
        source.update(features(r.text)[1])
    for r in target:
        aim.update(features(r.text)[1])
    s, t = sum(source.values()), sum(aim.values())
    out = []
    for r in rows:
        n, fs = features(r.text)
        weight = sum(math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in fs)
        h = int(hashlib.sha256(f"{seed}:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        out.append((r.doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    may = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    rank = {}
    for i, x in enumerate(may[: len(may) * percent // 100], 1):
        rank.setdefault(x, []).append(i)
    return sorted([(*x[:4], rank[x].pop() if rank.get(x) else None) for x in out], key=repr)


@pytest.mark.parametrize("longest,percent,least,buckets", [(1, 10, 20, 10_000), (2, 50, 5, 64), (3, 100, 1, 1000)])
def test_resampling_of_a_table(spark, docs, clashing, longest, percent, least, buckets):
    target = spark.createDataFrame([(1, PASSAGE[:400]), (2, None), (3, "der B2 漢字 der")], "item_id bigint, text string")
    expected = _drawn(docs.collect(), target.collect(), longest, percent, least, buckets, "2024")
    for table in (docs, clashing):
        assert _rows(resampling.resample(table, target, percent, least, buckets, longest), "doc_id", "n_features", "weight", "score", "rank") == expected


def test_resampling_of_empty_tables(spark, docs, empty):
    assert resampling.resample(empty, docs).collect() == []
    none = spark.createDataFrame([], "text string")
    expected = _drawn(docs.collect(), [], 1, 10, 20, 10_000, "2024")
    assert _rows(resampling.resample(docs, none), "doc_id", "n_features", "weight", "score", "rank") == expected


def test_words_of_bytes():
    for text in TEXTS:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        assert [w.decode() for w in resampling.words(text and text.encode())] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_resampling"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    out = llm_queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    expected = c.sql(llm_queries.ORACLE_SQL[name])
    assert sorted(expected.columns) == sorted(out.columns)
    assert _rows(out, *expected.columns) == sorted(expected.fetchall(), key=repr)


def test_token_count_query(spark, model):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in llm_queries.QUERIES["op13_token_counts"](spark, "/root/testdata/sf0.001").collect():
        n = len(model.encode(rows[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(rows[r.doc_id].encode()), n, n > 4096)
