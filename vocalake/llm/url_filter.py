"""URL filter: listed rules first, then a ratio of character models.

Two smoothed Markov models of variable order (contexts of 0 to 3 symbols, Witten-Bell interpolation down to uniform) are
counted over all urls that a rule accepts or rejects; the others are judged by the difference of their log-likelihoods
per symbol. The cutoff is calibrated on listed urls that were kept out of the counts: at most `limit` of the accepted
ones fall below it, and at least half of the rejected ones do not (a url is blocked only if it looks as bad as those). Symbols are folded to 40 classes, so a model has 40^4 cells at most, whatever the input.

Defined cases: a null url or one without `://` has an empty host and path; without accepted or rejected urls to learn
from, what no rule decides is allowed; repeated urls are judged alike; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalake.llm.common import stored, table

#: Host, path, verdict.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
ORDER, LIMIT = 3, 0.01
#: Symbol classes: 0 for all others, 1 for the end, then these (upper case folded).
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./"
WIDTH = len(ALPHABET) + 2
#: Score bins of the calibration: width and number on either side of 0.
BIN, BINS = 0.005, 2000

_CLASS = np.zeros(256, np.int64)
for _i, _c in enumerate(ALPHABET, 2):
    _CLASS[ord(_c)] = _CLASS[ord(_c.upper())] = _i


def split_urls(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path."""
    out = pages.select("page_id", "url")
    rest = F.coalesce(F.when(F.col("url").contains("://"), F.expr("substring(url, locate('://', url) + 3)")), F.lit(""))
    out = out.withColumn("_rest", rest).withColumn("_host", F.regexp_extract("_rest", r"^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(_rest, length(_host) + 1)"), r"^[^?#]*", 0)
    low = F.translate("_host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return out.select("page_id", "url", low.alias("host"), path.alias("path"))


def with_rules(urls: DataFrame, rules=RULES) -> DataFrame:
    """urls with rule and listed (its verdict): the longest rule whose host is the url's or above it, and whose path its path starts with."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("listed", verdict)


def _symbols(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each symbol with its three predecessors, the place where each string begins, and its length; strings end with an end symbol."""
    raw = [s.encode() for s in strings]
    lengths = np.array([len(r) + 1 for r in raw], np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = _CLASS[np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)]
    flat[starts + lengths - 1] = 1
    place = np.arange(len(flat)) - np.repeat(starts, lengths)
    cells = flat.copy()
    for back in range(1, ORDER + 1):
        before = np.ones(len(flat), np.int64)
        before[back:] = flat[:-back]
        before[place < back] = 1
        cells += before * WIDTH**back
    return cells, starts, lengths


def counts(listed: DataFrame) -> DataFrame:
    """cell, allow, block: how often each symbol follows each context in accepted and in rejected urls. At most 40^4 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, WIDTH ** (ORDER + 1)), np.int64)
        for batch in batches:
            if batch.num_rows:
                cells, _, lengths = _symbols(batch.column("s").to_pylist())
                blocked = np.repeat(np.array(batch.column("blocked").to_pylist(), np.int64), lengths)
                for k in (0, 1):
                    total[k] += np.bincount(cells[blocked == k], minlength=total.shape[1])
        found = np.flatnonzero(total.any(0))
        yield pa.record_batch([pa.array(found), pa.array(total[0][found]), pa.array(total[1][found])], ["cell", "allow", "block"])

    rows = listed.select(F.concat("host", "path").alias("s"), (F.col("listed") == "block").cast("int").alias("blocked"))
    return rows.mapInArrow(run, "cell bigint, allow bigint, block bigint").groupBy("cell").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))


def log_probabilities(n: np.ndarray) -> np.ndarray:
    """Of each symbol after each context of ORDER symbols: orders 0 to ORDER interpolated by Witten-Bell."""
    n = n.reshape((WIDTH,) * (ORDER + 1)).astype(np.float64)
    p = np.full(WIDTH, 1 / WIDTH)
    for order in range(ORDER + 1):
        c = n.sum(axis=tuple(range(ORDER - order)))
        kinds = (c > 0).sum(-1, keepdims=True)
        total = c.sum(-1, keepdims=True)
        p = np.where(total > 0, (c + kinds * p) / np.maximum(total + kinds, 1), p)
    return np.log(p).ravel()


def score(urls: DataFrame, ratio: np.ndarray) -> DataFrame:
    """urls with score: log-likelihood when accepted less that when rejected, per symbol of host and path."""
    held = urls.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))
    names = ["page_id", "host", "path", "rule", "listed", "kept_out"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                strings = [h + p for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
                cells, starts, lengths = _symbols(strings)
                out = np.add.reduceat(held.value[cells].astype(np.float64), starts) / lengths
                yield pa.record_batch([*(batch.column(c) for c in names), pa.array(out)], [*names, "score"])

    return urls.select(*names).mapInArrow(run, "page_id bigint, host string, path string, rule string, listed string, kept_out boolean, score double")


def judge(pages: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, score, verdict of each row of pages."""
    urls = with_rules(split_urls(pages), rules).withColumn("kept_out", F.coalesce(F.crc32(F.col("url")) % 5 == 0, F.lit(False)))
    total = np.zeros((2, WIDTH ** (ORDER + 1)), np.int64)
    for r in counts(urls.where("listed is not null and not kept_out")).toLocalIterator():
        total[:, r["cell"]] = r["allow"], r["block"]
    learned = bool(total[0].any() and total[1].any())
    scored = stored(score(urls, log_probabilities(total[0]) - log_probabilities(total[1]) if learned else np.zeros(total.shape[1])))
    # Of either side's urls that weren't counted, a bounded histogram of scores.
    bins = F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") / BIN)))
    below = {k: np.zeros(2 * BINS + 2) for k in ("allow", "block")}
    for r in scored.where("listed is not null and kept_out").groupBy("listed", bins.alias("bin")).count().collect():
        below[r["listed"]][r["bin"] + BINS + 1] = r["count"]
    cuts = [int(np.searchsorted(np.cumsum(n), share * n.sum(), "right")) - 1 - BINS for n, share in ((below["allow"], limit), (below["block"], 0.5)) if n.any()]
    cut = min(cuts) * BIN if learned and len(cuts) == 2 else float("-inf")
    verdict = F.coalesce(F.col("listed"), F.when(F.col("score") < cut, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", "score", verdict.alias("verdict"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
