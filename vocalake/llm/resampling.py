"""Importance resampling towards a target: documents whose word features the target has more often are likelier drawn.

Features are runs of words, told apart by the checksum of their bytes in a fixed number of buckets. A table of 256 bytes
lower-cases and blanks separators in UTF-8, splitting the bytes yields words, and the checksum of a longer run goes on
from the shorter one's. Tasks reduce their features to counts by bucket, Spark adds them up, and the table of gains has
one row per bucket, so it may be broadcast however large the corpus is. Scores are gains plus Gumbel noise by id; the
highest ones are a draw without replacement by weight.

Ranks are global positions by ranges and counts per range, so no task sorts all scores. Only documents that may be drawn
take part in that.

Defined cases: a null or empty text has no features, weight 0, and is not drawn; ties go to the smaller id; rows that
share an id get the same noise, each has a rank of its own; a null id is hashed as the empty string and comes after
others of its score; an empty table gives no rows, an empty target only gains by the corpus; other columns are left
alone, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalake.llm.common import Memo, by_parts, stored, table
from vocalake.tables import numbered, spread

BUCKETS, LONGEST, LEAST_WORDS, PERCENT = 10_000, 1, 20, 10
#: A-Z as a-z; a-z, 0-9 and all bytes of other characters as they are; the rest separates words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def features(text: list[bytes], longest: int, crc: Memo) -> list[int]:
    """Checksums of all runs of 1 to `longest` consecutive words, joined by one space."""
    seeds = list(map(crc.__getitem__, text))
    out = list(seeds)
    for n in range(1, longest):
        seeds = [zlib.crc32(b" " + w, s) for s, w in zip(seeds, text[n:])]
        out += seeds
    return out


def bucket_counts(df: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """bucket, n (features in it) of a table's texts: a row per bucket and task is shuffled at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = Memo(zlib.crc32), Counter()
        for batch in by_parts(batches):
            seen: Counter = Counter()
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                seen.update(words(text) if longest == 1 else features(words(text), longest, crc))
            for feature, n in seen.items():
                total[(crc[feature] if longest == 1 else feature) % buckets] += n
        yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["bucket", "n"])

    return spread(df.select("text")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Of each bucket: a thousand times the logarithm of target share over source share, each with one more in every bucket."""
    s, t = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1) * s / ((source.get(b, 0) + 1) * t))) for b in range(buckets)]


def weights(docs: DataFrame, gain: list[int], longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, buckets = shared.value, len(shared.value)
        crc = Memo(zlib.crc32)
        of_word = Memo(lambda w: gain[zlib.crc32(w) % buckets])
        for batch in by_parts(batches):
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = words(text)
                if longest == 1:
                    rows.append((len(found), len(found), sum(map(of_word.__getitem__, found))))
                else:
                    all_of = features(found, longest, crc)
                    rows.append((len(found), len(all_of), sum(gain[x % buckets] for x in all_of)))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 3)]
            yield pa.record_batch([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, buckets: int = BUCKETS, longest: int = LONGEST, seed: str = "2024") -> DataFrame:
    """doc_id, n_features, weight, score, rank of each document; rank is null where it isn't drawn."""
    source, aim = ({r["bucket"]: r["n"] for r in bucket_counts(t, buckets, longest).collect()} for t in (docs, target))  # a row per bucket
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = stored(weights(docs, gains(source, aim, buckets), longest).withColumn("score", F.col("weight") + noise))
    may = scored.where(F.col("n_words") >= least)
    drawn = may.count() * percent // 100
    place = numbered(may.withColumn("_down", -F.col("score")).withColumn("_null", F.col("doc_id").isNull()), "_down", "_null", "doc_id")
    columns = ("doc_id", "n_features", "weight", "score")
    ranked = place.select(*columns, F.when(F.col("position") < drawn, F.col("position") + 1).alias("rank"))
    return ranked.unionByName(scored.where(F.col("n_words") < least).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_CRC = "xor(list_reduce(list_concat([4294967295], [('0x' || hex(encode(w))[2 * i + 1 : 2 * i + 2])::BIGINT FOR i IN range(strlen(w))]), lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
SQL = rf"""
WITH a AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
d AS (SELECT doc_id, unnest(l) AS w FROM a), v AS (SELECT w, {_CRC} % {BUCKETS} AS bucket FROM (SELECT w FROM d UNION SELECT w FROM b)),
s AS (SELECT bucket, count(*) AS n FROM d JOIN v USING (w) GROUP BY bucket), t AS (SELECT bucket, count(*) AS n FROM b JOIN v USING (w) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s FULL JOIN t USING (bucket)),
y AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM d JOIN v USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
z AS (SELECT doc_id, len(l)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id::VARCHAR)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM a LEFT JOIN y USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM z WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) FROM r) * {PERCENT} // 100 THEN rank END AS rank FROM z LEFT JOIN r USING (doc_id)
"""
