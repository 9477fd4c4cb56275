"""Running prompts of conversations: a prefix scan whose blocks are scanned apart and joined by an associative digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalake.tables import stored

#: The digest of a text is two polynomials of its code points, each with its base and modulus (primes below 2^31).
DIGEST = ((1_000_003, 2_147_483_647), (1_000_033, 2_147_483_629))


class _Powers:
    """Powers of the bases, as many as the longest text needed so far."""

    def __init__(self):
        self.held = [np.ones(1, np.int64) for _ in DIGEST]

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.held[0]) <= n:
            size = len(self.held[0])
            self.held = [np.concatenate([p, p * (int(p[-1]) * b % m) % m]) for p, (b, m) in zip(self.held, DIGEST)]
            assert len(self.held[0]) == 2 * size
        return self.held


def text_digest(text: str, powers: _Powers | None = None) -> list[tuple[int, int]]:
    """(digest, power of the base for its length) of a text, for each modulus: those of a text and one after it make that of both."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    n = len(points)
    return [(int((points * p[:n][::-1] % m).sum() % m), int(p[n])) for p, (_, m) in zip((powers or _Powers()).upto(n), DIGEST)]


def merge_prompts(turns: DataFrame) -> DataFrame:
    """conv_id, turn, prompt_hash, prompt_chars, prompt_feats, mode: what the prompt of all turns up to each one is.

    turns: conv_id, turn, text, ref_audio and, if there are features, n_feats (how many a turn has). The prompt of a turn is
    the first prompt_chars characters of the conversation's texts, and its first prompt_feats features; prompt_hash tells
    such texts apart, however they are cut into turns (two digests of 31 bits, one number). mode is ref_continuation from
    the first turn with a reference on.

    Turns are dealt by ranges of (conv_id, turn), so a long conversation is many tasks'. Each range is scanned by itself,
    and what stands before it comes from one row per range. Null texts are empty; null ids are one conversation; repeated
    turns come in the order of their texts.
    """
    kinds = dict(turns.dtypes)
    feats = F.col("n_feats").cast("bigint") if "n_feats" in kinds else F.lit(0).cast("bigint")
    rows = turns.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(feats, F.lit(0)).alias("n_feats"), F.col("ref_audio").isNotNull().alias("ref"))
    names = ["conv_id", "turn", "_part", "_row", "_open", "_h1", "_p1", "_h2", "_p2", "chars", "feats", "ref"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, powers, first, row = TaskContext.get().partitionId(), _Powers(), True, 0
        conv = state = None
        for batch in batches:
            out = []
            for c, text, n, ref in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "text", "n_feats", "ref"))):
                if state is None or c != conv:
                    first = state is None
                    conv, state = c, [0, 1, 0, 1, 0, 0, False]
                (h1, p1), (h2, p2) = text_digest(text, powers)
                a, b, d, e, chars, feats, had = state
                state = [(a * p1 + h1) % DIGEST[0][1], b * p1 % DIGEST[0][1], (d * p2 + h2) % DIGEST[1][1], e * p2 % DIGEST[1][1], chars + len(text), feats + n, had or ref]
                out.append((part, row, first, *state))
                row += 1
            columns = list(zip(*out)) if out else [()] * 10
            types = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.bool_()]
            yield pa.record_batch([batch.column("conv_id"), batch.column("turn"), *(pa.array(x, t) for x, t in zip(columns, types))], names)

    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, _part bigint, _row bigint, _open boolean, _h1 bigint, _p1 bigint, _h2 bigint, _p2 bigint, chars bigint, feats bigint, ref boolean"
    local = stored(rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "text").mapInArrow(scan, schema))

    state = ("_h1", "_p1", "_h2", "_p2", "chars", "feats", "ref")
    ends = local.groupBy("_part").agg(F.min_by("conv_id", "_row").alias("first"), F.max_by(F.struct("conv_id", "_open", *state), "_row").alias("last"))

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the conversation at the start of each range has had before it."""
        conv, had, any_before = None, None, False
        for batch in batches:
            out = []
            for part, first, last in zip(*(batch.column(x).to_pylist() for x in ("_part", "first", "last"))):
                before = had if any_before and conv == first else None
                out.append((part, *(before or (0, 0, 0, 0, False))))
                h1, p1, h2, p2, chars, feats, ref = (last[x] for x in state)
                if before and last["_open"]:
                    h1, h2 = (before[0] * p1 + h1) % DIGEST[0][1], (before[1] * p2 + h2) % DIGEST[1][1]
                    chars, feats, ref = before[2] + chars, before[3] + feats, before[4] or ref
                conv, had, any_before = last["conv_id"], (h1, h2, chars, feats, ref), True
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.record_batch([*(pa.array(x, pa.int64()) for x in columns[:5]), pa.array(columns[5], pa.bool_())], ["_part", "b1", "b2", "bchars", "bfeats", "bref"])

    carried = ends.repartition(1).sortWithinPartitions("_part").mapInArrow(carry, "_part bigint, b1 bigint, b2 bigint, bchars bigint, bfeats bigint, bref boolean")  # a row per range
    own = lambda c: F.when(F.col("_open"), F.col(c)).otherwise(0)
    out = local.join(F.broadcast(carried), "_part")
    h1, h2 = (F.pmod(own(b) * F.col(p) + F.col(h), F.lit(m)) for b, p, h, (_, m) in (("b1", "_p1", "_h1", DIGEST[0]), ("b2", "_p2", "_h2", DIGEST[1])))
    with_ref = F.col("ref") | (F.col("_open") & F.col("bref"))
    return out.select("conv_id", "turn", (h1 * (1 << 31) + h2).alias("prompt_hash"), (own("bchars") + F.col("chars")).alias("prompt_chars"), (own("bfeats") + F.col("feats")).alias("prompt_feats"), F.when(with_ref, "ref_continuation").otherwise("continuation").alias("mode"))


def prompt_features(turns: DataFrame, feats: DataFrame) -> DataFrame:
    """conv_id, at, values: the features of each turn (conv_id, turn, i from 0, values) at their places in the conversation's own track. The prompt of a turn has those with at < prompt_feats, so no turn copies those of the turns before."""
    ends = merge_prompts(turns).select("conv_id", "turn", "prompt_feats").join(turns.select("conv_id", "turn", F.col("n_feats").cast("bigint").alias("n_feats")), ["conv_id", "turn"])
    return feats.join(ends, ["conv_id", "turn"]).select("conv_id", (F.col("prompt_feats") - F.coalesce("n_feats", F.lit(0)) + F.col("i")).alias("at"), "values")
