"""Lengths, token budgets, order, batches and shards of samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalake.operators.hooks import PerWorker
from vocalake.tables import numbered, stored


def estimate_length(text_len: Column, duration: Column, ref_duration: Column, fps: float = 25.0, patch: int = 4) -> Column:
    """Positions of a packed sample: text, audio patches, reference patches, and 2 or 4 marks."""
    patches = lambda d: F.ceil(F.ceil(d * fps) / patch)
    ref = F.when(F.coalesce(ref_duration, F.lit(0.0)) > 0, patches(ref_duration)).otherwise(0)
    return (text_len + patches(duration) + ref + F.when(ref > 0, 4).otherwise(2)).cast("long")


def token_budget_filter(df: DataFrame, budget: int, batch: int, length: str = "length") -> DataFrame:
    """Rows of the train split whose length fits budget div batch; all rows without a budget. batch below 1: any length fits."""
    if budget <= 0 or batch <= 0:
        return df
    return df.where((F.col("split") != "train") | (F.col(length) <= budget // batch))


def select_kept(df: DataFrame, limit: int, length: str = "length") -> DataFrame:
    """The rows whose length fits the limit."""
    return df.where(F.col(length) <= limit)


def budget_report(df: DataFrame, budget: int, batch: int, length: str = "length") -> DataFrame:
    """total, dropped, most: rows of the train split, how many of them `token_budget_filter` leaves out, and the length that still fits (null: any)."""
    most = budget // batch if budget > 0 and batch > 0 else None
    return df.where("split = 'train'").agg(F.count("*").alias("total"), (F.count_if(F.col(length) > most) if most is not None else F.lit(0).cast("bigint")).alias("dropped")).withColumn("most", F.lit(most).cast("bigint"))


def head_samples(df: DataFrame, key: str, n: int = 2) -> DataFrame:
    """The first n rows in order of the key: a look at the data."""
    return df.orderBy(key).limit(n)


def epoch_shuffle(df: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """df with its position in an order that depends on seed and epoch."""
    return numbered(df.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:{epoch}:"), F.col(key).cast("string")))), "_key", key).drop("_key")


def assign_batches(df: DataFrame, size: int, drop_last: bool) -> DataFrame:
    """df (with position) with batch_id and pos_in_batch; drop_last leaves out a last batch that isn't full."""
    out = df.withColumn("batch_id", F.floor(F.col("position") / size)).withColumn("pos_in_batch", (F.col("position") % size).cast("int"))
    if drop_last:
        full = df.agg(F.floor(F.count("*") / size).alias("_full"))
        out = out.join(F.broadcast(full), F.col("batch_id") < F.col("_full")).drop("_full")  # one row
    return out


def shard_ranks(df: DataFrame, world: int) -> DataFrame:
    return df.withColumn("rank", F.pmod("position", F.lit(world)).cast("int") if world > 1 else F.lit(0))


def dataset_count(df: DataFrame) -> DataFrame:
    """n: datasets that ids number, 1 without the column."""
    n = F.coalesce(F.max("dataset_id") + 1, F.lit(1)) if "dataset_id" in df.columns else F.max(F.lit(1))
    return df.agg(n.cast("int").alias("n"))


def dataset_count_by_batch(df: DataFrame, given: int = 1) -> DataFrame:
    """batch_id, n: datasets that a batch's tallies have room for: those that are given, or more if an id of the batch needs it, one at least."""
    return df.groupBy("batch_id").agg(F.greatest(F.lit(given), F.coalesce(F.max("dataset_id") + 1, F.lit(0)), F.lit(1)).cast("int").alias("n"))


def consumption_by_dataset(packed: DataFrame, n: int, fps: float = 25.0) -> DataFrame:
    """batch_id, dataset_id, seconds of audio and text tokens (cut to whole numbers after summing), with zeros for unused ids."""
    sums = packed.groupBy("batch_id", "dataset_id").agg((F.sum("frames") / fps).cast("long").alias("audio_seconds"), F.sum("text_tokens").cast("long").alias("text_tokens"))
    ids = packed.select("batch_id").distinct().select("batch_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("dataset_id"))
    return ids.join(sums, ["batch_id", "dataset_id"], "left").fillna(0, ["audio_seconds", "text_tokens"])


def vocab_encode(tokens: DataFrame, vocab: DataFrame, unk: int = 0, most: int = 1_000_000, block: int = 1_000_000) -> DataFrame:
    """key, ids: tokens (key, tokens array) by a vocabulary (token, id; each token once), unknown ones as unk.

    A vocabulary of at most `most` rows is broadcast, and each array looked up where it lies: nothing is shuffled. A larger
    one is joined by blocks of about `block` tokens (or one row): a block's distinct tokens get numbers of its own and meet
    the vocabulary once, so a hot token crosses once per block; what is shuffled of the texts are these numbers. A null
    token is unknown, null tokens are an empty array.
    """
    vocab = vocab.select("token", F.col("id").cast("int").alias("id"))
    held = vocab.limit(most + 1).toArrow()
    kind = dict(tokens.dtypes)["key"]
    if held.num_rows <= most:
        spark = tokens.sparkSession
        table = spark.sparkContext.broadcast(held)
        known = PerWorker(lambda: dict(zip(table.value.column("token").to_pylist(), table.value.column("id").to_pylist())))

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with known as find:
                for batch in _by_tokens(batches, block):
                    sizes, distinct, codes = _numbered_tokens(batch.column("tokens"))
                    ids = np.array([*(find.get(t, unk) for t in distinct), unk], np.int32)[codes]  # the last one is that of nulls
                    yield pa.record_batch([batch.column("key"), _arrays(sizes, ids)], ["key", "ids"])

        return tokens.select("key", "tokens").mapInArrow(look_up, f"key {kind}, ids array<int>")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of keys and the numbers of their tokens, and for each block one row of its distinct tokens."""
        part, n = TaskContext.get().partitionId(), 0
        for batch in _by_tokens(batches, block):
            sizes, distinct, codes = _numbered_tokens(batch.column("tokens"))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + block, "right")) - 1)
                used, own = np.unique(codes[ends[start] : ends[stop]], return_inverse=True)
                words = [distinct[i] if i >= 0 else None for i in used.tolist()]
                rows, at = stop - start, (part << 33) + n
                yield pa.record_batch([
                    pa.array([at] * (rows + 1), pa.int64()), pa.concat_arrays([batch.column("key").slice(start, rows), pa.nulls(1, batch.column("key").type)]),
                    pa.array([False] * rows + [True]), pa.concat_arrays([_arrays(sizes[start:stop], own.astype(np.int32)), pa.nulls(1, pa.list_(pa.int32()))]), pa.array([None] * rows + [words], pa.list_(pa.string())),
                ], ["block", "key", "head", "codes", "words"])
                start, n = stop, n + 1

    rows = stored(tokens.select("key", "tokens").mapInArrow(coded, f"block bigint, key {kind}, head boolean, codes array<int>, words array<string>"))
    words = rows.where("head").select("block", F.posexplode("words").alias("code", "token")).join(vocab, "token", "left")
    table = words.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("code", F.coalesce("id", F.lit(unk)).alias("id")))).alias("_t"))
    out = rows.where("not head").select("block", "key", "codes").join(table.select("block", F.transform("_t", lambda x: x["id"]).alias("_ids")), "block", "left")
    return out.select("key", F.transform("codes", lambda c: F.get("_ids", c)).alias("ids"))


def _by_tokens(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of `most` tokens at most (or one row), so a worker holds the numbers of so many."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _numbered_tokens(lists: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Of arrays of tokens: how many each has, their distinct tokens, and the number of every token (-1 for null)."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return sizes, coded.dictionary.to_pylist(), pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)


def _arrays(sizes: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, pa.int32()))


def clip_pad(df: DataFrame, track: str, batch: str, most: int, pad) -> DataFrame:
    """track cut or filled to the longest of its batch, at most `most`."""
    from vocalake.functions.nested import pad_to

    target = df.groupBy(batch).agg(F.least(F.max(F.size(track)), F.lit(most)).alias("_n"))
    return df.join(target, batch).withColumn(track, pad_to(F.col(track), F.col("_n"), pad)).drop("_n")


def latent_track(packed: DataFrame, latents: DataFrame) -> DataFrame:
    """key, pos (from 0), values: packed samples (key, audio_mask) a row per position, with the latents (key, patch from 0, values) at audio positions in order, zero patches of their width elsewhere.

    values is null where an audio position has no latent.
    """
    at = lambda m: F.filter(F.sequence(F.lit(0), F.size("audio_mask") - 1), lambda i: F.get("audio_mask", i) == m)
    some = packed.where(F.size("audio_mask") > 0)
    audio = some.select("key", F.posexplode(at(1)).alias("patch", "pos")).join(latents, ["key", "patch"], "left").select("key", "pos", "values")
    width = latents.agg(F.max(F.size("values")).alias("_w"))  # one row
    zero = F.transform(F.array_repeat(F.lit(0), F.col("_w")), lambda x: x.cast("double"))
    rest = some.select("key", F.explode(at(0)).alias("pos")).join(F.broadcast(width)).select("key", "pos", zero.alias("values"))
    return audio.unionByName(rest)


def tokenized(df: DataFrame, tokenize: Callable[[list[str]], list[list[int]]] | PerWorker, column: str = "text", remove: tuple[str, ...] = ()) -> DataFrame:
    """df with text_ids by a user's batch tokenizer, or by a `PerWorker` that makes one, without the columns to remove. Where a vocabulary join does, `vocab_encode` is faster."""
    hook = tokenize if isinstance(tokenize, PerWorker) else PerWorker(lambda: tokenize)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with hook as own:
            for texts in batches:
                yield pd.Series(own(texts.fillna("").tolist()), index=texts.index)

    return df.withColumn("text_ids", ids(F.col(column))).drop(*remove)
