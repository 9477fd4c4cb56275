"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vocalake.llm.common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text, n_chars (if docs have it) and label (0 or 1) of at most `most` labelled rows that may be learned from, chosen by a hash of the id.

    The ids are chosen before any text is read; that table has `most` rows at most, so it is broadcast. Of rows that share
    an id, one counts. An id with both labels counts as 1; null ids and labels, and labels without a document, are left out.
    """
    known = labels.where(f"doc_id is not null and `{label}` in (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return _rows(docs, known, most)


def unlabelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """doc_id, text, n_chars (if docs have it) of at most `most` rows that have no label and aren't held out, chosen in the same way."""
    known = labels.where("doc_id is not null").select("doc_id").distinct()
    return _rows(docs, docs.where("doc_id is not null").where(~held_out()).select("doc_id").join(known, "doc_id", "left_anti").distinct(), most)


def _rows(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(*[c for c in ("doc_id", "text", "n_chars") if c in docs.columns]).join(F.broadcast(chosen), "doc_id")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))  # Spark keeps one row of an id in each task before it shuffles
    return rows.withColumn("_first", first).where("_first = 1").drop("_first")


def kept_slots(slots: np.ndarray, most: int) -> np.ndarray:
    """Which slots (from 0) of a row to learn from: all, or `most` of them by a hash that also depends on how many there are, so that rows leave out different ones."""
    if len(slots) <= most:
        return np.arange(len(slots))
    mixed = (slots.astype(np.uint64) + np.uint64(len(slots))) * np.uint64(0x9E3779B97F4A7C15)
    return np.sort(np.argsort(mixed ^ (mixed >> np.uint64(29)), kind="stable")[:most])
