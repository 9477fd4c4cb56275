"""A corpus pipeline of five stages: each takes the documents that the one before kept, as a table.

`run` writes what each stage returns as Parquet in the shared folder and reads it again for the next one. All columns go
through all stages but the last, whatever their names. Defined cases: an empty table stays empty; a text that is null,
empty or without words fails the quality rules (so later stages get none from `run`; on their own they keep such rows as
they are); a null id is a document of its own, which no other one is linked with; rows that share an id are judged each
by its text, but stay or go together in the quality stage; of equal rows one is left by `near_duplicates`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalake.llm import jaccard_join, packing, quality_rules, run_length_index, weak_toxicity
from vocalake.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.apply_rules(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't score as toxic."""
    return weak_toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are linked by similarities of 0.8 or more."""
    return jaccard_join.without_near_duplicates(docs, 5, 80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 100 bytes or more that occur earlier; n_chars, where there is one, follows the text (0 for null)."""
    out = run_length_index.deduplicated(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("toxicity", toxicity), ("jaccard_join", near_duplicates), ("suffix_dedup", repeats), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The learned and tokenized stages can't be told in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None
