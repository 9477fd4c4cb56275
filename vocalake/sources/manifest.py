"""Line-based inputs: manifests, batches of texts, splits."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vocalake.functions.text import strip


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no (from 1, over files in order of their names) and raw of every line.

    Lines are numbered within their block of a file, and blocks by the lines before them: a count per block is all that is
    gathered, so a file of any size is read by many tasks.
    """
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_id"))
    blocks = lines.groupBy("_f", "_b").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)  # over one row per block
    blocks = blocks.select("_f", "_b", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return lines.join(blocks, ["_f", "_b"]).select((F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "raw")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """line_no, raw of the lines that aren't blank; blank ones keep their numbers."""
    return numbered_lines(spark, path).where(strip(F.col("raw")) != "")


def manifest_error(spark: SparkSession, path: str) -> str | None:
    """Why there is nothing to validate at a path: not_found, or empty (no line at all); null if there is."""
    try:
        return "empty" if spark.read.text(path).isEmpty() else None
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return "not_found"


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """i (from 1 over kept lines), text: lines stripped, without blank ones. A path without any such line is a ValueError."""
    kept = spark.read.text(path).select(strip(F.col("value")).alias("text"), F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_id")).where("text <> ''")
    if kept.isEmpty():
        raise ValueError(f"{path} has no text")
    w = Window.partitionBy("_f", "_b").orderBy("_id")
    before = Window.orderBy("_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = kept.groupBy("_f", "_b").agg(F.count("*").alias("_n")).select("_f", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return kept.withColumn("_r", F.row_number().over(w)).join(blocks, ["_f", "_b"]).select((F.col("_before") + F.col("_r")).alias("i"), "text")


def read_splits(train: DataFrame, val: DataFrame | None = None) -> DataFrame:
    out = train.withColumn("split", F.lit("train"))
    return out if val is None else out.unionByName(val.withColumn("split", F.lit("validation")))


def canonicalise_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """df with the mapped columns under their usual names (text, audio, ref_audio, dataset_id); dataset_id is 0 where there is no such column."""
    names = {source: name for name, source in mapping.items() if source in df.columns}
    out = df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])
    if "audio" not in out.columns:
        raise ValueError(f"no audio column: {mapping.get('audio', 'audio')} is not among {df.columns}")
    return out if "dataset_id" in out.columns else out.withColumn("dataset_id", F.lit(0))
