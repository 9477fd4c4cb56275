"""Durable intermediate tables, and global row numbers without a single task."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder named by spark.checkpoint.dir. Where that is unset, a temporary one, but only in local mode: no other machine would see it."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        sc.setCheckpointDir(named or f"file://{tempfile.mkdtemp(prefix='spark-')}")
    return f"{sc._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again; the shuffles of this write are dropped at its end."""
    spark, path, cleanup = df.sparkSession, shared_path(df.sparkSession), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over as many tasks as can run at once, where it comes in fewer partitions (a small table of one row group); a large one stays as it lies. For scans: a plan with shuffles would run to tell its partitions."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def numbered(df: DataFrame, *keys: str, name: str = "position") -> DataFrame:
    """df with the position (from 0) of each row in the order of the keys, which must tell rows apart.

    Rows are dealt by ranges of the keys and sorted within; the offsets of the ranges come from a count per range (as many
    rows as partitions), so nothing funnels through one task.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    ranged = stored(ranged.select("*", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_row")).drop("_id"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def in_blocks(df: DataFrame, *keys: str, before: int, size: int = 100_000) -> tuple[DataFrame, WindowSpec]:
    """df in the order of the keys (which must tell rows apart), and a window over it that reaches `before` rows back.

    Rows are numbered and cut into blocks of `size`; the last rows of a block are in the next one too, with _own false, so a
    window's task has size + before rows at most, however many rows share a key. Rows with _own are those of df.
    """
    size = max(size, before + 1)
    block = F.floor(F.col("_at") / size)
    late = F.col("_at") % size >= size - before
    rows = numbered(df, *keys, name="_at").withColumn("_home", block)
    rows = rows.withColumn("_block", F.explode(F.when(late, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
    return rows.withColumn("_own", F.col("_block") == F.col("_home")).drop("_home"), Window.partitionBy("_block").orderBy("_at")


def upper_median(df: DataFrame, column: str) -> DataFrame:
    """median: the value at place n div 2 of the sorted values (nulls left out); null without any.

    Values are counted, so that frequent ones are one row, dealt by ranges, and added up within a range; the ranges before
    it come from a sum per range.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    ranged = stored(counts.repartitionByRange("_v").withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    parts = ranged.groupBy("_part").agg(F.sum("_n").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    up_to = F.col("_before") + F.sum("_n").over(Window.partitionBy("_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(F.broadcast(parts), "_part").withColumn("_up", up_to).where(F.col("_up") > F.floor(F.col("_all") / 2)).agg(F.min("_v").alias("median"))
