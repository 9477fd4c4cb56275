"""Connected components of an edge table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalake.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """node, component (the smallest node that it reaches), for every node of an edge.

    Large and small stars in turn (Kiveris et al. 2014): every node hangs its larger, then its smaller neighbours below
    the smallest one it knows, until nothing changes. Each round is a grouping by node with a running minimum, so a node
    with very many neighbours is aggregated before it is shuffled; rounds are written to the shared folder, and the
    driver sees counts only. Edges of a node with itself and nulls are dropped.
    """
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    digest = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    last = tuple(now.agg(*digest).first())
    for _ in range(most if last[0] else 0):
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = large.join(least, "u")
        small = kept.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        after = stored(small.where("u <> v"))
        now, before = after, last
        last = tuple(now.agg(*digest).first())
        if last == before:
            break
    else:
        if last[0]:
            raise RuntimeError(f"components did not settle in {most} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
