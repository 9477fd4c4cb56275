"""Work that is cut into parts, so that disks and workers hold a bounded share of it."""

import os

from pyspark.sql import functions as F

from vocalake.sources.listing import artifact_files
from vocalake.sources.sidecars import by_parts_of_tree


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]


def test_tree_by_parts_holds_some_files_at_a_time_and_leaves_none(spark, tmp_path):
    rows = spark.range(300).select(F.format_string("run_%d/step_%d/config.json", F.col("id") % 7, "id").alias("name"), F.col("id").cast("string").alias("payload"))
    held = []

    def read(path):
        own = path.removeprefix("file:").replace("//", "/")
        held.append((own, len([f for f in _files(own) if f.endswith("config.json")])))
        return artifact_files(spark, path).where("name is not null and dir <> ''").select("dir", "name", "body")

    got = by_parts_of_tree(rows, read, most=50)
    assert sorted((r.dir, r.body) for r in got.collect()) == sorted((f"run_{i % 7}/step_{i}", str(i)) for i in range(300))
    assert sum(n for _, n in held) == 300 and max(n for _, n in held) < 100 and len(held) == 6
    assert not any(os.path.exists(own) for own, _ in held)


def test_listed_queries_leave_no_tree(spark):
    from vocalake import registry

    top = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = sum(f.endswith("weights.safetensors") for f in _files(top))
    assert registry.QUERIES["s9_listed_catalog"](spark, "/root/testdata/sf0.001").count()
    assert sum(f.endswith("weights.safetensors") for f in _files(top)) == before
