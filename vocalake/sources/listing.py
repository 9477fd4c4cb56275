"""Files and folders of a tree, listed in tasks; stores are those that Arrow's file systems know."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalake.tables import stored

#: Rows of a listing that a task hands over at once, times that folders are dealt, and entries up to which a task also lists what is below its folders.
BATCH_ROWS, DEEPEST, WALK = 50_000, 200, 100_000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def list_tree(spark: SparkSession, path: str) -> DataFrame:
    """dir, name, is_dir, bytes, modified of all files and folders under a folder; dir is relative to it, "" for itself.

    Folders are listed by as many tasks as run at once, however few bytes their names have. Where there are several for each, a
    task also lists what is below its own, up to `WALK` entries; what it leaves is dealt anew, and the driver sees whether
    anything is left. A folder that is gone meanwhile has no rows, and no folder at all is an empty table. One folder is one task's.
    """
    kinds = "dir string, name string, is_dir boolean, bytes bigint, modified timestamp, more boolean"

    def run(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
        store, top = opened(path)
        rows: list[tuple] = []
        walked = 0

        def full() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.record_batch([*map(pa.array, columns[:2]), pa.array(columns[2], pa.bool_()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.timestamp("us", "UTC")), pa.array(columns[5], pa.bool_())], ["dir", "name", "is_dir", "bytes", "modified", "more"])

        for batch in batches:
            for given in batch.column("dir").to_pylist():
                below = [given]
                while below:
                    d = below.pop()
                    for x in store.get_file_info(fs.FileSelector(f"{top.rstrip('/')}/{d}", allow_not_found=True)):
                        folder, down = not x.is_file, walked < most
                        walked += 1
                        rows.append((d, x.base_name, folder, x.size, x.mtime_ns and x.mtime_ns // 1000, folder and not down))
                        if folder and down:
                            below.append(f"{d}/{x.base_name}" if d else x.base_name)
                        if len(rows) == BATCH_ROWS:
                            yield full()
        if rows:
            yield full()

    level, many, found, tasks = spark.createDataFrame([("",)], "dir string"), False, [], spark.sparkContext.defaultParallelism
    for _ in range(DEEPEST):
        most = WALK if many else 0
        found.append(stored(level.repartition(tasks, "dir").mapInArrow(lambda batches, most=most: run(batches, most), kinds)))
        level = found[-1].where("more").select(F.concat_ws("/", F.nullif("dir", F.lit("")), "name").alias("dir"))
        if not (n := level.count()):
            return reduce(DataFrame.unionAll, found).drop("more")
        many = n >= 8 * tasks
    raise RuntimeError(f"{path} has more than {DEEPEST} levels")


def with_bodies(files: DataFrame, path: str, wanted: str, most: int = 1 << 20) -> DataFrame:
    """dir, name, is_dir, bytes, modified of a listing with body: the text of files that fit the condition and have at most `most` bytes; null for others, and where it can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = opened(path)

        def body(d: str, name: str, read: bool) -> str | None:
            if not read:
                return None
            try:
                with store.open_input_file(f"{top.rstrip('/')}/{d}/{name}") as f:
                    return f.read().decode()
            except (OSError, UnicodeDecodeError):
                return None

        for batch in batches:
            bodies = [body(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("dir", "name", "_read")))]
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(bodies, pa.string())], [*names, "body"])

    names = ["dir", "name", "is_dir", "bytes", "modified"]
    read = F.expr(wanted) & ~F.col("is_dir") & (F.col("bytes") <= most)
    rows = files.select(*names, F.coalesce(read, F.lit(False)).alias("_read")).repartition(files.sparkSession.sparkContext.defaultParallelism, "dir", "name")
    return rows.mapInArrow(run, "dir string, name string, is_dir boolean, bytes bigint, modified timestamp, body string")


def artifact_files(spark: SparkSession, path: str) -> DataFrame:
    """dir, name, body of the files under a folder, as `runs` takes them: bodies of small JSON files; a folder is a row without a name, so an empty one is seen, too."""
    rows = with_bodies(list_tree(spark, path), path, "name like '%.json'")
    own = F.concat_ws("/", F.nullif("dir", F.lit("")), "name")
    return rows.select(F.when(F.col("is_dir"), own).otherwise(F.col("dir")).alias("dir"), F.when(~F.col("is_dir"), F.col("name")).alias("name"), "body")
