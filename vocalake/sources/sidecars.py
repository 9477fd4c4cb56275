"""One file per row, under the row's own name: a sink whose files are whole or absent."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from vocalake.sources.listing import opened
from vocalake.tables import shared_path, stored

#: Files that a part of a tree has, about, where a tree is written and read by parts.
PART_FILES = 120_000
#: So many parts are made of a smaller tree, too, if they have that many files each: on local disks most files are made in the first and removed in the last.
FEW_PARTS, SMALL_PART = 16, 20_000


@dataclass
class Written(WriterCommitMessage):
    files: int


class SidecarWriter(DataSourceWriter):
    """Tasks write into a folder of their own attempt and move their files to their names when all are there.

    A task that fails leaves nothing; one that is tried again, or runs twice, puts the same files in place. Names that
    tasks have put in place are listed in the staging folder: a job that ends well drops it and marks the folder with
    _SUCCESS, one that fails removes the files that it had put in place.
    """

    def __init__(self, path: str):
        self.path, self.staging = path.rstrip("/"), f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"

    def _at(self, name: str, top: str) -> str:
        return name if name.startswith("/") else f"{top}/{name}"

    def write(self, iterator: Iterator[Row]) -> Written:
        task = TaskContext.get()
        store, top = opened(self.path)
        staging = opened(self.staging)[1]
        own = f"{staging}/{task.partitionId()}-{task.attemptNumber()}-{task.taskAttemptId()}"
        store.create_dir(own)
        staged: dict[str, str] = {}
        try:
            for name, payload in iterator:
                place = staged.setdefault(name, f"{own}/{len(staged)}")
                with store.open_output_stream(place) as f:
                    f.write(payload.encode() if isinstance(payload, str) else bytes(payload))
            with store.open_output_stream(f"{own}.names") as f:
                f.write("".join(json.dumps(n) + "\n" for n in staged).encode())
            for folder in {self._at(n, top).rpartition("/")[0] for n in staged}:
                store.create_dir(folder)
            for name, place in staged.items():
                store.move(place, self._at(name, top))
        finally:
            store.delete_dir(own)
        return Written(len(staged))

    def commit(self, messages: list[Written | None]) -> None:
        store, top = opened(self.path)
        if store.get_file_info(opened(self.staging)[1]).type != fs.FileType.NotFound:
            store.delete_dir(opened(self.staging)[1])
        store.create_dir(top)
        with store.open_output_stream(f"{top}/_SUCCESS") as f:
            f.write(json.dumps({"files": sum(m.files for m in messages if m)}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, top = opened(self.path)
        staging = opened(self.staging)[1]
        for x in store.get_file_info(fs.FileSelector(staging, allow_not_found=True)):
            if x.path.endswith(".names"):
                with store.open_input_stream(x.path) as f:
                    names = [json.loads(n) for n in f.read().decode().splitlines()]
                for place in (self._at(n, top) for n in names):
                    if store.get_file_info(place).is_file:
                        store.delete_file(place)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class Sidecars(DataSource):
    """Rows of name and payload; option path: the folder that names which aren't absolute are in."""

    @classmethod
    def name(cls) -> str:
        return "sidecars"

    def schema(self) -> str:
        return "name string, payload string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return SidecarWriter(self.options["path"])


def write_files(rows: DataFrame, path: str, tasks: int | None = None) -> None:
    """Writes the payload (text or bytes) of each row (name, payload) as a file of that name; of rows with one name, the one whose payload sorts last. tasks: how many write; by default, what the rows' bytes ask for."""
    rows.sparkSession.dataSource.register(Sidecars)
    own = rows.where("name is not null and payload is not null").select("name", "payload")
    own.repartition(*([tasks] if tasks else []), "name").sortWithinPartitions("name", "payload").write.format("sidecars").option("path", path).mode("append").save()


def drop_files(rows: DataFrame, path: str) -> None:
    """Removes the folder that rows (name, relative to it) were written into: what is right below it in tasks, then the folder."""

    def run(tops: Iterator[Row]) -> None:
        store, top = opened(path)
        for (name,) in tops:
            at = f"{top.rstrip('/')}/{name}"
            kind = store.get_file_info(at).type
            if kind == fs.FileType.Directory:
                store.delete_dir(at)
            elif kind == fs.FileType.File:
                store.delete_file(at)

    rows.where("name is not null").select(F.substring_index("name", "/", 1)).distinct().repartition(rows.sparkSession.sparkContext.defaultParallelism).foreachPartition(run)
    store, top = opened(path)
    if store.get_file_info(top).type != fs.FileType.NotFound:
        store.delete_dir(top)


class Spent:
    """A task's share of a local tree that nobody needs any more, from which it makes new folders."""

    def __init__(self, places: list[str]):
        self.free: dict[str, list[tuple[str, set[str]]]] = defaultdict(list)  # folders without folders in them, and their files, by the first file's name
        self.below: Counter[str] = Counter()  # folders that still are in a folder
        self.empty: list[str] = []  # folders with nothing in them
        self.above: str | None = None
        for place in places:
            for folder, inner, names in os.walk(place):
                if inner:
                    self.below[folder] = len(inner) + len(names)
                elif names:
                    self.free[min(names)].append((folder, set(names)))
                else:
                    self.empty.append(folder)

    def folder(self, place: str, first: str) -> set[str]:
        """Makes a folder for files of which the first has this name, out of one like it if there is any: the names of the files in it. Folders come in the order of their names."""
        above, free = os.path.dirname(place), self.free.get(first)
        if above != self.above:
            self.above = above
            if not (os.path.isdir(above) or self.empty and self._take(self.empty.pop(), above)):
                os.makedirs(above, exist_ok=True)
        while free:
            folder, names = free.pop()
            if self._take(folder, place):
                return names
        os.makedirs(place, exist_ok=True)
        return set()

    def _take(self, folder: str, place: str) -> bool:
        try:
            os.rename(folder, place)
        except OSError:  # another attempt of the task took it, or nothing is above the place
            return False
        above = os.path.dirname(folder)
        self.below[above] -= 1
        if not self.below[above]:
            self.empty.append(above)
        return True


def _share(top: str, task: int, tasks: int) -> list[str]:
    """What a task has of the entries of a local folder: each entry is one task's."""
    return [f"{top}/{x}" for x in (os.listdir(top) if os.path.isdir(top) else ()) if crc32(os.fsencode(x)) % tasks == task]


def _removed(places: Iterable[str]) -> None:
    for place in places:
        if os.path.isdir(place):
            shutil.rmtree(place, ignore_errors=True)
        elif os.path.exists(place):
            os.remove(place)


def _gone(path: str) -> bool:
    """Whether nothing is left of a local tree; its folder goes then."""
    try:
        os.rmdir(opened(path)[1])
    except OSError:
        return False
    return True


def _put(place: str, goal: str) -> None:
    """Moves a file or folder to its name; where a folder of that name is, what is in this one moves there."""
    try:
        os.rename(place, goal)
    except OSError:
        if not os.path.isdir(place):
            raise
        for x in os.listdir(place):
            _put(f"{place}/{x}", f"{goal}/{x}")


def write_tree(rows: DataFrame, path: str, tasks: int, deal: Column, spent: Sequence[str] = ()) -> None:
    """Writes the payload of each row (name, payload; as write_files, names are relative) into a new local folder. Rows that share `deal` are one task's.

    spent: trees of before. A folder takes over one of theirs whose first file has the same name, under a new name and with
    new payloads; what isn't taken stays. Files and folders that are made and removed each time cost a disk far more: blocks
    and inodes are freed and searched for.
    """
    folder = F.regexp_extract("name", "^(.*)/", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, top = TaskContext.get(), opened(path)[1].rstrip("/")
        own = f"{top}-staging/{task.partitionId()}-{task.attemptNumber()}-{task.taskAttemptId()}"
        os.makedirs(own)
        os.makedirs(top, exist_ok=True)
        free = Spent([x for old in spent for x in _share(opened(old)[1], task.partitionId(), tasks)])
        at, left, files = None, set(), 0
        for batch in batches:
            for name, payload in zip(batch.column("name").to_pylist(), batch.column("payload").to_pylist()):
                into, _, file = name.rpartition("/")
                if into != at:
                    _removed(f"{own}/{at}/{x}" for x in left)
                    at, left = into, free.folder(f"{own}/{into}", file) if into else set()
                content = payload.encode() if isinstance(payload, str) else payload
                with open(f"{own}/{name}", "r+b" if file in left else "wb", buffering=0) as f:  # blocks that are there are written over
                    done = f.write(content)
                    while done < len(content):
                        done += f.write(memoryview(content)[done:])
                    if file in left and (not done or os.fstat(f.fileno()).st_size > done):
                        f.truncate(done)
                left.discard(file)
                files += 1
        _removed(f"{own}/{at}/{x}" for x in left)
        for x in os.listdir(own):
            _put(f"{own}/{x}", f"{top}/{x}")
        shutil.rmtree(own)
        yield pa.record_batch([pa.array([files], pa.int64())], ["files"])

    own = rows.where("name is not null and payload is not null").repartition(tasks, deal).sortWithinPartitions(folder, "name", "payload")
    own.select("name", "payload").mapInArrow(run, "files bigint").agg(F.sum("files")).collect()
    _removed([opened(f"{path}-staging")[1]])


def drop_trees(spark: SparkSession, paths: Sequence[str], tasks: int) -> None:
    """Removes local trees: what is right below them in tasks, then the folders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                _removed(x for path in paths for x in _share(opened(path)[1], k, tasks))
            yield batch

    spark.range(0, tasks, 1, tasks).mapInArrow(run, "id bigint").count()
    _removed(opened(path)[1] for path in paths)


def by_parts_of_tree(rows: DataFrame, read: Callable[[str], DataFrame], most: int = PART_FILES) -> DataFrame:
    """What `read` gives of the folder of each part of the files (name, payload; names are relative): a part is written and read, and gives way to the next one.

    So at most about `most` files, each of which takes a block of a disk or more, are there at a time, and on local disks what
    of one part's folders the next one doesn't take over. A folder's own files are all in one part (many in one folder make it larger), and so is all that
    is below a folder at the top, unless that has over a twentieth of a part.
    """
    spark, table, sink = rows.sparkSession, shared_path(rows.sparkSession), shared_path(rows.sparkSession)
    tasks, local = spark.sparkContext.defaultParallelism, isinstance(opened(table)[0], fs.LocalFileSystem)
    own = rows.where("name is not null and payload is not null").select("name", "payload", F.substring_index("name", "/", 1).alias("top"))
    tops = stored(own.groupBy("top").agg(F.count("*").alias("n")))
    files = tops.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-files // most), min(FEW_PARTS, files // SMALL_PART))
    large = tops.where(F.col("n") > most // 20).select("top", F.lit(True).alias("large"))  # as many as twenty parts have, at most
    own = own.join(F.broadcast(large), "top", "left")
    together = F.when(F.col("large"), F.regexp_extract("name", "^(.*)/", 1)).otherwise(F.col("top"))
    own.withColumn("part", F.pmod(F.xxhash64(together), F.lit(parts)).cast("int")).repartition("part").write.partitionBy("part").parquet(table)
    kept, kind, spent = spark.read.schema(f"top string, name string, payload {dict(own.dtypes)['payload']}, large boolean, part int").parquet(table), None, []
    for k in range(parts):
        path, part = shared_path(spark), kept.where(F.col("part") == k)
        if local:
            write_tree(part, path, tasks, F.when(F.col("large"), F.col("name")).otherwise(F.col("top")), spent)
        else:
            write_files(part, path, tasks)  # small files: their number counts, not their bytes
        out = read(path)
        kind = out.schema
        out.write.mode("append").parquet(sink)
        if local:
            spent = [*(x for x in spent if not _gone(x)), path]
        else:
            drop_files(part, path)
    if spent:
        drop_trees(spark, spent, tasks)
    return spark.read.schema(kind).parquet(sink)
