"""Lines of files that arrive in a folder, numbered within their file, as a stream."""

from __future__ import annotations

import io
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from vocalake.sources.listing import opened

#: Bytes of files that one task reads (one file at least), and lines of a batch that it hands over.
TASK_BYTES, BATCH_LINES = 64_000_000, 10_000


@dataclass
class Files(InputPartition):
    paths: list[str]


class ArrivingLinesReader(DataSourceStreamReader):
    """An offset is the last file that was taken, by time and name: a few bytes, however many files there have been."""

    def __init__(self, path: str, settle: float):
        self.path, self.settle = path, settle

    def _found(self) -> list[tuple[int, str, int]]:
        """(time in ns, path, bytes) of the whole files, in the order in which they are taken."""
        store, top = opened(self.path)
        found = store.get_file_info(fs.FileSelector(top, allow_not_found=True))
        until = time.time_ns() - self.settle * 1e9
        return sorted((x.mtime_ns or 0, x.path, x.size) for x in found if x.is_file and x.base_name[0] not in "._" and (x.mtime_ns or 0) <= until)

    def initialOffset(self) -> dict:
        return {"time": 0, "file": ""}

    def latestOffset(self) -> dict:
        found = self._found()
        return {"time": found[-1][0], "file": found[-1][1]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        out: list[Files] = []
        held = 0
        for at, path, size in self._found():
            if (start["time"], start["file"]) < (at, path) <= (end["time"], end["file"]):
                if not out or held + size > TASK_BYTES:
                    out.append(Files([]))
                    held = 0
                out[-1].paths.append(path)
                held += size
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        for path in partition.paths:
            with io.TextIOWrapper(io.BufferedReader(store.open_input_file(path), 1 << 20), encoding="utf-8-sig", errors="replace", newline=None) as lines:
                held: list[str] = []
                first = 1
                for line in lines:
                    held.append(line.removesuffix("\n"))
                    if len(held) == BATCH_LINES:
                        yield _batch(path, first, held)
                        first, held = first + len(held), []
                if held:
                    yield _batch(path, first, held)


def _batch(path: str, first: int, lines: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([path] * len(lines)), pa.array(range(first, first + len(lines)), pa.int64()), pa.array(lines)], ["file", "line_no", "raw"])


class ArrivingLines(DataSource):
    """Options: path (a folder, or a URI that Arrow's file systems know), settle (seconds, 1)."""

    @classmethod
    def name(cls) -> str:
        return "arriving_lines"

    def schema(self) -> str:
        return "file string, line_no bigint, raw string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ArrivingLinesReader(self.options["path"], float(self.options.get("settle", 1)))


def arriving_lines(spark: SparkSession, path: str, settle: float = 1) -> DataFrame:
    """file, line_no (from 1 in each file), raw of every line of the files that come into a folder, as a stream.

    Files are taken whole, in order of their time and name, each once also over restarts (the checkpoint holds the last one);
    a file is read by one task, which holds some lines of it. They must be whole when they get their names. Files younger
    than `settle` seconds wait, so that those of the same time are all there; names that begin with . or _ are left out.
    A file that comes with an older time than the last one taken is not seen. Lines end as in `numbered_lines`.
    """
    spark.dataSource.register(ArrivingLines)
    return spark.readStream.format("arriving_lines").option("path", path).option("settle", settle).load()
