"""Landed line files as a stream whose batches end at a number of records.

A Python streaming data source with offsets of its own: the file, the byte in it that comes next, and how many
files are before it. A batch is the next ``recordsPerBatch`` lines in order of file names, wherever files
begin and end; only their newlines are counted where the stream is planned, and the tasks read
byte ranges of about ``bytesPerPartition``. After a restart the offsets written in the checkpoint say where the
next batch begins, so batches stay as they were and no line is read twice or missed.

Files are whole when they appear, are not compressed, and their names sort after those that are
taken already (a landing time at the front does it): a file that lands before them is an error, not a loss.

    spark.dataSource.register(LandedLines)
    spark.readStream.format("landed_lines").option("checkpointLocation", c).option("recordsPerBatch", n).load(path)
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

RECORDS_PER_BATCH = 1_000_000
BYTES_PER_PARTITION = 32 << 20
#: Bytes read at a time, and lines of a batch that a task sends on.
READ_BYTES, SEND_LINES = 1 << 20, 10_000


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _names(path: str) -> list[str]:
    """Names of the files below a folder, relative to it, in order; none if it does not exist."""
    system, root = _file_system(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = [f.path[len(root) :].lstrip("/") for f in found if f.type == fs.FileType.File]
    return sorted(n for n in names if not any(part[0] in "_." for part in n.split("/")))


def _path(path: str, name: str) -> tuple[fs.FileSystem, str]:
    system, root = _file_system(path)
    return system, f"{root.rstrip('/')}/{name}"


def after_lines(path: str, name: str, at: int, most: int) -> tuple[int, int, bool]:
    """(position, lines, ended) after at most ``most`` lines of a file from byte ``at`` on."""
    system, file = _path(path, name)
    lines, last = 0, b"\n"
    with system.open_input_file(file) as f:
        f.seek(at)
        while block := f.read(READ_BYTES):
            n = block.count(b"\n")
            if lines + n >= most:
                for _ in range(most - lines):
                    begin = block.index(b"\n") + 1
                    at, block = at + begin, block[begin:]
                return at, most, at == f.size()
            lines, at, last = lines + n, at + len(block), block[-1:]
    return at, lines + (last != b"\n"), True  # a last line may have no newline


@dataclass
class ByteRange(InputPartition):
    """The lines of a file that begin in [begin, end); ``first`` is a line's beginning."""

    name: str
    first: int
    begin: int
    end: int


class LandedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.records = int(options.get("recordsPerBatch", RECORDS_PER_BATCH))
        self.bytes = int(options.get("bytesPerPartition", BYTES_PER_PARTITION))
        self.last = self._written(options.get("checkpointLocation")) or self.initialOffset()

    @staticmethod
    def _written(checkpoint: str | None) -> dict | None:
        """The end of the last batch that the checkpoint knows (its offset log: one JSON line per source)."""
        if not checkpoint:
            return None
        numbers = [int(n) for n in _names(f"{checkpoint}/offsets") if n.isdigit()]
        if not numbers:
            return None
        system, file = _path(f"{checkpoint}/offsets", str(max(numbers)))
        with system.open_input_stream(file) as f:
            return json.loads(f.read().decode().strip().split("\n")[-1])

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0, "files": 0}

    def latestOffset(self) -> dict:
        names, left = _names(self.path), self.records
        file, at, files = self.last["file"], self.last["at"], self.last["files"]
        if file and (files >= len(names) or names[files] != file):
            raise ValueError(f"files landed before {file}, which is being read: {names[:files + 1][-3:]}")
        while files < len(names) and left:
            if names[files] != file:
                file, at = names[files], 0
            at, n, ended = after_lines(self.path, file, at, left)
            left -= n
            if not ended or files + 1 == len(names) or not left:
                break
            files += 1
        self.last = {"file": file, "at": at, "files": files}
        return self.last

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        names, out = _names(self.path), []
        for i in range(start["files"], min(end["files"] + 1, len(names))):
            system, file = _path(self.path, names[i])
            first = start["at"] if names[i] == start["file"] else 0
            last = end["at"] if names[i] == end["file"] else system.get_file_info(file).size
            out += [ByteRange(names[i], first, at, min(at + self.bytes, last)) for at in range(first, last, self.bytes)]
        return out

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        system, file = _path(self.path, partition.name)
        at, lines = partition.begin, []
        with io.BufferedReader(system.open_input_file(file), READ_BYTES) as f:
            f.seek(at - (at > partition.first))
            if at > partition.first:
                at += len(f.readline()) - 1  # the line that begins before belongs to the range before
            while at < partition.end:
                line = f.readline()
                at += len(line)
                lines.append(line.removesuffix(b"\n").removesuffix(b"\r"))
                if len(lines) == SEND_LINES:
                    yield _batch(lines)
                    lines = []
        if lines:
            yield _batch(lines)

    def commit(self, end: dict) -> None:
        """The offsets in the checkpoint are all that is kept."""


def _batch(lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())], ["value"])


class LandedLines(DataSource):
    """``landed_lines``: options path, recordsPerBatch, bytesPerPartition and checkpointLocation (that of the query)."""

    @classmethod
    def name(cls) -> str:
        return "landed_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> LandedReader:
        return LandedReader(self.options)  # whose keys count in any case


def stream_records(spark: SparkSession, path: str, checkpoint: str, records_per_batch: int = RECORDS_PER_BATCH) -> DataFrame:
    """Landed line files as a stream of ``value``, ``records_per_batch`` lines a batch. The query must
    use ``checkpoint`` as its checkpoint."""
    spark.dataSource.register(LandedLines)
    reader = spark.readStream.format("landed_lines").option("recordsPerBatch", records_per_batch)
    return reader.option("checkpointLocation", checkpoint).load(path)
