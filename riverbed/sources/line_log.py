"""An append-only log of text lines in partitions, read as a replayable stream.

The counterpart of a topic of strings (or of a socket, whose lines a receiver appends): a
folder per partition with immutable segment files named by the offsets they hold
(``p=3/000000000120-000000000180.log``: lines 120 to 179). Offsets follow from the names
alone, so a restarted query asks for exactly the lines after its last committed batch,
and every batch can be read again.

The reader is a Python data source: one task per partition and micro-batch, Arrow
batches out, no port and no jar. Files are reached through ``pyarrow.fs`` (local or
shared folders, HDFS, object stores), which must see the same path on driver and
executors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "value string, partition int, offset long"
_SEGMENT = re.compile(r"p=(\d+)/(\d{12})-(\d{12})\.log$")
#: lines of an Arrow batch
BATCH = 8192


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Segments:
    """The finished segments of a log."""

    def __init__(self, path: str):
        self.fs, self.root = _open(path.replace("file:/", "file:///", 1)
                                   if re.match(r"file:/[^/]", path) else path)

    def list(self) -> dict[int, list[tuple[int, int, str]]]:
        """partition -> ``(first, end, file)`` in offset order."""
        found: dict[int, list[tuple[int, int, str]]] = {}
        for info in self.fs.get_file_info(pafs.FileSelector(self.root, allow_not_found=True, recursive=True)):
            m = _SEGMENT.search(info.path)
            if m:
                found.setdefault(int(m[1]), []).append((int(m[2]), int(m[3]), info.path))
        return {p: sorted(s) for p, s in found.items()}

    def ends(self) -> dict[int, int]:
        """The next offset of every partition; a gap ends what can be read."""
        out = {}
        for p, segments in self.list().items():
            at = 0
            for first, end, _ in segments:
                at = end if first <= at < end else at
            out[p] = at
        return out

    def append(self, partition: int, first: int, lines: list[str]) -> None:
        """One segment; written under another name and renamed, so it appears whole."""
        folder = f"{self.root}/p={partition}"
        self.fs.create_dir(folder, recursive=True)
        name = f"{folder}/{first:012d}-{first + len(lines):012d}.log"
        body = "\n".join(x.replace("\\", "\\\\").replace("\n", "\\n") for x in lines)
        with self.fs.open_output_stream(name + ".tmp") as out:
            out.write(body.encode())
        self.fs.move(name + ".tmp", name)

    def read(self, partition: int, first: int, end: int) -> Iterator[tuple[int, list[str]]]:
        """Runs of lines ``(offset, lines)`` of offsets ``first`` to ``end``."""
        for lo, hi, name in self.list().get(partition, []):
            if hi > first and lo < end:
                with self.fs.open_input_stream(name) as f:
                    lines = f.read().decode().split("\n")
                a, b = max(lo, first), min(hi, end)
                if a < b:
                    yield a, lines[a - lo:b - lo]
                    first = b


def _plain(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line) if "\\" in line else line


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {str(p): end for p, end in Segments(self.path).ends().items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition((int(p), start.get(p, 0), n)) for p, n in sorted(end.items())
                if n > start.get(p, 0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        p, first, end = partition.value
        for at, lines in Segments(self.path).read(p, first, end):
            for i in range(0, len(lines), BATCH):
                some = [_plain(x) for x in lines[i:i + BATCH]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.string()), pa.array([p] * len(some), pa.int32()),
                     pa.array(range(at + i, at + i + len(some)), pa.int64())],
                    names=["value", "partition", "offset"])

    def commit(self, end: dict) -> None:
        pass


class LineLog(DataSource):
    """``spark.readStream.format("line_log").load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "line_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"])


def stream_line_log(spark: SparkSession, path: str) -> DataFrame:
    """``value, partition, offset`` of every line, each once over all restarts of a run."""
    spark.dataSource.register(LineLog)
    return spark.readStream.format("line_log").option("path", path).load()


def append_lines(lines: DataFrame, path: str, value: str = "value", segment: int = 10_000) -> None:
    """Append a table of lines: one partition per task, segments of ``segment`` lines.

    A retried task writes the same segments again under the same names; one run of this
    function at a time may append to a log. A null is an empty line.
    """
    ends = Segments(path).ends()

    def run(batches):
        log, p = Segments(path), TaskContext.get().partitionId()
        at, held = ends.get(p, 0), []
        for batch in batches:
            held += [x or "" for x in batch.column(0).to_pylist()]
            while len(held) >= segment:
                log.append(p, at, held[:segment])
                at, held = at + segment, held[segment:]
        if held:
            log.append(p, at, held)
            at += len(held)
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64())], names=["end"])

    lines.select(F.col(value).alias("value")).mapInArrow(run, "end long").agg(F.sum("end")).collect()
