"""A streaming source that follows growing text files: appended, truncated and rotated logs.

An offset says, for each file below a folder, how far it was read. A file is known by its inode, so
that one renamed by a rotation goes on where it was, and the new file under the old name starts
at its first byte. A file that is shorter than what was read of it, or whose first bytes have changed,
was written anew and is read from its start. Lines are read once they have their line feed.

The folder is a path that the driver and all executors see under one name (a shared mount). What a
writer appends and truncates again between two batches is never seen. A copy that a rotation makes
has an inode of its own: keep such copies out of ``pattern``. Empty files and folders give no rows.
"""

from __future__ import annotations

import os
import stat
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

TAIL = "file string, inode string, position long, line string"
HEAD = 1024
PART = 32 << 20
BLOCK = 1 << 16
BATCH_BYTES = 4 << 20


def _files(folder: str, pattern: str) -> dict[str, tuple[str, int]]:
    """Path and size of the regular files by inode; of two names of one file the first by name."""
    found: dict[str, tuple[str, int]] = {}
    for path in sorted(Path(folder).rglob(pattern)):
        try:
            info = path.stat()
        except FileNotFoundError:  # renamed or removed since it was listed
            continue
        if stat.S_ISREG(info.st_mode):
            found.setdefault(f"{info.st_dev}-{info.st_ino}", (str(path), info.st_size))
    return found


def _last_line_end(path: str, size: int) -> int:
    """The byte after the last line feed of the first ``size`` bytes."""
    with open(path, "rb") as file:
        end = size
        while end > 0:
            start = max(0, end - BLOCK)
            file.seek(start)
            at = file.read(end - start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


def _head(path: str, n: int) -> int:
    with open(path, "rb") as file:
        return zlib.crc32(file.read(n))


@dataclass
class Part(InputPartition):
    """Lines of a file that begin at a byte from ``start`` up to ``end``; ``first`` is where the batch begins in the file."""

    path: str
    inode: str
    first: int
    start: int
    end: int
    stop: int


class TailReader(DataSourceStreamReader):
    def __init__(self, folder: str, pattern: str, part_bytes: int) -> None:
        self.folder, self.pattern, self.part_bytes = folder, pattern, part_bytes
        self.seen: dict[str, tuple[tuple[str, int], dict]] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for inode, (path, size) in _files(self.folder, self.pattern).items():
            stamp = (path, size, os.stat(path).st_mtime_ns) if os.path.exists(path) else None
            if stamp is not None and inode in self.seen and self.seen[inode][0] == stamp:
                out[inode] = self.seen[inode][1]
                continue
            try:
                end = _last_line_end(path, size)
                out[inode] = {"byte": end, "head": min(HEAD, end), "crc": _head(path, min(HEAD, end))}
            except FileNotFoundError:  # it is found under its new name next time
                if inode in self.seen:
                    out[inode] = self.seen[inode][1]
                continue
            self.seen[inode] = (stamp, out[inode])
        return out

    def _begin(self, path: str, old: dict | None, new: dict) -> int:
        """Where the unread bytes of a file begin."""
        if old is None or new["byte"] < old["byte"]:
            return 0
        if old["head"] == new["head"]:
            return old["byte"] if old["crc"] == new["crc"] else 0
        return old["byte"] if _head(path, old["head"]) == old["crc"] else 0

    def partitions(self, start: dict, end: dict) -> list[Part]:
        parts = []
        files = _files(self.folder, self.pattern)
        for inode, new in end.items():
            if new == start.get(inode):
                continue
            if inode not in files:
                raise FileNotFoundError(f"a file of {self.folder} went before its lines were read: inode {inode}")
            path = files[inode][0]
            first = self._begin(path, start.get(inode), new)
            for at in range(first, new["byte"], self.part_bytes):
                parts.append(Part(path, inode, first, at, min(at + self.part_bytes, new["byte"]), new["byte"]))
        return parts or [Part("", "", 0, 0, 0, 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition.start >= partition.end:
            return
        with self._open(partition) as file:
            yield from _lines(file, partition)

    def _open(self, part: Part):
        """The file by its inode, also if it was renamed since."""
        for path in (part.path, _files(self.folder, self.pattern).get(part.inode, (part.path,))[0]):
            try:
                file = open(path, "rb")
            except FileNotFoundError:
                continue
            info = os.fstat(file.fileno())
            if f"{info.st_dev}-{info.st_ino}" == part.inode:
                return file
            file.close()
        raise FileNotFoundError(f"{part.path} went before its lines were read")

    def commit(self, end: dict) -> None:
        pass


def _lines(file, part: Part) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("inode", pa.string()), ("position", pa.int64()), ("line", pa.string())])
    position = part.start
    if position > part.first:  # a line that began in the part before belongs to it
        file.seek(position - 1)
        position += len(file.readline()) - 1
    else:
        file.seek(position)
    positions, lines, held = [], [], 0

    def batch() -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array([part.path] * n), pa.array([part.inode] * n), pa.array(positions, pa.int64()),
                                           pa.array(lines, pa.string())], schema=schema)

    while position < part.end:
        raw = file.readline()
        if not raw.endswith(b"\n") or position + len(raw) > part.stop:
            raise OSError(f"{part.path} was truncated while it was read")
        positions.append(position)
        lines.append(raw.rstrip(b"\r\n").decode("utf-8", "replace"))
        position += len(raw)
        held += len(raw) + 50
        if held > BATCH_BYTES:
            yield batch()
            positions, lines, held = [], [], 0
    if lines:
        yield batch()


class TailSource(DataSource):
    """``spark.readStream.format("tail")`` with options ``path``, ``pattern`` (default ``*.log``) and ``partBytes``."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return TAIL

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options["path"], self.options.get("pattern", "*.log"), int(self.options.get("partBytes", PART)))


def tail_stream(spark: SparkSession, folder: str, pattern: str = "*.log", part_bytes: int = PART) -> DataFrame:
    """``(file, inode, position, line)`` of the lines that files below a folder gain.

    ``position`` is the line's first byte in its file; files are cut into ranges of ``part_bytes``, one task each.
    """
    spark.dataSource.register(TailSource)
    return (spark.readStream.format("tail").option("path", folder.removeprefix("file:")).option("pattern", pattern)
            .option("partBytes", part_bytes).load())
