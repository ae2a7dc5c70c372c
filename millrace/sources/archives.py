"""Zip archives read by seeking: a directory of all members first, then only the wanted byte ranges.

No archive ever stands in one cell. Tasks read the directories at the ends of the archives; any filter or
join on the directory is the list of members to read; those are dealt to tasks by bytes, in
ranges of their place in the archive, so that an archive larger than a partition is read by many tasks.

Archives lie in a folder that all executors see under one name (a shared mount). Archives without members
and empty folders give no rows; a damaged directory or member is an error. A null archive or member of a
list is never found. The bytes of one member have to fit in a binary value (2 GB).
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import materialize

DIRECTORY = "archive string, member string, size long, packed long, place long, crc long"
CONTENT = "archive string, member string, size long, content binary"
PART_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
BATCH_ROWS = 10_000


def _batches(rows: Iterator[tuple], columns: list[str], weigh) -> Iterator[pd.DataFrame]:
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += weigh(row)
        if weight > BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield pd.DataFrame(held, columns=columns)
            held, weight = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def archive_directory(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """``(archive, member, size, packed, place, crc)`` of all members; only the directories of the archives are read.

    ``size`` and ``packed`` are bytes, ``place`` is where the member begins in its archive.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
             .select(F.regexp_replace("path", "^file:/*", "/").alias("archive")))

    def members(names) -> Iterator[tuple]:
        for name in names:
            with zipfile.ZipFile(name) as archive:
                for info in archive.infolist():
                    yield name, info.filename, info.file_size, info.compress_size, info.header_offset, info.CRC

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in DIRECTORY.split(", ")]
        for batch in batches:
            yield from _batches(members(batch["archive"]), columns, lambda row: 200 + len(row[1]))

    return files.mapInPandas(listed, DIRECTORY)


def read_members(directory: DataFrame, *, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(archive, member, size, content)`` of the members of a directory, or of what a filter or join left of it.

    Members are dealt to tasks in ranges of (archive, place): there are as many ranges as the bytes ask for.
    Each task opens an archive once for the members it reads of it, and seeks from one to the next.
    """
    wanted = materialize(directory.select("archive", "member", "size", "packed", "place").filter(
        "archive IS NOT NULL AND member IS NOT NULL"))
    # a member weighs at least as much as the seek to it
    total = wanted.agg(F.sum(F.greatest(F.col("packed"), F.col("size"), F.lit(4096)))).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    dealt = wanted.repartitionByRange(parts, "archive", "place").sortWithinPartitions("archive", "place")

    def bodies(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        archive = None
        try:
            for batch in batches:
                for name, member, size, place in zip(batch["archive"], batch["member"], batch["size"], batch["place"], strict=True):
                    if archive is None or archive.filename != name:
                        if archive is not None:
                            archive.close()
                        archive = zipfile.ZipFile(name)
                        at = {i.header_offset: i for i in archive.infolist()}
                    yield name, member, size, archive.read(at[place])
        finally:
            if archive is not None:
                archive.close()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _batches(bodies(batches), ["archive", "member", "size", "content"], lambda row: 200 + len(row[3]))

    return dealt.mapInPandas(read, CONTENT)
