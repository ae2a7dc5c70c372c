"""File scans."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import archive_member_path, tokens
from millrace.operators.manifests import class_map, image_manifest, properties
from millrace.plans import lookup_join
from millrace.session import materialize

MEMBERS = "archive string, member string, size long, content binary"
HAZARDS = (
    "car string, driver string, tagger string, "
    "tags array<struct<location: struct<lat: double, lon: double>, timestamp: timestamp, type: string>>"
)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(path, line)`` of text files."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def text_tokens(spark: SparkSession, path: str, *, lower: bool = False) -> DataFrame:
    """Token array of every line of text files; blank lines have none."""
    return text_lines(spark, path).select("path", tokens(F.col("line"), lower).alias("tokens"))


def image_folder(spark: SparkSession, path: str, *, content: bool = False) -> DataFrame:
    """Image files below a folder with label and root; the bytes are read only if asked for."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .withColumn("path", F.regexp_replace("path", "^file:", ""))
    )
    columns = ["path", "modificationTime", "length"] + (["content"] if content else [])
    return image_manifest(files.select(*columns))


def archives(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)`` of zip archives, each below the 2 GB a binary value can hold."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")


def _unpack(name: str, data: bytes, read: bool, wanted) -> Iterator[pd.DataFrame]:
    """Members of one archive for which ``wanted(info)`` holds; no other bytes are unpacked."""
    columns = ["archive", "member", "size", "content"]
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        rows, held = [], 0
        for info in archive.infolist():
            if not wanted(info):
                continue
            body = archive.read(info) if read else None
            rows.append((name, info.filename, info.file_size, body))
            held += 100 + (len(body) if body else 0)
            if held > 8 << 20:
                yield pd.DataFrame(rows, columns=columns)
                rows, held = [], 0
        yield pd.DataFrame(rows, columns=columns)


def zip_members(
    files: DataFrame, *, path: str = "path", content: str = "content", read: bool = True, extensions: Sequence[str] | None = None
) -> DataFrame:
    """``(archive, member, size, content)`` of archives held as bytes; ``read=False`` lists without unpacking.

    With ``extensions`` folders, dot names, empty members and other extensions are passed over before
    their bytes are read. Members leave in small batches, so an archive is never unpacked as a whole.
    """
    ends = None if extensions is None else {e.lower() for e in extensions}

    def wanted(info: zipfile.ZipInfo) -> bool:
        name = info.filename
        if ends is None:
            return True
        dot = name.rpartition("/")[2].rpartition(".")
        return not name.endswith("/") and not name.startswith(".") and info.file_size > 0 and f".{dot[2].lower()}" in ends and bool(dot[1])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch[path], batch[content], strict=True):
                yield from _unpack(name, data, read, wanted)

    return files.select(path, content).mapInPandas(unpack, MEMBERS)


def listed_members(
    files: DataFrame, wanted: DataFrame, *, path: str = "path", content: str = "content", archive: str = "archive", member: str = "member"
) -> DataFrame:
    """``(archive, member, size, content)`` of the members listed in ``wanted`` (``archive, member``).

    The listing meets each archive as one row, no longer than the archive's own directory; archives
    without listed members are not opened.
    """
    lists = materialize(wanted.groupBy(F.col(archive).alias(path)).agg(F.collect_set(member).alias("_members")))

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data, members in zip(batch[path], batch[content], batch["_members"], strict=True):
                names = set(members)
                yield from _unpack(name, data, True, lambda info, names=names: info.filename in names)

    return lookup_join(files.select(path, content), lists, [path]).select(path, content, "_members").mapInPandas(unpack, MEMBERS)


def class_map_file(spark: SparkSession, path: str) -> DataFrame:
    return class_map(text_lines(spark, path))


def image_list(lines: DataFrame, archive: str, line: str = "line") -> DataFrame:
    """``archive@/member`` path of every listed member."""
    return lines.select(archive_member_path(F.lit(archive), F.col(line)).alias("path"))


def image_list_file(spark: SparkSession, path: str, archive: str) -> DataFrame:
    """Paths of the members listed in text files, one to a line."""
    return image_list(text_lines(spark, path), archive)


def properties_files(spark: SparkSession, path: str) -> DataFrame:
    """Properties of small files: each file is one row first, so that its line order is kept."""
    whole = spark.read.option("wholetext", True).text(path)
    lines = whole.select(
        F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line")
    )
    return properties(lines)


def sensor_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Sensor rows of per-trip CSV files with a header; ``trip_file`` is the file's name."""
    rows = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(path)
    return rows.withColumn("trip_file", F.substring_index(F.col("_metadata.file_path"), "/", -1))


def hazard_tags(records: DataFrame) -> DataFrame:
    """One row per tag of hazard records."""
    return records.select("car", "driver", "tagger", F.explode("tags").alias("_t")).select(
        "car", "driver", "tagger", F.col("_t.location.lat").alias("lat"), F.col("_t.location.lon").alias("lon"),
        F.col("_t.timestamp").alias("ts"), F.col("_t.type").alias("type"))


def hazard_json(spark: SparkSession, path: str) -> DataFrame:
    """Tags of hazard JSON files."""
    return hazard_tags(spark.read.schema(HAZARDS).json(path))
