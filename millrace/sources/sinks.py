"""File sinks. Paths belong to the shared file system; each call writes a fresh folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.text import flatten_path_name
from millrace.operators.manifests import image_lines
from millrace.operators.metrics import center_vectors, group_mean_vector


def _relative(base: str) -> Column:
    """Folder relative to ``base``; ``.`` for the base itself."""
    base = base.rstrip("/")
    root = F.col("root")
    return F.when(root == base, ".").otherwise(F.substring(root, F.lit(len(base) + 2), F.length(root)))


def write_image_list(manifest: DataFrame, base: str, path: str) -> None:
    """``relative-path label`` lines as text, one folder per root named after its flattened path."""
    lines = image_lines(manifest, base)
    named = lines.select(flatten_path_name(_relative(base), "images.txt").alias("list"), F.col("line").alias("value"))
    named.write.partitionBy("list").text(path)


def write_group_mean(images: DataFrame, path: str, group: str = "root", vector: str = "pixels", size: int | None = None) -> None:
    """Mean array per group as Parquet."""
    group_mean_vector(images, group, vector, size).write.parquet(path)


def write_centered_dataset(
    images: DataFrame, path: str, group: str = "root", vector: str = "pixels", label: str = "label", size: int | None = None
) -> None:
    """Data minus its group's mean and the label, both as floats, partitioned by group."""
    centered = center_vectors(images, group, vector, size, out="data")
    kept = [c for c in images.columns if c not in (group, vector, label)]
    centered.select(
        *kept, group, F.col("data").cast("array<float>").alias("data"), F.col(label).cast("float").alias("label")
    ).write.partitionBy(group).parquet(path)


def write_jsonl_verified(messages: DataFrame, path: str, expected: int, *, reread: bool = False) -> int:
    """One JSON line per message. The rows are counted as they are written, or with ``reread`` the lines of the
    files afterwards; a number other than ``expected`` is an error."""
    written = Observation()
    lines = messages.select(F.to_json(F.struct(*messages.columns)).alias("value"))
    lines.observe(written, F.count(F.lit(1)).alias("n")).write.text(path)
    found = messages.sparkSession.read.text(path).count() if reread else written.get["n"]
    if found != expected:
        raise RuntimeError(f"{path}: {found} lines written, {expected} expected")
    return found


def write_annotations(lists: DataFrame, path: str) -> None:
    """Nested annotation rows as Parquet."""
    lists.write.parquet(path)


def write_buckets(pairs: DataFrame, path: str) -> None:
    """Encoded pairs, one folder per bucket."""
    pairs.write.partitionBy("bucket_id").parquet(path)


def append_lines(lines: DataFrame, path: str, rank: str = "rank") -> None:
    """Append log lines, one folder per rank."""
    lines.select(rank, F.col("line").alias("value")).write.mode("append").partitionBy(rank).text(path)
