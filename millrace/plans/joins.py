"""Joins of a large side with a lookup side of unknown size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.widths import row_width
from millrace.session import materialize

BROADCAST_BYTES = 64 << 20
ROWS_PER_TASK = 4_000_000
BYTES_PER_TASK = 1 << 30
MAX_HOT_KEYS = 32_768
SAMPLED_ROWS = 10_000
PART_BYTES = 64 << 20


def broadcastable(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df``: True only if its rows were counted and fit ``max_bytes``.

    Give it a stored table or a checkpointed result: the measurement reads it once.
    """
    return measured_bytes(df) <= max_bytes


def measured_bytes(df: DataFrame) -> int:
    """About the bytes of all rows in memory, counted."""
    return df.agg(F.sum(row_width(df))).first()[0] or 0


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    max_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    bytes_per_task: int = BYTES_PER_TASK,
) -> DataFrame:
    """Join on ``keys``: broadcast the lookup if it is measured small, else shuffle and cut hot keys.

    A key of the large side with more rows or bytes than a task should hold is hot. Its rows are
    dealt to as many parts as their size asks for, and only its lookup rows are copied, one per
    part. All other keys take a plain shuffle join, and rows without a key take none. ``how`` may
    be inner, left, left_semi or left_anti; the result is the same either way.
    """
    keys = list(keys)
    looked_up = measured_bytes(lookup)
    if looked_up <= max_bytes:
        return large.join(F.broadcast(lookup), keys, how)
    hot, many_null, size = _hot_keys(large, keys, rows_per_task, bytes_per_task)
    parts = max(large.sparkSession.sparkContext.defaultParallelism, -(-(size + looked_up) // PART_BYTES))

    def shuffled(left: DataFrame, right: DataFrame) -> DataFrame:
        # so many parts that what a task sorts does not grow with the tables; parts of a given number are not merged again
        if all(left.schema[k].dataType == right.schema[k].dataType for k in keys):
            left, right = left.repartition(parts, *keys), right.repartition(parts, *keys)
        return left.join(right, keys, how)

    if hot is None and not many_null:
        return shuffled(large, lookup)
    some = F.lit(True)
    for key in keys:
        some = some & F.col(f"`{key}`").isNotNull()
    known = large.filter(some)
    out = shuffled(known, lookup)
    if hot is not None:
        # a broadcast of at most MAX_HOT_KEYS rows
        out = shuffled(known.join(F.broadcast(hot.select(*keys)), keys, "left_anti"), lookup)
        # by content, so that a repeated task deals the same; the partition id separates rows that are copies of each other
        content = [F.col(f"`{f.name}`") for f in large.schema.fields if "map<" not in f.dataType.simpleString()]
        deal = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.col("_parts")).cast("int")
        left = known.join(F.broadcast(hot), keys).withColumn("_part", deal).drop("_parts")
        right = lookup.join(F.broadcast(hot), keys).withColumn(
            "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        out = out.unionByName(left.join(right, [*keys, "_part"], how).drop("_part"))
    if how in ("left", "left_anti"):
        # a null key matches nothing, and all of them together would meet in one task
        out = out.unionByName(large.filter(~some), allowMissingColumns=True)
    return out


def _hot_keys(df: DataFrame, keys: list[str], rows_per_task: int, bytes_per_task: int) -> tuple[DataFrame | None, bool, int]:
    """``keys, _parts`` of the keys too large for a task, at most MAX_HOT_KEYS, or None; whether null keys are too many; and
    about the bytes of all rows.

    Of short rows every so many are counted, by their places, so that the counts stay small where hardly any key repeats.
    This decides where rows are joined, never the result.
    """
    stride = max(1, rows_per_task // SAMPLED_ROWS)
    width, place = row_width(df), F.xxhash64(F.monotonically_increasing_id())
    weighed = df.select(*keys, width.alias("_w"), place.alias("_place")).withColumn(
        "_each", F.when(F.col("_w") * SAMPLED_ROWS > bytes_per_task, 1).otherwise(stride)).filter(F.pmod("_place", "_each") == 0)
    counts = materialize(weighed.groupBy(*keys).agg(F.sum("_each").alias("_n"), F.sum(F.col("_w") * F.col("_each")).alias("_b")))
    share = F.greatest(F.col("_n") / F.lit(rows_per_task), F.col("_b") / F.lit(bytes_per_task))
    hot = counts.filter(share > 1).select(*keys, F.ceil(share).cast("int").alias("_parts"))
    rows = hot.orderBy(F.desc("_parts")).limit(MAX_HOT_KEYS).collect()
    full = [r for r in rows if all(r[k] is not None for k in keys)]
    size = counts.agg(F.sum("_b")).first()[0] or 0
    return df.sparkSession.createDataFrame(full, hot.schema) if full else None, len(full) < len(rows), size
