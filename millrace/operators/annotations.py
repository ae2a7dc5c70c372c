"""Annotated images: regions of interest as rows ``(file, cls, xmin, ymin, xmax, ymax)``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.images import rect_ratio
from millrace.plans import lookup_join, numbered, top_n
from millrace.session import materialize, scratch_path

# Smallest box share, regions kept per class.
MIN_RATIO = 0.04
CLASS_CAP = 600
FILES_PER_TASK = 500_000
BOX = ("cls", "xmin", "ymin", "xmax", "ymax")


def class_histogram(rois: DataFrame, cls: str = "cls") -> DataFrame:
    """Regions per class."""
    return rois.groupBy(cls).agg(F.count(F.lit(1)).alias("n"))


def group_rois(
    rois: DataFrame,
    file: str = "file",
    order: Sequence[str] = ("roi_no",),
    fields: Sequence[str] = BOX,
    max_rois: int = 10_000,
) -> DataFrame:
    """Regions to lists: ``(file, part, parts, rois)`` with at most ``max_rois`` regions in one row.

    No row grows without bound: a file of up to ``max_rois`` regions is one row, ``part`` 0 of
    ``parts`` 1; a larger one has all its regions in ``parts`` rows, in order.
    """
    placed = numbered(rois, [file], order, "_n")
    part = F.floor((F.col("_n") - 1) / max_rois).cast("int").alias("part")
    lists = placed.groupBy(file, part).agg(F.array_sort(F.collect_list(F.struct("_n", *fields))).alias("_rois"))
    sizes = materialize(rois.groupBy(file).agg(F.ceil(F.count(F.lit(1)) / max_rois).cast("int").alias("parts")))
    return lookup_join(lists, sizes, [file]).select(
        file, "part", "parts", F.transform("_rois", lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias("rois")
    )


def ungroup_rois(lists: DataFrame, file: str = "file") -> DataFrame:
    """Lists back to one row per region."""
    return lists.select(file, F.explode("rois").alias("_r")).select(file, "_r.*")


def too_small(width: Column, height: Column, min_ratio: float = MIN_RATIO) -> Column:
    ratio = rect_ratio(*[F.col(c) for c in BOX[1:]], width, height)
    return (ratio["w_ratio"] < min_ratio) | (ratio["h_ratio"] < min_ratio)


def filter_min_box_ratio(
    files: DataFrame, rois: DataFrame, min_ratio: float = MIN_RATIO, file: str = "file"
) -> DataFrame:
    """Files without any box below ``min_ratio`` of the image's width or height.

    ``rois`` carry the image's ``width`` and ``height``; an image that could not be
    measured (null size) keeps its file, and so does a file without regions.
    """
    small = F.coalesce(too_small(F.col("width"), F.col("height"), min_ratio), F.lit(False))
    return lookup_join(files, materialize(rois.filter(small).select(file).distinct()), [file], "left_anti")


def remaining_files(files: DataFrame, removed: DataFrame, file: str = "file") -> DataFrame:
    """All files but the removed ones."""
    return lookup_join(files, materialize(removed.select(file).distinct()), [file], "left_anti")


def _read_in_order(files: DataFrame, seen: dict, cap: int, file: str) -> DataFrame:
    """The kept files of one task, read in order after ``seen`` regions of each class were kept."""
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = dict(seen)
        for batch in batches:
            kept = []
            for regions in batch["_r"]:
                chosen = any(counts.get(r["c"], 0) < cap for r in regions)
                if chosen:
                    for r in regions:
                        counts[r["c"]] = counts.get(r["c"], 0) + r["n"]
                kept.append(chosen)
            yield batch.loc[kept, [file]]

    return files.repartition(1).sortWithinPartitions(file).mapInPandas(keep, files.select(file).schema)


def cap_per_class_any(
    rois: DataFrame, cap: int = CLASS_CAP, file: str = "file", cls: str = "cls", files_per_task: int = FILES_PER_TASK
) -> DataFrame:
    """Files kept, in file order, while any of their classes has fewer than ``cap`` kept regions.

    Every region of a kept file counts for its class. As long as a class is open,
    each file with it is kept and adds at least one region, so a file can only be
    kept for a class if it is among the first ``cap`` files of that class. These
    files, at most ``cap`` per class, are found in parallel and cut into ranges of about ``files_per_task``.

    Between two closings of a class the decision is a plain filter: a file with an open class stays. Sums per
    range and class tell the first range in which a class closes; the ranges before it are filtered, that one is
    read in order by one task, and the rest goes on with fewer open classes. So there is at most one round
    per class, and the decisions are those of a single reader of all files. The driver holds one number per class.
    """
    counts = materialize(rois.groupBy(file, cls).agg(F.count(F.lit(1)).alias("_n")))
    names = materialize(top_n(counts, [cls], [file], cap).select(file).distinct())
    candidates = lookup_join(counts, names, [file], "left_semi")
    regions = F.collect_list(F.struct(F.col(cls).alias("c"), F.col("_n").alias("n"))).alias("_r")
    per_file = candidates.groupBy(file).agg(regions)
    ranges = -(-names.count() // files_per_task)
    if ranges <= 1:
        return _read_in_order(per_file, {}, cap, file)

    spark = rois.sparkSession
    placed = materialize(per_file.repartitionByRange(ranges, file).withColumn("_range", F.spark_partition_id()))
    class_type = counts.select(F.col(cls).alias("c"), F.lit(0).cast("long").alias("seen")).schema
    seen: dict = {}
    pieces: list[str] = []

    def store(kept: DataFrame) -> None:
        """Write the next kept files and add their regions to what was seen."""
        pieces.append(scratch_path(spark, "kept"))
        kept.write.parquet(pieces[-1])
        rows = spark.read.schema(placed.schema).parquet(pieces[-1]).select(F.explode("_r").alias("r"))
        for row in rows.groupBy("r.c").agg(F.sum("r.n").alias("n")).collect():
            seen[row["c"]] = seen.get(row["c"], 0) + row["n"]

    begin = 0
    while begin < ranges:
        closed = [c for c, n in seen.items() if n >= cap]
        is_closed = F.coalesce(F.col("c").isin([c for c in closed if c is not None]), F.lit(None in closed))
        rest = placed.filter(F.col("_range") >= begin)
        open_files = rest.select(file, F.explode("_r.c").alias("c")).filter(~is_closed).select(file).distinct()
        live = materialize(lookup_join(rest, materialize(open_files), [file], "left_semi")) if closed else rest
        sums = live.select("_range", F.explode("_r").alias("r")).groupBy("_range", F.col("r.c").alias("c")).agg(F.sum("r.n").alias("n"))
        so_far = sums.filter(~is_closed).withColumn(
            "_sum", F.sum("n").over(Window.partitionBy("c").orderBy("_range")))
        before = spark.createDataFrame(list(seen.items()), class_type).withColumnRenamed("c", "_c")
        closing = so_far.join(before, F.col("c").eqNullSafe(F.col("_c")), "left").filter(
            F.col("_sum") + F.coalesce("seen", F.lit(0)) >= cap).agg(F.min("_range")).first()[0]
        if closing is None:
            store(live)
            break
        if closing > begin:
            store(live.filter(F.col("_range") < closing))
        here = live.filter(F.col("_range") == closing)
        kept = materialize(_read_in_order(here, seen, cap, file))
        store(here.join(kept, here[file].eqNullSafe(kept[file]), "left_semi"))
        begin = closing + 1
    return spark.read.schema(placed.schema).parquet(*pieces).select(file)


def selection_report(files: DataFrame) -> DataFrame:
    """One row of counts over files ``(n_rois, selected, by_colour)``.

    Files and regions before and after the selection, and the files removed by colour.
    """
    chosen = F.col("selected")
    return files.agg(
        F.count(F.lit(1)).alias("files_before"),
        F.sum("n_rois").alias("rois_before"),
        F.count_if(chosen).alias("files_after"),
        F.coalesce(F.sum(F.when(chosen, F.col("n_rois"))), F.lit(0)).alias("rois_after"),
        F.count_if(F.col("by_colour")).alias("removed_by_colour"),
    )


def files_exist(rois: DataFrame, existing: DataFrame, file: str = "file") -> tuple[DataFrame, DataFrame]:
    """Annotations whose file exists, and those whose file is missing."""
    known = materialize(existing.select(file).distinct())
    return lookup_join(rois, known, [file], "left_semi"), lookup_join(rois, known, [file], "left_anti")
