"""Queries over annotated images."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs
from millrace.catalog.array_queries import _PIXELS, pixels
from millrace.catalog.registry import Registry
from millrace.functions import images
from millrace.operators import annotations
from millrace.operators import pixels as pixel_ops
from millrace.session import scratch_path
from millrace.sources import sinks

registry = Registry()
add = registry.add

_BOXES = """
boxes AS (
  SELECT l_orderkey AS file, l_returnflag || l_linestatus AS cls, l_linenumber AS roi_no,
    CAST(l_partkey % 500 AS INTEGER) AS xmin, CAST(l_suppkey * 7 % 500 AS INTEGER) AS ymin,
    CAST(l_partkey % 500 + CAST(l_quantity AS BIGINT) * 4 AS INTEGER) AS xmax,
    CAST(l_suppkey * 7 % 500 + l_partkey % 60 * 5 + 30 AS INTEGER) AS ymax,
    CASE WHEN l_orderkey % 37 <> 0 THEN 1000 END AS width, CASE WHEN l_orderkey % 37 <> 0 THEN 1000 END AS height
  FROM lineitem),
small AS (SELECT DISTINCT file FROM boxes WHERE (xmax - xmin) / width < 0.04 OR (ymax - ymin) / height < 0.04)"""


def boxes(spark, folder):
    """One region per lineitem; the order is the image, 1000 x 1000 unless it could not be measured."""
    items = inputs.load_table(spark, folder, "lineitem")
    x, y = F.col("l_partkey") % 500, F.col("l_suppkey") * 7 % 500
    side = F.when(F.col("l_orderkey") % 37 != 0, 1000)
    return items.select(
        F.col("l_orderkey").alias("file"), F.concat("l_returnflag", "l_linestatus").alias("cls"),
        F.col("l_linenumber").alias("roi_no"), x.cast("int").alias("xmin"), y.cast("int").alias("ymin"),
        (x + F.col("l_quantity").cast("long") * 4).cast("int").alias("xmax"),
        (y + F.col("l_partkey") % 60 * 5 + 30).cast("int").alias("ymax"), side.alias("width"), side.alias("height"))


def files(spark, folder):
    return inputs.load_table(spark, folder, "orders").select(F.col("o_orderkey").alias("file"), "o_orderstatus")


@add("i14_rect_ratio", f"""
WITH {_BOXES} SELECT file, roi_no, xmin, ymin, round((xmax - xmin) / width, 9) AS w_ratio, round((ymax - ymin) / height, 9) AS h_ratio
FROM boxes WHERE width IS NOT NULL""")
def rect_ratio(spark, folder):
    rows = boxes(spark, folder).filter("width IS NOT NULL")
    ratio = images.rect_ratio(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax", "width", "height")])
    return rows.select("file", "roi_no", "xmin", "ymin", F.round(ratio["w_ratio"], 9).alias("w_ratio"),
                       F.round(ratio["h_ratio"], 9).alias("h_ratio"))


@add("i15_rescale_point", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CAST(floor(l_partkey % 1024 * (1920 / 1024.0::DOUBLE)) AS INTEGER) AS x, CAST(floor(l_suppkey % 720 * (1080 / 720.0::DOUBLE)) AS INTEGER) AS y
FROM lineitem""")
def rescale_point(spark, folder):
    return inputs.load_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        images.rescale_point(F.col("l_partkey") % 1024, F.lit(1920), 1024).alias("x"),
        images.rescale_point(F.col("l_suppkey") % 720, F.lit(1080), 720).alias("y"))


@add("e3_class_histogram", f"WITH {_BOXES} SELECT cls, count(*) AS n FROM boxes GROUP BY cls")
def class_histogram(spark, folder):
    return annotations.class_histogram(boxes(spark, folder))


_ORDER = ("roi_no", "cls", "xmin", "ymin", "xmax", "ymax")
_ORDER_SQL = ", ".join(_ORDER)


@add("e4_group_rois", f"""
WITH {_BOXES}, placed AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY file ORDER BY {_ORDER_SQL}) - 1) // 3 AS INTEGER) AS part FROM boxes)
SELECT file, part, CAST(max(max(part)) OVER (PARTITION BY file) + 1 AS INTEGER) AS parts, CAST(count(*) AS INTEGER) AS n,
  string_agg(cls || ' ' || xmin || ' ' || ymin || ' ' || xmax || ' ' || ymax, ';' ORDER BY {_ORDER_SQL}) AS rois
FROM placed GROUP BY file, part""")
def group_rois(spark, folder):
    """Lists of at most three regions, so that files of the tables fill several parts."""
    lists = annotations.group_rois(boxes(spark, folder), order=_ORDER, max_rois=3)
    text = F.transform("rois", lambda r: F.concat_ws(" ", *[r[f].cast("string") for f in annotations.BOX]))
    return lists.select("file", "part", "parts", F.size("rois").alias("n"), F.array_join(text, ";").alias("rois"))


@add("e4_ungroup_rois", f"WITH {_BOXES} SELECT file, cls, xmin, ymin, xmax, ymax FROM boxes")
def ungroup_rois(spark, folder):
    return annotations.ungroup_rois(annotations.group_rois(boxes(spark, folder), order=_ORDER))


@add("b6_write_annotations", f"WITH {_BOXES} SELECT file, cls, xmin, ymin, xmax, ymax FROM boxes")
def write_annotations(spark, folder):
    path = scratch_path(spark, "annotations")
    sinks.write_annotations(annotations.group_rois(boxes(spark, folder), order=_ORDER), path)
    return annotations.ungroup_rois(spark.read.parquet(path))


@add("c2_filter_min_box_ratio", f"""
WITH {_BOXES} SELECT o_orderkey AS file FROM orders WHERE o_orderkey NOT IN (SELECT file FROM small)""")
def filter_min_box_ratio(spark, folder):
    return annotations.filter_min_box_ratio(files(spark, folder).select("file"), boxes(spark, folder))


@add("h3_remaining_files", """
SELECT o_orderkey AS file, o_orderstatus FROM orders WHERE o_orderkey NOT IN (
  SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def remaining_files(spark, folder):
    removed = boxes(spark, folder).filter(F.startswith("cls", F.lit("R")))
    return annotations.remaining_files(files(spark, folder), removed)


_EXISTING = "existing AS (SELECT o_orderkey AS file FROM orders WHERE o_orderstatus <> 'P')"


@add("d7_files_exist", f"""
WITH {_BOXES}, {_EXISTING}
SELECT file, cls, xmin, ymin, xmax, ymax, file IN (SELECT file FROM existing) AS found FROM boxes""")
def files_exist(spark, folder):
    existing = files(spark, folder).filter("o_orderstatus <> 'P'")
    found, missing = annotations.files_exist(boxes(spark, folder), existing)
    names = ["file", *annotations.BOX]
    return (found.select(*names, F.lit(True).alias("found"))
            .unionByName(missing.select(*names, F.lit(False).alias("found"))))


@add("e11_selection_report", f"""
WITH {_BOXES},
per_file AS (
  SELECT file, count(*) AS n_rois, bool_or(cls = 'AF') AND file % 5 = 0 AS by_colour FROM boxes GROUP BY file),
flagged AS (SELECT *, NOT by_colour AND file NOT IN (SELECT file FROM small) AS selected FROM per_file)
SELECT count(*) AS files_before, CAST(sum(n_rois) AS BIGINT) AS rois_before, count(*) FILTER (selected) AS files_after,
  CAST(coalesce(sum(n_rois) FILTER (selected), 0) AS BIGINT) AS rois_after, count(*) FILTER (by_colour) AS removed_by_colour
FROM flagged""")
def selection_report(spark, folder):
    small = F.coalesce(annotations.too_small(F.col("width"), F.col("height")), F.lit(False))
    per_file = boxes(spark, folder).groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rois"), F.bool_or(F.col("cls") == "AF").alias("_af"), F.bool_or(small).alias("_small"))
    by_colour = F.col("_af") & (F.col("file") % 5 == 0)
    return annotations.selection_report(
        per_file.select("n_rois", by_colour.alias("by_colour"), (~by_colour & ~F.col("_small")).alias("selected")))


_CLASSES = ("AF", "AO", "NF", "NO", "RF", "RO")
_CAP = 40


@add("f3_cap_per_class_any", f"""
WITH {_BOXES},
per_file AS (
  SELECT file, [{', '.join(f"count(*) FILTER (cls = '{c}')" for c in _CLASSES)}] AS c FROM boxes GROUP BY file),
folded AS (
  SELECT list_reduce(list({{'c': c, 'f': [file]}} ORDER BY file),
    lambda acc, x: CASE WHEN len(list_filter(range(1, 7), lambda i: x.c[i] > 0 AND acc.c[i] < {_CAP})) > 0
      THEN {{'c': list_transform(acc.c, lambda v, i: v + x.c[i]), 'f': list_concat(acc.f, x.f)}} ELSE acc END,
    {{'c': [0, 0, 0, 0, 0, 0]::BIGINT[], 'f': []::BIGINT[]}}) AS s
  FROM per_file)
SELECT unnest(s.f) AS file FROM folded""")
def cap_per_class_any(spark, folder):
    return annotations.cap_per_class_any(boxes(spark, folder), _CAP)


# the pixel arrays as 11 x 2 images with two boxes each, every third image of a colour-checked class
_LIMITS = ((20, 30, 60), (120, 255, 255))


def annotated_pixels(spark, folder):
    vec = F.col("vec_id")
    checked = F.when(vec % 3 == 0, "US_SL_30").when(vec % 3 == 1, "SPEED_LIMIT_50").otherwise("STOP")

    def box(cls, xmin, ymin, xmax, ymax):
        return F.struct(cls.alias("cls"), *[v.cast("int").alias(n) for n, v in
                                            zip(annotations.BOX[1:], (xmin, ymin, xmax, ymax), strict=True)])

    first = box(checked, vec % 3, vec % 2, vec % 3 + 7, F.lit(2))
    second = box(F.lit("GIVE_WAY"), F.lit(0), F.lit(0), F.lit(11), F.lit(2))
    return pixels(spark, folder).select(
        vec.alias("file"), F.transform("p", lambda x: x.cast("int")).alias("pixels"), F.lit(11).alias("width"),
        F.array(first, second).alias("rois"))


_HSV = f"""
{_PIXELS},
cells AS (
  SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(p[i * 3 + 1] AS INTEGER) AS b, CAST(p[i * 3 + 2] AS INTEGER) AS g,
    CAST(p[i * 3 + 3] AS INTEGER) AS r FROM px, range(22) AS t(i)),
inbox AS (
  SELECT *, greatest(b, g, r) AS v, greatest(b, g, r) - least(b, g, r) AS d FROM cells
  WHERE i % 11 >= vec_id % 3 AND i % 11 < vec_id % 3 + 7 AND i // 11 >= vec_id % 2),
sectors AS (
  SELECT *, (d * CAST(CASE WHEN v = 0 THEN 0 ELSE round_even(1044480.0::DOUBLE / v, 0) END AS INTEGER) + 2048) >> 12 AS s,
    CASE WHEN v = r THEN g - b WHEN v = g THEN b - r + 2 * d ELSE r - g + 4 * d END AS hh FROM inbox),
hsv AS (
  SELECT *, CAST(floor((hh * CAST(CASE WHEN d = 0 THEN 0 ELSE round_even(122880.0::DOUBLE / d, 0) END AS INTEGER) + 2048) / 4096.0::DOUBLE) AS INTEGER) AS h
  FROM sectors),
shares AS (
  SELECT vec_id, avg(CASE WHEN (CASE WHEN h < 0 THEN h + 180 ELSE h END) BETWEEN 20 AND 120 AND s BETWEEN 30 AND 255
    AND v BETWEEN 60 AND 255 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share FROM hsv GROUP BY vec_id)"""


@add("c3_filter_color_fraction", f"""
WITH {_HSV} SELECT vec_id AS file FROM shares WHERE vec_id % 3 = 2 OR share <= 0.5""")
def filter_color_fraction(spark, folder):
    return pixel_ops.filter_color_fraction(annotated_pixels(spark, folder), 0.5, _LIMITS).select("file")


@add("c3_color_fraction", f"WITH {_HSV} SELECT vec_id AS file, CASE WHEN vec_id % 3 <> 2 THEN round(share, 9) END AS share FROM shares")
def color_fraction(spark, folder):
    images = pixel_ops.with_colour_shares(annotated_pixels(spark, folder), _LIMITS)
    return images.select("file", F.round(F.col("shares")[0], 9).alias("share"))
