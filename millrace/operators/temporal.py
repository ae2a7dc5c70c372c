"""Sensor rows and events in time: joins by nearest time, intervals, windows, resampling, sampling.

Times are whole numbers (microseconds, unless a caller uses another unit). ``order``
names the columns that order the rows of a key; together they are unique in it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import hash32
from millrace.plans import Run, lookup_join, numbered, rolling, running, top_n
from millrace.session import materialize

# Thresholds of text predictions, and the part of a trip's start that is cropped.
CONF_THRESHOLD = 0.5
MIN_COMPONENT = 25
CROP_SHARE = 0.05
START, END, UNPAVED = "bumpy_road_start", "bumpy_road_end", "unpaved_road"
EARTH_RADIUS_M = 6_371_000.0
PACK = 64
CROWDED, MAX_LEVELS = 1024, 5


# -- filters -----------------------------------------------------------------------


def filter_predictions(df: DataFrame, conf: float = CONF_THRESHOLD, size: int = MIN_COMPONENT) -> DataFrame:
    """Predictions of enough confidence on large enough components."""
    return df.filter((F.col("conf") >= conf) & (F.col("comp_size") >= size))


def filter_trips(
    rows: DataFrame,
    blacklist: DataFrame | None = None,
    folders: DataFrame | None = None,
    device: str | None = None,
    hazards: Sequence[str] | None = None,
) -> DataFrame:
    """Drop listed trips; keep listed drive folders, one device type and the given hazard types."""
    if device is not None:
        rows = rows.filter(F.col("device") == device)
    if hazards is not None:
        rows = rows.filter(F.col("type").isin(*hazards))
    if blacklist is not None:
        rows = lookup_join(rows, materialize(blacklist.select("trip_id").distinct()), ["trip_id"], "left_anti")
    if folders is not None:
        rows = lookup_join(rows, materialize(folders.select("folder").distinct()), ["folder"], "left_semi")
    return rows


def crop_trip_start(
    rows: DataFrame, order: Sequence[str], keys: Sequence[str] = ("trip_id",), share: float = CROP_SHARE
) -> DataFrame:
    """Drop the first ``share`` of each trip's rows (rounded down). ``order`` must be unique within a trip."""
    sizes = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")))
    placed = numbered(rows, keys, order, "_n")
    kept = lookup_join(placed, sizes, keys).filter(F.col("_n") > F.floor(F.col("_size") * share))
    return kept.select(*rows.columns)


def select_features(rows: DataFrame, features: Sequence[str], keys: Sequence[str] = ("trip_id", "ts")) -> DataFrame:
    return rows.select(*keys, *features)


# -- joins in time -------------------------------------------------------------------


def nearest_time_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    *,
    ts: str = "ts",
    left_id: str = "id",
    right_id: str = "id",
    tolerance: int | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Each left row with the right row nearest in time; of two equally near the earlier one.

    Both sides are laid in one time order; every left row takes the last right row
    before it and the first after it. Adds ``payload``, ``right_ts`` and ``gap``,
    null without a right row (within ``tolerance``). No pairs are built.
    """
    names = left.columns
    match = F.struct(F.col(ts).alias("right_ts"), *[F.col(c) for c in payload])
    kind = right.select(match.alias("m")).schema["m"].dataType
    one = left.select(
        *keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"), F.col(left_id).cast("string").alias("_id"),
        F.struct(*names).alias("_row"), F.lit(None).cast(kind).alias("_match"))
    row_kind = one.schema["_row"].dataType
    two = right.select(
        *keys, F.col(ts).alias("_t"), F.lit(0).alias("_side"), F.col(right_id).cast("string").alias("_id"),
        F.lit(None).cast(row_kind).alias("_row"), match.alias("_match"))
    found = running(
        one.unionByName(two), keys, ["_t", "_side", "_id"],
        {"_before": Run("last", F.col("_match")), "_after": Run("next", F.col("_match"))},
        rows_per_task=rows_per_task,
    ).filter(F.col("_side") == 1)
    back, ahead = F.col("_t") - F.col("_before.right_ts"), F.col("_after.right_ts") - F.col("_t")
    best = F.when(ahead.isNull() | (back <= ahead), F.col("_before")).otherwise(F.col("_after"))
    chosen = found.withColumn("_best", best).withColumn("_gap", F.abs(F.col("_t") - F.col("_best.right_ts")))
    if tolerance is not None:
        chosen = chosen.withColumn("_best", F.when(F.col("_gap") <= tolerance, F.col("_best")))
    gap = F.when(F.col("_best").isNotNull(), F.col("_gap"))
    return chosen.select(
        "_row.*", *[F.col(f"_best.{c}").alias(c) for c in payload], F.col("_best.right_ts").alias("right_ts"),
        gap.alias("gap"))


def label_sensor_rows(
    rows: DataFrame, hazards: DataFrame, step: int, keys: Sequence[str] = ("trip_id",), **kw
) -> DataFrame:
    """Add ``hazard``: the type of the nearest hazard at most half a ``step`` away."""
    labelled = nearest_time_join(
        rows, hazards.withColumn("hazard", F.col("type")), keys, ["hazard"], tolerance=step // 2, **kw)
    return labelled.drop("right_ts", "gap")


def pair_start_end(
    tags: DataFrame, keys: Sequence[str] = ("trip_id",), order: Sequence[str] = ("ts", "id"),
    types: tuple[str, str, str] = (START, END, UNPAVED),
) -> DataFrame:
    """Intervals from a start tag to the first end tag after it: ``(start_ts, end_ts, cls)``.

    A start that meets another start before any end is dropped. An unpaved tag
    inside makes the interval unpaved instead of bumpy.
    """
    start, end, unpaved = types
    kind, ts = F.col("type"), F.col(order[0])
    numbered_tags = running(
        tags.filter(kind.isin(*types)), keys, order, {"_start": Run("count", F.when(kind == start, 1))}
    ).filter(F.col("_start") > 0)
    first = F.struct(*order)

    def earliest(name: str) -> Column:
        return F.min(F.when(kind == name, first))

    pairs = numbered_tags.groupBy(*keys, "_start").agg(
        F.min(F.when(kind == start, ts)).alias("start_ts"), earliest(end).alias("_end"), earliest(unpaved).alias("_unpaved"))
    cls = F.when(F.col("_unpaved") < F.col("_end"), "unpaved_road").otherwise("bumpy_road")
    return pairs.filter(F.col("_end").isNotNull()).select(
        *keys, "start_ts", F.col("_end")[order[0]].alias("end_ts"), cls.alias("cls"))


def interval_label_join(
    rows: DataFrame, intervals: DataFrame, keys: Sequence[str] = ("trip_id",), *, ts: str = "ts", row_id: str = "id",
    default: str = "paved_road", rows_per_task: int | None = None,
) -> DataFrame:
    """Add ``cls`` of the interval ``[start_ts, end_ts]`` a row lies in, else ``default``.

    The intervals of a key must not overlap (:func:`pair_start_end` gives such); a
    row then only has to look at the last interval begun before it.
    """
    interval = F.struct("start_ts", "end_ts", "cls")
    kind = intervals.select(interval.alias("i")).schema["i"].dataType
    one = rows.select(
        *keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"), F.col(row_id).cast("string").alias("_id"),
        F.struct(*rows.columns).alias("_row"), F.lit(None).cast(kind).alias("_interval"))
    two = intervals.select(
        *keys, F.col("start_ts").alias("_t"), F.lit(0).alias("_side"), F.col("end_ts").cast("string").alias("_id"),
        F.lit(None).cast(one.schema["_row"].dataType).alias("_row"), interval.alias("_interval"))
    found = running(
        one.unionByName(two), keys, ["_t", "_side", "_id"], {"_open": Run("last", F.col("_interval"))},
        rows_per_task=rows_per_task,
    ).filter(F.col("_side") == 1)
    inside = F.when(F.col("_t") <= F.col("_open.end_ts"), F.col("_open.cls"))
    return found.select("_row.*", F.coalesce(inside, F.lit(default)).alias("cls"))


def interval_cover(intervals: DataFrame, keys: Sequence[str] = ("trip_id",), *, rows_per_task: int | None = None) -> DataFrame:
    """Who holds each point of time, where intervals overlap: ``(ts, cls_at, cls_after)`` per key and interval end.

    ``cls_at`` holds at the instant ``ts``, ``cls_after`` from there to the next ``ts``; null where no interval
    is open. Of several open intervals the one begun last counts, of equal starts the one that ends first,
    then the greatest ``cls``. Intervals without a start, an end or a key, or that end before they start, are left out.

    The ends of a key are ranked. Each interval is cut into the few nodes of a binary tree over the ranks that it
    covers as a whole, one winner is kept per node, and every rank looks up the winners of its ancestors:
    no pair of intervals and no pair of interval and point is ever made.
    """
    keys = list(keys)
    known = intervals.filter("start_ts <= end_ts")
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    ends = known.select(*keys, F.explode(F.array("start_ts", "end_ts")).alias("ts")).distinct()
    ranked = materialize(numbered(ends, keys, ["ts"], "_rank", rows_per_task=rows_per_task))
    levels = (2 * (ranked.agg(F.max("_rank")).first()[0] or 0) + 2).bit_length()
    # an end of rank r is position 2r, the open stretch after it 2r + 1
    spans = lookup_join(known, ranked.select(*keys, F.col("ts").alias("start_ts"), (2 * F.col("_rank")).alias("_a")), [*keys, "start_ts"])
    spans = lookup_join(spans, ranked.select(*keys, F.col("ts").alias("end_ts"), (2 * F.col("_rank") + 1).alias("_b")), [*keys, "end_ts"])
    nodes = []
    for k in range(levels):
        low, high = F.shiftright(F.col("_a") + ((1 << k) - 1), k), F.shiftright("_b", k)
        nodes += [F.when((low < high) & (low % 2 == 1), low * 64 + k), F.when((low < high) & (high % 2 == 1), (high - 1) * 64 + k)]
    winner = F.struct("start_ts", (-F.col("end_ts")).alias("_end"), "cls")
    held = materialize(spans.select(*keys, F.explode(F.array_compact(F.array(F.lit(None).cast("long"), *nodes))).alias("_node"), winner.alias("_w"))
                       .groupBy(*keys, "_node").agg(F.max("_w").alias("_w")))
    places = ranked.select(*keys, "ts", F.explode(F.array(F.lit(0), F.lit(1))).alias("_after"), "_rank")
    above = F.array(*[F.shiftright(2 * F.col("_rank") + F.col("_after"), k) * 64 + k for k in range(levels)])
    found = lookup_join(places.select(*keys, "ts", "_after", F.explode(above).alias("_node")), held, [*keys, "_node"], "left")
    return found.groupBy(*keys, "ts").agg(
        F.max(F.when(F.col("_after") == 0, F.col("_w")))["cls"].alias("cls_at"),
        F.max(F.when(F.col("_after") == 1, F.col("_w")))["cls"].alias("cls_after"))


def overlap_label_join(
    rows: DataFrame, intervals: DataFrame, keys: Sequence[str] = ("trip_id",), *, ts: str = "ts", row_id: str = "id",
    default: str = "paved_road", rows_per_task: int | None = None,
) -> DataFrame:
    """Add ``cls`` of the interval ``[start_ts, end_ts]`` that holds a row's time, else ``default``; intervals may nest and cross.

    Precedence is that of :func:`interval_cover`; a row then only looks at the last interval end
    before it, and a key with very many rows is cut. Rows without a key or a time get ``default``.
    """
    cover = materialize(interval_cover(intervals, keys, rows_per_task=rows_per_task))
    state = F.struct("ts", "cls_at", "cls_after")
    kind = cover.select(state.alias("s")).schema["s"].dataType
    one = rows.select(
        *keys, F.col(ts).alias("_t"), F.lit(1).alias("_side"), F.col(row_id).cast("string").alias("_id"),
        F.struct(*rows.columns).alias("_row"), F.lit(None).cast(kind).alias("_state"))
    two = cover.select(
        *keys, F.col("ts").alias("_t"), F.lit(0).alias("_side"), F.lit("").alias("_id"),
        F.lit(None).cast(one.schema["_row"].dataType).alias("_row"), state.alias("_state"))
    found = running(
        one.unionByName(two), keys, ["_t", "_side", "_id"], {"_open": Run("last", F.col("_state"))}, rows_per_task=rows_per_task,
    ).filter(F.col("_side") == 1)
    cls = F.when(F.col("_t") == F.col("_open.ts"), F.col("_open.cls_at")).otherwise(F.col("_open.cls_after"))
    return found.select("_row.*", F.coalesce(cls, F.lit(default)).alias("cls"))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in metres."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.asin(F.sqrt(a)) * (2 * EARTH_RADIUS_M)


def _columns_of_band(row: Column, cell: float) -> Column:
    """How many equal columns a band of latitude has, so that each is at least as wide as ``cell`` is high.

    The width is taken a cell beyond the band's edge nearer to a pole, where a degree of longitude
    is shortest; a band that reaches a pole is one column.
    """
    edge = F.greatest(F.abs(row * cell), F.abs((row + 1) * cell)) + cell
    ratio = F.sin(F.radians(F.lit(cell / 2))) / F.cos(F.radians(F.least(edge, F.lit(90.0))))
    width = F.degrees(2 * F.asin(F.least(ratio, F.lit(1.0))))
    return F.when((edge < 90) & (ratio < 1), F.greatest(F.lit(1), F.floor(360 / width))).otherwise(1).cast("long")


def _column(lon: Column, columns: Column) -> Column:
    return F.pmod(F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * columns), columns).cast("long")


def match_way_section(
    points: DataFrame, sections: DataFrame, cell: float = 0.001, point_id: str = "id", crowded: int = CROWDED
) -> DataFrame:
    """Add ``section_id`` and ``distance_m`` of the nearest section within ``cell`` degrees of arc, null without one.

    Bands of latitude are cut into columns that are a cell wide at the band's own latitude and go
    round at 180 degrees, so that all sections within reach lie in the nine cells around a point.
    Where a cell holds more than ``crowded`` sections, points look for one within an eighth of the
    reach first, and only those without go on to the next size. Sections at the same place are
    compared once, under their lowest id. ``point_id`` is unique.
    """
    places = materialize(sections.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy("lat", "lon").agg(
        F.min("section_id").alias("section_id")))
    reaches = [cell]
    while len(reaches) < MAX_LEVELS and _most_in_a_cell(places, reaches[-1]) > crowded:
        reaches.append(reaches[-1] / 8)
    left, found = points.select(point_id, "lat", "lon"), None
    for reach in reversed(reaches):
        near = _nearest_within(left, places, reach, point_id)
        last = reach == cell
        near = near if last else materialize(near)
        done = near if last else near.filter(F.col("section_id").isNotNull())
        found = done if found is None else found.unionByName(done)
        if not last:
            left = lookup_join(left, done.select(point_id), [point_id], "left_anti")
    return found


def _cells(df: DataFrame, reach: float) -> DataFrame:
    row = F.floor(F.col("lat") / reach).cast("long")
    return df.withColumn("_row", row).withColumn("_col", _column(F.col("lon"), _columns_of_band(F.col("_row"), reach)))


def _most_in_a_cell(places: DataFrame, reach: float) -> int:
    return _cells(places, reach).groupBy("_row", "_col").count().agg(F.max("count")).first()[0] or 0


def _nearest_within(points: DataFrame, places: DataFrame, reach: float, point_id: str) -> DataFrame:
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    columns = _columns_of_band(F.col("_row"), reach)
    copies = (
        places.select("section_id", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
        .withColumn("_dr", F.explode(around))
        .withColumn("_row", F.floor(F.col("_lat") / reach).cast("long") + F.col("_dr"))
        # each copy has its column in the band it is copied to; a band of fewer than three columns has them once
        .withColumn("_col", F.explode(F.array_distinct(F.transform(
            around, lambda d: F.pmod(_column(F.col("_lon"), columns) + d, columns).cast("long")))))
    )
    packed = materialize(
        numbered(copies, ["_row", "_col"], ["section_id"], "_n")
        .groupBy("_row", "_col", F.floor((F.col("_n") - 1) / PACK).alias("_pack"))
        .agg(F.collect_list(F.struct("section_id", "_lat", "_lon")).alias("_sections"))
        .drop("_pack")
    )
    best = F.array_min(F.transform(
        "_sections",
        lambda s: F.struct(
            haversine(F.col("lat"), F.col("lon"), s["_lat"], s["_lon"]).alias("d"), s["section_id"].alias("section_id")
        ),
    ))
    limit = math.radians(reach) * EARTH_RADIUS_M
    nearest = (
        lookup_join(_cells(points, reach), packed, ["_row", "_col"], "left")
        .select(point_id, best.alias("_best"))
        .withColumn("_best", F.when(F.col("_best.d") <= limit, F.col("_best")))
        .groupBy(point_id)
        .agg(F.min("_best").alias("_best"))
    )
    return nearest.select(point_id, F.col("_best.section_id").alias("section_id"), F.col("_best.d").alias("distance_m"))


# -- windows ----------------------------------------------------------------------------


def rolling_features(
    rows: DataFrame, features: Sequence[str], size: int, order: Sequence[str], keys: Sequence[str] = ("trip_id",),
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add mean, standard deviation, minimum and maximum of the last ``size`` rows of each feature.

    ``order`` must be unique within a trip: several devices may have one time.
    """
    kinds = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    columns = {
        f"{feature}_{name}": (lambda w, f=feature, agg=agg: agg(f).over(w))
        for feature in features for name, agg in kinds.items()
    }
    return rolling(rows, keys, order, size, columns, rows_per_task=rows_per_task)


def step_windows(
    rows: DataFrame, steps: int, hazard_buffer: int, features: Sequence[str],
    keys: Sequence[str] = ("trip_id",), order: Sequence[str] = ("ts",), hazard: str = "hazard",
) -> DataFrame:
    """Full windows of ``steps`` consecutive rows with their feature means and ``label``.

    The label is the first hazard of the window that is not within ``hazard_buffer``
    steps of either end; without one the window has none (null).
    """
    at = F.pmod(F.col("_n") - 1, F.lit(steps))
    counts = (at >= hazard_buffer) & (at < steps - hazard_buffer) & F.col(hazard).isNotNull()
    windows = numbered(rows, keys, order, "_n").groupBy(*keys, F.floor((F.col("_n") - 1) / steps).alias("window")).agg(
        F.count(F.lit(1)).alias("_size"),
        F.min_by(F.col(hazard), F.when(counts, F.col("_n"))).alias("label"),
        *[F.avg(f).alias(f"{f}_mean") for f in features],
    )
    return windows.filter(F.col("_size") == steps).drop("_size")


def resample(
    rows: DataFrame, step: int, features: Sequence[str], keys: Sequence[str] = ("trip_id",), ts: str = "ts"
) -> DataFrame:
    """Feature means per ``step`` of time; empty steps between two filled ones repeat the earlier one."""
    cells = rows.groupBy(*keys, (F.floor(F.col(ts) / step) * step).cast("long").alias(ts)).agg(
        *[F.avg(f).alias(f) for f in features])
    filled = running(materialize(cells), keys, [ts], {"_next": Run("next", F.col(ts), strict=True)})
    times = F.sequence(F.col(ts), F.coalesce(F.col("_next") - step, F.col(ts)), F.lit(step))
    return filled.select(*keys, F.explode(times).alias("_at"), *features).withColumnRenamed("_at", ts)


def scale_features(rows: DataFrame, features: Sequence[str], kind: str = "standard") -> DataFrame:
    """Scale features over all rows: ``standard`` (mean 0, deviation 1) or ``minmax`` (0 to 1); no spread gives 0."""
    if kind == "standard":
        stats = [(F.avg(f), F.stddev_pop(f)) for f in features]
    elif kind == "minmax":
        stats = [(F.min(f), F.max(f) - F.min(f)) for f in features]
    else:
        raise ValueError(f"unknown scaler: {kind}")
    found = rows.agg(*[F.struct(low.cast("double").alias("low"), width.cast("double").alias("width")).alias(f)
                       for f, (low, width) in zip(features, stats, strict=True)]).first()

    def scaled(name: str) -> Column:
        low, width = found[name]["low"], found[name]["width"]
        return F.lit(0.0) if not width else (F.col(name) - low) / width

    return rows.withColumns({f: scaled(f) for f in features})


# -- sampling -----------------------------------------------------------------------------


def sample_per_length(texts: DataFrame, n: int, limit: int = 16, text: str = "text", key: str = "id", seed: object = 0) -> DataFrame:
    """``n`` texts of each length from 2 to ``limit``, chosen by hash of the key."""
    sized = texts.withColumn("n_chars", F.char_length(text)).filter(F.col("n_chars").between(2, limit))
    drawn = sized.withColumn("_draw", hash32(seed, F.col(key)))
    return top_n(drawn, ["n_chars"], ["_draw", key], n, few_keys=True).drop("_draw")


def balance_negatives(rows: DataFrame, factor: float, label: str = "label", key: str = "id", seed: object = 0) -> DataFrame:
    """All positive rows and ``factor`` times as many negative ones (null label), chosen by hash of the key."""
    positive = rows.filter(F.col(label).isNotNull())
    wanted = int(factor * positive.count())
    negative = rows.filter(F.col(label).isNull()).withColumn("_draw", hash32(seed, F.col(key)))
    kept = numbered(negative, [], ["_draw", key], "_n").filter(F.col("_n") <= wanted)
    return positive.unionByName(kept.select(*rows.columns))


def split_by_day(rows: DataFrame, days: DataFrame, ts_day: Column) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: test rows fall on the listed days (a table with a ``day`` date column)."""
    listed = materialize(days.select("day").distinct())
    dated = rows.withColumn("day", ts_day)
    return lookup_join(dated, listed, ["day"], "left_anti"), lookup_join(dated, listed, ["day"], "left_semi")


def ocr_eval(predictions: DataFrame, file: str = "file", text: str = "text", pattern: str = r"^(?:.*/)?[^_/]*_(.*)\.[^.]*$") -> DataFrame:
    """Rows and exact-match rate per length of the truth, which stands in the file name after the first ``_``."""
    truth = F.regexp_extract(file, pattern, 1)
    return predictions.select(truth.alias("truth"), F.col(text).alias("found")).groupBy(
        F.char_length("truth").alias("n_chars")
    ).agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("truth") == F.col("found")).cast("int")).alias("match_rate"))
