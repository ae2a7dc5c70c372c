import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import annotations, manifests, temporal


def test_cap_equals_a_single_reader(spark):
    """The bounded ordered pass keeps exactly what a reader of all files in order keeps."""
    draw = random.Random(11)
    rows = [(f"f{i:04}", draw.choice("AAAAABBCDEF")) for i in range(600) for _ in range(draw.randrange(1, 4))]
    rois = spark.createDataFrame(rows, "file string, cls string")
    for cap in (1, 5, 40):
        seen, want = {}, []
        files = {}
        for name, cls in rows:
            files.setdefault(name, []).append(cls)
        for name in sorted(files):
            if any(seen.get(c, 0) < cap for c in files[name]):
                want.append(name)
                for c in files[name]:
                    seen[c] = seen.get(c, 0) + 1
        got = sorted(r["file"] for r in annotations.cap_per_class_any(rois, cap).collect())
        assert got == want


def box_rows(spark, rows):
    return spark.createDataFrame(rows, "file string, cls string, xmin int, ymin int, xmax int, ymax int, width int, height int")


def test_box_ratio_boundary(spark):
    rois = box_rows(spark, [("edge", "a", 0, 0, 40, 40, 1000, 1000), ("thin", "a", 0, 0, 39, 900, 1000, 1000),
                            ("mixed", "a", 0, 0, 500, 500, 1000, 1000), ("mixed", "a", 0, 0, 5, 500, 1000, 1000),
                            ("unmeasured", "a", 0, 0, 1, 1, None, None)])
    files = spark.createDataFrame([("edge",), ("thin",), ("mixed",), ("unmeasured",), ("bare",)], "file string")
    kept = {r["file"] for r in annotations.filter_min_box_ratio(files, rois).collect()}
    assert kept == {"edge", "unmeasured", "bare"}


def test_class_map(spark):
    lines = ["", " \t ", "a.zip@/x/1.jpg\t7", "a.zip@x/2.jpg\t\t8\tmore", "one", "noat\t1", "a@/\t1", "a@b\tx"]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = [(r["member"], r["class_idx"], r["error"]) for r in manifests.class_map(df).collect()]
    assert got == [("x/1.jpg", 7, None), ("x/2.jpg", 8, None), (None, None, "too few fields"), (None, None, "no @ in class"),
                   (None, None, "empty member"), (None, None, "bad index")]


def test_changed_minus_deleted_keeps_duplicates(spark):
    changed = spark.createDataFrame([("a;b;a;c",)], "names string")
    deleted = spark.createDataFrame([("a;c",)], "names string")
    assert sorted(r["name"] for r in manifests.changed_minus_deleted(changed, deleted).collect()) == ["a", "b"]


def test_limit(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    assert manifests.limit_n(df, -1, ["n"]).count() == 10 == manifests.limit_n(df, None, ["n"]).count()
    assert [r["n"] for r in manifests.limit_n(df, 3, ["n"]).collect()] == [0, 1, 2]
    assert manifests.worker_batch(16, 4) == 64


@pytest.mark.parametrize("limit", [None, 3])
@pytest.mark.parametrize("keys", [["k"], []])
def test_nearest_time(spark, limit, keys):
    draw = random.Random(3)
    left = [("x" if draw.random() < 0.8 else "y", draw.randrange(60), i) for i in range(80)]
    right = [("x" if draw.random() < 0.8 else "z", t, i) for i, t in enumerate(draw.sample(range(60), 25))]
    a = spark.createDataFrame(left, "k string, ts long, id long")
    b = spark.createDataFrame(right, "k string, ts long, rid long")
    out = temporal.nearest_time_join(a, b, keys, ["rid"], right_id="rid", tolerance=6, rows_per_task=limit)
    got = {r["id"]: r["right_ts"] for r in out.collect()}
    for key, ts, i in left:
        times = [t for k, t, _ in right if not keys or k == key]
        best = min(times, key=lambda t: (abs(t - ts), t), default=None)
        assert got[i] == (best if best is not None and abs(best - ts) <= 6 else None)


def test_pairs_and_intervals(spark):
    s, e, u = temporal.START, temporal.END, temporal.UNPAVED
    tags = [(1, s), (3, s), (4, u), (5, e), (6, e), (7, u), (8, s), (9, e), (10, s)]
    df = spark.createDataFrame([("t", ts, i, kind) for i, (ts, kind) in enumerate(tags)], "trip_id string, ts long, id long, type string")
    pairs = temporal.pair_start_end(df)
    assert sorted((r["start_ts"], r["end_ts"], r["cls"]) for r in pairs.collect()) == [
        (3, 5, "unpaved_road"), (8, 9, "bumpy_road")]
    rows = spark.createDataFrame([("t", i, i) for i in range(11)], "trip_id string, ts long, id long")
    for limit in (None, 2):
        got = {r["ts"]: r["cls"] for r in temporal.interval_label_join(rows, pairs, rows_per_task=limit).collect()}
        assert sorted(
            t for t, c in got.items() if c == "unpaved_road") == [3, 4, 5]
        assert sorted(t for t, c in got.items() if c == "bumpy_road") == [8, 9]


def test_step_windows(spark):
    rows = [("t", i, float(i), "h" if i in (0, 5, 11, 12) else None) for i in range(14)]
    df = spark.createDataFrame(rows, "trip_id string, ts long, f double, hazard string")
    got = {r["window"]: (r["label"], r["f_mean"]) for r in temporal.step_windows(df, 4, 1, ["f"]).collect()}
    assert got == {0: (None, 1.5), 1: ("h", 5.5), 2: (None, 9.5)}


def test_resample_fills_gaps(spark):
    df = spark.createDataFrame([("t", 0, 1.0), ("t", 5, 3.0), ("t", 31, 7.0)], "trip_id string, ts long, f double")
    got = sorted((r["ts"], r["f"]) for r in temporal.resample(df, 10, ["f"]).collect())
    assert got == [(0, 2.0), (10, 2.0), (20, 2.0), (30, 7.0)]


def test_no_spread_scales_to_zero(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    assert [tuple(r) for r in temporal.scale_features(df, ["a", "b"], "minmax").orderBy("b").collect()] == [(0.0, 0.0), (0.0, 1.0)]
    assert [r["b"] for r in temporal.scale_features(df, ["b"]).orderBy("b").collect()] == [-1.0, 1.0]


def test_balance(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") < 10, "h").alias("label"))
    assert temporal.balance_negatives(rows, 2).filter("label IS NULL").count() == 20
    assert temporal.balance_negatives(rows, 50).count() == 100


def test_way_sections(spark):
    points = spark.createDataFrame([(1, 45.0, 7.0), (2, 45.5, 7.5)], "id long, lat double, lon double")
    sections = spark.createDataFrame([(9, 45.0004, 7.0), (8, 45.0002, 7.0), (7, 45.0002, 7.0)], "section_id long, lat double, lon double")
    got = {r["id"]: r["section_id"] for r in temporal.match_way_section(points, sections).collect()}
    assert got == {1: 7, 2: None}


@pytest.mark.parametrize("latitude", [0.0, 45.0, -65.0, 80.0, 89.9995])
def test_way_sections_at_any_latitude(spark, latitude):
    """Nearest within reach, by brute force, also across 180 degrees and in crowded cells."""
    draw, reach = random.Random(int(latitude)), 0.001
    wide = min(20.0, 0.003 / max(1e-9, math.cos(math.radians(min(89.9999, abs(latitude))))))

    def place():
        lon = 180 + draw.uniform(-wide, wide)
        return max(-90.0, min(90.0, latitude + draw.uniform(-0.003, 0.003))), lon - 360 if lon > 180 else lon

    sections = [(i, *place()) for i in range(60)] + [(100 + i, latitude, 179.9999 + i * 1e-7) for i in range(40)]
    points = [(i, *place()) for i in range(120)]

    def distance(a, b):
        dlat, dlon = math.radians(b[0] - a[0]) / 2, math.radians(b[1] - a[1]) / 2
        h = math.sin(dlat) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(dlon) ** 2
        return 2 * temporal.EARTH_RADIUS_M * math.asin(math.sqrt(h))

    want = {}
    for i, *p in points:
        d, s = min((distance(p, q), s) for s, *q in sections)
        want[i] = s if d <= math.radians(reach) * temporal.EARTH_RADIUS_M else None
    left = spark.createDataFrame(points, "id long, lat double, lon double")
    right = spark.createDataFrame(sections, "section_id long, lat double, lon double")
    for crowded in (1024, 8):
        got = {r["id"]: r["section_id"] for r in temporal.match_way_section(left, right, reach, crowded=crowded).collect()}
        assert got == want
