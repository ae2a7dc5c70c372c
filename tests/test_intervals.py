"""Overlapping intervals against brute force."""

import random

import pytest

from millrace.operators import temporal

ROWS = "trip_id long, ts long, id long"
SPANS = "trip_id long, start_ts long, end_ts long, cls string"


def plain(rows, spans):
    out = {}
    for trip, ts, row in rows:
        held = [(s, -e, c) for t, s, e, c in spans
                if None not in (t, s, e, trip, ts) and t == trip and s <= ts <= e]
        out[row] = max(held)[2] if held else "paved_road"
    return out


@pytest.mark.parametrize("rows_per_task", [None, 40])
def test_nested_and_crossing(spark, rows_per_task):
    """Half of all rows and intervals belong to one trip; ends touch, intervals repeat and have no length."""
    draw = random.Random(5)
    rows = [(draw.choice([1, 1, 1, 2, 3, None]), draw.randrange(-20, 220), i) for i in range(600)] + [(1, None, 600)]
    spans = []
    for _ in range(150):
        start = draw.randrange(200)
        spans.append((draw.choice([1, 1, 2, None]), start, start + draw.choice([0, 1, 3, 10, 60]), draw.choice("abc")))
    spans += spans[:10] + [(1, 50, 40, "backwards"), (1, None, 9, "x"), (2, 9, None, "y")]
    got = temporal.overlap_label_join(spark.createDataFrame(rows, ROWS), spark.createDataFrame(spans, SPANS), rows_per_task=rows_per_task)
    assert {r["id"]: r["cls"] for r in got.collect()} == plain(rows, spans)


def test_no_intervals(spark):
    rows, none = spark.createDataFrame([(1, 5, 0)], ROWS), spark.createDataFrame([], SPANS)
    assert [r["cls"] for r in temporal.overlap_label_join(rows, none).collect()] == ["paved_road"]
    assert temporal.overlap_label_join(rows.limit(0), none).count() == 0
