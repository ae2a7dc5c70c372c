"""Keyed run status: many runs of few lines share groups and timers, and stay apart in them."""

import json

import pandas as pd
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import keyed, sources
from tests.test_keyed_status import statuses
from tests.test_streaming import newest, sample_lines


def test_groups_and_timers_do_not_grow_with_the_runs(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKETS", 3, raising=False)
    folder, lines = scratch_path(spark, "test-buckets"), sample_lines(spark)
    lines = spark.range(40).select((F.col("id") * 1000).alias("shift")).crossJoin(lines).withColumn("run_id", F.col("run_id") + F.col("shift")).drop("shift")
    sources.publish(lines.filter("line_no % 2 = 0"), f"{folder}/logs")
    options = {"block_lines": 70, "idle_ms": 10**9, "keep_marks_ms": 10**9}
    query = keyed.stream_run_events(sources.log_stream(spark, f"{folder}/logs"), folder, **options)
    query.awaitTermination()
    assert sum(p["customMetrics"]["numRegisteredTimers"] for p in query.recentProgress[-1]["stateOperators"]) <= 3
    sources.publish(lines.filter("line_no % 2 = 1"), f"{folder}/logs")
    keyed.stream_run_events(sources.log_stream(spark, f"{folder}/logs"), folder, **options).awaitTermination()
    assert len(statuses(spark, folder)) > 40 and statuses(spark, folder) == newest(lines)


def test_a_run_without_an_id_leaves_others_alone(spark):
    """Ids beside a null one are whole numbers, beyond those that a double holds too."""
    big = (1 << 60) + 1
    rows = [(run, n, 10 * n, text) for i, run in enumerate((None, 0, 7, big))
            for n, text in enumerate((f"Training Loss {i}.5, at iteration {i + 1}", f"PROGRESS: 1{i}.0%", "other"))]
    folder = scratch_path(spark, "test-no-run")
    for part in (rows[::2], rows[1::2], rows[:5]):
        sources.publish(spark.createDataFrame(part, sources.LOG_SCHEMA).coalesce(1), f"{folder}/logs")
        keyed.stream_run_events(sources.log_stream(spark, f"{folder}/logs"), folder).awaitTermination()
    assert statuses(spark, folder) == {run: (10.0 + i, i + 0.5, i + 2, i + 0.5, i + 0.5, 1) for i, run in enumerate((None, 0, 7, big))}


class Store:
    """State and timers of one group in memory."""

    def __init__(self):
        self.maps, self.timers = {}, set()

    def getMapState(self, name, *_):
        values = self.maps.setdefault(name, {})

        class Map:
            def getValue(self, key):
                return values.get(key)

            def updateValue(self, key, value):
                values[key] = value

            def removeKey(self, key):
                del values[key]

        return Map()

    def registerTimer(self, when):
        assert when not in self.timers
        self.timers.add(when)


class Clock:
    def __init__(self, now, when=None):
        self.getCurrentProcessingTimeInMs = lambda: now
        self.getExpiryTimeInMs = lambda: when


def test_runs_of_a_group_are_idle_each_at_its_time():
    store, step = Store(), keyed._RunsStep(100, 300)
    step.init(store)

    def lines(now, *runs):
        rows = [(run or 0, run is None, 0, run == 4, json.dumps(keyed.of_line(now, now, None, None, float(now)))) for run in runs]
        frame = pd.DataFrame(rows, columns=["run_id", "no_run", "block", "ended", "summary"])
        return told(step.handleInputRows((0,), iter([frame]), Clock(now)))

    def passes(now):
        out = []
        for when in sorted(t for t in store.timers if t <= now):
            out += told(step.handleExpiredTimer((0,), Clock(now), Clock(now, when)))
            store.timers.discard(when)
        return out

    def told(frames):
        return [(r.run_id, r.version, r.kind, r.progress) for f in frames for r in f.itertuples()]

    assert lines(10, 1, None, 4) == [(1, 1, "status", 10.0), (None, 1, "status", 10.0), (4, 1, "status", 10.0), (4, 2, "end", 100.0)]
    assert lines(50, 1) == [(1, 2, "status", 50.0)] and passes(109) == []
    assert passes(120) == [(None, 2, "beat", 10.0)]  # due at 110; the next one at 220
    assert passes(160) == [(1, 3, "beat", 50.0)]
    assert lines(165, None) == [(None, 3, "status", 165.0)]
    assert passes(225) == []  # the run without an id had lines
    assert passes(270) == [(1, 4, "beat", 50.0), (None, 4, "beat", 165.0)]
    assert (4, False) in store.maps["runs"]
    passes(310)
    assert (4, False) not in store.maps["runs"] and len(store.maps["due"]) == len(store.timers) <= 2


def test_lines_in_order_are_summed_up_as_one_by_one():
    lines = [(0, 5, None, None, None), (1, None, 2.0, 10, None), (2, 7, None, None, 30.0), (3, 8, 1.0, 20, None), (4, 3, 3.0, 30, 60.0), (5, 4, 9.0, 1, None)]
    for stop in range(1, len(lines) + 1):
        whole = keyed.of_line(*lines[0])
        for line in lines[1:stop]:
            whole = keyed.follow(whole, keyed.of_line(*line))
        assert keyed.of_lines(lines[:stop]) == whole
