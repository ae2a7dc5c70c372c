"""Run status from keyed state: late, repeated and spread lines, restarts, beats and ends."""

import time

from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import keyed, sources
from tests.test_streaming import newest, sample_lines

FIELDS = ("progress", "last_loss", "tot_epochs", "max_loss", "min_loss", "n_epochs")


def statuses(spark, folder):
    return {r["run_id"]: tuple(r[c] for c in FIELDS) for r in keyed.newest_status(spark, folder).collect()}


def test_folding_blocks_equals_one_block():
    lines = [(0, 5, None, None, None), (1, 6, 2.0, 10, None), (2, 7, None, None, 30.0), (3, 8, 1.0, 20, None), (4, 9, 3.0, 30, 60.0)]
    whole = keyed.of_line(*lines[0])
    for line in lines[1:]:
        whole = keyed.follow(whole, keyed.of_line(*line))
    assert whole.at_n == whole.n == 3 and (whole.at_loss, whole.at_iter, whole.at_max, whole.at_min) == (3.0, 30, 3.0, 1.0)
    assert (whole.mark, whole.progress, whole.last_line, whole.last_at) == (4, 60.0, 4, 9)
    for cut in range(1, len(lines)):
        parts = []
        for part in (lines[:cut], lines[cut:]):
            one = keyed.of_line(*part[0])
            for line in part[1:]:
                one = keyed.follow(one, keyed.of_line(*line))
            parts.append(one)
        assert keyed.follow(*parts) == whole


def test_chunks_in_any_order_over_restarts(spark):
    """Every chunk is a query of its own, restarted from the checkpoint; chunk 1 comes late, chunk 2 twice."""
    lines = sample_lines(spark)
    folder = scratch_path(spark, "test-keyed")
    for chunk in (0, 2, 3, 1, 2):
        sources.publish(lines.filter(F.floor(F.col("line_no") / 100) == chunk), f"{folder}/logs")
        keyed.stream_run_events(sources.log_stream(spark, f"{folder}/logs"), folder, block_lines=70).awaitTermination()
    assert statuses(spark, folder) == newest(lines)
    late = keyed.told(spark, folder).filter("kind = 'status'").groupBy("run_id").agg(F.count("*").alias("n"), F.max("version").alias("v"))
    assert all(r["n"] == r["v"] == 5 for r in late.collect())


def test_beats_and_ends(spark):
    folder = scratch_path(spark, "test-beats")
    schema = f"{sources.LOG_SCHEMA}, ended boolean"
    rows = [(1, 0, 5, "Training Loss 2.5, at iteration 3", None), (1, 1, 6, "PROGRESS: 40.0%", False),
            (2, 0, 7, "PROGRESS: 99.0%", False), (2, 1, 8, "bye", True), (3, 0, 9, "nothing yet", None), (3, None, 9, "PROGRESS: 1.0%", None)]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/logs")
    query = keyed.stream_run_events(sources.log_stream(spark, f"{folder}/logs", schema), folder, idle_ms=200, keep_ms=300,
                                    trigger={"processingTime": "300 milliseconds"})
    try:
        for _ in range(120):
            time.sleep(0.5)
            assert query.exception() is None
            if query.lastProgress and keyed.told(spark, folder).filter("kind = 'beat'").count() >= 2:
                break
    finally:
        query.stop()
    found = keyed.told(spark, folder).collect()
    beats = [r for r in found if r["kind"] == "beat"]
    assert len(beats) >= 2 and {(r["run_id"], r["progress"], r["last_loss"]) for r in beats} == {(1, 40.0, 2.5)}
    assert [(r["run_id"], r["progress"]) for r in found if r["kind"] == "end"] == [(2, 100.0)]
    assert statuses(spark, folder).keys() == {1, 2}
