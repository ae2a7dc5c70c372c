import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.runlogs import parse_losses, running_loss_status
from millrace.session import list_folders, scratch_path
from millrace.streaming import sources, stages, status


def sample_lines(spark, n=400):
    draw = random.Random(9)
    rows = []
    for i in range(n):
        kind = draw.random()
        text = (f"x Training Loss {draw.randrange(900) / 100}, at iteration {i}" if kind < 0.3
                else f"PROGRESS: {draw.randrange(100)}.5%" if kind < 0.4 else "noise")
        rows.append((draw.choice([1, 1, 1, 2, 3]), i, i * 1000, text))
    return spark.createDataFrame(rows, sources.LOG_SCHEMA)


def newest(df):
    """Last progress line of each run by the batch operator."""
    out = {}
    for r in running_loss_status(parse_losses(df)).orderBy("line_no").collect():
        out[r["run_id"]] = (r["progress"], r["last_loss"], r["tot_epochs"], r["max_loss"], r["min_loss"], r["n_epochs"])
    return out


def test_merged_summaries_equal_the_batch(spark):
    """Wherever the lines are cut, the merged status is that of all lines."""
    lines = sample_lines(spark)
    parsed = parse_losses(lines)
    for cuts in ([200], [3, 5, 390], [100, 101, 250]):
        folder = scratch_path(spark, "test-status")
        for n, (low, high) in enumerate(zip([0, *cuts], [*cuts, 400], strict=True)):
            part = parsed.filter((F.col("line_no") >= low) & (F.col("line_no") < high))
            status.write_status_snapshot(status.summarize(part), folder, n)
        status.write_status_snapshot(status.summarize(part), folder, n)  # a repeated batch changes nothing
        got = {r["run_id"]: tuple(r[c] for c in ("progress", "last_loss", "tot_epochs", "max_loss", "min_loss", "n_epochs"))
               for r in status.latest_status(spark, folder).collect()}
        assert got == newest(lines)


def test_chunks_in_any_order(spark):
    """Late chunks, chunks that overlap and repeated lines give the status of the whole log."""
    lines = sample_lines(spark)
    want = newest(lines)
    for order in ([2, 0, 3, 1], [3, 2, 1, 0], [0, 1, 1, 3, 2]):
        folder = scratch_path(spark, "test-order")
        for chunk in order:
            sources.publish(lines.filter(F.floor(F.col("line_no") / 100) == chunk), f"{folder}/logs")
            status.stream_log_status(sources.log_stream(spark, f"{folder}/logs"), folder).awaitTermination()
        got = {r["run_id"]: tuple(r[c] for c in ("progress", "last_loss", "tot_epochs", "max_loss", "min_loss", "n_epochs"))
               for r in status.latest_status(spark, f"{folder}/status").collect()}
        assert got == want


def test_old_versions_go(spark, monkeypatch):
    monkeypatch.setattr(status, "FULL_EVERY", 3)
    folder, parsed = scratch_path(spark, "test-compact"), parse_losses(sample_lines(spark))
    for n in range(8):
        part = parsed.filter((F.col("line_no") >= n * 50) & (F.col("line_no") < n * 50 + 50))
        status.write_status_snapshot(status.summarize(part), folder, n)
    assert sorted(list_folders(spark, folder)) == ["batch=2", "batch=3", "batch=4", "batch=5", "batch=6", "batch=7"]
    assert {r["run_id"]: r["progress"] for r in status.latest_status(spark, folder).collect()} == {
        k: v[0] for k, v in newest(sample_lines(spark)).items()}


def test_missing_status_is_told_from_a_broken_one(spark):
    assert status.current_status(spark, scratch_path(spark, "none")) is None
    folder = scratch_path(spark, "broken")
    spark.range(3).selectExpr("cast(id as string) t").write.text(f"{folder}/batch=0")
    with pytest.raises(Exception, match="(?i)parquet"):
        status.current_status(spark, folder).collect()


def test_heartbeats(spark):
    rows = [(1, 0, 50.0, 0.5), (2, 90, 10.0, 0.1)]
    df = spark.createDataFrame(rows, "run_id long, last_at long, progress double, last_loss double")
    got = [tuple(r) for r in status.heartbeats(df, F.lit(100), 60).collect()]
    assert got == [(1, 100, 50.0, 0.5)]


def test_stage_chain_survives_a_restart(spark):
    folder = scratch_path(spark, "test-chain")
    chain = [stages.Stage("even", lambda m: m.filter("id % 2 = 0")), stages.Stage("named", lambda m: m.withColumn("n", F.lit("x")))]
    for low in (0, 10):
        sources.publish(spark.range(low, low + 10), f"{folder}/in")
        out = stages.run_chain(spark, chain, f"{folder}/in", "id long", folder)
    assert sorted(r["id"] for r in out.collect()) == list(range(0, 20, 2))


def test_late_rows_are_dropped(spark):
    folder = scratch_path(spark, "test-late")
    schema = "trip_id long, ts timestamp, f double"

    def feed(*seconds):
        rows = spark.createDataFrame([(1, s, 1.0) for s in seconds], "trip_id long, s long, f double")
        sources.publish(rows.selectExpr("trip_id", "timestamp_seconds(s) AS ts", "f"), f"{folder}/in")
        out = stages.window_sensor_stream(sources.message_stream(spark, f"{folder}/in", schema), "10 seconds", "5 seconds", ["f"])
        (out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
         .trigger(availableNow=True).start().awaitTermination())

    feed(1, 2, 30)
    feed(3, 31, 60)
    feed(100)
    got = {r["s"]: r["n"] for r in spark.read.parquet(f"{folder}/out").selectExpr("unix_seconds(start) AS s", "n").collect()}
    assert got == {0: 2, 30: 2, 60: 1}


def test_heartbeat_stream(spark):
    folder = scratch_path(spark, "test-beat")
    status.write_status_snapshot(status.summarize(parse_losses(sample_lines(spark, 60))), f"{folder}/status", 0)
    spark.createDataFrame([(2,)], "run_id long").write.parquet(f"{folder}/ended")
    query = status.heartbeat_stream(spark, folder, every="1 second", ended=f"{folder}/ended")
    while not query.recentProgress or query.lastProgress["batchId"] < 2:
        query.awaitTermination(0.5)
    query.stop()
    sent = spark.read.parquet(f"{folder}/heartbeats").collect()
    assert {r["run_id"] for r in sent if r["kind"] == "beat"} == {1, 3}
    assert [(r["run_id"], r["progress"]) for r in sent if r["kind"] == "end"] == [(2, 100.0)]
