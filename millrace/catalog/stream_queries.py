"""Queries that run as Structured Streaming jobs over the given tables, and the user hooks."""

from __future__ import annotations

import os
import unicodedata
from pathlib import Path

from pyspark.sql import functions as F

from millrace.catalog import inputs
from millrace.catalog.registry import Registry
from millrace.catalog.runlog_queries import _STATUS
from millrace.catalog.temporal_queries import HOUR, _SENSOR, sensor
from millrace.functions import logs as rx
from millrace.functions import text
from millrace.operators import hooks
from millrace.session import scratch_path
from millrace.streaming import keyed, sources, stages, status, tail

registry = Registry()
add = registry.add

CHUNKS = 3


def _feed(spark, folder, label, consume):
    """Publish the log lines in chunks of rising line numbers; let ``consume`` drain each before the next."""
    path = scratch_path(spark, label)
    logs = inputs.run_logs(spark, folder)
    last = logs.agg(F.max("line_no")).first()[0]
    for chunk in range(CHUNKS):
        low, high = last * chunk // CHUNKS, last * (chunk + 1) // CHUNKS
        part = logs.filter((F.col("line_no") > (low if chunk else -1)) & (F.col("line_no") <= high))
        sources.publish(part, f"{path}/logs")
        consume(path)
    return path


def _status(path, spark):
    status.stream_log_status(sources.log_stream(spark, f"{path}/logs"), path).awaitTermination()


@add("k1_stream_log_status", f"""
{_STATUS} SELECT run_id, progress, last_loss, tot_epochs, max_loss, min_loss, n_epochs FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY line_no DESC) AS rn FROM status) WHERE rn = 1""")
def stream_log_status(spark, folder):
    path = _feed(spark, folder, "status", lambda p: _status(p, spark))
    return status.latest_status(spark, f"{path}/status").drop("last_at")


@add("k1_keyed_run_status", f"""
{_STATUS} SELECT run_id, progress, last_loss, tot_epochs, max_loss, min_loss, n_epochs FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY line_no DESC) AS rn FROM status) WHERE rn = 1""")
def keyed_run_status(spark, folder):
    """The same from keyed state over two batches of a restarted query; the middle third of all lines comes last."""
    path = scratch_path(spark, "keyed")
    logs = inputs.run_logs(spark, folder)
    last = logs.agg(F.max("line_no")).first()[0]
    middle = F.col("line_no").between(last // 3, last * 2 // 3)
    for part in (logs.filter(~middle), logs.filter(middle)):
        sources.publish(part, f"{path}/logs")
        keyed.stream_run_events(sources.log_stream(spark, f"{path}/logs"), path).awaitTermination()
    return keyed.newest_status(spark, path).drop("last_at")


@add("b5_write_status_snapshot", f"""
{_STATUS} SELECT run_id, max(line_no) AS last_line, arg_max(progress, line_no) AS progress FROM status GROUP BY run_id""")
def write_status_snapshot(spark, folder):
    """Two snapshots in turn, the second merged into the first; versions hold the runs that changed."""
    path = scratch_path(spark, "snapshot")
    parsed = inputs_parsed(spark, folder).filter("progress IS NOT NULL")
    middle = parsed.agg((F.max("line_no") / 2).cast("long")).first()[0]
    status.write_status_snapshot(status.summarize(parsed.filter(F.col("line_no") <= middle)), path, 0)
    status.write_status_snapshot(status.summarize(parsed.filter(F.col("line_no") > middle)), path, 1)
    return status.current_status(spark, path).select("run_id", "last_line", "progress")


def inputs_parsed(spark, folder):
    from millrace.operators.runlogs import parse_losses

    return parse_losses(inputs.run_logs(spark, folder))


@add("b8_write_tee", f"WITH {inputs.SQL_LOGS} SELECT run_id, line_no, line FROM logs")
def write_tee(spark, folder):
    path = _feed(spark, folder, "tee", lambda p: stages.consume(
        sources.log_stream(spark, f"{p}/logs"), lambda batch, n: status.write_tee(batch, f"{p}/tee", n),
        f"{p}/checkpoint").awaitTermination())
    return spark.read.schema(sources.LOG_SCHEMA).parquet(f"{path}/tee").select("run_id", "line_no", "line")


@add("a8_scan_log_stream", f"""
WITH {inputs.SQL_LOGS} SELECT run_id, count(*) AS n_lines, max(line_no) AS last_line FROM logs GROUP BY run_id""")
def scan_log_stream(spark, folder):
    """Lines per run, counted from a stream into a table of partial counts."""
    def count(batch, n, path):
        counts = batch.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.max("line_no").alias("last_line"))
        counts.write.mode("overwrite").parquet(f"{path}/counts/batch={n}")

    path = _feed(spark, folder, "log-stream", lambda p: stages.consume(
        sources.log_stream(spark, f"{p}/logs"), lambda batch, n: count(batch, n, p), f"{p}/checkpoint").awaitTermination())
    counts = spark.read.schema("run_id long, n long, last_line long").parquet(f"{path}/counts")
    return counts.groupBy("run_id").agg(F.sum("n").alias("n_lines"), F.max("last_line").alias("last_line"))


LINES_PER_FILE = 50_000


def _append_lines(rows, folder, sizes):
    """Append ``(file, text)`` rows; each file belongs to one task, which first cuts it back to its size before this step."""
    def write(batches):
        begun = set()
        for batch in batches:
            for name, group in batch.groupby("file"):
                with open(f"{folder}/{name}", "ab") as file:
                    if name not in begun:
                        file.truncate(sizes.get(name, 0))
                        begun.add(name)
                    file.write("".join(f"{t}\n" for t in group["text"]).encode())
        yield from ()

    rows.repartition("file").sortWithinPartitions("file").mapInPandas(write, "file string").write.format("noop").mode("overwrite").save()


@add("a8_tail_growing_logs", f"""
WITH {inputs.SQL_LOGS} SELECT run_id, count(*) AS n_lines, max(line_no) AS last_line, md5(min(line)) AS first_digest FROM logs GROUP BY run_id""")
def tail_growing_logs(spark, folder):
    """The lines are appended to text files in thirds; the files grow once and are rotated once between runs of one stream."""
    path = scratch_path(spark, "tail").removeprefix("file:")
    logs = inputs.run_logs(spark, folder)
    total, last = logs.agg(F.count(F.lit(1)), F.max("line_no")).first()
    files = total // LINES_PER_FILE + 4
    name = F.concat(F.lit("part-"), F.pmod(F.xxhash64("run_id", F.floor(F.col("line_no") / 1000)), F.lit(files)), F.lit(".log"))
    os.makedirs(f"{path}/logs")
    for chunk in range(CHUNKS):
        grown = list(Path(f"{path}/logs").glob("part-*.log"))
        if chunk == 2:
            for file in grown:
                file.rename(file.with_name(f"old-{file.name}"))
            grown = []
        low, high = last * chunk // CHUNKS, last * (chunk + 1) // CHUNKS
        part = logs.filter((F.col("line_no") > (low if chunk else -1)) & (F.col("line_no") <= high))
        _append_lines(part.select(name.alias("file"), F.concat_ws("\t", "run_id", "line_no", "line").alias("text")),
                      f"{path}/logs", {f.name: f.stat().st_size for f in grown})
        (tail.tail_stream(spark, f"{path}/logs").writeStream.format("parquet").option("path", f"{path}/rows")
         .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    fields = F.split("line", "\t", 3)
    rows = spark.read.schema(tail.TAIL).parquet(f"{path}/rows").select(
        fields[0].cast("long").alias("run_id"), fields[1].cast("long").alias("line_no"), fields[2].alias("line"))
    return rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_lines"), F.max("line_no").alias("last_line"),
                                      F.md5(F.min("line")).alias("first_digest"))


@add("k2_stream_heartbeat", f"""
WITH {inputs.SQL_SOLVER},
limited AS (SELECT *, last_value(max_iter IGNORE NULLS) OVER w AS lim FROM solver
  WINDOW w AS (PARTITION BY run_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
lines AS (
  SELECT *, CASE WHEN loss IS NOT NULL AND lim IS NOT NULL THEN CAST(iter AS DOUBLE) / lim * 100 END AS p,
    CASE WHEN loss IS NOT NULL AND lim IS NOT NULL THEN loss END AS l FROM limited),
known AS (
  SELECT *, last_value(p IGNORE NULLS) OVER w AS progress, last_value(l IGNORE NULLS) OVER w AS last_loss,
    lead(at_us) OVER (PARTITION BY run_id ORDER BY line_no) AS nxt FROM lines
  WINDOW w AS (PARTITION BY run_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))
SELECT run_id, at_us, round(progress, 6) AS progress, last_loss AS loss, 'line' AS kind FROM known WHERE p IS NOT NULL
UNION ALL
SELECT run_id, at_us + {6 * HOUR} * k, round(progress, 6), last_loss, 'beat' FROM (
  SELECT *, unnest(range(1, (nxt - 1 - at_us) // {6 * HOUR} + 1)) AS k FROM known
  WHERE progress IS NOT NULL AND nxt - at_us > {6 * HOUR})
UNION ALL
SELECT run_id, max(at_us), CAST(100.0 AS DOUBLE), arg_max(last_loss, line_no) FILTER (last_loss IS NOT NULL), 'end'
FROM known GROUP BY run_id""")
def stream_heartbeat(spark, folder):
    """The heartbeats the recorded logs would have had at one per six idle hours, told by a stream of their chunks."""
    def tell(path):
        lines = sources.log_stream(spark, f"{path}/logs")
        parsed = lines.select("run_id", "line_no", "at_us", *[c.alias(n) for n, c in rx.solver_fields(F.col("line")).items()])
        status.stream_replay_heartbeats(parsed, path, 6 * HOUR).awaitTermination()

    path = _feed(spark, folder, "heartbeat", tell)
    return status.printed_heartbeats(spark, path).withColumn("progress", F.round("progress", 6))


# -- messages ----------------------------------------------------------------------------------

_MESSAGE = "page_id long, image_path string"
_CHAIN = (
    stages.Stage("classified", lambda m: m.withColumn("quality", (F.col("page_id") % 5).cast("int"))),
    stages.Stage("good", lambda m: m.filter("quality > 0")),
    stages.Stage("detected", lambda m: m.withColumn("n_signs", (F.col("page_id") % 3).cast("int")).filter("n_signs > 0")),
    stages.Stage("texts", lambda m: m.withColumn("text", F.concat(text.base_name(F.col("image_path")), F.lit("#"),
                                                                 F.col("n_signs").cast("string")))),
)
_CHAINED = """SELECT page_id, url AS image_path, CAST(page_id % 5 AS INTEGER) AS quality, CAST(page_id % 3 AS INTEGER) AS n_signs,
  regexp_extract(url, '([^/]*)$', 1) || '#' || page_id % 3 AS text FROM pages WHERE page_id % 5 > 0 AND page_id % 3 > 0"""


def messages(spark, folder):
    return inputs.load_table(spark, folder, "pages").select("page_id", F.col("url").alias("image_path"))


@add("a9_scan_message_queue", "SELECT page_id, url AS image_path FROM pages")
def scan_message_queue(spark, folder):
    path = scratch_path(spark, "queue")
    sources.publish(messages(spark, folder), f"{path}/in")
    copy = stages.Stage("out", lambda m: m)
    stages.start_stage(spark, copy, f"{path}/in", _MESSAGE, f"{path}/out").awaitTermination()
    return spark.read.schema(_MESSAGE).parquet(f"{path}/out")


@add("k3_stream_stage_chain", _CHAINED)
def stream_stage_chain(spark, folder):
    path = scratch_path(spark, "chain")
    sources.publish(messages(spark, folder), f"{path}/raw")
    return stages.run_chain(spark, _CHAIN, f"{path}/raw", _MESSAGE, path)


@add("k4_stream_drain", "SELECT count(*) AS sent, count(*) FILTER (page_id % 5 > 0) AS received FROM pages")
def stream_drain(spark, folder):
    """Messages arrive in two parts; the stage is drained after each, so none is left."""
    path = scratch_path(spark, "drain")
    for part in range(2):
        sources.publish(messages(spark, folder).filter(F.col("page_id") % 2 == part), f"{path}/raw")
        keep = stages.Stage("kept", lambda m: m.filter(F.col("page_id") % 5 > 0))
        stages.drain(stages.start_stage(spark, keep, f"{path}/raw", _MESSAGE, f"{path}/kept", processingTime="0 seconds"))
    sent = spark.read.schema(_MESSAGE).parquet(f"{path}/raw").agg(F.count(F.lit(1)).alias("sent")).withColumn("_k", F.lit(1))
    kept = spark.read.schema(_MESSAGE).parquet(f"{path}/kept").agg(F.count(F.lit(1)).alias("received")).withColumn("_k", F.lit(1))
    return sent.join(kept, "_k").select("sent", "received")


@add("k5_stream_count_stop", """
WITH parts AS (SELECT page_id % 4 AS batch, count(*) AS n FROM pages WHERE page_id % 4 < 3 GROUP BY 1),
expected AS (SELECT sum(n) AS e FROM parts)
SELECT batch, n, round(sum(n) OVER (ORDER BY batch) * 100.0::DOUBLE / e, 2) AS percent FROM parts, expected""")
def stream_count_stop(spark, folder):
    """Messages arrive in four parts; counting stops at the size of the first three."""
    path = scratch_path(spark, "count")
    sent = messages(spark, folder)
    counter = stages.CountStop(spark, sent.filter(F.col("page_id") % 4 < 3).count(), path)
    for part in range(4):
        sources.publish(sent.filter(F.col("page_id") % 4 == part), f"{path}/in")
        if counter.run(sources.message_stream(spark, f"{path}/in", _MESSAGE)):
            break
    return counter.progress()


@add("k6_window_sensor_stream", f"""
WITH {_SENSOR}, closed AS (SELECT max(ts) - {2 * HOUR} AS mark FROM sensor)
SELECT trip_id, ts // {24 * HOUR} * {24 * HOUR} AS start_us, count(*) AS n, round(avg(f1), 6) AS f1_mean
FROM sensor, closed GROUP BY trip_id, 2, mark HAVING ts // {24 * HOUR} * {24 * HOUR} + {24 * HOUR} <= mark""")
def window_sensor_stream(spark, folder):
    """Daily windows of the recorded rows; the last day is still open when the stream ends."""
    path = scratch_path(spark, "sensor-stream")
    schema = "trip_id long, ts timestamp, f1 double"
    sensor(spark, folder).select("trip_id", F.timestamp_micros("ts").alias("ts"), "f1").write.parquet(f"{path}/in")
    rows = sources.message_stream(spark, f"{path}/in", schema)
    out = stages.window_sensor_stream(rows, "24 hours", "2 hours", ["f1"])
    (out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    found = spark.read.schema("trip_id long, start timestamp, n long, f1_mean double").parquet(f"{path}/out")
    return found.select("trip_id", F.unix_micros("start").alias("start_us"), "n", F.round("f1_mean", 6).alias("f1_mean"))


# -- hooks ---------------------------------------------------------------------------------------


def _unaccented(batch):
    """Texts without accents: a rule of Unicode that no column function knows."""
    def plain(text):
        return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")

    return batch.assign(plain=batch["text"].map(plain, na_action="ignore")).drop(columns="text")


@add("m1_sample_transform", "SELECT conv_id, turn, strip_accents(text) AS plain FROM conversations")
def sample_transform(spark, folder):
    rows = inputs.load_table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return hooks.map_samples(rows, _unaccented, "conv_id long, turn long, plain string")


@add("m2_reader_hooks", f"""
WITH {inputs.SQL_LINES}, cut AS (SELECT doc_id, line_no, {inputs.sql_tokens('line')} AS t FROM lines)
SELECT doc_id, line_no, array_to_string(list_reverse(t), ' ') AS source, array_to_string(list_transform(t, lambda x: '<' || x || '>'), ' ') AS target FROM cut""")
def reader_hooks(spark, folder):
    pairs = hooks.read_samples(
        inputs.corpus_lines(spark, folder), text.tokens, lambda t: (F.reverse(t), F.transform(t, lambda x: F.concat(F.lit("<"), x, F.lit(">")))))
    return pairs.select("doc_id", "line_no", F.array_join("source", " ").alias("source"), F.array_join("target", " ").alias("target"))


def _sentence_pairs(line):
    """Each sentence of a line with the next one: none for a line of a single sentence."""
    sentences = [t for t in ([w for w in s.split(" ") if w] for s in line.split(".")) if t]
    yield from zip(sentences, sentences[1:])


@add("m2_many_samples", """
WITH cut AS (SELECT conv_id, turn, list_filter(list_transform(string_split(text, '.'),
  lambda s: list_filter(string_split(s, ' '), lambda w: w <> '')), lambda t: len(t) > 0) AS parts FROM conversations),
numbered AS (SELECT conv_id, turn, parts, unnest(range(1, len(parts))) AS i FROM cut)
SELECT conv_id, turn, array_to_string(parts[i], ' ') AS source, array_to_string(parts[i + 1], ' ') AS target FROM numbered""")
def many_samples(spark, folder):
    """Any number of pairs per message, made by a reader of its own."""
    rows = inputs.load_table(spark, folder, "conversations").select("conv_id", "turn", F.col("text").alias("line"))
    pairs = hooks.read_many_samples(rows, _sentence_pairs)
    return pairs.select("conv_id", "turn", F.array_join("source", " ").alias("source"), F.array_join("target", " ").alias("target"))


@add("m4_message_consumer", "SELECT page_id % 4 AS grp, count(*) AS n FROM pages GROUP BY 1")
def message_consumer(spark, folder):
    path = scratch_path(spark, "consumer")
    sources.publish(messages(spark, folder), f"{path}/in")

    def callback(batch, n):
        groups = batch.groupBy((F.col("page_id") % 4).alias("grp")).agg(F.count(F.lit(1)).alias("n"))
        groups.write.mode("overwrite").parquet(f"{path}/out/batch={n}")

    stages.consume(sources.message_stream(spark, f"{path}/in", _MESSAGE), callback, f"{path}/checkpoint").awaitTermination()
    return spark.read.schema("grp long, n long").parquet(f"{path}/out").groupBy("grp").agg(F.sum("n").alias("n"))
