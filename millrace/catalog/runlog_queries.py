"""Queries over run logs and checkpoints."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs
from millrace.catalog.registry import Registry
from millrace.functions import logs as rx
from millrace.operators import runlogs
from millrace.session import materialize


registry = Registry()
add = registry.add


def parsed_losses(spark, folder, **kw):
    return runlogs.parse_losses(inputs.run_logs(spark, folder), **kw)


def parsed_solver(spark, folder):
    return runlogs.parse_solver(inputs.run_logs(spark, folder))


@add("i1_rx_loss_iteration", f"""
WITH {inputs.SQL_PARSED} SELECT run_id, line_no, loss, iter, progress FROM parsed
WHERE loss IS NOT NULL OR progress IS NOT NULL""")
def rx_loss_iteration(spark, folder):
    return (parsed_losses(spark, folder).select("run_id", "line_no", "loss", "iter", "progress")
            .filter("loss IS NOT NULL OR progress IS NOT NULL"))


@add("i2_rx_solver_log", f"""
WITH {inputs.SQL_SOLVER} SELECT run_id, line_no, max_iter, iter, loss FROM solver
WHERE max_iter IS NOT NULL OR loss IS NOT NULL""")
def rx_solver_log(spark, folder):
    return (parsed_solver(spark, folder).select("run_id", "line_no", "max_iter", "iter", "loss")
            .filter("max_iter IS NOT NULL OR loss IS NOT NULL"))


@add("i3_rx_step_log", f"""
WITH {inputs.SQL_STEPS} SELECT run_id, line_no, minibatch_loss, epoch_loss, command FROM steps
WHERE minibatch_loss IS NOT NULL OR command IS NOT NULL""")
def rx_step_log(spark, folder):
    logs = inputs.run_logs(spark, folder)
    return (logs.select("run_id", "line_no", *[c.alias(n) for n, c in rx.step_fields(F.col("line")).items()])
            .filter("minibatch_loss IS NOT NULL OR command IS NOT NULL"))


@add("i4_parse_checkpoint_name", f"WITH {inputs.SQL_CHECKPOINTS} SELECT path, prefix, iter, suffix FROM states")
def parse_checkpoint_name(spark, folder):
    return runlogs.checkpoints(inputs.checkpoint_files(spark, folder)).select("path", "prefix", "iter", "suffix")


_STATUS = f"""
WITH {inputs.SQL_PARSED},
running AS (
  SELECT run_id, line_no, progress,
    last_value(loss IGNORE NULLS) OVER w AS ll, last_value(iter IGNORE NULLS) OVER w AS li,
    max(loss) OVER w AS max_loss, min(loss) OVER w AS min_loss, count(loss) OVER w AS n_epochs
  FROM parsed WINDOW w AS (PARTITION BY run_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
status AS (
  SELECT run_id, line_no, progress, coalesce(ll, 0.0) AS last_loss,
    CASE WHEN coalesce(li, 0) <> 0 THEN li + 1 ELSE 1 END AS tot_epochs, max_loss, min_loss, n_epochs
  FROM running WHERE progress IS NOT NULL)"""


@add("f4_running_loss_status", f"{_STATUS} SELECT * FROM status")
def running_loss_status(spark, folder):
    return runlogs.running_loss_status(parsed_losses(spark, folder, marked_only=True))


def _progress_sql(kind):
    limit = {
        "first": "first_value(nullif(max_iter, 0) IGNORE NULLS) OVER w",
        "last": "last_value(max_iter IGNORE NULLS) OVER w",
    }[kind]
    return f"""
WITH {inputs.SQL_SOLVER},
limited AS (
  SELECT run_id, line_no, iter, loss, CAST({limit} AS BIGINT) AS limit_iter
  FROM solver WINDOW w AS (PARTITION BY run_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))
SELECT run_id, line_no, iter, limit_iter, round(CAST(iter AS DOUBLE) / limit_iter * 100, 6) AS progress, loss
FROM limited WHERE loss IS NOT NULL AND limit_iter IS NOT NULL"""


def _rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


@add("f5_progress_first_max", _progress_sql("first"))
def progress_first_max(spark, folder):
    return _rounded(runlogs.progress_first_max(parsed_solver(spark, folder)), "progress")


@add("f6_progress_last_max", _progress_sql("last"))
def progress_last_max(spark, folder):
    return _rounded(runlogs.progress_last_max(parsed_solver(spark, folder)), "progress")


def default_logs(spark, folder):
    """The log lines, some maxima at the start of their line and some iterations followed by a comma."""
    line = (F.when(F.col("line_no") % 4 == 0, F.ltrim("line"))
            .when(F.col("line_no") % 3 == 0, F.replace("line", F.lit(" (2.5 iter/s), loss"), F.lit(", loss"))).otherwise(F.col("line")))
    # stored, so that the long expression behind a line stands once in the plan
    return materialize(inputs.run_logs(spark, folder)).withColumn("line", line)


@add("f7_progress_default_max", rf"""
WITH {inputs.SQL_LOGS},
raw AS (
  SELECT run_id, line_no, CASE WHEN line_no % 4 = 0 THEN ltrim(line)
    WHEN line_no % 3 = 0 THEN replace(line, ' (2.5 iter/s), loss', ', loss') ELSE line END AS line FROM logs),
fields AS (
  SELECT run_id, line_no, CASE WHEN regexp_matches(line, '^max_iter: [0-9]+$') THEN CAST(split_part(line, ' ', 2) AS BIGINT) END AS max_iter,
    CASE WHEN regexp_matches(line, 'Iteration [0-9]+.*loss = [0-9.]+') THEN CAST(regexp_extract(line, '(?:^|\s)Iteration\s+([0-9]+)', 1) AS BIGINT) END AS iter,
    TRY_CAST(regexp_extract(line, '(?:^|\s)loss\s+\S+\s+(\S+)', 1) AS DOUBLE) AS loss FROM raw),
limited AS (
  SELECT *, coalesce(last_value(max_iter IGNORE NULLS) OVER w, {rx.DEFAULT_MAX_ITER}) AS limit_iter
  FROM fields WINDOW w AS (PARTITION BY run_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))
SELECT run_id, line_no, iter, limit_iter, round(CAST(iter AS DOUBLE) / limit_iter * 100, 6) AS progress, loss
FROM limited WHERE iter IS NOT NULL AND limit_iter <> 0""")
def progress_default_max(spark, folder):
    return _rounded(runlogs.progress_default_max(default_logs(spark, folder)), "progress")


_SESSIONS = f"""
WITH {inputs.SQL_STEPS},
sessions AS (
  SELECT *, count(command) OVER w AS session, last_value(command IGNORE NULLS) OVER w AS session_command
  FROM steps WINDOW w AS (PARTITION BY run_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))"""


@add("f8_command_sessions", f"{_SESSIONS} SELECT run_id, line_no, session, session_command FROM sessions")
def command_sessions(spark, folder):
    return runlogs.command_sessions(inputs.run_logs(spark, folder)).select(
        "run_id", "line_no", "session", "session_command")


@add("e13_log_epoch_summary", f"""
{_SESSIONS}
SELECT run_id, session, max(session_command) AS session_command, count(minibatch_loss) AS n_minibatch,
  round(avg(minibatch_loss), 6) AS avg_minibatch, min(minibatch_loss) AS min_minibatch, max(minibatch_loss) AS max_minibatch,
  arg_max(minibatch_loss, line_no) FILTER (minibatch_loss IS NOT NULL) AS last_minibatch, count(epoch_loss) AS n_epoch,
  arg_max(epoch_loss, line_no) FILTER (epoch_loss IS NOT NULL) AS last_epoch
FROM sessions GROUP BY run_id, session""")
def log_epoch_summary(spark, folder):
    sessions = runlogs.command_sessions(inputs.run_logs(spark, folder))
    return _rounded(runlogs.log_epoch_summary(sessions), "avg_minibatch")


@add("e10_loss_extrema", f"""
WITH {inputs.SQL_PARSED} SELECT run_id, max(loss) AS max_loss, min(loss) AS min_loss FROM parsed GROUP BY run_id""")
def loss_extrema(spark, folder):
    return runlogs.loss_extrema(parsed_losses(spark, folder), "run_id")


@add("i12_status_json", f"""
{_STATUS},
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY line_no DESC) AS rn FROM status) WHERE rn = 1),
epochs AS (
  SELECT p.run_id, p.iter, p.loss, (row_number() OVER (PARTITION BY p.run_id ORDER BY p.line_no) - 1) // 5 AS part, p.line_no
  FROM parsed p JOIN newest n ON n.run_id = p.run_id AND p.line_no < n.line_no WHERE p.loss IS NOT NULL),
parts AS (
  SELECT run_id, part, count(*) AS n_fin, arg_max(iter, line_no) AS last_iter, arg_max(loss, line_no) AS last_fin FROM epochs GROUP BY ALL)
SELECT n.run_id, CAST(coalesce(part, 0) AS INTEGER) AS part,
  CAST(coalesce(max(part) OVER (PARTITION BY n.run_id), 0) + 1 AS INTEGER) AS parts, last_loss AS last_err, progress AS last_progress, tot_epochs,
  max_loss AS g_max_err, 'train' AS command_name, CAST(coalesce(n_fin, 0) AS INTEGER) AS n_fin, last_iter, last_fin
FROM newest n LEFT JOIN parts USING (run_id)""")
def status_json(spark, folder):
    """The newest document of every run, five epochs to a part, read back from its JSON text."""
    parsed = parsed_losses(spark, folder, marked_only=True)
    documents = runlogs.status_documents(
        runlogs.newest_status(runlogs.running_loss_status(parsed)), runlogs.finished_epochs(parsed),
        log="logrank.0.log", command="train", max_epochs=5)
    epochs = F.from_json(F.get_json_object("document", "$.commands[0].finEpochs"), "array<array<double>>")

    def field(path, kind):
        return F.get_json_object("document", path).cast(kind)

    return documents.withColumn("epochs", epochs).select(
        "run_id", "part", "parts", field("$.lastErr", "double").alias("last_err"), field("$.lastProgress", "double").alias("last_progress"),
        field("$.totEpochs", "long").alias("tot_epochs"), field("$.gMaxErr", "double").alias("g_max_err"),
        field("$.commands[0].name", "string").alias("command_name"), F.size("epochs").alias("n_fin"),
        F.try_element_at("epochs", F.lit(-1))[0].cast("long").alias("last_iter"),
        F.try_element_at("epochs", F.lit(-1))[1].alias("last_fin"))


@add("i13_percent_progress", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate_us, percent, text FROM (
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_us(l_shipdate) AS l_shipdate_us,
  round(CAST(l_partkey AS DOUBLE) / (l_orderkey + 1) * 100, 6) AS percent,
  printf('%05.2f', 100.0 * l_linenumber * 10 / 70.0) AS text FROM lineitem)""")
def percent_progress(spark, folder):
    lines = inputs.load_table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", inputs.micros(F.col("l_shipdate")).alias("l_shipdate_us"),
        F.round(rx.percent(F.col("l_partkey"), F.col("l_orderkey") + 1), 6).alias("percent"),
        rx.timed_percent(F.col("l_linenumber"), F.lit(10), F.lit(70.0)).alias("text"))


@add("g3_second_latest_checkpoint", f"""
WITH {inputs.SQL_CHECKPOINTS} SELECT model, path, iter FROM ranked_states WHERE rank = 2""")
def second_latest_checkpoint(spark, folder):
    states = runlogs.checkpoints(inputs.checkpoint_files(spark, folder))
    return runlogs.second_latest_checkpoint(states, ["model"]).select("model", "path", "iter")


@add("g4_latest_two", f"""
WITH {inputs.SQL_CHECKPOINTS} SELECT model, path, iter, rank FROM ranked_states WHERE rank <= 2""")
def latest_two(spark, folder):
    states = runlogs.checkpoints(inputs.checkpoint_files(spark, folder))
    return runlogs.latest_checkpoints(states, 2, ["model"]).select("model", "path", "iter", "rank")


@add("g5_fallback_newest", f"""
WITH {inputs.SQL_CHECKPOINTS},
models AS (SELECT c_custkey AS model FROM customer),
newest AS (SELECT model, arg_max(path, (mtime, path)) AS path FROM weights GROUP BY model),
chosen AS (SELECT model, path FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY iter DESC, path) AS rn FROM states WHERE status = 'P') WHERE rn = 2)
SELECT m.model, coalesce(c.path, n.path) AS path,
  CASE WHEN c.path IS NOT NULL THEN 'snapshot' WHEN n.path IS NOT NULL THEN 'weights' END AS kind
FROM models m LEFT JOIN chosen c ON c.model = m.model LEFT JOIN newest n ON n.model = m.model""")
def fallback_newest(spark, folder):
    models = inputs.load_table(spark, folder, "customer").select(F.col("c_custkey").alias("model"))
    states = runlogs.checkpoints(inputs.checkpoint_files(spark, folder).filter("status = 'P'"))
    chosen = runlogs.second_latest_checkpoint(states, ["model"])
    return runlogs.fallback_newest(models, chosen, inputs.weight_files(spark, folder), ["model"])


@add("m5_pluggable_log_parser", f"""
WITH {inputs.SQL_SOLVER}, losses AS (SELECT * FROM ({'WITH ' + inputs.SQL_PARSED} SELECT * FROM parsed))
SELECT s.run_id, s.line_no, CASE WHEN s.run_id % 2 = 0 THEN l.loss ELSE s.loss END AS loss
FROM solver s JOIN losses l ON l.line_no = s.line_no
WHERE CASE WHEN s.run_id % 2 = 0 THEN l.loss ELSE s.loss END IS NOT NULL""")
def pluggable_log_parser(spark, folder):
    """Even runs are parsed by the epoch parser, odd ones by the solver parser."""
    logs = inputs.run_logs(spark, folder)
    parser = F.when(F.col("run_id") % 2 == 0, "epoch").otherwise("solver")
    return (logs.select("run_id", "line_no", rx.parsed_by(parser, F.trim("line"), "loss").alias("loss"))
            .filter("loss IS NOT NULL"))
