"""Continuous run status: one status row per run, renewed by every micro-batch.

A batch is first reduced to one summary per run, with partial aggregation. The
summary of a run whose lines follow all earlier ones is merged into the status
before it. A run that received lines out of order (a rotated file, several files
in one batch) is summed up again from its kept loss and progress lines, so that
any order of chunks gives the status of the whole log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.runlogs import finished_epochs, parse_losses
from millrace.plans import Run, find_splits, lookup_join, running
from millrace.session import folder_exists, list_folders, materialize, remove_folder, scratch_scope

SUMMARY = (
    "run_id long, first_line long, last_line long, last_at long, progress double, at_loss double, at_iter long, at_max double, "
    "at_min double, at_epochs long, loss double, iter long, max_loss double, min_loss double, n_epochs long"
)
MARKS = "run_id long, line_no long, at_us long, loss double, iter long, progress double"
# a version with the status of all runs is written once in so many batches
FULL_EVERY = 32


def summarize(parsed: DataFrame) -> DataFrame:
    """One row per run: the values at its last progress line (``at_...``) and at its last line."""
    line, loss, step = F.col("line_no"), F.col("loss"), F.col("iter")
    marks = parsed.filter(F.col("progress").isNotNull()).groupBy("run_id").agg(
        F.max("line_no").alias("_mark"), F.max_by("progress", "line_no").alias("_progress"))
    rows = lookup_join(parsed, materialize(marks), ["run_id"], "left")
    before = line <= F.col("_mark")
    has = loss.isNotNull()
    return rows.groupBy("run_id").agg(
        F.min(line).alias("first_line"),
        F.max(line).alias("last_line"),
        F.max("at_us").alias("last_at"),
        F.max("_progress").alias("progress"),
        F.max_by(loss, F.when(before & has, line)).alias("at_loss"),
        F.max_by(step, F.when(before & has, line)).alias("at_iter"),
        F.max(F.when(before, loss)).alias("at_max"),
        F.min(F.when(before, loss)).alias("at_min"),
        F.count_if(before & has).alias("at_epochs"),
        F.max_by(loss, F.when(has, line)).alias("loss"),
        F.max_by(step, F.when(has, line)).alias("iter"),
        F.max(loss).alias("max_loss"),
        F.min(loss).alias("min_loss"),
        F.count(loss).alias("n_epochs"),
    )


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Status after ``new``, which follows ``old`` line for line."""
    names = [c for c in new.columns if c != "run_id"]
    a = old.select("run_id", *[F.col(c).alias(f"a_{c}") for c in names])
    b = new.select("run_id", *[F.col(c).alias(f"b_{c}") for c in names])
    fresh = F.col("b_progress").isNotNull()

    def later(name: str) -> Column:
        return F.coalesce(f"b_{name}", f"a_{name}")

    def marked(name: str, value: Column) -> Column:
        return F.when(fresh, value).otherwise(F.col(f"a_{name}")).alias(name)

    zero = F.lit(0).cast("long")
    return a.join(b, "run_id", "full_outer").select(
        "run_id",
        F.least("a_first_line", "b_first_line").alias("first_line"),
        F.greatest("a_last_line", "b_last_line").alias("last_line"),
        F.greatest("a_last_at", "b_last_at").alias("last_at"),
        later("progress").alias("progress"),
        marked("at_loss", F.coalesce("b_at_loss", "a_loss")),
        marked("at_iter", F.coalesce("b_at_iter", "a_iter")),
        marked("at_max", F.greatest("b_at_max", "a_max_loss")),
        marked("at_min", F.least("b_at_min", "a_min_loss")),
        marked("at_epochs", F.coalesce("b_at_epochs", zero) + F.coalesce("a_n_epochs", zero)),
        later("loss").alias("loss"),
        later("iter").alias("iter"),
        F.greatest("a_max_loss", "b_max_loss").alias("max_loss"),
        F.least("a_min_loss", "b_min_loss").alias("min_loss"),
        (F.coalesce("a_n_epochs", zero) + F.coalesce("b_n_epochs", zero)).alias("n_epochs"),
    )


def current_status(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """The newest row of every run, of batches before ``before``; None where nothing was written yet."""
    if not folder_exists(spark, folder):
        return None
    versions = spark.read.schema(f"{SUMMARY}, batch long").parquet(folder)
    if before is not None:
        versions = versions.filter(F.col("batch") < before)
    names = [c for c in versions.columns if c not in ("run_id", "batch")]
    newest = versions.groupBy("run_id").agg(F.max_by(F.struct(*names), "batch").alias("_s"))
    return newest.select("run_id", *[F.col(f"_s.{n}").alias(n) for n in names])


def write_status_snapshot(new: DataFrame, folder: str, batch_id: int, marks: str | None = None) -> None:
    """Write the status of the runs of a batch as version ``batch_id``; repeating a batch rewrites its version.

    ``new`` is the summary of the batch. ``marks`` is the folder of the loss and progress lines of all
    batches, this one included, by ``batch``; runs with lines out of order are summed up from it, and
    without it they are an error. Every FULL_EVERY batches a version holds all runs, and those
    older than the full version before it are removed.
    """
    spark = new.sparkSession
    full = batch_id % FULL_EVERY == FULL_EVERY - 1
    old = current_status(spark, folder, batch_id)
    status = new
    if old is not None:
        known = materialize(old)
        new = materialize(new)
        lasts = known.select("run_id", F.col("last_line").alias("_last"), F.col("last_at").alias("_at"), F.col("first_line").alias("_first"))
        late = materialize(lookup_join(new, lasts, ["run_id"]).filter(F.col("first_line") <= F.col("_last")).select(
            "run_id", F.least("first_line", "_first").alias("_first"), F.greatest("last_line", "_last").alias("_last"),
            F.greatest("last_at", "_at").alias("_at")))
        touched = known if full else lookup_join(known, new.select("run_id"), ["run_id"], "left_semi")
        if late.isEmpty():
            status = merge(touched, new)
        else:
            if marks is None:
                raise ValueError("lines out of order need the kept loss and progress lines")
            ids = late.select("run_id")
            kept = spark.read.schema(f"{MARKS}, batch long").parquet(marks).filter(F.col("batch") <= batch_id).drop("batch")
            again = summarize(materialize(lookup_join(kept, ids, ["run_id"], "left_semi").dropDuplicates(["run_id", "line_no"])))
            names = [c for c in again.columns if c not in ("run_id", "first_line", "last_line", "last_at")]
            redone = lookup_join(late, again.select("run_id", *names), ["run_id"], "left").select(
                "run_id", F.col("_first").alias("first_line"), F.col("_last").alias("last_line"), F.col("_at").alias("last_at"),
                *[F.coalesce(n, F.lit(0)).cast("long").alias(n) if n.endswith("epochs") else n for n in names])
            status = merge(lookup_join(touched, ids, ["run_id"], "left_anti"),
                           lookup_join(new, ids, ["run_id"], "left_anti")).unionByName(redone)
    status.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
    if full:
        for name in list_folders(spark, folder):
            if name.startswith("batch=") and int(name[6:]) < batch_id - FULL_EVERY:
                remove_folder(spark, f"{folder}/{name}")


def write_tee(lines: DataFrame, folder: str, batch_id: int) -> None:
    """Keep the raw lines of a batch; repeating a batch rewrites them."""
    lines.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def latest_status(spark: SparkSession, folder: str) -> DataFrame:
    """Status per run as of its last progress line; runs without progress are not published."""
    status = current_status(spark, folder)
    if status is None:
        raise FileNotFoundError(f"no status was written to {folder}")
    return status.filter(F.col("progress").isNotNull()).select(
        "run_id", "progress", F.coalesce("at_loss", F.lit(0.0)).alias("last_loss"),
        F.when(F.coalesce("at_iter", F.lit(0)) != 0, F.col("at_iter") + 1).otherwise(1).cast("long").alias("tot_epochs"),
        F.col("at_max").alias("max_loss"), F.col("at_min").alias("min_loss"), F.col("at_epochs").alias("n_epochs"), "last_at")


def stream_log_status(lines: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Keep ``folder/status``, ``folder/epochs``, ``folder/marks`` and ``folder/tee`` up to date with a stream of log lines.

    The tee is the stored form of a batch that all other results are computed from.
    """

    def renew(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_tee(batch, f"{folder}/tee", batch_id)
        with scratch_scope(spark):
            kept = spark.read.schema(batch.schema).parquet(f"{folder}/tee/batch={batch_id}").dropDuplicates(["run_id", "line_no"])
            # the last line of each run has to be known, also if it says nothing
            parsed = materialize(parse_losses(kept).select("run_id", "line_no", "at_us", "loss", "iter", "progress"))
            parsed.filter("loss is not null or progress is not null").write.mode("overwrite").parquet(
                f"{folder}/marks/batch={batch_id}")
            finished_epochs(parsed).write.mode("overwrite").parquet(f"{folder}/epochs/batch={batch_id}")
            write_status_snapshot(summarize(parsed), f"{folder}/status", batch_id, f"{folder}/marks")

    return (
        lines.writeStream.foreachBatch(renew)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# -- heartbeats ----------------------------------------------------------------------------


def heartbeats(status: DataFrame, now_us: Column, idle_us: int) -> DataFrame:
    """Runs without a line for ``idle_us``: their last progress and loss once more."""
    return status.filter(now_us - F.col("last_at") >= idle_us).select(
        "run_id", now_us.alias("at_us"), "progress", F.col("last_loss").alias("loss"))


def heartbeat_stream(
    spark: SparkSession, folder: str, idle_us: int = 60_000_000, every: str = "60 seconds", ended: str | None = None
) -> StreamingQuery:
    """Every ``every``, append the heartbeats of idle runs to ``folder/heartbeats``.

    The clock is a rate stream; what is sent comes from the status table, one row per run. Nothing
    is sent while there is no status yet. ``ended`` is a Parquet folder of ``run_id`` of finished
    runs, which may come to be later: such a run gets one last row of 100 percent, and no more.
    """

    def beat(_clock: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            if not folder_exists(spark, f"{folder}/status"):
                return
            now = F.unix_micros(F.current_timestamp())
            status = latest_status(spark, f"{folder}/status")
            found = heartbeats(status, now, idle_us).withColumn("kind", F.lit("beat"))
            if ended is not None and folder_exists(spark, ended):
                done = materialize(spark.read.schema("run_id long").parquet(ended).distinct())
                found = lookup_join(found, done, ["run_id"], "left_anti")
                told = done.limit(0)
                if folder_exists(spark, f"{folder}/heartbeats"):
                    sent = spark.read.schema(f"{BEATS}, batch long").parquet(f"{folder}/heartbeats")
                    told = materialize(sent.filter((F.col("kind") == "end") & (F.col("batch") < batch_id)).select("run_id").distinct())
                ends = lookup_join(lookup_join(status, done, ["run_id"], "left_semi"), told, ["run_id"], "left_anti")
                found = found.unionByName(ends.select(
                    "run_id", now.alias("at_us"), F.lit(100.0).alias("progress"), F.col("last_loss").alias("loss"), F.lit("end").alias("kind")))
            found.write.mode("overwrite").parquet(f"{folder}/heartbeats/batch={batch_id}")

    return (
        spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        .writeStream.foreachBatch(beat)
        .option("checkpointLocation", f"{folder}/heartbeat-checkpoint")
        .trigger(processingTime=every)
        .start()
    )


BEATS = "run_id long, at_us long, progress double, loss double, kind string"
CARRY = "run_id long, line_no long, at_us long, max_iter long, progress double, loss double"
BEATS_PER_ROW = 10_000


def _printed(solver: DataFrame, carried: DataFrame, idle_us: int) -> tuple[DataFrame, DataFrame]:
    """What a tail prints for the lines after ``carried``, and what it carries on from there."""
    keys, order = ["run_id"], ["line_no"]
    lines = solver.select("run_id", "line_no", "at_us", "max_iter", "iter", "loss", F.lit(False).alias("_old"),
                          F.lit(None).cast("double").alias("_was"), F.lit(None).cast("double").alias("_lost"))
    before = carried.select("run_id", "line_no", "at_us", "max_iter", F.lit(None).cast("long").alias("iter"),
                            F.lit(None).cast("double").alias("loss"), F.lit(True).alias("_old"),
                            F.col("progress").alias("_was"), F.col("loss").alias("_lost"))
    both = materialize(before.unionByName(lines))
    splits = find_splits(both, keys, order)
    limited = running(both, keys, order, {"_limit": Run("last", F.col("max_iter"))}, splits=splits)
    counted = F.col("iter").isNotNull() & F.col("loss").isNotNull() & (F.coalesce("_limit", F.lit(0)) != 0)
    marked = limited.withColumns({
        "_progress": F.when(counted, F.col("iter").cast("double") / F.col("_limit") * 100),
        "_loss": F.when(counted, F.col("loss")),
    })
    known = materialize(running(marked, keys, order, {
        "progress": Run("last", F.coalesce("_progress", "_was")),
        "last_loss": Run("last", F.coalesce("_loss", "_lost")),
        "_next": Run("next", F.col("at_us"), strict=True),
    }, splits=splits))
    printed = known.filter(F.col("_progress").isNotNull()).select(
        "run_id", "at_us", "progress", F.col("last_loss").alias("loss"), F.lit("line").alias("kind"))
    # a long pause is cut into rows of a bounded number of beats before these are written out
    step = F.lit(idle_us * BEATS_PER_ROW)
    pauses = known.filter(F.col("progress").isNotNull() & (F.col("_next") - F.col("at_us") > idle_us)).withColumn(
        "_from", F.explode(F.sequence(F.col("at_us") + idle_us, F.col("_next") - 1, step)))
    until = F.least(F.col("_next") - 1, F.col("_from") + step - 1)
    beats = pauses.select("run_id", F.explode(F.sequence(F.col("_from"), until, F.lit(idle_us))).alias("at_us"),
                          "progress", F.col("last_loss").alias("loss"), F.lit("beat").alias("kind"))
    last = F.max_by(F.struct("line_no", "at_us", F.col("_limit").alias("max_iter"), "progress", F.col("last_loss").alias("loss")), "line_no")
    carry = known.groupBy("run_id").agg(last.alias("s")).select("run_id", "s.*")
    return printed.unionByName(beats), carry


def _ends(carry: DataFrame) -> DataFrame:
    return carry.select("run_id", "at_us", F.lit(100.0).alias("progress"), "loss", F.lit("end").alias("kind"))


def replay_heartbeats(solver: DataFrame, idle_us: int) -> DataFrame:
    """What a tail of recorded solver logs prints: progress lines, heartbeats in every pause, 100 at the end.

    ``kind`` is ``line``, ``beat`` (each ``idle_us`` of a pause) or ``end``.
    """
    printed, carry = _printed(solver, solver.sparkSession.createDataFrame([], CARRY), idle_us)
    return printed.unionByName(_ends(carry))


def stream_replay_heartbeats(solver: DataFrame, folder: str, idle_us: int, **trigger) -> StreamingQuery:
    """The same from a stream of solver lines in the logs' own time: ``folder/printed``, one version per micro-batch.

    Between batches each run carries one row. Lines of a run come in order of their numbers.
    """

    def tell(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_scope(spark):
            carried = spark.createDataFrame([], CARRY)
            if batch_id and folder_exists(spark, f"{folder}/carried/batch={batch_id - 1}"):
                carried = spark.read.schema(CARRY).parquet(f"{folder}/carried/batch={batch_id - 1}")
            printed, carry = _printed(batch, carried, idle_us)
            printed.write.mode("overwrite").parquet(f"{folder}/printed/batch={batch_id}")
            carry.write.mode("overwrite").parquet(f"{folder}/carried/batch={batch_id}")
        if batch_id > 1:  # the version before the last is needed no more
            remove_folder(spark, f"{folder}/carried/batch={batch_id - 2}")

    return (
        solver.writeStream.foreachBatch(tell)
        .option("checkpointLocation", f"{folder}/printed-checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def printed_heartbeats(spark: SparkSession, folder: str) -> DataFrame:
    """All that was printed, with the end marks of the runs as they stand."""
    carried = f"{folder}/carried/batch={max(int(n[6:]) for n in list_folders(spark, f'{folder}/carried'))}"
    printed = spark.read.schema(BEATS).parquet(f"{folder}/printed").select("run_id", "at_us", "progress", "loss", "kind")
    return printed.unionByName(_ends(spark.read.schema(CARRY).parquet(carried)))
