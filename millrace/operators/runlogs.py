"""Run logs ``(run_id, line_no, line)``: status, progress, sessions, checkpoints.

``line_no`` orders the lines of a run and is unique in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.logs import (
    DEFAULT_MAX_ITER,
    EPOCH_STEP,
    LOSS_MARK,
    PROGRESS_MARK,
    checkpoint_fields,
    default_fields,
    loss_iteration,
    percent,
    solver_fields,
    status_json,
    step_fields,
)
from millrace.plans import Run, Splits, find_splits, lookup_join, numbered, running, top_n
from millrace.session import materialize

RUN, LINE_NO = "run_id", "line_no"


def parse_losses(logs: DataFrame, line: str = "line", *, marked_only: bool = False) -> DataFrame:
    """Add ``loss``, ``iter`` and ``progress``; ``marked_only`` first drops lines that can have neither."""
    if marked_only:
        text = F.col(line)
        logs = logs.filter(F.contains(text, F.lit(LOSS_MARK)) | F.contains(text, F.lit(PROGRESS_MARK)))
    return logs.withColumns(loss_iteration(F.col(line)))


def parse_solver(logs: DataFrame, line: str = "line") -> DataFrame:
    """Add ``max_iter``, ``iter`` and ``loss`` of solver lines."""
    return logs.withColumns(solver_fields(F.col(line)))


def running_loss_status(
    parsed: DataFrame,
    keys: Sequence[str] = (RUN,),
    order: Sequence[str] = (LINE_NO,),
    splits: Splits | None = None,
) -> DataFrame:
    """One row per progress line: last loss and iteration, highest and lowest loss, epochs so far.

    Missing values follow the status document: loss 0.0, epoch count 1. Lines
    without either value may be left out beforehand (:func:`parse_losses`).
    """
    columns = {
        "last_loss": Run("last", F.col("loss")),
        "last_iter": Run("last", F.col("iter")),
        "max_loss": Run("max", F.col("loss")),
        "min_loss": Run("min", F.col("loss")),
        "n_epochs": Run("count", F.col("loss")),
    }
    return (
        running(parsed.select(*keys, *order, "progress", "loss", "iter"), keys, order, columns, splits=splits)
        .filter(F.col("progress").isNotNull())
        .select(
            *keys,
            *order,
            "progress",
            F.coalesce("last_loss", F.lit(0.0)).alias("last_loss"),
            F.when(F.coalesce("last_iter", F.lit(0)) != 0, F.col("last_iter") + 1)
            .otherwise(1)
            .cast("long")
            .alias("tot_epochs"),
            "max_loss",
            "min_loss",
            "n_epochs",
        )
    )


def _progress(parsed: DataFrame, keys: Sequence[str], order: Sequence[str], kind: str, default: int | None) -> DataFrame:
    splits = find_splits(parsed, keys, order)
    shown = F.col("iter").isNotNull() & (F.lit(default is not None) | F.col("loss").isNotNull())
    relevant = parsed.filter(F.col("max_iter").isNotNull() | shown)
    # a maximum of 0 counts as not yet seen
    seen = F.when(F.col("max_iter") != 0, F.col("max_iter")) if kind == "first" else F.col("max_iter")
    limited = running(relevant, keys, order, {"_limit": Run(kind, seen)}, splits=splits)
    limit = F.col("_limit") if default is None else F.coalesce("_limit", F.lit(default))
    return (
        limited.withColumn("limit_iter", limit)
        .filter(shown & (F.coalesce("limit_iter", F.lit(0)) != 0))
        .select(*keys, *order, "iter", "limit_iter", percent(F.col("iter"), F.col("limit_iter")).alias("progress"), "loss")
    )


def progress_first_max(parsed: DataFrame, keys: Sequence[str] = (RUN,), order: Sequence[str] = (LINE_NO,)) -> DataFrame:
    """Progress of iteration lines against the first ``max_iter``; lines before it are skipped."""
    return _progress(parsed, keys, order, "first", None)


def progress_last_max(parsed: DataFrame, keys: Sequence[str] = (RUN,), order: Sequence[str] = (LINE_NO,)) -> DataFrame:
    """Progress against the latest ``max_iter`` so far."""
    return _progress(parsed, keys, order, "last", None)


def progress_default_max(
    logs: DataFrame, keys: Sequence[str] = (RUN,), order: Sequence[str] = (LINE_NO,), default: int = DEFAULT_MAX_ITER
) -> DataFrame:
    """Progress of raw log lines against the latest ``max_iter``, or ``default`` until one is seen.

    This logger has line rules of its own (``functions.logs.default_fields``). A line with an
    unreadable loss counts, its loss is null.
    """
    parsed = logs.select(*keys, *order, *[c.alias(n) for n, c in default_fields(F.col("line")).items()])
    return _progress(parsed, keys, order, "last", default)


def command_sessions(
    logs: DataFrame, keys: Sequence[str] = (RUN,), order: Sequence[str] = (LINE_NO,), epoch_step: int = EPOCH_STEP
) -> DataFrame:
    """Add the step fields, ``session`` (0 before the first command) and its ``session_command``."""
    parsed = logs.withColumns(step_fields(F.col("line"), epoch_step))
    return running(
        parsed,
        keys,
        order,
        {"session": Run("count", F.col("command")), "session_command": Run("last", F.col("command"))},
    )


def log_epoch_summary(sessions: DataFrame, keys: Sequence[str] = (RUN,), order: Sequence[str] = (LINE_NO,)) -> DataFrame:
    """Per command session: counts and statistics of minibatch and epoch losses."""
    position = F.struct(*[F.col(c) for c in order])

    def latest(name: str) -> Column:
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), position))

    return sessions.groupBy(*keys, "session").agg(
        F.max("session_command").alias("session_command"),
        F.count("minibatch_loss").alias("n_minibatch"),
        F.avg("minibatch_loss").alias("avg_minibatch"),
        F.min("minibatch_loss").alias("min_minibatch"),
        F.max("minibatch_loss").alias("max_minibatch"),
        latest("minibatch_loss").alias("last_minibatch"),
        F.count("epoch_loss").alias("n_epoch"),
        latest("epoch_loss").alias("last_epoch"),
    )


def loss_extrema(parsed: DataFrame, *keys: str) -> DataFrame:
    """Highest and lowest loss, per key or over all lines."""
    return parsed.groupBy(*keys).agg(F.max("loss").alias("max_loss"), F.min("loss").alias("min_loss"))


def finished_epochs(parsed: DataFrame, keys: Sequence[str] = (RUN,), order: Sequence[str] = (LINE_NO,)) -> DataFrame:
    """The epochs of a run as rows; a run may have more of them than one array should hold."""
    return parsed.filter(F.col("loss").isNotNull()).select(*keys, *order, "iter", "loss")


def newest_status(status: DataFrame, keys: Sequence[str] = (RUN,), order: Sequence[str] = (LINE_NO,)) -> DataFrame:
    """The status at the last progress line of each run."""
    fall = status.withColumn("_fall", -F.col(order[0]))
    return top_n(fall, keys, ["_fall"], 1).drop("_fall")


def status_documents(
    newest: DataFrame, epochs: DataFrame, *, log: str, command: str, max_epochs: int = 10_000,
    run: str = RUN, line_no: str = LINE_NO,
) -> DataFrame:
    """``(run_id, part, parts, document)``: the JSON status of each run with its epochs before that status.

    No text grows without bound: a run of up to ``max_epochs`` epochs is one document, ``part`` 0
    of ``parts`` 1; a longer one has ``parts`` documents that repeat the status, each with the next epochs.
    """
    newest = materialize(newest)
    marks = newest.select(run, F.col(line_no).alias("_mark"))
    before = lookup_join(epochs, marks, [run]).filter(F.col(line_no) <= F.col("_mark"))
    part = F.floor((F.col("_n") - 1) / max_epochs).cast("int").alias("part")
    lists = materialize(numbered(before, [run], [line_no], "_n").groupBy(run, part).agg(
        F.array_sort(F.collect_list(F.struct("_n", "iter", "loss"))).alias("_epochs")))
    none = F.array().cast(lists.schema["_epochs"].dataType)
    bare = lookup_join(newest, materialize(lists.select(run).distinct()), [run], "left_anti")
    sizes = materialize(lists.groupBy(run).agg((F.max("part") + 1).cast("int").alias("parts")))
    joined = lookup_join(lookup_join(lists, newest, [run]), sizes, [run]).unionByName(
        bare.select("*", F.lit(0).alias("part"), F.lit(1).alias("parts"), none.alias("_epochs")))
    pairs = F.transform("_epochs", lambda e: F.array(e["iter"].cast("double"), e["loss"]))
    document = status_json(
        F.col("last_loss"), F.col("tot_epochs") - 1, F.col("progress"), F.col("min_loss"), F.col("max_loss"),
        F.lit(log), F.lit(command), pairs)
    return joined.select(run, "part", "parts", document.alias("document"))


# -- checkpoints --------------------------------------------------------------------


def checkpoints(files: DataFrame, path: str = "path") -> DataFrame:
    """Files that are checkpoints, with ``prefix``, ``iter`` and ``suffix``."""
    return files.withColumns(checkpoint_fields(F.col(path))).filter(F.col("iter").isNotNull())


def latest_checkpoints(parsed: DataFrame, n: int = 2, keys: Sequence[str] = ("prefix",)) -> DataFrame:
    """The ``n`` highest iterations per key, ``rank`` 1 the highest; ties in path order."""
    ordered = parsed.withColumn("_fall", -F.col("iter"))
    return top_n(ordered, keys, ["_fall", "path"], n, rank="rank").drop("_fall")


def second_latest_checkpoint(parsed: DataFrame, keys: Sequence[str] = ("prefix",)) -> DataFrame:
    """The second highest iteration; keys with a single checkpoint have none."""
    return latest_checkpoints(parsed, 2, keys).filter(F.col("rank") == 2).drop("rank")


def fallback_newest(
    groups: DataFrame, chosen: DataFrame, weights: DataFrame, keys: Sequence[str] = ("prefix",)
) -> DataFrame:
    """Start point per group: the chosen checkpoint, else the newest weight file, else none."""
    newest = weights.groupBy(*keys).agg(F.max_by("path", F.struct("mtime", "path")).alias("_newest"))
    states = materialize(chosen.select(*keys, F.col("path").alias("_state")))
    found = lookup_join(groups, states, keys, "left")
    return lookup_join(found, materialize(newest), keys, "left").select(
        *keys,
        F.coalesce("_state", "_newest").alias("path"),
        F.when(F.col("_state").isNotNull(), "snapshot").when(F.col("_newest").isNotNull(), "weights").alias("kind"),
    )
