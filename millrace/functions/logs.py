"""Patterns and column functions for training logs and checkpoint names."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The log formats that are recognised. Patterns apply from the start of a line.
LOSS_ITERATION = r"^.*Training Loss ([0-9.]+), at iteration ([0-9]+)"
PROGRESS = r"^.*PROGRESS: ([0-9.]+)%"
LOSS_MARK, PROGRESS_MARK = "Training Loss ", "PROGRESS: "
MAX_ITER = r"^\s*max_iter:\s(\d+)\s*$"
ITERATION_LOSS = r"^.*\sIteration\s+(\d+)\s.*loss\s=\s([-+]?\d*.?\d+(?:e[-+]\d+)?)(?:\s.*)?$"
STEP_LOSS = r"^.*step\s\d+,\sloss\s=\s(.*?)\s.*$"
COMMAND = r"^.*Execute\sCommand:\s(.*?)$"
CHECKPOINT = r"^(?:.*/)?(.*_)([0-9]+)\.solverstate(.*)$"
DEFAULT_MAX_ITER = 100_000_000
# the rules of the logger that starts from a default maximum: raw lines, fields at white space
DEFAULT_MAX = r"^max_iter: ([0-9]+)$"
DEFAULT_LINE = r"Iteration [0-9]+.*loss = [0-9.]+"
DEFAULT_ITER = r"^(?:.*\s)?Iteration\s+([0-9]+)"
DEFAULT_LOSS = r"^(?:.*\s)?loss\s+\S+\s+(\S+)"
EPOCH_STEP = 490


def epoch_pattern(step: int = EPOCH_STEP) -> str:
    return rf"^.*step\s{step},\sloss\s=\s(.*?)\s.*$"


def extracted(line: Column, pattern: str, group: int = 1, marker: str = "") -> Column:
    """A group of the pattern; null where the line does not match.

    ``marker`` is a text every match contains: other lines are told apart by it
    before the pattern is tried.
    """
    hit = F.rlike(line, F.lit(pattern))
    return F.when(F.contains(line, F.lit(marker)) & hit, F.regexp_extract(line, pattern, group))


def _parsed(line: Column, pattern: str, group: int, marker: str, kind: str) -> Column:
    # a line without a match gives an empty text, which is no number either
    return F.when(F.contains(line, F.lit(marker)), F.regexp_extract(line, pattern, group).try_cast(kind))


def number(line: Column, pattern: str, group: int = 1, marker: str = "") -> Column:
    """A numeric group; null where the line does not match or the number is malformed."""
    return _parsed(line, pattern, group, marker, "double")


def whole(line: Column, pattern: str, group: int = 1, marker: str = "") -> Column:
    return _parsed(line, pattern, group, marker, "long")


def loss_iteration(line: Column) -> dict[str, Column]:
    """``loss`` and ``iter`` of a loss line; ``progress`` of any other line that has one.

    A loss line with a malformed number gives neither, and no progress.
    """
    is_loss = F.contains(line, F.lit(LOSS_MARK)) & F.rlike(line, F.lit(LOSS_ITERATION))
    loss, step = number(line, LOSS_ITERATION, 1, LOSS_MARK), whole(line, LOSS_ITERATION, 2, LOSS_MARK)
    return {
        "loss": F.when(step.isNotNull(), loss),
        "iter": F.when(loss.isNotNull(), step),
        "progress": F.when(F.contains(line, F.lit(PROGRESS_MARK)) & ~is_loss, number(line, PROGRESS, 1)),
    }


def solver_fields(line: Column) -> dict[str, Column]:
    """``max_iter``, ``iter`` and ``loss`` of solver output (lines are stripped first)."""
    text = F.trim(line)
    return {
        "max_iter": whole(text, MAX_ITER, 1, "max_iter:"),
        "iter": whole(text, ITERATION_LOSS, 1, "Iteration"),
        "loss": number(text, ITERATION_LOSS, 2, "Iteration"),
    }


def default_fields(line: Column) -> dict[str, Column]:
    """``max_iter``, ``iter`` and ``loss`` by the rules of the logger with a default maximum.

    ``max_iter:`` stands at the very start of the untrimmed line. The iteration is the number that
    begins the field after ``Iteration``, the loss the second field after ``loss``.
    """
    hit = F.contains(line, F.lit("Iteration ")) & F.rlike(line, F.lit(DEFAULT_LINE))
    return {
        "max_iter": whole(line, DEFAULT_MAX, 1, "max_iter: "),
        "iter": F.when(hit, whole(line, DEFAULT_ITER)),
        "loss": F.when(hit, number(line, DEFAULT_LOSS)),
    }


def step_fields(line: Column, epoch_step: int = EPOCH_STEP) -> dict[str, Column]:
    """``minibatch_loss``, ``epoch_loss`` (only at ``epoch_step``) and ``command``."""
    return {
        "minibatch_loss": number(line, STEP_LOSS, 1, "step"),
        "epoch_loss": number(line, epoch_pattern(epoch_step), 1, f"{epoch_step},"),
        "command": extracted(line, COMMAND, 1, "Execute"),
    }


def checkpoint_fields(path: Column) -> dict[str, Column]:
    """``prefix``, ``iter`` and ``suffix`` of ``<prefix>_<iter>.solverstate<suffix>``."""
    return {
        "prefix": extracted(path, CHECKPOINT, 1, ".solverstate"),
        "iter": whole(path, CHECKPOINT, 2, ".solverstate"),
        "suffix": extracted(path, CHECKPOINT, 3, ".solverstate"),
    }


def percent(iteration: Column, maximum: Column) -> Column:
    return iteration.cast("double") / maximum * 100


def timed_percent(position: Column, step: Column, whole_time: Column) -> Column:
    """``100 * i * step / total`` with two decimals, as text."""
    return F.format_string("%05.2f", F.lit(100.0) * position * step / whole_time)


@dataclass(frozen=True)
class LogParser:
    """A named set of numeric patterns; a run is parsed by the parser it names."""

    name: str
    patterns: dict[str, tuple[str, int]] = field(default_factory=dict)


PARSERS = (
    LogParser("epoch", {"loss": (LOSS_ITERATION, 1), "iter": (LOSS_ITERATION, 2)}),
    LogParser("solver", {"loss": (ITERATION_LOSS, 2), "iter": (ITERATION_LOSS, 1)}),
)


def parsed_by(parser: Column, line: Column, field_name: str, parsers: tuple[LogParser, ...] = PARSERS) -> Column:
    """``field_name`` by the parser each row names; null for unknown parsers."""
    out = F.lit(None).cast("double")
    for known in parsers:
        if field_name in known.patterns:
            pattern, group = known.patterns[field_name]
            out = F.when(parser == known.name, number(line, pattern, group)).otherwise(out)
    return out


def status_json(loss: Column, step: Column, progress: Column, low: Column, high: Column, log: Column, command: Column,
                epochs: Column) -> Column:
    """Status document of one progress line: a missing loss is 0.0, a missing iteration counts as epoch 1."""
    last = F.coalesce(loss, F.lit(0.0))
    epoch = F.when(F.coalesce(step, F.lit(0)) != 0, step + 1).otherwise(F.lit(1).cast("long"))
    run = F.struct(
        command.alias("name"),
        progress.alias("progress"),
        epoch.alias("totepoch"),
        F.array().cast("array<double>").alias("minibatch"),
        epochs.alias("finEpochs"),
    )
    return F.to_json(
        F.struct(
            last.alias("lastErr"),
            progress.alias("lastProgress"),
            epoch.alias("totEpochs"),
            low.alias("gMinErr"),
            high.alias("gMaxErr"),
            low.alias("gFMinErr"),
            high.alias("gFMaxErr"),
            log.alias("logfilename"),
            command.alias("curCommand"),
            F.array(run).alias("commands"),
        )
    )
