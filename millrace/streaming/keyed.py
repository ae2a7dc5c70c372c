"""Run status and heartbeats as one stateful query: state per run in the state store, timers for idle runs.

The lines of a run are dealt to blocks of line numbers. A first stateful step keeps each block's loss
and progress lines and gives the block's summary; a second one keeps the summaries of a run's blocks,
folds them in order, and owns the run's timer. A late line is therefore summed up again within
its block only, a run with very many lines is spread over as many tasks as it has blocks, and no
table of earlier versions is read. What is told is appended to a Parquet folder.

Spark groups by buckets of blocks and of runs: a group costs milliseconds, whatever is in it, and most blocks
have few lines. Within its bucket each block and each run has entries of its own, and only those of a
batch are read and written. State is found by bucket: another number of them needs a new checkpoint.

Repeated lines count once. Null run ids make a run of their own; lines without a number are left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.operators.runlogs import parse_losses

BLOCK_LINES = 1_000_000
IDLE_MS = 60_000
KEEP_MS = 3_600_000
MARKS_PER_CALL = 100_000
BUCKETS = 4096
PORTION_ROWS = 200_000
PROVIDER = ("spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

MARK = "loss double, iter long, progress double"
PACKED_MARK = np.dtype([("line_no", "<i8"), ("loss", "<f8"), ("iter", "<i8"), ("progress", "<f8")])
BLOCK = (
    "last_line long, last_at long, mark long, progress double, at_loss double, at_iter long, at_max double, at_min double, "
    "at_n long, loss double, iter long, max_loss double, min_loss double, n long"
)
RUN_KEY = "run_id long, no_run boolean"
BLOCK_KEY = f"{RUN_KEY}, block long"
TOLD = (
    "run_id long, version long, kind string, at_ms long, last_line long, last_at long, progress double, last_loss double, "
    "tot_epochs long, max_loss double, min_loss double, n_epochs long"
)


class Block(NamedTuple):
    """Summary of the lines of a range: values at its last progress line (``mark``, ``at_...``) and at its end."""

    last_line: int
    last_at: int | None
    mark: int | None = None
    progress: float | None = None
    at_loss: float | None = None
    at_iter: int | None = None
    at_max: float | None = None
    at_min: float | None = None
    at_n: int = 0
    loss: float | None = None
    iter: int | None = None
    max_loss: float | None = None
    min_loss: float | None = None
    n: int = 0


def _pick(choose, *values):
    known = [v for v in values if v is not None]
    return choose(known) if known else None


def of_line(line: int, at: int | None, loss: float | None, step: int | None, progress: float | None) -> Block:
    """Summary of one line."""
    block = Block(line, at)
    if loss is not None:
        block = block._replace(loss=loss, iter=step, max_loss=loss, min_loss=loss, n=1)
    if progress is not None:
        block = block._replace(mark=line, progress=progress, at_loss=block.loss, at_iter=block.iter, at_max=block.max_loss,
                               at_min=block.min_loss, at_n=block.n)
    return block


def of_lines(lines: Iterable[tuple]) -> Block:
    """Summary of some lines in rising order, as :func:`of_line` and :func:`follow` have it line by line."""
    last_at = loss = step = high = low = mark = progress = at_loss = at_iter = at_max = at_min = None
    n = at_n = 0
    for line, at, value, count, percent in lines:
        if at is not None and (last_at is None or at > last_at):
            last_at = at
        if value is not None:
            loss, step, n = value, count, n + 1
            high = value if high is None or value > high else high
            low = value if low is None or value < low else low
        if percent is not None:
            mark, progress, at_loss, at_iter, at_max, at_min, at_n = line, percent, loss, step, high, low, n
    return Block(line, last_at, mark, progress, at_loss, at_iter, at_max, at_min, at_n, loss, step, high, low, n)


def follow(a: Block, b: Block) -> Block:
    """Summary of the lines of ``a`` and then those of ``b``."""
    out = b if b.n else b._replace(loss=a.loss, iter=a.iter)
    if b.mark is None:
        out = out._replace(**{f: getattr(a, f) for f in ("mark", "progress", "at_loss", "at_iter", "at_max", "at_min", "at_n")})
    else:
        if not b.at_n:
            out = out._replace(at_loss=a.loss, at_iter=a.iter)
        out = out._replace(at_max=_pick(max, b.at_max, a.max_loss), at_min=_pick(min, b.at_min, a.min_loss), at_n=b.at_n + a.n)
    return out._replace(
        last_line=max(a.last_line, b.last_line), last_at=_pick(max, a.last_at, b.last_at),
        max_loss=_pick(max, a.max_loss, b.max_loss), min_loss=_pick(min, a.min_loss, b.min_loss), n=a.n + b.n)


def _plain(value: Any) -> Any:
    return None if value is None or value != value or value is pd.NA else value


def _whole(value: Any) -> int | None:
    value = _plain(value)
    return None if value is None else int(value)


class _BlockStep(StatefulProcessor):
    """Loss and progress lines of one block of a run; gives its summary whenever lines arrive."""

    def __init__(self, keep_marks_ms: int | None) -> None:
        self.keep = keep_marks_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.summary = handle.getValueState("summary", BLOCK, self.keep)
        # a list takes all new lines of a batch in few calls, a map needs one call per line
        self.marks = handle.getListState("marks", f"line_no long, {MARK}", self.keep)

    def _again(self, last_line: int, last_at: int | None) -> Block:
        """The summary of all kept lines, which come in no order: the last mark first, then what stands before it."""
        mark = progress = None
        for line, _, _, percent in self.marks.get():
            if percent is not None and (mark is None or line > mark):
                mark, progress = line, percent
        end, at_end = (None, None, None), (None, None, None)
        high = low = at_max = at_min = None
        n = at_n = 0
        for line, loss, step, _ in self.marks.get():
            if loss is None:
                continue
            n += 1
            high = loss if high is None or loss > high else high
            low = loss if low is None or loss < low else low
            if end[0] is None or line > end[0]:
                end = (line, loss, step)
            if mark is not None and line <= mark:
                at_n += 1
                at_max = loss if at_max is None or loss > at_max else at_max
                at_min = loss if at_min is None or loss < at_min else at_min
                if at_end[0] is None or line > at_end[0]:
                    at_end = (line, loss, step)
        return Block(last_line, last_at, mark, progress, at_end[1], at_end[2], at_max, at_min, at_n, end[1], end[2], high, low, n)

    def _taken(self, known: Block | None, lines: Iterable[tuple]) -> Block:
        """The summary of the block with more lines ``(line_no, at_us, loss, iter, progress)``, in rising order; they are kept."""
        last = None if known is None else known.last_line
        latest, new, late = None, [], []
        for one in lines:
            line, at, loss, _, percent = one
            if at is not None and (latest is None or at > latest):
                latest = at
            says = loss is not None or percent is not None
            if last is not None and line <= last:
                if says:
                    late.append(one)
            elif not new or new[-1][0] != line:
                new.append(one)
            elif says and new[-1][2] is None and new[-1][4] is None:
                new[-1] = one
        if new:
            known = of_lines(new) if known is None else follow(known, of_lines(new))
        known = known._replace(last_at=_pick(max, known.last_at, latest))
        marks = [(line, loss, step, percent) for line, _, loss, step, percent in new if loss is not None or percent is not None]
        if late:  # a line that is kept already counts once
            kept = {mark[0] for mark in self.marks.get()} | {mark[0] for mark in marks}
            late = list({line: (line, loss, step, percent) for line, _, loss, step, percent in reversed(late) if line not in kept}.values())
        marks += late
        for at in range(0, len(marks), MARKS_PER_CALL):
            self.marks.appendList(marks[at : at + MARKS_PER_CALL])
        return self._again(known.last_line, known.last_at) if late else known

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = Block(*self.summary.get()) if self.summary.exists() else None
        ended = False
        for batch in rows:
            batch = batch.sort_values("line_no", kind="stable")
            ended |= bool(batch["ended"].eq(True).any())
            known = self._taken(known, _plain_lines(batch))
        if known is None:
            return
        self.summary.update(tuple(known))
        yield pd.DataFrame([(*key, ended, *known)], columns=["run_id", "block", "ended", *Block._fields])

    def close(self) -> None:
        pass


def _plain_lines(batch: pd.DataFrame) -> Iterator[tuple]:
    return zip(batch["line_no"].tolist(), map(_whole, batch["at_us"].tolist()), map(_plain, batch["loss"].tolist()),
               map(_whole, batch["iter"].tolist()), map(_plain, batch["progress"].tolist()), strict=True)


class _PackedMarks:
    """The list of loss and progress lines of one block in a map of many: an entry per ``appendList``."""

    def __init__(self, state, key: tuple, parts: int) -> None:
        self.state, self.key, self.parts = state, key, parts

    def get(self) -> Iterator[tuple]:
        for part in range(self.parts):
            entry = self.state.getValue((*self.key, part))
            if entry is None:  # its time is over
                continue
            for line, loss, step, percent in np.frombuffer(entry[0], PACKED_MARK).tolist():
                yield line, _plain(loss), None if loss != loss else step, _plain(percent)

    def appendList(self, marks: list[tuple]) -> None:
        packed = np.array([(line, np.nan if loss is None else loss, 0 if step is None else step, np.nan if percent is None else percent)
                           for line, loss, step, percent in marks], PACKED_MARK)
        self.state.updateValue((*self.key, self.parts), (packed.tobytes(),))
        self.parts += 1


class _BlocksStep(_BlockStep):
    """The blocks of a bucket: what :class:`_BlockStep` keeps of one block, as entries of maps by run and block."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.summaries = handle.getMapState("summaries", BLOCK_KEY, "summary string, parts long", self.keep)
        self.kept = handle.getMapState("kept", f"{BLOCK_KEY}, part long", "marks binary", self.keep)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        touched: dict[tuple, list] = {}  # by run and block: summary, lists of marks, whether the run has ended
        for batch in _portions(rows):
            batch = batch.sort_values(["run_id", "no_run", "block", "line_no"], kind="stable")
            where = zip(batch["run_id"].tolist(), batch["no_run"].tolist(), batch["block"].tolist(), strict=True)
            for block, group in groupby(zip(where, batch["ended"].tolist(), _plain_lines(batch), strict=True), lambda row: row[0]):
                _, ends, lines = zip(*group, strict=True)
                if block not in touched:
                    entry = self.summaries.getValue(block)
                    touched[block] = [None, 0, False] if entry is None else [Block(*json.loads(entry[0])), entry[1], False]
                known, parts, ended = touched[block]
                self.marks = _PackedMarks(self.kept, block, parts)
                touched[block] = [self._taken(known, lines), self.marks.parts, ended or any(ends)]
        told = []
        for block, (known, parts, ended) in touched.items():
            summary = json.dumps(known)
            self.summaries.updateValue(block, (summary, parts))
            told.append((*block, ended, summary))
        yield pd.DataFrame(told, columns=["run_id", "no_run", "block", "ended", "summary"])


def _portions(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of a group in frames of about ``PORTION_ROWS``."""
    held: list[pd.DataFrame] = []
    for batch in rows:
        held.append(batch)
        if sum(map(len, held)) >= PORTION_ROWS:
            yield pd.concat(held)
            held = []
    if held:
        yield pd.concat(held)


class _RunsStep(StatefulProcessor):
    """The runs of a bucket: the summaries of a run's blocks, its status and the time at which it is idle.

    Runs that are idle at one time share a timer; a run that got lines since then has a later one.
    """

    def __init__(self, idle_ms: int, keep_ms: int) -> None:
        self.idle, self.keep = idle_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getMapState("runs", RUN_KEY, "version long, ended boolean, due_ms long, blocks string")
        self.due = handle.getMapState("due", "due_ms long", "runs string")

    def _status(self, run: tuple, kind: str, now: int, version: int, blocks: dict[str, list]) -> tuple:
        whole = None
        for _, block in sorted((int(at), Block(*summary)) for at, summary in blocks.items()):
            whole = block if whole is None else follow(whole, block)
        epochs = whole.at_iter + 1 if whole.at_iter else 1
        return (None if run[1] else run[0], version, kind, now, whole.last_line, whole.last_at, 100.0 if kind == "end" else whole.progress,
                whole.at_loss or 0.0, epochs, whole.at_max, whole.at_min, whole.at_n)

    def _set_timers(self, due: dict[int, list[tuple]]) -> None:
        for when, runs in due.items():
            before = self.due.getValue((when,))
            if before is None:
                self.handle.registerTimer(when)
            self.due.updateValue((when,), (json.dumps([*([] if before is None else json.loads(before[0])), *runs]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        arrived: dict[tuple, list] = {}
        for batch in rows:
            for *run, block, ended, summary in zip(*(batch[c].tolist() for c in ("run_id", "no_run", "block", "ended", "summary")), strict=True):
                one = arrived.setdefault(tuple(run), [False, {}])
                one[0] |= ended
                one[1][str(block)] = json.loads(summary)
        told: list[tuple] = []
        due: dict[int, list[tuple]] = {}
        for run, (ended, new) in arrived.items():
            entry = self.runs.getValue(run)
            version, was_ended, blocks = (0, False, {}) if entry is None else (entry[0], entry[1], json.loads(entry[3]))
            ended |= was_ended
            blocks |= new
            kinds = ["status", "end"] if ended and not was_ended else ["status"]
            told += [self._status(run, kind, now, version + i, blocks) for i, kind in enumerate(kinds, 1)]
            when = now + (self.keep if ended else self.idle)
            self.runs.updateValue(run, (version + len(kinds), ended, when, json.dumps(blocks)))
            due.setdefault(when, []).append(run)
        self._set_timers(due)
        yield _told(told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, when = timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()
        entry = self.due.getValue((when,))
        if entry is None:
            return
        self.due.removeKey((when,))
        beats: list[tuple] = []
        again: list[tuple] = []
        for run in map(tuple, json.loads(entry[0])):
            state = self.runs.getValue(run)
            if state is None or state[2] != when:
                continue
            version, ended, _, blocks = state
            if ended:
                self.runs.removeKey(run)
                continue
            beat = self._status(run, "beat", now, version + 1, json.loads(blocks))
            if beat[6] is not None:
                version += 1
                beats.append(beat)
            self.runs.updateValue(run, (version, ended, now + self.idle, blocks))
            again.append(run)
        if again:
            self._set_timers({now + self.idle: again})
        if beats:
            yield _told(beats)

    def close(self) -> None:
        pass


def _told(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in TOLD.split(", ")], dtype=object)


def _slim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines that say something, and the last line of each run in the batch, which tells that the run is alive."""
    for batch in batches:
        says = batch["loss"].notna() | batch["progress"].notna() | batch["ended"]
        last = batch["line_no"] == batch.groupby(["run_id", "no_run"])["line_no"].transform("max")
        yield batch[says | last]


def run_events(
    lines: DataFrame, *, idle_ms: int = IDLE_MS, keep_ms: int = KEEP_MS, keep_marks_ms: int | None = None,
    block_lines: int = BLOCK_LINES,
) -> DataFrame:
    """Status rows, heartbeats and end marks of a stream of log lines ``(run_id, line_no, at_us, line)``.

    ``kind`` is ``status`` (a run got lines), ``beat`` (no line for ``idle_ms``, and again for every such pause)
    or ``end`` (once, when a line with a true ``ended`` column arrived); ``version`` rises by one per row
    of a run. ``keep_ms`` after its end a run's state is dropped; ``keep_marks_ms``, if given, is the
    time after which a block forgets a line, longer than any line may be late.
    """
    ended = F.coalesce("ended", F.lit(False)) if "ended" in lines.columns else F.lit(False)
    parsed = parse_losses(lines.filter("line_no IS NOT NULL").withColumn("_ended", ended))
    # whole numbers that are never null stay whole in pandas
    slim = parsed.select(
        F.coalesce("run_id", F.lit(0)).alias("run_id"), F.col("run_id").isNull().alias("no_run"),
        F.floor(F.col("line_no") / block_lines).cast("long").alias("block"), "line_no", "at_us", "loss",
        F.coalesce(F.col("iter").cast("long"), F.lit(0)).alias("iter"), "progress", F.col("_ended").alias("ended")).mapInPandas(
        _slim, f"{BLOCK_KEY}, line_no long, at_us long, loss double, iter long, progress double, ended boolean")
    blocks = slim.withColumn("bucket", _bucket("run_id", "no_run", "block")).groupBy("bucket").transformWithStateInPandas(
        _BlocksStep(keep_marks_ms), f"{BLOCK_KEY}, ended boolean, summary string", "Append", "processingTime")
    return blocks.withColumn("bucket", _bucket("run_id", "no_run")).groupBy("bucket").transformWithStateInPandas(
        _RunsStep(idle_ms, keep_ms), TOLD, "Append", "processingTime")


def _bucket(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("bucket")


def stream_run_events(lines: DataFrame, folder: str, *, trigger: dict | None = None, **options) -> StreamingQuery:
    """Append what :func:`run_events` tells to ``folder/told``; the state and the place in the stream are in ``folder/keyed-checkpoint``.

    Without a trigger all that has arrived is read in one batch and the query ends (``availableNow`` would not:
    while there are timers, there may be another batch).
    """
    conf = lines.sparkSession.conf
    before = conf.get(PROVIDER[0], None)
    conf.set(*PROVIDER)  # the query keeps the settings it was started with
    try:
        return (
            run_events(lines, **options)
            .writeStream.format("parquet").outputMode("append")
            .option("path", f"{folder}/told").option("checkpointLocation", f"{folder}/keyed-checkpoint")
            .trigger(**(trigger or {"once": True}))
            .start()
        )
    finally:
        if before is None:
            conf.unset(PROVIDER[0])
        else:
            conf.set(PROVIDER[0], before)


def told(spark: SparkSession, folder: str) -> DataFrame:
    """All rows told so far."""
    return spark.read.schema(TOLD).parquet(f"{folder}/told")


def newest_status(spark: SparkSession, folder: str) -> DataFrame:
    """The newest status of every run that has progress."""
    names = ("progress", "last_loss", "tot_epochs", "max_loss", "min_loss", "n_epochs", "last_at")
    rows = told(spark, folder).filter("kind = 'status'").groupBy("run_id").agg(F.max_by(F.struct(*names), "version").alias("s"))
    return rows.select("run_id", "s.*").filter("progress IS NOT NULL")
