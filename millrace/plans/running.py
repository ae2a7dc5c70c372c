"""Ordered computations per key that survive a key holding a third of all rows.

A window partitioned by a key runs each key in one task. Here the keys with more
rows than one task should sort are found first (one partial aggregation). If there
are none, the plain window is used. Otherwise each hot key is cut into ranges of
its order columns; every range is one window partition, and what the earlier
ranges contribute (a count, a sum, the last non-null value ...) comes from a
summary of one row per range. The rows are shuffled once in either case.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.plans.widths import row_width

ROWS_PER_TASK = 4_000_000
BYTES_PER_TASK = 1 << 30
MAX_RANGES = 32_768
_SAMPLES_PER_RANGE = 64
_PART = "_part"


@dataclass(frozen=True)
class Run:
    """One running column: ``kind`` over ``value`` from the first row of the key.

    ``count`` ``sum`` ``max`` ``min`` accumulate; ``last`` and ``first`` take the
    latest or earliest non-null value so far; ``next`` takes the earliest non-null
    value from here on. ``strict`` leaves the row itself out.
    """

    kind: str
    value: Column | None = None
    strict: bool = False


@dataclass(frozen=True)
class Splits:
    """Cut points of the hot keys: a bounded local table, or None without hot keys."""

    bounds: DataFrame | None
    longest: int = 0


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def _join_small(df: DataFrame, small: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Broadcast join on null-safe equal names; ``small`` has at most one row per hot range."""
    renamed = small.withColumnsRenamed({n: f"_r_{n}" for n in names})
    condition = F.lit(True)
    for name in names:
        condition = condition & df[name].eqNullSafe(renamed[f"_r_{name}"])
    return df.join(F.broadcast(renamed), condition, how).drop(*[f"_r_{n}" for n in names])


def find_splits(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_task: int | None = None,
) -> Splits:
    """Find the hot keys and cut each into ranges of about ``rows_per_task`` rows, fewer where rows are wide.

    ``order`` has to be unique within a key. The cut points come from a sample
    chosen by hash; they decide only where rows are computed, never the result.
    """
    keys = list(keys)
    counts = df.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"), F.sum(row_width(df)).alias("_b"))
    total, largest, size = counts.agg(F.sum("_n"), F.max("_n"), F.sum("_b")).first()
    by_size = BYTES_PER_TASK * (total or 0) // max(1, size or 0)
    limit = max(min(rows_per_task or ROWS_PER_TASK, by_size), (total or 0) // MAX_RANGES, 1)
    if not total or largest <= limit:
        return Splits(None)

    stride = max(1, limit // _SAMPLES_PER_RANGE)
    every = max(1, limit // stride)
    hot = counts.filter(F.col("_n") > limit).select(*keys)
    sample = (
        _join_small(df.select(*dict.fromkeys([*keys, *order])), hot, keys, "left_semi")
        .filter(F.pmod(F.xxhash64(*keys, *order), F.lit(stride)) == 0)
        .select(*keys, F.struct(*order).alias("_cut"))
        .distinct()
    )
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_cut"))
    cuts = (
        sample.withColumn("_nth", nth)
        .filter(F.col("_nth") % every == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
    )
    rows = cuts.collect()  # at most total / limit <= MAX_RANGES cut points and a few
    if not rows:
        return Splits(None)
    bounds = df.sparkSession.createDataFrame(rows, cuts.schema)
    return Splits(bounds, max(len(row["_cuts"]) for row in rows))


def _assign(df: DataFrame, keys: Sequence[str], order: Sequence[str], splits: Splits) -> DataFrame:
    """Add the range number of each row: null for keys that need no cutting."""
    steps = [1 << bit for bit in reversed(range(splits.longest.bit_length()))]
    cuts, here = F.col("_cuts"), F.struct(*[F.col(c) for c in order])

    def advance(pos: Column, step: Column) -> Column:
        return F.when(F.try_element_at(cuts, pos + step) <= here, pos + step).otherwise(pos)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)
    return (
        _join_small(df, splits.bounds, keys, "left")
        .withColumn(_PART, F.when(cuts.isNotNull(), found))
        .drop("_cuts")
    )


def _local(run: Run, value: Column, forward: WindowSpec, backward: WindowSpec) -> Column:
    end = -1 if run.strict else 0
    ahead = forward.rowsBetween(Window.unboundedPreceding, end)
    if run.kind == "count":
        return F.count(F.lit(1) if run.value is None else value).over(ahead)
    if run.kind in ("sum", "max", "min"):
        return getattr(F, run.kind)(value).over(ahead)
    if run.kind == "last":
        return F.last(value, ignorenulls=True).over(ahead)
    if run.kind == "first":
        return F.first(value, ignorenulls=True).over(ahead)
    if run.kind == "next":
        return F.last(value, ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, end))
    raise ValueError(f"unknown running kind: {run.kind}")


def _summary(run: Run, value: Column, order: Sequence[str]) -> Column:
    if run.kind == "count":
        return F.count(F.lit(1) if run.value is None else value)
    if run.kind in ("sum", "max", "min"):
        return getattr(F, run.kind)(value)
    place = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    rank = F.when(value.isNotNull(), place)
    return F.max_by(value, rank) if run.kind == "last" else F.min_by(value, rank)


def _carry(run: Run, value: Column, keys: Sequence[str]) -> Column:
    by_part = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    from_end = Window.partitionBy(*keys).orderBy(F.desc(_PART)).rowsBetween(Window.unboundedPreceding, -1)
    if run.kind in ("count", "sum"):
        return F.sum(value).over(by_part)
    if run.kind in ("max", "min"):
        return getattr(F, run.kind)(value).over(by_part)
    if run.kind == "first":
        return F.first(value, ignorenulls=True).over(by_part)
    return F.last(value, ignorenulls=True).over(by_part if run.kind == "last" else from_end)


def _combine(run: Run, local: Column, carry: Column) -> Column:
    if run.kind == "count":
        return local + F.coalesce(carry, F.lit(0))
    if run.kind == "sum":
        return F.coalesce(local + carry, local, carry)
    if run.kind == "max":
        return F.greatest(local, carry)
    if run.kind == "min":
        return F.least(local, carry)
    return F.coalesce(carry, local) if run.kind == "first" else F.coalesce(local, carry)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, Run],
    *,
    splits: Splits | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add running columns per key in ascending ``order`` (unique within a key).

    Pass ``splits`` from :func:`find_splits` to share one search between calls.
    """
    keys, order, source = list(keys), list(order), df.columns
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    if splits is None:
        splits = find_splits(df, keys, order, rows_per_task)
    values = {f"_v{i}": run.value for i, run in enumerate(columns.values()) if run.value is not None}
    df = df.withColumns(values) if values else df
    names = {name: F.col(f"_v{i}") for i, name in enumerate(columns)}

    whole = splits.bounds is None
    parted = df if whole else _assign(df, keys, order, splits)
    group = keys if whole else [*keys, _PART]
    forward = Window.partitionBy(*group).orderBy(*order)
    backward = Window.partitionBy(*group).orderBy(*[F.desc(c) for c in order])
    out = parted.withColumns(
        {f"_l_{name}": _local(run, names[name], forward, backward) for name, run in columns.items()}
    )
    if whole:
        return out.select(*source, *[F.col(f"_l_{name}").alias(name) for name in columns])

    summary = (
        parted.filter(F.col(_PART).isNotNull())
        .groupBy(*group)
        .agg(*[_summary(run, names[name], order).alias(name) for name, run in columns.items()])
    )
    carries = summary.select(
        *group, *[_carry(run, F.col(name), keys).alias(f"_c_{name}") for name, run in columns.items()]
    )
    joined = _join_small(out, carries, group, "left")
    return joined.select(
        *source,
        *[
            _combine(run, F.col(f"_l_{name}"), F.col(f"_c_{name}")).alias(name)
            for name, run in columns.items()
        ],
    )


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, **kw) -> DataFrame:
    """Row number (from 1) per key in ascending order."""
    return running(df, keys, order, {name: Run("count")}, **kw)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    *,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Columns over the last ``size`` rows of the key, the row itself included.

    Hot keys are cut into blocks of consecutive rows; each block also receives the
    ``size - 1`` rows before it, which are dropped again after the window.
    """
    keys, order, source = list(keys), list(order), df.columns
    splits = find_splits(df, keys, order, rows_per_task)
    if splits.bounds is None:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - size, 0)
        return df.withColumns({name: make(frame) for name, make in columns.items()})

    length = max(rows_per_task or ROWS_PER_TASK, 4 * size)
    nth = F.col("_nth") - 1
    block = F.floor(nth / length)
    tail = (nth % length >= length - (size - 1)) if size > 1 else F.lit(False)
    copies = (
        numbered(df, keys, order, "_nth", splits=splits)
        .withColumn("_home", block)
        .withColumn("_block", F.explode(F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))))
    )
    frame = Window.partitionBy(*keys, "_block").orderBy("_nth").rowsBetween(1 - size, 0)
    return (
        copies.withColumns({name: make(frame) for name, make in columns.items()})
        .filter(F.col("_block") == F.col("_home"))
        .select(*source, *columns)
    )


def _within_limits(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The rows up to the ``n``-th of the least values of ``order[0]`` in hash classes of the rows; all rows of a key
    with fewer classes. At least ``n`` rows of a key lie within its limit."""
    first = F.col(order[0])
    classes = F.pmod(F.xxhash64(*order), F.lit(8 * n)).alias("_class")
    least = df.groupBy(*keys, classes).agg(F.min(first).alias("_least"))
    limits = least.groupBy(*keys).agg(F.try_element_at(F.array_sort(F.collect_list("_least")), F.lit(n)).alias("_limit"))
    rows = limits.filter("_limit IS NOT NULL").collect()
    if not rows:
        return df
    known = _join_small(df, df.sparkSession.createDataFrame(rows, limits.schema), keys, "left")
    return known.filter(F.col("_limit").isNull() | first.isNull() | (first <= F.col("_limit"))).drop("_limit")


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    *,
    salts: int = 64,
    rank: str | None = None,
    few_keys: bool = False,
) -> DataFrame:
    """The first ``n`` rows per key in ascending ``order``, without any hot task.

    ``few_keys``: the keys are few and have very many rows, and the first order column is a number. Then a first pass
    finds a limit per key that its first ``n`` rows do not exceed, and only rows within it are sorted and shuffled.

    For small ``n`` every key is first reduced within hash salts (Spark also limits
    each map task ahead of the shuffle) and then across them. A large ``n`` is
    answered by exact row numbers instead.
    """
    keys, order, source = list(keys), list(order), df.columns
    name = rank or "_rank"
    if n > 1000:
        out = numbered(df, keys, order, name).filter(F.col(name) <= n)
    else:
        if few_keys:
            df = _within_limits(df, keys, order, n)
        salt = F.pmod(F.xxhash64(*order), F.lit(salts)).alias("_salt")
        inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
        outer = Window.partitionBy(*keys).orderBy(*order)
        out = (
            df.select("*", salt)
            .withColumn("_inner", F.row_number().over(inner))
            .filter(F.col("_inner") <= n)
            .withColumn(name, F.row_number().over(outer))
            .filter(F.col(name) <= n)
        )
    return out.select(*source, *([rank] if rank else []))
