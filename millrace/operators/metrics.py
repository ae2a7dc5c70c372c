"""Group means, prediction scores and losses, class hierarchies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.arrays import argmax, cross_entropy, softmax, squared_error, zipped
from millrace.plans import lookup_join, numbered
from millrace.session import materialize, spread

# Fixed value: the smallest normal 32-bit float, the floor of a probability.
FLOAT_MIN = 1.17549435e-38
# trees up to this size are walked on the driver: nodes, and nodes of all their paths
SMALL_TREE, SMALL_PATHS = 10_000, 500_000
# sums that a task keeps before it hands them on
HELD_VALUES = 4_000_000


def group_mean_vector(df: DataFrame, group: str, vector: str, size: int | None = None) -> DataFrame:
    """``(group, n, mean)``: elementwise mean of vectors per group.

    All vectors of a group must have one length, ``size`` if it is given; anything else, and a
    null element, is an error. Null vectors are left out. Each task adds its vectors up in Arrow
    batches and gives one row per group, so that only those sums are shuffled, by position.
    """
    kind = df.schema[group].dataType.simpleString()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[object, tuple[int, np.ndarray]] = {}
        held = 0
        for batch in batches:
            lists = batch.column(1)
            if lists.values.null_count:
                raise ValueError("a vector has a null element")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            rows: dict[object, list[int]] = {}
            for row, name in enumerate(batch.column(0).to_pylist()):
                rows.setdefault(name, []).append(row)
            for name, own in rows.items():
                widths = offsets[1:][own] - offsets[:-1][own]
                n, known = sums.get(name, (0, None))
                width = int(widths[0]) if known is None else len(known)
                if (widths != width).any() or size is not None and width != size:
                    raise ValueError(f"vectors of unequal length in group {name}: {sorted(set(widths.tolist()) | {width})}")
                total = np.zeros(width) if known is None else known
                held += width if known is None else 0
                for at in range(0, len(own), 256):
                    starts = offsets[:-1][own[at : at + 256]]
                    total = total + flat[starts[:, None] + np.arange(width)].sum(0)
                sums[name] = n + len(own), total
            if held > HELD_VALUES:
                yield _partial(sums, batch.schema.field(0).type)
                sums, held = {}, 0
        if sums:
            yield _partial(sums, batch.schema.field(0).type)

    vectors = df.filter(F.col(vector).isNotNull()).select(F.col(group), F.col(vector).cast("array<double>"))
    parts = materialize(vectors.mapInArrow(add_up, f"`{group}` {kind}, n long, sums array<double>"))
    widths = parts.groupBy(group).agg(F.sum("n").alias("n"), F.min(F.size("sums")).alias("low"), F.max(F.size("sums")).alias("top"))
    unequal = F.raise_error(F.concat(F.lit("vectors of unequal length in group "), F.col(group).cast("string")))
    counts = widths.select(group, F.when(F.col("low") == F.col("top"), F.col("n")).otherwise(unequal).alias("n"))
    cells = parts.select(group, F.posexplode_outer("sums").alias("pos", "_x"))
    means = cells.groupBy(group, "pos").agg(F.sum("_x").alias("s"))
    pairs = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "s"))))  # one entry per position
    totals = means.groupBy(group).agg(F.transform(pairs, lambda p: p["s"]).alias("_sums"))
    same = [counts[group].eqNullSafe(totals[group])]
    return counts.join(totals, same).select(
        counts[group], "n", F.transform("_sums", lambda s: s / F.col("n")).alias("mean"))


def _partial(sums: dict[object, tuple[int, np.ndarray]], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), kind), pa.array([n for n, _ in sums.values()], pa.int64()),
         pa.array([total for _, total in sums.values()], pa.list_(pa.float64()))], ["g", "n", "sums"])


def center_vectors(df: DataFrame, group: str, vector: str, size: int | None = None, out: str = "centered") -> DataFrame:
    """Subtract the mean of its group from every vector. A row without a group is dropped, a null vector gives null."""
    means = materialize(group_mean_vector(df, group, vector, size)).select(group, "mean")
    joined = lookup_join(df, means, [group])
    return joined.withColumn(out, zipped(F.col(vector), F.col("mean"), lambda x, m: x.cast("double") - m)).drop("mean")


def accuracy(df: DataFrame, scores: str = "scores", label: str = "label", *keys: str) -> DataFrame:
    """Share of samples whose first highest score is at the label."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg((argmax(F.col(scores)) == F.col(label)).cast("int")).alias("accuracy")
    )


def euclidean_loss(df: DataFrame, output: str, target: str, weights: str | None = None, loss_weight: float = 1.0) -> DataFrame:
    """Sum of (weighted) squared differences over ``2 N``."""
    w = None if weights is None else F.col(weights)
    error = squared_error(F.col(output), F.col(target), w)
    return df.agg((F.sum(error) / (2 * F.count(F.lit(1))) * loss_weight).alias("loss"))


def softmax_loss(df: DataFrame, scores: str = "scores", label: str = "label", loss_weight: float = 1.0) -> DataFrame:
    """Mean cross-entropy of the labels."""
    return df.agg((F.avg(cross_entropy(F.col(scores), F.col(label))) * loss_weight).alias("loss"))


# -- class hierarchies --------------------------------------------------------------


def tree_groups(tree: DataFrame) -> DataFrame:
    """``(parent, grp, offset, size)``: the children of one parent form a group, groups in offset order."""
    groups = tree.groupBy("parent").agg(F.min("node").alias("offset"), F.count(F.lit(1)).alias("size"))
    return numbered(materialize(groups), [], ["offset"], "_n").select(
        "parent", (F.col("_n") - 1).cast("long").alias("grp"), "offset", "size"
    )


def tree_paths(tree: DataFrame) -> DataFrame:
    """``(node, path)``: the node and its ancestors up to the root (parent below 0).

    A parent that is no node ends a path. A cycle is an error. A tree of at most SMALL_TREE nodes
    and short paths is walked at once; otherwise paths double in length each round, so a tree of
    depth d takes about log2(d) joins.
    """
    spark = tree.sparkSession
    head = tree.select(F.col("node").cast("long"), F.col("parent").cast("long")).limit(SMALL_TREE + 1).collect()
    small = _small_paths({r.node: r.parent for r in head}) if len({r.node for r in head}) == len(head) <= SMALL_TREE else None
    if small is not None:
        return spark.createDataFrame(small, "node long, path array<long>")
    paths = materialize(spread(tree).select("node", F.array("node").alias("path"), F.col("parent").alias("tip")))
    total, open_nodes = paths.agg(F.count(F.lit(1)), F.count_if(F.col("tip") >= 0)).first()
    rounds, limit = 0, total.bit_length() + 1
    while open_nodes:
        rounds += 1
        if rounds > limit:
            raise ValueError("the tree has a cycle")
        above = paths.select(F.col("node").alias("tip"), F.col("path").alias("_path"), F.col("tip").alias("_tip"))
        longer = lookup_join(paths.filter(F.col("tip") >= 0), above, ["tip"], "left").select(
            "node",
            F.concat("path", F.coalesce("_path", F.array().cast("array<long>"))).alias("path"),
            F.coalesce("_tip", F.lit(-1)).alias("tip"),
        )
        paths = materialize(paths.filter(F.col("tip") < 0).unionByName(longer))
        open_nodes = paths.filter(F.col("tip") >= 0).count()
    return paths.select("node", "path")


def _small_paths(parents: dict[int, int]) -> list[tuple[int, list[int]]] | None:
    """Paths of a small tree; None where they hold more than SMALL_PATHS nodes together."""
    out, held = [], 0
    for node in parents:
        path, above = [node], parents[node]
        while above is not None and above >= 0 and above in parents:
            if len(path) > len(parents):
                raise ValueError("the tree has a cycle")
            path.append(above)
            above = parents[above]
        held += len(path)
        if held > SMALL_PATHS:
            return None
        out.append((node, path))
    return out


def tree_path_closure(tree: DataFrame) -> DataFrame:
    """``(node, ancestor, distance)`` for the node itself and every ancestor."""
    return tree_paths(tree).select("node", F.posexplode("path").alias("distance", "ancestor"))


def group_softmax(scores: Column, groups: Sequence[tuple[int, int]]) -> Column:
    """Softmax inside each ``(offset, size)`` range of the scores; the ranges cover the array in order."""
    ranges = F.array(*[F.struct(F.lit(int(o)).alias("o"), F.lit(int(s)).alias("s")) for o, s in groups])
    return F.flatten(F.transform(ranges, lambda g: softmax(F.slice(scores, g["o"] + 1, g["s"]))))


def tree_softmax_loss(
    df: DataFrame,
    paths: DataFrame,
    probabilities: str = "prob",
    label: str = "label",
    ignore_label: int | None = None,
    loss_weight: float = 1.0,
) -> DataFrame:
    """Mean over samples of ``-log(p)`` summed along the label's path to the root.

    An ignored (or otherwise negative) label adds 0 and stays in the denominator.
    """
    if ignore_label is not None and ignore_label >= 0:
        raise ValueError("an ignored label must be negative")
    steps = paths.select(F.col("node").cast("long").alias("_node"), F.col("path").alias("_path"))
    joined = lookup_join(df.withColumn("_node", F.col(label).cast("long")), steps, ["_node"], "left")
    loss = F.aggregate(
        F.coalesce("_path", F.array().cast("array<long>")),
        F.lit(0.0),
        lambda acc, node: acc
        - F.log(F.greatest(F.element_at(F.col(probabilities), node.cast("int") + 1), F.lit(FLOAT_MIN))),
    )
    return joined.agg((F.sum(loss) / F.count(F.lit(1)) * loss_weight).alias("loss"))
