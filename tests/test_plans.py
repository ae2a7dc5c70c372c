"""Split plans give what plain windows and joins give."""

import random
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.plans import Run, find_splits, lookup_join, numbered, rolling, running, top_n

def runs():
    return {
        "n": Run("count"),
        "total": Run("sum", F.col("x")),
        "high": Run("max", F.col("x")),
        "low": Run("min", F.col("x")),
        "latest": Run("last", F.col("x")),
        "earliest": Run("first", F.col("x")),
        "ahead": Run("next", F.col("x"), strict=True),
        "before": Run("count", F.col("x"), strict=True),
    }


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds half of all rows, one key is null, many are small."""
    draw = random.Random(4)
    data = []
    for i in range(4000):
        key = draw.choice(["hot", "hot", None, f"k{draw.randrange(40)}"])
        data.append((key, draw.randrange(50), i, draw.choice([None, draw.randrange(100)])))
    return spark.createDataFrame(data, "k string, t int, id long, x long").cache()


@pytest.mark.parametrize("limit", [10, 150, 900])
def test_running_split_equals_plain(rows, limit):
    splits = find_splits(rows, ["k"], ["t", "id"], rows_per_task=limit)
    assert splits.bounds is not None and splits.longest >= 1
    cut = running(rows, ["k"], ["t", "id"], runs(), splits=splits)
    plain = running(rows, ["k"], ["t", "id"], runs())
    assert cut.exceptAll(plain).count() == 0 and plain.exceptAll(cut).count() == 0


def test_split_windows_stay_small(rows):
    from millrace.plans.running import _assign

    splits = find_splits(rows, ["k"], ["t", "id"], rows_per_task=100)
    sizes = _assign(rows, ["k"], ["t", "id"], splits).groupBy("k", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] < 400


def test_global_numbers(rows):
    out = numbered(rows, [], ["t", "id"], "n", rows_per_task=200)
    plain = rows.withColumn("n", F.row_number().over(Window.orderBy("t", "id")).cast("long"))
    assert out.exceptAll(plain).count() == 0 and out.count() == 4000


@pytest.mark.parametrize("size", [1, 7, 60])
def test_rolling_split_equals_plain(rows, size):
    columns = {"s": lambda w: F.sum("x").over(w), "m": lambda w: F.max("x").over(w), "c": lambda w: F.count("*").over(w)}
    cut = rolling(rows, ["k"], ["t", "id"], size, columns, rows_per_task=120)
    plain = rolling(rows, ["k"], ["t", "id"], size, columns)
    assert cut.exceptAll(plain).count() == 0 and cut.count() == 4000


@pytest.mark.parametrize("n", [1, 5, 1500])
def test_top_n(rows, n):
    plain = rows.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("t", "id"))).filter(F.col("r") <= n)
    out = top_n(rows, ["k"], ["t", "id"], n)
    assert out.exceptAll(plain.drop("r")).count() == 0 and out.count() == plain.count()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_per_task,bytes_per_task", [(10**9, 10**12), (300, 10**12), (10**9, 5000)])
def test_lookup_join_cut_equals_broadcast(spark, rows, how, rows_per_task, bytes_per_task):
    names = spark.createDataFrame([("hot", 1), ("hot", 4), ("k1", 2), ("none", 3), (None, 5)], "k string, v int")
    small = lookup_join(rows, names, ["k"], how)
    cut = lookup_join(rows, names, ["k"], how, max_bytes=0, rows_per_task=rows_per_task, bytes_per_task=bytes_per_task)
    assert small.columns == cut.columns
    assert small.exceptAll(cut).count() == 0 and cut.exceptAll(small).count() == 0


def test_lookup_join_copies_hot_lookups_only(spark, rows):
    names = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")

    def plan(limit):
        return lookup_join(rows, names, ["k"], max_bytes=0, rows_per_task=limit)._jdf.queryExecution().toString()

    assert "explode" not in plan(10**9)
    assert "explode" in plan(300)


def test_wide_rows_are_cut_by_bytes(spark, monkeypatch):
    wide = spark.range(400).selectExpr("'a' k", "id t", "repeat('x', 1000) w")
    assert find_splits(wide, ["k"], ["t"]).bounds is None
    monkeypatch.setattr(sys.modules["millrace.plans.running"], "BYTES_PER_TASK", 100_000)
    assert find_splits(wide, ["k"], ["t"]).longest >= 2
