"""What a task sorts, shuffles or asks of its state does not grow with the table."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.plans import joins, lookup_join, top_n
from millrace.plans.running import _within_limits
from millrace.streaming import keyed


def test_few_keys_sort_few_rows(spark):
    rows = spark.range(0, 60_000, 1, 4).select((F.col("id") % 3).alias("k"), F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("v"), "id")
    odd = spark.createDataFrame([(5, None, 1), (5, 7, 2), (None, 3, 3), (None, None, 4)], "k long, v long, id long")
    both = rows.unionByName(odd)
    got = top_n(both, ["k"], ["v", "id"], 20, few_keys=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, top_n(both, ["k"], ["v", "id"], 20).collect()))
    assert _within_limits(both, ["k"], ["v", "id"], 20).count() < 300


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffled_joins_have_parts_by_size(spark, how, monkeypatch):
    monkeypatch.setattr(joins, "PART_BYTES", 20_000)
    large = spark.range(0, 20_000, 1, 4).select((F.col("id") % 7000).alias("k"), "id")
    large = large.unionByName(spark.createDataFrame([(None, -1)], "k long, id long"))
    lookup = spark.range(0, 5000).select(F.col("id").alias("k"), *([(F.col("id") * 2).alias("w")] if how in ("inner", "left") else []))
    got = lookup_join(large, lookup, ["k"], how, max_bytes=0)
    assert sorted(map(str, got.collect())) == sorted(map(str, large.join(lookup, ["k"], how).collect()))
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 20


class Lists:
    """A state store in memory that counts its calls."""

    def __init__(self):
        self.calls, self.value, self.rows = 0, None, []

    def getValueState(self, *_):
        return self

    def getListState(self, *_):
        return self

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value

    def get(self):
        self.calls += 1
        return self.value if self.reads_value else iter(self.rows)

    def appendList(self, rows):
        self.calls += 1
        self.rows += rows

    reads_value = False


def block_step():
    step = keyed._BlockStep(None)
    step.summary, step.marks = Lists(), Lists()
    step.summary.reads_value = True
    return step


def lines(numbers):
    return pd.DataFrame({"line_no": numbers, "at_us": numbers, "loss": [float(n) for n in numbers], "iter": numbers,
                         "progress": [n / 10 for n in numbers], "ended": False})


def test_new_lines_of_a_block_take_few_calls():
    step = block_step()
    list(step.handleInputRows((1, 0), iter([lines(list(range(0, 4000, 2)))]), None))
    assert step.marks.calls <= 2 and len(step.marks.rows) == 2000
    # late lines, some of them kept already, repeated ones among them
    out = list(step.handleInputRows((1, 0), iter([lines([1, 3, 3, 4, 5, 3998, 4001])]), None))
    assert len(step.marks.rows) == len({r[0] for r in step.marks.rows}) == 2004 and step.marks.calls <= 8
    whole = block_step()
    once = list(whole.handleInputRows((1, 0), iter([lines(sorted({*range(0, 4000, 2), 1, 3, 5, 4001}))]), None))
    assert out[0].iloc[0].tolist() == once[0].iloc[0].tolist()
