import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import arrays, text
from millrace.operators import metrics, pixels
from millrace.operators.pixels import hsv, pixel_jitter
from millrace.operators.vectors import parse_sparse_lines


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def both(spark, line, *dims, **kw):
    """The column expression and the Arrow operator have to agree."""
    a = one(spark, arrays.sparse_to_dense(F.lit(line), *dims, **kw))
    b = parse_sparse_lines(spark.createDataFrame([(line,)], "line string"), "line", *dims, **kw).first()
    assert (a is None and b["label"] is None) or (a["label"], a["data"]) == (b["label"], b["data"])
    return a


def test_int_label(spark):
    out = both(spark, "0:1 2:1 20:1.1", 1, 25)
    assert out["label"] == [1] and len(out["data"]) == 25
    assert out["data"][1] == 1 and out["data"][19] == pytest.approx(1.1)


def test_float_label(spark):
    out = both(spark, "0:1.1 2:1 20:1.1", 4, 25, int_label=False)
    assert out["label"] == pytest.approx([1.1, 0, 1, 0]) and out["data"][16] == pytest.approx(1.1)


def test_last_value_wins_and_labels_truncate(spark):
    out = both(spark, "3:1  0:2.9 3:5 1:7", 1, 3)
    assert out["label"] == [2] and out["data"] == [7, 0, 5]


@pytest.mark.parametrize("line", ["4:1", "0:1 -1:2", "1:x", "1", "a:1", "1:2:3"])
def test_bad_lines(spark, line):
    assert both(spark, line, 1, 3, strict=False) is None
    with pytest.raises(Exception, match="invalid sparse line"):
        one(spark, arrays.sparse_to_dense(F.lit(line), 1, 3))
    with pytest.raises(Exception, match="invalid sparse line"):
        parse_sparse_lines(spark.createDataFrame([(line,)], "line string"), "line", 1, 3).collect()


def test_round_trip(spark):
    draw = random.Random(7)
    rows = []
    for i in range(10):
        label = [draw.randint(0, 34) for _ in range(10)]
        data = [float(draw.randint(1, 10)) if draw.random() < 0.125 else 0.0 for _ in range(10_000)]
        rows.append((i, label, data))
    df = spark.createDataFrame(rows, "id long, label array<int>, data array<float>")
    lines = df.select("id", arrays.sparse_text(F.col("label"), F.col("data")).alias("line"))
    out = {r["id"]: r for r in parse_sparse_lines(lines, "line", 10, 10_000).collect()}
    expr = {r["id"]: r["p"] for r in lines.select("id", arrays.sparse_to_dense(F.col("line"), 10, 10_000).alias("p")).collect()}
    for i, label, data in rows:
        assert out[i]["label"] == label == expr[i]["label"]
        assert out[i]["data"] == data == expr[i]["data"]


def test_slices_drop_the_tail(spark):
    x = F.array(*[F.lit(i) for i in range(6)])
    assert [one(spark, s) for s in arrays.slices(x, [2, 4])] == [[0, 1], [2, 3]]
    assert one(spark, arrays.crop(x, F.array(F.lit(0), F.lit(0)), 3)) == [3, 4]


def test_reshape_checks_the_product(spark):
    x = F.array(*[F.lit(float(i)) for i in range(6)])
    assert one(spark, arrays.reshape(x, (2, 3)))["shape"] == [2, 3]
    assert one(spark, arrays.reshape(x, (-1, 2)))["shape"] == [3, 2]
    assert one(spark, arrays.reshape(x, (4, 2))) is None and one(spark, arrays.reshape(x, (-1, 4))) is None
    assert arrays.flatten_from((2, 3, 4), 1) == [2, 12]


def test_elementwise(spark):
    a, b = (F.array(*[F.lit(v) for v in vs]) for vs in ([4.0, -1.0, 0.0], [2.0, 0.0, 0.0]))
    assert one(spark, arrays.elementwise("DIV", a, b))[:2] == [2.0, float("-inf")]
    assert one(spark, arrays.elementwise("MAX", a, b)) == [4.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        arrays.elementwise("SUB", a, b)


def test_chars(spark):
    assert one(spark, arrays.encode_chars(F.lit("ba!"), "ab", 5)) == [1, 0, 99, 99, 99]
    assert one(spark, arrays.encode_chars(F.lit("abab"), "ab", 2)) == [0, 1]


def test_tree(spark):
    parents = [-1, -1, 0, 0, 0, 1, 1, 2, 2, 2]
    tree = spark.createDataFrame(list(enumerate(parents)), "node long, parent long")
    paths = {r["node"]: r["path"] for r in metrics.tree_paths(tree).collect()}
    assert paths[9] == [9, 2, 0] and paths[1] == [1]
    groups = [(r["offset"], r["size"]) for r in metrics.tree_groups(tree).orderBy("grp").collect()]
    assert groups == [(0, 2), (2, 3), (5, 2), (7, 3)]
    with pytest.raises(ValueError, match="cycle"):
        metrics.tree_paths(spark.createDataFrame([(0, 1), (1, 0)], "node long, parent long"))


def test_ignored_label_stays_in_the_denominator(spark):
    tree = spark.createDataFrame([(0, -1), (1, -1)], "node long, parent long")
    rows = spark.createDataFrame([(0, [0.5, 0.5]), (-1, [0.5, 0.5])], "label int, prob array<double>")
    loss = metrics.tree_softmax_loss(rows, metrics.tree_paths(tree), ignore_label=-1).first()["loss"]
    assert loss == pytest.approx(0.6931471805599453 / 2)


def test_group_softmax_sums_to_one(spark):
    x = F.array(*[F.lit(float(i)) for i in range(4)])
    out = one(spark, metrics.group_softmax(x, [(0, 1), (1, 3)]))
    assert out[0] == 1 and sum(out[1:]) == pytest.approx(1)


def test_hsv():
    def of(*bgr):
        return tuple(int(v) for v in hsv(np.array([bgr]))[0])

    assert of(0, 0, 255) == (0, 255, 255) and of(0, 255, 0) == (60, 255, 255) and of(255, 0, 0) == (120, 255, 255)
    assert of(0, 255, 255) == (30, 255, 255) and of(7, 7, 7) == (0, 0, 7) and of(128, 0, 255)[0] in range(160, 176)


def test_lighting_moves_all_pixels_alike(spark):
    rows = [(1, [10.0, 20.0, 200.0, 90.0, 80.0, 120.0, 50.0, 60.0, 70.0])]
    df = spark.createDataFrame(rows, "id long, p array<double>")
    out = np.array(pixel_jitter(df, "p", "id", enabled=("lighting",)).first()["p"]).reshape(-1, 3)
    moved = out - np.array(rows[0][1]).reshape(-1, 3)
    inside = (out > 0) & (out < 255)
    for c in range(3):
        assert np.ptp(moved[inside[:, c], c]) < 1e-9


def test_paths(spark):
    assert one(spark, text.dotted_suffix(F.lit("a.b/.hidden"))) == ""
    assert one(spark, text.dotted_suffix(F.lit("a/x.TAR.GZ"))) == ".gz"
    assert one(spark, text.dir_name(F.lit("file"))) == "." and one(spark, text.stem(F.lit("a/b.c.d"))) == "b.c"
    assert one(spark, text.path_group(F.lit("/hdfs/vc/x/y"), "/hdfs/")) == "vc"
    assert one(spark, text.kv_args(F.lit("a=1 b=x=y a=2"))) == {"a": "2", "b": "x=y"}
    assert one(spark, text.substitute(F.lit("$A$$A$"), {"A": "x"}, first_only=True)) == "x$A$"


ODD = ["2:NaN", "2:nan", "+2:1", "-0:1", "-1:1", "2:1.5f", "2:1.5d", "2:0x1p3", "2:inf", "2:-Infinity", "2:+1.5", "2:.5", "2:5.", "2:1e3",
       "2: 1", " 2:1", "2:1 ", "2:", ":1", "2", "2:1:1", "9:1", "0:NaN", "0:inf", "0:1.9", "4:1", "12345678901:1", ""]


@pytest.mark.parametrize("int_label", [True, False])
def test_parsers_agree_on_odd_entries(spark, int_label):
    rows = spark.createDataFrame(list(enumerate(ODD)), "n int, line string")
    a = {r["n"]: r["p"] for r in rows.select("n", arrays.sparse_to_dense(F.col("line"), 1, 3, int_label, strict=False).alias("p")).collect()}
    b = {r["n"]: r for r in parse_sparse_lines(rows, "line", 1, 3, int_label=int_label, strict=False).collect()}
    for n, line in enumerate(ODD):
        expression = None if a[n] is None else repr((a[n]["label"], a[n]["data"]))
        batch = None if b[n]["label"] is None else repr((b[n]["label"], b[n]["data"]))
        assert expression == batch, line
    good = {line for n, line in enumerate(ODD) if a[n] is not None}
    assert good >= {"2:NaN", "+2:1", "2:+1.5", "2:inf", "0:1.9", ""} and not good & {"2:1.5f", "-1:1", "2:0x1p3", "4:1", "2:1:1", "2"}
    assert ("0:NaN" in good) != int_label


def test_unequal_lengths_are_errors(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    for column in (arrays.elementwise("SUM", F.col("a"), F.col("b")), arrays.squared_error(F.col("a"), F.col("b"))):
        with pytest.raises(Exception, match="unequal length"):
            df.select(column).collect()
    nulls = df.select(arrays.elementwise("MAX", F.col("a"), F.lit(None).cast("array<double>")).alias("x"))
    assert nulls.first()["x"] is None


@pytest.mark.parametrize("size", [2, None])
def test_group_means_of_whole_vectors(spark, size, monkeypatch):
    monkeypatch.setattr(metrics, "HELD_VALUES", 3)
    rows = [("a", [1.0, 2.0]), ("a", [3.0, 5.0]), ("b", [7.0, 8.0]), (None, [1.0, 1.0]), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v array<double>").repartition(3)
    got = {r["g"]: (r["n"], r["mean"]) for r in metrics.group_mean_vector(df, "g", "v", size).collect()}
    assert got == {"a": (2, [2.0, 3.5]), "b": (1, [7.0, 8.0]), None: (1, [1.0, 1.0])}


@pytest.mark.parametrize("size", [2, 64, 300, None])
@pytest.mark.parametrize("parts", [1, 2])
def test_group_means_refuse_unequal_lengths(spark, size, parts):
    df = spark.createDataFrame([("a", [1.0, 2.0, 3.0]), ("a", [5.0, 6.0])], "g string, v array<double>").repartition(parts)
    with pytest.raises(Exception, match="unequal length"):
        metrics.group_mean_vector(df, "g", "v", size).collect()


def test_chars_can_be_strict(spark):
    df = spark.createDataFrame([("abc",)], "t string")
    assert df.select(arrays.encode_chars(F.col("t"), "abc", 2).alias("c")).first()["c"] == [0, 1]
    with pytest.raises(Exception, match="too long"):
        df.select(arrays.encode_chars(F.col("t"), "abc", 2, strict=True)).collect()


def test_jitter_blends(spark):
    stack = np.array([[[10.0, 20.0, 30.0], [200.0, 100.0, 0.0]]])
    gray = stack @ np.array([0.299, 0.587, 0.114])
    for own, mean, reference in ((1.0, 0.0, gray[..., None]), (0.0, 1.0, gray.mean()), (0.0, 0.0, 0.0)):
        got = pixels.blended(stack, np.array([0.7]), np.array([own]), np.array([mean]))
        assert np.allclose(got, 0.7 * stack + 0.3 * reference)
    df = spark.createDataFrame([(1, [1.0] * 6), (2, None), (3, []), (4, [9.0, 8.0, 7.0])], "id long, p array<double>")
    out = {r["id"]: r["p"] for r in pixel_jitter(df, "p", "id").collect()}
    assert out[2] is None and out[3] == [] and len(out[1]) == 6 and len(out[4]) == 3
