"""Queries over numeric arrays, pixel arrays, prediction scores and class trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs
from millrace.catalog.registry import Registry
from millrace.functions import arrays, images
from millrace.operators import metrics, vectors
from millrace.operators import pixels as pixel_ops
from millrace.session import spread

registry = Registry()
add = registry.add

SIZE = 64
_EMB = """emb AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
  list_reverse(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS r FROM embeddings)"""


def embeddings(spark, folder):
    """``vec_id, label``, the vector ``v`` as doubles and ``r``, the same reversed."""
    table = spread(inputs.load_table(spark, folder, "embeddings"))
    v = F.col("embedding").cast("array<double>")
    return table.select("vec_id", "label", v.alias("v"), F.reverse(v).alias("r"))


def cells(df, column, *keys, digits=6):
    """One row per array element, rounded."""
    return df.select(*keys, F.posexplode(column).alias("pos", "x")).withColumn("x", F.round("x", digits))


def sql_cells(source, column, *keys, digits=6):
    names = ", ".join(keys)
    return f"""SELECT {names}, pos, round(x, {digits}) AS x FROM (
  SELECT {names}, CAST(generate_subscripts({column}, 1) - 1 AS INTEGER) AS pos, unnest({column}) AS x FROM {source})"""


def mapped(name, expression, sql, digits=6):
    """Register an array function of the embeddings: its Spark column and its SQL over ``emb``."""

    @add(name, f"WITH {_EMB}, out AS (SELECT vec_id, {sql} AS o FROM emb) {sql_cells('out', 'o', 'vec_id', digits=digits)}")
    def query(spark, folder):
        return cells(embeddings(spark, folder).withColumn("o", expression()), "o", "vec_id", digits=digits)

    return query


# -- sparse lines ----------------------------------------------------------------------

_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def sparse_lines(spark, folder):
    """``0:label part:quantity supplier:discount``, one line per lineitem; the two indexes may be equal."""
    items = spread(inputs.load_table(spark, folder, "lineitem").select(*_KEYS, "l_quantity", "l_discount"))
    line = F.concat(
        F.lit("0:"), F.col("l_linenumber").cast("string"), F.lit(".7 "),
        (F.col("l_partkey") % 24 + 1).cast("string"), F.lit(":"), F.col("l_quantity").cast("long").cast("string"),
        F.lit(" "), (F.col("l_suppkey") % 24 + 1).cast("string"), F.lit(":"),
        F.round(F.col("l_discount") * 100).cast("long").cast("string"))
    return items.select(*_KEYS, line.alias("line"))


_DENSE = """
dense AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, list_transform(range(24), lambda i: CASE
      WHEN l_suppkey % 24 = i THEN CAST(round(l_discount * 100) AS INTEGER)
      WHEN l_partkey % 24 = i THEN CAST(l_quantity AS INTEGER) ELSE 0 END) AS data
  FROM lineitem)"""


@add("j1_sparse_to_dense", f"""
WITH {_DENSE} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber AS label,
  array_to_string(data, ' ') AS data FROM dense""")
def sparse_to_dense(spark, folder):
    parsed = vectors.parse_sparse_lines(sparse_lines(spark, folder), "line", 1, 24)
    return parsed.select(*_KEYS, F.col("label")[0].alias("label"),
                         F.array_join(F.col("data").cast("array<int>").cast("array<string>"), " ").alias("data"))


@add("m3_parse_expression", f"""
WITH {_DENSE} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 10 > 1 THEN l_linenumber END AS label,
  CASE WHEN l_partkey % 10 > 1 THEN array_to_string(data, ' ') END AS data FROM dense""")
def parse_expression(spark, folder):
    """The same as a column expression, with lines that cannot be read: a bad number, an index out of range."""
    bad = F.when(F.col("l_partkey") % 10 == 0, " 3:x").when(F.col("l_partkey") % 10 == 1, " 25:1").otherwise("")
    lines = sparse_lines(spark, folder).withColumn("line", F.concat("line", bad))
    parsed = lines.withColumn("p", arrays.sparse_to_dense(F.col("line"), 1, 24, strict=False))
    return parsed.select(*_KEYS, F.col("p.label")[0].alias("label"),
                         F.array_join(F.col("p.data").cast("array<int>").cast("array<string>"), " ").alias("data"))


@add("b7_write_sparse_text", f"""
WITH {_DENSE}, cells AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER () AS rid, data FROM dense),
flat AS (SELECT rid, unnest(data) AS x, generate_subscripts(data, 1) AS i FROM cells),
texts AS (SELECT rid, string_agg(i || ':' || x, ' ' ORDER BY i) AS t FROM flat WHERE x > 0 GROUP BY rid)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '0:' || l_linenumber || coalesce(' ' || t, '') AS line
FROM cells LEFT JOIN texts USING (rid)""")
def write_sparse_text(spark, folder):
    parsed = sparse_lines(spark, folder).withColumn("p", arrays.sparse_to_dense(F.col("line"), 1, 24))
    return parsed.select(*_KEYS, arrays.sparse_text(F.col("p.label"), F.col("p.data").cast("array<int>")).alias("line"))


# -- array functions --------------------------------------------------------------------


@add("j2_reshape", f"""
WITH {_EMB}, shaped AS (SELECT vec_id, unnest(range(8)) AS i, v FROM emb)
SELECT vec_id, CAST(i AS INTEGER) AS row_no, '8x8' AS shape, round(list_sum(list_slice(v, i * 8 + 1, i * 8 + 8)), 6) AS row_sum
FROM shaped""")
def reshape(spark, folder):
    shaped = embeddings(spark, folder).withColumn("s", arrays.reshape(F.col("v"), (8, -1)))
    rows = shaped.select("vec_id", F.array_join(F.col("s.shape").cast("array<string>"), "x").alias("shape"),
                         F.posexplode(arrays.rows_of(F.col("s.flat"), 8)).alias("row_no", "row"))
    return rows.select("vec_id", "row_no", "shape", F.round(arrays.total(F.col("row")), 6).alias("row_sum"))


mapped("j7_elementwise_sum", lambda: arrays.elementwise("SUM", F.col("v"), F.col("r"), F.col("v")),
       "list_transform(v, lambda x, i: x + r[i] + x)")
mapped("j7_elementwise_mul", lambda: arrays.elementwise("MUL", F.col("v"), F.col("r")), "list_transform(v, lambda x, i: x * r[i])")
mapped("j7_elementwise_div", lambda: arrays.elementwise("DIV", F.col("v"), F.transform("r", lambda x: x * x + 1)),
       "list_transform(v, lambda x, i: x / (r[i] * r[i] + 1))")
mapped("j7_elementwise_max", lambda: arrays.elementwise("MAX", F.col("v"), F.col("r")), "list_transform(v, lambda x, i: greatest(x, r[i]))")
mapped("j8_scale_shift", lambda: arrays.scale_shift(F.col("v"), (0.5, 1.0, 2.0, -1.0), (0.0, 0.1, 0.2, 0.3), inner=16),
       "list_transform(v, lambda x, i: x * [0.5, 1.0, 2.0, -1.0][(i - 1) // 16 + 1] + [0.0, 0.1, 0.2, 0.3][(i - 1) // 16 + 1])")
mapped("j9_l2_normalize", lambda: arrays.l2_normalize(F.col("v"), 20.0),
       "list_transform(v, lambda x: x / (sqrt(list_sum(list_transform(v, lambda y: y * y))) + 1e-10) * 20.0)")
mapped("j10_array_crop", lambda: arrays.crop(F.col("v"), F.slice("r", 1, 10), 5), "list_slice(v, 6, 15)")
mapped("j12_array_concat", lambda: F.concat("v", "r"), "list_concat(v, r)")
mapped("j13_array_flatten", lambda: F.flatten(arrays.rows_of(F.col("r"), 16)), "r")


@add("j11_array_slices", f"""
WITH {_EMB} SELECT vec_id, CAST(piece AS INTEGER) AS piece, CAST(len(o) AS INTEGER) AS n, round(list_sum(o), 6) AS total FROM (
  SELECT vec_id, 0 AS piece, list_slice(v, 1, 10) AS o FROM emb
  UNION ALL SELECT vec_id, 1, list_slice(v, 11, 32) FROM emb
  UNION ALL SELECT vec_id, 2, list_slice(v, 33, 60) FROM emb)""")
def array_slices(spark, folder):
    pieces = embeddings(spark, folder).select(
        "vec_id", F.posexplode(F.array(*arrays.slices(F.col("v"), (10, 32, 60)))).alias("piece", "o"))
    return pieces.select("vec_id", "piece", F.size("o").alias("n"), F.round(arrays.total(F.col("o")), 6).alias("total"))


@add("j18_encode_chars", """
SELECT p_partkey, array_to_string(list_transform(range(16), lambda i: CASE WHEN i < length(p_name)
  AND instr('abcdefghijklmnopqrstuvwxyz ', substr(p_name, i + 1, 1)) > 0
  THEN instr('abcdefghijklmnopqrstuvwxyz ', substr(p_name, i + 1, 1)) - 1 ELSE 99 END), ' ') AS codes FROM part""")
def encode_chars(spark, folder):
    codes = arrays.encode_chars(F.col("p_name"), "abcdefghijklmnopqrstuvwxyz ")
    return inputs.load_table(spark, folder, "part").select(
        "p_partkey", F.array_join(codes.cast("array<string>"), " ").alias("codes"))


# -- group means ---------------------------------------------------------------------------

_MEANS = f"""
WITH {_EMB},
flat AS (SELECT vec_id, label, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS pos, unnest(v) AS x FROM emb),
means AS (SELECT label, pos, avg(x) AS m, count(*) AS n FROM flat GROUP BY label, pos)"""


@add("e5_group_mean_vector", f"{_MEANS} SELECT label, n, pos, round(m, 6) AS x FROM means")
def group_mean_vector(spark, folder):
    return cells(metrics.group_mean_vector(embeddings(spark, folder), "label", "v", SIZE), "mean", "label", "n")


@add("e5_group_mean_vector_any_size", f"{_MEANS} SELECT label, n, pos, round(m, 6) AS x FROM means")
def group_mean_vector_any_size(spark, folder):
    return cells(metrics.group_mean_vector(embeddings(spark, folder), "label", "v"), "mean", "label", "n")


@add("j19_center_vector", f"{_MEANS} SELECT vec_id, pos, round(x - m, 6) AS x FROM flat JOIN means USING (label, pos)")
def center_vector(spark, folder):
    return cells(metrics.center_vectors(embeddings(spark, folder), "label", "v", SIZE), "centered", "vec_id")


# -- scores -------------------------------------------------------------------------------------

_PRED = f"{_EMB}, pred AS (SELECT vec_id, label, v AS s FROM emb)"
_CELLS = f"""{_PRED},
cells AS (SELECT vec_id, label, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS node, unnest(s) AS x FROM pred)"""


def predictions(spark, folder):
    """A score per class and sample: the components of the embedding."""
    return embeddings(spark, folder).select("vec_id", "label", F.col("v").alias("scores"))


@add("e6_accuracy", f"""
WITH {_PRED} SELECT count(*) AS n, round(avg(CAST(list_position(s, list_max(s)) - 1 = label AS INTEGER)), 9) AS accuracy FROM pred""")
def accuracy(spark, folder):
    return metrics.accuracy(predictions(spark, folder)).withColumn("accuracy", F.round("accuracy", 9))


@add("e7_euclidean_loss", f"""
WITH {_EMB}, cells AS (SELECT vec_id, unnest(v) AS o, unnest(r) AS t FROM emb)
SELECT round(sum((o - t) * (o - t) * abs(o)) / (2 * (SELECT count(*) FROM emb)) * 0.5, 6) AS loss FROM cells""")
def euclidean_loss(spark, folder):
    weighted = embeddings(spark, folder).withColumn("w", F.transform("v", F.abs))
    return metrics.euclidean_loss(weighted, "v", "r", "w", 0.5).withColumn("loss", F.round("loss", 6))


@add("e8_softmax_loss", f"""
WITH {_CELLS}, sums AS (SELECT vec_id, ln(sum(exp(x))) AS z, max(x) FILTER (node = label) AS y FROM cells GROUP BY vec_id)
SELECT round(avg(z - y), 6) AS loss FROM sums""")
def softmax_loss(spark, folder):
    return metrics.softmax_loss(predictions(spark, folder)).withColumn("loss", F.round("loss", 6))


# a class tree over the scores: two roots (parent below 0), then three children of each class in turn
PARENTS = (-1, -1, *((n - 2) // 3 for n in range(2, SIZE)))
RANGES = ((0, 2), *((first, min(3, SIZE - first)) for first in range(2, SIZE, 3)))
_TREE = "tree(node, parent) AS (VALUES " + ", ".join(f"({n}, {p})" for n, p in enumerate(PARENTS)) + ")"
_GROUPED = f"""{_CELLS}, {_TREE},
probs AS (
  SELECT vec_id, label, node, exp(x) / sum(exp(x)) OVER (PARTITION BY vec_id, parent) AS p FROM cells JOIN tree USING (node))"""


@add("f9_group_softmax", f"WITH {_GROUPED} SELECT vec_id, node AS pos, round(p, 6) AS x FROM probs")
def group_softmax(spark, folder):
    return cells(predictions(spark, folder).withColumn("p", metrics.group_softmax(F.col("scores"), RANGES)), "p", "vec_id")


@add("e9_tree_softmax_loss", f"""
WITH RECURSIVE {_GROUPED},
labels_of AS (SELECT vec_id, CASE WHEN vec_id % 50 = 0 THEN -1 ELSE label END AS label FROM pred),
closure AS (
  SELECT node, node AS anc, parent FROM tree
  UNION ALL SELECT c.node, t.node, t.parent FROM closure c JOIN tree t ON t.node = c.parent)
SELECT round(sum(-ln(greatest(p, 1.17549435e-38))) / (SELECT count(*) FROM pred), 6) AS loss
FROM labels_of l JOIN closure c ON c.node = l.label JOIN probs p ON p.vec_id = l.vec_id AND p.node = c.anc""")
def tree_softmax_loss(spark, folder):
    tree = spark.createDataFrame(list(enumerate(PARENTS)), "node long, parent long")
    probs = predictions(spark, folder).select(
        F.when(F.col("vec_id") % 50 == 0, -1).otherwise(F.col("label")).alias("label"),
        metrics.group_softmax(F.col("scores"), RANGES).alias("prob"))
    loss = metrics.tree_softmax_loss(probs, metrics.tree_paths(tree), ignore_label=-1)
    return loss.withColumn("loss", F.round("loss", 6))


_ORDER_TREE = """
nodes AS (SELECT o_orderkey AS node, CASE WHEN o_orderkey = 0 THEN -1 ELSE (o_orderkey - 1) // 4 END AS parent FROM orders)"""


def order_tree(spark, folder):
    key = F.col("o_orderkey")
    return inputs.load_table(spark, folder, "orders").select(
        key.alias("node"), F.when(key == 0, -1).otherwise(F.floor((key - 1) / 4)).cast("long").alias("parent"))


@add("l1_tree_groups", f"""
WITH {_ORDER_TREE} SELECT parent, row_number() OVER (ORDER BY "offset") - 1 AS grp, "offset", size FROM (
  SELECT parent, min(node) AS "offset", count(*) AS size FROM nodes GROUP BY parent)""")
def tree_groups(spark, folder):
    return metrics.tree_groups(order_tree(spark, folder))


@add("l2_tree_path_closure", f"""
WITH RECURSIVE {_ORDER_TREE},
closure AS (
  SELECT node, node AS ancestor, 0 AS distance, parent FROM nodes
  UNION ALL SELECT c.node, t.node, c.distance + 1, t.parent FROM closure c JOIN nodes t ON t.node = c.parent)
SELECT node, ancestor, distance FROM closure""")
def tree_path_closure(spark, folder):
    return metrics.tree_path_closure(order_tree(spark, folder))


# -- pixels ----------------------------------------------------------------------------------------

# 64 values per image and two zeros, read as 2 x 11 pixels of three channels
HEIGHT, WIDTH = 2, 11
PIXELS = HEIGHT * WIDTH
_PIXELS = """px AS (SELECT vec_id, list_concat(list_transform(embedding, lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 1000) % 256 AS DOUBLE)),
  [0.0::DOUBLE, 0.0::DOUBLE]) AS p FROM embeddings)"""
_FLAT = f"""{_PIXELS},
flat AS (SELECT vec_id, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, unnest(p) AS x FROM px),
gray AS (SELECT vec_id, pos // 3 AS pixel, max(x) FILTER (pos % 3 = 0) * 0.299::DOUBLE + max(x) FILTER (pos % 3 = 1) * 0.587::DOUBLE
    + max(x) FILTER (pos % 3 = 2) * 0.114::DOUBLE AS g FROM flat GROUP BY ALL)"""


def pixels(spark, folder):
    values = F.transform("v", lambda x: (F.floor(F.abs(x) * 1000) % 256).cast("double"))
    return embeddings(spark, folder).select("vec_id", F.concat(values, F.array(F.lit(0.0), F.lit(0.0))).alias("p"))


@add("j14_restore_image", f"""
WITH {_PIXELS}, s AS (SELECT vec_id, CAST(unnest(range({3 * PIXELS})) AS INTEGER) AS pos, list_transform(p, lambda x: x / 3 - 20) AS p FROM px)
SELECT vec_id, pos, CAST(((trunc(p[(2 - pos % 3) * {PIXELS} + pos // 3 + 1] + [104.0, 117.0, 123.0][2 - pos % 3 + 1]) % 256) + 256) % 256 AS INTEGER) AS x
FROM s""")
def restore_image(spark, folder):
    data = pixels(spark, folder).withColumn("p", F.transform("p", lambda x: x / 3 - 20))
    return data.select("vec_id", F.posexplode(images.restore_image(F.col("p"), HEIGHT, WIDTH)).alias("pos", "x"))


_B, _C = inputs.sql_hash01("5brightness", "vec_id"), inputs.sql_hash01("5contrast", "vec_id")


@add("j15_pixel_jitter", f"""
WITH {_FLAT},
draws AS (SELECT vec_id, {inputs.sql_hash32('5order', 'vec_id')} % 2 AS turn, {_B} + 0.3::DOUBLE AS b, {_C} + 0.5::DOUBLE AS c FROM px),
means AS (SELECT vec_id, avg(g) AS m FROM gray GROUP BY vec_id),
bright AS (SELECT vec_id, pos, least(greatest(x * b, 0.0), 255.0) AS x FROM flat JOIN draws USING (vec_id)),
bright_means AS (
  SELECT vec_id, sum(x * CASE pos % 3 WHEN 0 THEN 0.299::DOUBLE WHEN 1 THEN 0.587::DOUBLE ELSE 0.114::DOUBLE END) / {PIXELS} AS m
  FROM bright GROUP BY vec_id)
SELECT vec_id, f.pos, round(CASE WHEN turn = 0
    THEN least(greatest(bright.x * c + (1 - c) * bm.m, 0.0), 255.0)
    ELSE least(greatest(least(greatest(f.x * c + (1 - c) * means.m, 0.0), 255.0) * b, 0.0), 255.0) END, 6) AS x
FROM flat f JOIN draws USING (vec_id) JOIN means USING (vec_id) JOIN bright_means bm USING (vec_id)
JOIN bright ON bright.vec_id = f.vec_id AND bright.pos = f.pos""")
def pixel_jitter(spark, folder):
    out = pixel_ops.pixel_jitter(pixels(spark, folder), "p", "vec_id", enabled=("brightness", "contrast"), seed=5)
    return cells(out, "p", "vec_id")


@add("j15_saturation", f"""
WITH {_FLAT}, draws AS (SELECT vec_id, {inputs.sql_hash01('6saturation', 'vec_id')} + 0.5::DOUBLE AS a FROM px)
SELECT vec_id, pos, round(least(greatest(x * a + (1 - a) * g, 0.0), 255.0), 6) AS x
FROM flat JOIN draws USING (vec_id) JOIN gray USING (vec_id) WHERE gray.pixel = pos // 3""")
def saturation(spark, folder):
    return cells(pixel_ops.pixel_jitter(pixels(spark, folder), "p", "vec_id", enabled=("saturation",), seed=6), "p", "vec_id")


_NOISE = ", ".join(
    f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {inputs.sql_hash01(f'3light{i}', 'vec_id')})) "
    f"* cos(2.0::DOUBLE * pi() * {inputs.sql_hash01(f'3light{i + 3}', 'vec_id')}) * 0.5::DOUBLE AS n{i + 1}" for i in range(3))


def _sql_direction(i):
    """The unit vector of eigenvalue ``e{i}``: the longest cross product of two rows of (covariance - e I), largest part positive."""
    rows = [(f"(caa - e{i})", "cab", "cac"), ("cab", f"(cbb - e{i})", "cbc"), ("cac", "cbc", f"(ccc - e{i})")]
    crosses = []
    for (ax, ay, az), (bx, by, bz) in ((rows[0], rows[1]), (rows[0], rows[2]), (rows[1], rows[2])):
        x, y, z = f"{ay} * {bz} - {az} * {by}", f"{az} * {bx} - {ax} * {bz}", f"{ax} * {by} - {ay} * {bx}"
        crosses.append(f"{{'l': sqrt(pow({x}, 2) + pow({y}, 2) + pow({z}, 2)), 'v': [{x}, {y}, {z}]}}")
    return f"list_max([{', '.join(crosses)}]) AS d{i}"


def _sql_step(i):
    """Direction ``i`` with its sign, times its eigenvalue and noise."""
    sign = f"CASE WHEN list_filter(d{i}.v, lambda x: abs(x) = list_max(list_transform(d{i}.v, lambda y: abs(y))))[1] < 0 THEN -1.0 ELSE 1.0 END"
    return f"list_transform(d{i}.v, lambda x: x / d{i}.l * {sign} * e{i} * n{i}) AS s{i}"


@add("j16_lighting_jitter", f"""
WITH {_FLAT},
cells3 AS (SELECT vec_id, pos // 3 AS pixel, max(x) FILTER (pos % 3 = 0) / 255 AS a, max(x) FILTER (pos % 3 = 1) / 255 AS b,
  max(x) FILTER (pos % 3 = 2) / 255 AS c FROM flat GROUP BY ALL),
moments AS (SELECT vec_id, var_samp(a) AS caa, var_samp(b) AS cbb, var_samp(c) AS ccc, covar_samp(a, b) AS cab,
  covar_samp(a, c) AS cac, covar_samp(b, c) AS cbc FROM cells3 GROUP BY vec_id),
shape AS (SELECT *, (caa + cbb + ccc) / 3 AS q, sqrt((pow(caa - q, 2) + pow(cbb - q, 2) + pow(ccc - q, 2)
  + 2 * (cab * cab + cac * cac + cbc * cbc)) / 6) AS w FROM moments),
angles AS (SELECT *, acos(greatest(-1.0, least(1.0, ((caa - q) * ((cbb - q) * (ccc - q) - cbc * cbc) - cab * (cab * (ccc - q) - cbc * cac)
  + cac * (cab * cbc - (cbb - q) * cac)) / (2 * w * w * w)))) / 3 AS phi FROM shape),
eigen AS (SELECT *, q + 2 * w * cos(phi) AS e3, q + 2 * w * cos(phi + 2 * pi() / 3) AS e1, 3 * q - e1 - e3 AS e2 FROM angles),
axes AS (SELECT vec_id, e1, e2, e3, {_NOISE}, {", ".join(map(_sql_direction, (1, 2, 3)))} FROM eigen),
steps AS (SELECT vec_id, {", ".join(map(_sql_step, (1, 2, 3)))} FROM axes)
SELECT vec_id, pos, round(least(greatest(x + 255 * (s1[pos % 3 + 1] + s2[pos % 3 + 1] + s3[pos % 3 + 1]), 0.0), 255.0), 4) AS x
FROM flat JOIN steps USING (vec_id)""")
def lighting_jitter(spark, folder):
    return cells(pixel_ops.pixel_jitter(pixels(spark, folder), "p", "vec_id", enabled=("lighting",), seed=3), "p", "vec_id", digits=4)


# the 64 values as 4 x 4 pixels of four channels, over the 16 pixels made of the reversed values
@add("j17_alpha_blend", f"""
WITH {_EMB}, px AS (SELECT vec_id, list_transform(v, lambda x: CAST(floor(abs(x) * 1000) % 256 AS DOUBLE)) AS p FROM emb),
s AS (SELECT vec_id, CAST(unnest(range(48)) AS INTEGER) AS pos, p, list_reverse(p) AS r FROM px)
SELECT vec_id, pos, CAST(floor(
    (r[pos // 3 * 4 + pos % 3 + 1] + r[pos // 3 * 4 + 4]) % 256 * (1 / 255.0::DOUBLE) * ((255 - p[pos // 3 * 4 + 4]) * (1 / 255.0::DOUBLE)) * 255.0::DOUBLE
    + p[pos // 3 * 4 + pos % 3 + 1] * (1 / 255.0::DOUBLE) * (p[pos // 3 * 4 + 4] * (1 / 255.0::DOUBLE)) * 255.0::DOUBLE) AS INTEGER) AS x
FROM s""")
def alpha_blend(spark, folder):
    overlay = F.transform("v", lambda x: (F.floor(F.abs(x) * 1000) % 256).cast("double"))
    data = embeddings(spark, folder).select("vec_id", overlay.alias("overlay")).withColumn("r", F.reverse("overlay"))

    def below(i):
        first = F.floor(i / 3).cast("int") * 4
        return (F.element_at("r", first + i % 3 + 1) + F.element_at("r", first + 4)) % 256

    background = F.transform(F.sequence(F.lit(0), F.lit(47)), below)
    return data.select("vec_id", F.posexplode(images.alpha_blend(background, F.col("overlay"))).alias("pos", "x"))
