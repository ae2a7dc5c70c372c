"""Queries over manifests, archives, messages, lookups and path functions."""

from __future__ import annotations

import io
import os
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from millrace.catalog import inputs
from millrace.catalog.registry import Registry
from millrace.functions import text
from millrace.operators import manifests
from millrace.session import materialize, scratch_path
from millrace.sources import archives as by_seeking
from millrace.sources import files as scans
from millrace.sources import sinks

registry = Registry()
add = registry.add
table = inputs.load_table


def s(column):
    return F.col(column).cast("string")


# -- image folders ------------------------------------------------------------------------

_EXT = "CASE page_id % 5 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.jpeg' WHEN 3 THEN '.jpg' ELSE '.txt' END"
_IMAGES = f"""
paths AS (
  SELECT page_id, '/data/sets/' || CASE WHEN page_id % 4 = 0 THEN '' ELSE 'set.' || page_id % 4 || '/' END
    || 'label' || page_id % 7 || '/' || page_id || {_EXT} AS path FROM pages),
manifest AS (
  SELECT page_id, path, 'label' || page_id % 7 AS label,
    '/data/sets' || CASE WHEN page_id % 4 = 0 THEN '' ELSE '/set.' || page_id % 4 END AS root
  FROM paths WHERE page_id % 5 IN (0, 1, 3))"""


def image_files(spark, folder):
    n = F.col("page_id")
    ext = F.element_at(F.array(*[F.lit(e) for e in (".jpg", ".PNG", ".jpeg", ".jpg", ".txt")]), (n % 5 + 1).cast("int"))
    group = F.when(n % 4 == 0, "").otherwise(F.concat(F.lit("set."), (n % 4).cast("string"), F.lit("/")))
    path = F.concat(F.lit("/data/sets/"), group, F.lit("label"), (n % 7).cast("string"), F.lit("/"), n.cast("string"), ext)
    return table(spark, folder, "pages").select(n, path.alias("path"))


def manifest(spark, folder):
    return manifests.image_manifest(image_files(spark, folder))


@add("a3_image_manifest", f"WITH {_IMAGES} SELECT page_id, path, label, root FROM manifest")
def image_manifest(spark, folder):
    return manifest(spark, folder)


@add("a3_scan_image_folder", """
SELECT page_id, 'label=' || page_id % 7 AS label, 'set=' || page_id % 4 AS root FROM pages WHERE page_id % 5 <> 4""")
def scan_image_folder(spark, folder):
    """Files of at most 1,000 page ids are written into label folders, some with another extension, then the folder is scanned."""
    path = scratch_path(spark, "image-folder")
    n = F.col("page_id")
    rows = table(spark, folder, "pages").select(n, (n % 4).alias("set"), (n % 7).alias("label")).repartition("set", "label", F.floor(n / 10_000))
    for part, extension in ((rows.filter(n % 5 != 4), "jpg"), (rows.filter(n % 5 == 4), "txt")):
        part.write.mode("append").partitionBy("set", "label").option("maxRecordsPerFile", 1000).option("extension", extension).csv(path)
    files = scans.image_folder(spark, path, content=True)
    ids = F.explode(F.split(F.rtrim(F.decode("content", "UTF-8"), F.lit("\n")), "\n"))
    found = files.select(ids.alias("page_id"), "label", F.substring_index("root", "/", -1).alias("root"))
    return found.withColumn("page_id", F.col("page_id").cast("long"))


@add("e2_label_counts", f"WITH {_IMAGES} SELECT label, count(*) AS n FROM manifest GROUP BY label")
def label_counts(spark, folder):
    return manifests.label_counts(manifest(spark, folder))


@add("f2_cap_per_label", f"""
WITH {_IMAGES} SELECT page_id, path, label, root FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY path) AS rn FROM manifest) WHERE rn <= 10""")
def cap_per_label(spark, folder):
    return manifests.cap_per_label(manifest(spark, folder), 10)


@add("g6_sorted_scan", f"WITH {_IMAGES} SELECT page_id, path FROM paths ORDER BY path")
def sorted_scan(spark, folder):
    return manifests.sorted_scan(image_files(spark, folder))


@add("b1_write_image_list", f"""
WITH {_IMAGES}
SELECT CASE WHEN root = '/data/sets' THEN 'images.txt' ELSE replace(substr(root, 12), '.', '_') || '_images.txt' END AS list,
  substr(path, 12) || ' ' || label AS line FROM manifest""")
def write_image_list(spark, folder):
    path = scratch_path(spark, "image-list")
    sinks.write_image_list(manifest(spark, folder), "/data/sets", path)
    return spark.read.text(path).select("list", F.col("value").alias("line"))


def pixel_images(spark, folder):
    """Images of 64 pixels from the embeddings; the root is the label."""
    pixels = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1000).cast("int"))
    return table(spark, folder, "embeddings").select(
        "vec_id", F.concat(F.lit("r"), s("label")).alias("root"), pixels.alias("pixels"), "label")


_PIXEL_MEANS = """
flat AS (
  SELECT vec_id, label, 'r' || label AS root, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
    floor(abs(CAST(unnest(embedding) AS DOUBLE)) * 1000) AS x FROM embeddings),
means AS (SELECT root, pos, avg(x) AS m FROM flat GROUP BY root, pos)"""


@add("b2_write_group_mean", f"WITH {_PIXEL_MEANS} SELECT root, pos, round(m, 6) AS mean FROM means")
def write_group_mean(spark, folder):
    path = scratch_path(spark, "means")
    sinks.write_group_mean(pixel_images(spark, folder), path, size=64)
    rows = spark.read.parquet(path).select("root", F.posexplode("mean").alias("pos", "mean"))
    return rows.withColumn("mean", F.round("mean", 6))


@add("b3_write_centered_dataset", f"""
WITH {_PIXEL_MEANS} SELECT vec_id, root, CAST(label AS DOUBLE) AS label, pos, round(CAST(CAST(x - m AS FLOAT) AS DOUBLE), 3) AS x
FROM flat JOIN means USING (root, pos)""")
def write_centered_dataset(spark, folder):
    path = scratch_path(spark, "centered")
    sinks.write_centered_dataset(pixel_images(spark, folder), path, size=64)
    rows = spark.read.parquet(path).select(
        "vec_id", "root", F.col("label").cast("double").alias("label"), F.posexplode("data").alias("pos", "x"))
    return rows.withColumn("x", F.round(F.col("x").cast("double"), 3))


# -- archives --------------------------------------------------------------------------------


def _zipped(batches):
    for batch in batches:
        packed = []
        for key, source, body in zip(batch["doc_id"], batch["source"], batch["text"], strict=True):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"{source}/{key}.txt", body)
                archive.writestr(f"{source}/.hidden", "")
            packed.append(buffer.getvalue())
        yield pd.DataFrame({"path": [f"a{k}.zip" for k in batch["doc_id"]], "content": packed})


@add("a4_scan_zip_members", """
SELECT 'a' || doc_id || '.zip' AS archive, source || '/' || doc_id || '.txt' AS member,
  CAST(octet_length(encode(text)) AS BIGINT) AS size, md5(text) AS digest FROM documents
UNION ALL
SELECT 'a' || doc_id || '.zip', source || '/.hidden', CAST(0 AS BIGINT), md5('') FROM documents""")
def scan_zip_members(spark, folder):
    """Every document becomes a zip archive of two members, which are then scanned."""
    packed = table(spark, folder, "documents").select("doc_id", "source", "text").mapInPandas(
        _zipped, "path string, content binary")
    return scans.zip_members(packed).select("archive", "member", "size", F.md5("content").alias("digest"))


@add("a4_read_listed_members", """
SELECT 'a' || doc_id || '.zip' AS archive, source || '/' || doc_id || '.txt' AS member, md5(text) AS digest FROM documents""")
def read_listed_members(spark, folder):
    """Members are listed without unpacking, and all that have the wanted extension are read; hidden ones are passed over."""
    packed = materialize(table(spark, folder, "documents").select("doc_id", "source", "text").mapInPandas(
        _zipped, "path string, content binary"))
    names = scans.zip_members(packed, read=False, extensions=(".txt",))
    return scans.listed_members(packed, names).select("archive", "member", F.md5("content").alias("digest"))


DOCUMENTS_PER_ARCHIVE = 250


def _write_archives(folder):
    """Tasks that write one archive per value of ``archive``; rows of an archive follow each other."""
    def write(batches):
        name = archive = None

        def finish():
            if archive is not None:
                archive.close()
                os.replace(f"{folder}/{name}.part{os.getpid()}", f"{folder}/{name}")

        for batch in batches:
            for target, key, source, body in zip(batch["archive"], batch["doc_id"], batch["source"], batch["text"], strict=True):
                if target != name:
                    finish()
                    name, archive = target, zipfile.ZipFile(f"{folder}/{target}.part{os.getpid()}", "w", zipfile.ZIP_DEFLATED)
                archive.writestr(f"{source}/{key}.txt", body)
                archive.writestr(f"{source}/.{key}", "")
        finish()
        yield from ()

    return write


@add("a4_seek_archive_members", f"""
SELECT 'a' || (doc_id // {DOCUMENTS_PER_ARCHIVE}) || '.zip' AS archive, source || '/' || doc_id || '.txt' AS member,
  CAST(octet_length(encode(text)) AS BIGINT) AS size, md5(text) AS digest FROM documents""")
def seek_archive_members(spark, folder):
    """Documents are written into archives of some hundred; the members that are not empty are listed, then read by seeking."""
    path = scratch_path(spark, "archives").removeprefix("file:")
    os.makedirs(path)
    name = F.concat(F.lit("a"), F.floor(F.col("doc_id") / DOCUMENTS_PER_ARCHIVE).cast("string"), F.lit(".zip"))
    docs = table(spark, folder, "documents").select(name.alias("archive"), "doc_id", "source", "text")
    (docs.repartition("archive").sortWithinPartitions("archive", "doc_id").mapInPandas(_write_archives(path), "archive string")
     .write.format("noop").mode("overwrite").save())
    found = by_seeking.read_members(by_seeking.archive_directory(spark, path).filter("size > 0"))
    return found.select(F.substring_index("archive", "/", -1).alias("archive"), "member", "size", F.md5("content").alias("digest"))


_MEMBERS = """
members AS (
  SELECT p_partkey, CASE WHEN p_partkey % 17 = 0 THEN '.' ELSE '' END || p_brand || '/' || p_partkey
      || CASE p_size % 5 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.txt' WHEN 3 THEN '.bmp' ELSE '/' END AS member,
    p_partkey % 7 * 100 AS size FROM part),
good AS (
  SELECT * FROM members WHERE NOT ends_with(member, '/') AND NOT starts_with(member, '.') AND size > 0
    AND (lower(member) LIKE '%.jpg' OR lower(member) LIKE '%.png' OR lower(member) LIKE '%.bmp'))"""
_CLASS_LINES = """
map_lines AS (
  SELECT p_partkey, CASE p_partkey % 20 WHEN 0 THEN '  ' WHEN 1 THEN 'noat.jpg' || chr(9) || '5' WHEN 2 THEN 'a.zip@/only'
    WHEN 3 THEN 'a.zip@/x/3.jpg' || chr(9) || 'bad'
    ELSE 'a.zip@/' || p_brand || '/' || p_partkey || CASE p_size % 5 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' ELSE '.bmp' END
      || chr(9) || chr(9) || p_size END AS line, p_brand, p_size FROM part),
class_map AS (
  SELECT p_partkey, CASE WHEN p_partkey % 20 > 3 THEN p_brand || '/' || p_partkey
      || CASE p_size % 5 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' ELSE '.bmp' END END AS member,
    CASE WHEN p_partkey % 20 > 3 THEN p_size END AS class_idx,
    CASE p_partkey % 20 WHEN 1 THEN 'no @ in class' WHEN 2 THEN 'too few fields' WHEN 3 THEN 'bad index' END AS error
  FROM part WHERE p_partkey % 20 <> 0)"""


def _pick(index, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def archive_members(spark, folder):
    name = F.concat(F.when(F.col("p_partkey") % 17 == 0, ".").otherwise(""), "p_brand", F.lit("/"), s("p_partkey"),
                    _pick(F.col("p_size") % 5, (".jpg", ".PNG", ".txt", ".bmp", "/")))
    return table(spark, folder, "part").select("p_partkey", name.alias("member"), (F.col("p_partkey") % 7 * 100).alias("size"))


def class_lines(spark, folder):
    n = F.col("p_partkey") % 20
    entry = F.concat(F.lit("a.zip@/"), "p_brand", F.lit("/"), s("p_partkey"),
                     _pick(F.col("p_size") % 5, (".jpg", ".PNG", ".bmp", ".bmp", ".bmp")), F.lit("\t\t"), s("p_size"))
    line = (F.when(n == 0, "  ").when(n == 1, "noat.jpg\t5").when(n == 2, "a.zip@/only").when(n == 3, "a.zip@/x/3.jpg\tbad")
            .otherwise(entry))
    return table(spark, folder, "part").select("p_partkey", line.alias("line"))


def class_map(spark, folder):
    return manifests.class_map(class_lines(spark, folder))


@add("a5_class_map", f"WITH {_CLASS_LINES} SELECT p_partkey, member, class_idx, error FROM class_map")
def parsed_class_map(spark, folder):
    return class_map(spark, folder).select("p_partkey", "member", "class_idx", "error")


@add("a5_scan_class_map", f"""
WITH {_CLASS_LINES} SELECT line, c.member, c.class_idx, c.error FROM class_map c JOIN map_lines USING (p_partkey)""")
def scan_class_map(spark, folder):
    """The map's lines are written as text, then scanned."""
    path = scratch_path(spark, "class-map")
    class_lines(spark, folder).select("line").write.text(path)
    return scans.class_map_file(spark, path).select("line", "member", "class_idx", "error")


@add("c1_filter_archive_members", f"WITH {_MEMBERS} SELECT p_partkey, member, size FROM good")
def filter_archive_members(spark, folder):
    return manifests.filter_archive_members(archive_members(spark, folder))


@add("d1_join_archive_labels", f"""
WITH {_MEMBERS}, {_CLASS_LINES} SELECT g.member, g.p_partkey, g.size, c.class_idx
FROM good g JOIN class_map c ON c.member = g.member WHERE c.error IS NULL""")
def join_archive_labels(spark, folder):
    mapping = class_map(spark, folder).filter("error IS NULL").select("member", "class_idx")
    return manifests.join_archive_labels(manifests.filter_archive_members(archive_members(spark, folder)), mapping)


@add("d2_check_unique_label", """
SELECT member, min(idx) AS low, max(idx) AS high FROM (
  SELECT p_brand || '/' || p_partkey % 50 AS member, p_size % 3 AS idx FROM part) GROUP BY member HAVING min(idx) <> max(idx)""")
def check_unique_label(spark, folder):
    mapping = table(spark, folder, "part").select(
        F.concat("p_brand", F.lit("/"), (F.col("p_partkey") % 50).cast("string")).alias("member"),
        (F.col("p_size") % 3).alias("class_idx"))
    return manifests.check_unique_label(mapping)


_LISTED = "SELECT 'set.zip@/' || p_brand || '/' || p_partkey || '.jpg' AS path FROM part"


def listed_names(spark, folder):
    return table(spark, folder, "part").select(F.concat("p_brand", F.lit("/"), s("p_partkey"), F.lit(".jpg")).alias("line"))


@add("a6_image_list", _LISTED)
def image_list(spark, folder):
    return scans.image_list(listed_names(spark, folder), "set.zip")


@add("a6_scan_image_list", _LISTED)
def scan_image_list(spark, folder):
    """The list is written as text, then scanned."""
    path = scratch_path(spark, "image-list")
    listed_names(spark, folder).write.text(path)
    return scans.image_list_file(spark, path, "set.zip")


@add("c4_filter_carry_over", """
SELECT p_partkey, name FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Log' WHEN 1 THEN 'EVAL'
  WHEN 2 THEN 'Model.' || p_partkey WHEN 3 THEN 'logs' ELSE p_name END AS name FROM part)
WHERE lower(name) NOT IN ('log', 'eval') AND NOT starts_with(lower(name), 'model.')""")
def filter_carry_over(spark, folder):
    n = F.col("p_partkey") % 5
    name = (F.when(n == 0, "Log").when(n == 1, "EVAL").when(n == 2, F.concat(F.lit("Model."), s("p_partkey")))
            .when(n == 3, "logs").otherwise(F.col("p_name")))
    return manifests.filter_carry_over(table(spark, folder, "part").select("p_partkey", name.alias("name")))


_PROPERTIES = """
SELECT c_nationkey AS file, c_mktsegment AS key, arg_max(c_name || '=' || c_custkey, c_custkey) AS value
FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 10 <> 5 GROUP BY c_nationkey, c_mktsegment"""


def property_lines(spark, folder):
    n = F.col("c_custkey") % 10
    line = (F.when(n == 0, F.concat(F.lit("#"), "c_mktsegment", F.lit("=no"))).when(n == 5, F.lit("no assignment"))
            .otherwise(F.concat(F.lit(" "), "c_mktsegment", F.lit(" = "), "c_name", F.lit("="), s("c_custkey"), F.lit(" "))))
    return table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("file"), F.col("c_custkey").alias("line_no"), line.alias("line"))


@add("a7_properties", _PROPERTIES)
def parsed_properties(spark, folder):
    return manifests.properties(property_lines(spark, folder))


@add("a7_scan_properties", _PROPERTIES)
def scan_properties(spark, folder):
    """A file per nation is written, its lines in order, then scanned."""
    path = scratch_path(spark, "properties")
    ordered = property_lines(spark, folder).repartition("file").sortWithinPartitions("file", "line_no")
    ordered.select("file", F.col("line").alias("value")).write.partitionBy("file").text(path)
    found = scans.properties_files(spark, path)
    return found.withColumn("file", F.regexp_extract("file", "file=([0-9]+)/", 1).cast("int"))


# -- lookups -------------------------------------------------------------------------------------


@add("d6_lookup_with_default", """
WITH racks AS (
  SELECT 'host' || s_suppkey % 40 AS host, arg_max('/rack' || s_nationkey, s_suppkey) AS rack FROM supplier GROUP BY 1)
SELECT c_custkey, h.host, coalesce(rack, '/default/rack') AS rack
FROM (SELECT c_custkey, 'host' || c_custkey % 60 AS host FROM customer) h LEFT JOIN racks r ON r.host = h.host""")
def lookup_with_default(spark, folder):
    line = F.concat(F.lit("host"), (F.col("s_suppkey") % 40).cast("string"), F.lit("  /rack"), s("s_nationkey"))
    topology = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("line_no"), line.alias("line"))
    hosts = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("host"), (F.col("c_custkey") % 60).cast("string")).alias("host"))
    return manifests.lookup_with_default(hosts, topology, "/default/rack")


@add("d8_tag_latest", """
WITH latest AS (SELECT DISTINCT 'g' || p_brand AS grp, p_type || ':' || p_size AS name_tag FROM part WHERE p_size > 40)
SELECT p_partkey, p_size, 'g' || p_brand AS "group", p_type || ':' || p_size AS name_tag,
  ('g' || p_brand, p_type || ':' || p_size) IN (SELECT (grp, name_tag) FROM latest) AS is_latest FROM part""")
def tag_latest(spark, folder):
    images = table(spark, folder, "part").select(
        "p_partkey", "p_size", F.concat(F.lit("g"), "p_brand").alias("group"), F.concat("p_type", F.lit(":"), s("p_size")).alias("name_tag"))
    return manifests.tag_latest(images, images.filter(F.col("p_size") > 40).select("group", "name_tag"))


@add("h1_changed_minus_deleted", """
SELECT unnest(string_split(o_orderpriority || ';' || o_orderstatus || ';img/' || o_custkey, ';')) AS name FROM orders
EXCEPT ALL
SELECT unnest(string_split(o_orderstatus || ';img/' || o_custkey, ';')) FROM orders WHERE o_orderstatus = 'F'""")
def changed_minus_deleted(spark, folder):
    orders = table(spark, folder, "orders")
    image = F.concat(F.lit("img/"), s("o_custkey"))
    changed = orders.select(F.concat_ws(";", "o_orderpriority", "o_orderstatus", image).alias("names"))
    deleted = orders.filter("o_orderstatus = 'F'").select(F.concat_ws(";", "o_orderstatus", image).alias("names"))
    return manifests.changed_minus_deleted(changed, deleted)


# -- messages ------------------------------------------------------------------------------------


@add("c8_project_message_paths", """
SELECT page_id, CASE WHEN starts_with(base, '/jobs/') OR starts_with(base, '/hdfs/') THEN base || '.zip@/' || name
  ELSE base || '/' || name END AS image_path
FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/hdfs/set1' WHEN 1 THEN '/jobs/set2' ELSE '/local/set3' END AS base,
  regexp_extract(url, '([^/]*)$', 1) AS name FROM pages)""")
def project_message_paths(spark, folder):
    base = F.when(F.col("page_id") % 3 == 0, "/hdfs/set1").when(F.col("page_id") % 3 == 1, "/jobs/set2").otherwise("/local/set3")
    return table(spark, folder, "pages").select(
        "page_id", text.message_path(F.col("url"), base, ("/jobs/", "/hdfs/")).alias("image_path"))


@add("c9_add_default_fields", """
SELECT page_id, url AS image_path, 'US' AS region, '-1' AS trip_id, CAST(0.0 AS DOUBLE) AS lat, CAST(0.0 AS DOUBLE) AS lon,
  -1 AS sequence, true AS on_road FROM pages""")
def add_default_fields(spark, folder):
    messages = table(spark, folder, "pages").select("page_id", F.col("url").alias("image_path"))
    return manifests.add_default_fields(messages, {
        "image_path": "", "region": "US", "trip_id": "-1", "lat": 0.0, "lon": 0.0, "sequence": -1, "on_road": True})


@add("g2_limit_n", "SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT 25")
def limit_n(spark, folder):
    return manifests.limit_n(table(spark, folder, "conversations").select("conv_id", "turn", "role"), 25, ["conv_id", "turn"])


@add("g10_shard_assign", f"SELECT doc_id, CAST({inputs.sql_hash32('shards', 'doc_id')} % 8 AS INTEGER) AS shard FROM documents")
def shard_assign(spark, folder):
    return manifests.shard_assign(table(spark, folder, "documents").select("doc_id"), 8, F.col("doc_id"), seed="shards")


@add("b4_write_jsonl_verified", "SELECT conv_id, turn, role, text FROM conversations")
def write_jsonl_verified(spark, folder):
    messages = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch_path(spark, "messages")
    sinks.write_jsonl_verified(messages, path, messages.count())
    return spark.read.schema("conv_id long, turn long, role string, text string").json(path)


@add("j20_map_class_key", """
SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS key, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'good' WHEN '2' THEN 'bad'
  WHEN '3' THEN 'unsure' END AS cls FROM orders""")
def map_class_key(spark, folder):
    keys = table(spark, folder, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("key"))
    return manifests.map_class_key(keys, '{"1": "good", "2": "bad", "3": "unsure"}')


# -- strings and paths ----------------------------------------------------------------------------


@add("i5_rewrite_config", r"""
SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'snapshot_prefix: "/out/model/snap/m' || s_suppkey || '"'
  WHEN 1 THEN ' MAX_ITER: ' || s_suppkey * 10 ELSE 'base_lr: 0.01' END AS line,
  CASE WHEN s_suppkey % 3 = 1 THEN s_suppkey * 10 END AS max_iter FROM supplier""")
def rewrite_config(spark, folder):
    n = F.col("s_suppkey")
    line = (F.when(n % 3 == 0, F.concat(F.lit('Snapshot_Prefix: "snap\\m'), s("s_suppkey"), F.lit('"')))
            .when(n % 3 == 1, F.concat(F.lit(" MAX_ITER: "), (n * 10).cast("string"))).otherwise("base_lr: 0.01"))
    return table(spark, folder, "supplier").select(
        n, text.rewrite_solver_line(line, "/out/model").alias("line"), text.solver_max_iter(line).alias("max_iter"))


@add("i6_substitute_placeholders", """
SELECT c_custkey, c_name || ':/data/x;/data/y:' || c_mktsegment AS dollar, 'in=/m/' || c_custkey || ',[#model] out=' || c_name AS hash
FROM customer""")
def substitute_placeholders(spark, folder):
    dollar = text.substitute(F.lit("$Name$:$DataDir$/x;$DataDir$/y:$Segment$"),
                             {"Name": F.col("c_name"), "DataDir": "/data", "Segment": F.col("c_mktsegment")})
    hashed = text.substitute(F.lit("in=[#model],[#model] out=[#name]"),
                             {"model": F.concat(F.lit("/m/"), s("c_custkey")), "name": F.col("c_name")}, style="#", first_only=True)
    return table(spark, folder, "customer").select("c_custkey", dollar.alias("dollar"), hashed.alias("hash"))


@add("i7_path_parts", r"""
SELECT page_id, base, dir, ext, regexp_replace(base, '\.[^.]*$', '') AS stem, lower(ext) AS ext_lower FROM (
  SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_extract(url, '^(.*)/[^/]*$', 1) AS dir,
    regexp_extract(regexp_extract(url, '([^/]*)$', 1), '([^.]*)$', 1) AS ext FROM pages)""")
def path_parts(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.path_parts(F.col("url")).alias("p")).select("page_id", "p.*")


@add("i8_flatten_path_name", """
SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'mean.npy' ELSE 'v1_' || p_brand || '_' || p_size || '_mean.npy' END AS name FROM part""")
def flatten_path_name(spark, folder):
    relative = F.when(F.col("p_partkey") % 9 == 0, ".").otherwise(F.concat(F.lit("v1."), "p_brand", F.lit("/"), s("p_size")))
    return table(spark, folder, "part").select("p_partkey", text.flatten_path_name(relative, "mean.npy").alias("name"))


@add("i9_image_name_tag", """
SELECT p_partkey, p_type || ':' || p_size AS name_tag, CASE WHEN p_partkey % 2 = 0 THEN 'custom' ELSE lower(p_brand) END AS type_prefix,
  CASE WHEN p_partkey % 2 = 0 THEN 'custom-' || p_type || '-' || p_size ELSE 'custom-' || lower(p_brand) || '-' || p_type || '-' || p_size END AS dashed
FROM part""")
def image_name_tag(spark, folder):
    kind = F.when(F.col("p_partkey") % 2 == 0, "custom").otherwise(F.lower("p_brand"))
    path = F.concat_ws("/", F.lit("images"), kind, "p_type", s("p_size"))
    return table(spark, folder, "part").select("p_partkey", text.image_name_tag(path).alias("p")).select("p_partkey", "p.*")


@add("i10_kv_args", """
SELECT p_partkey, 'k' || p_size AS mpi, 'a=' || p_brand AS expr, '2' AS dup, 3 AS n FROM part""")
def kv_args(spark, folder):
    args = F.concat(F.lit(" --mpi=k"), s("p_size"), F.lit("  expr=a="), "p_brand", F.lit(" dup=1 dup=2"))
    return table(spark, folder, "part").withColumn("m", text.kv_args(args)).select(
        "p_partkey", F.col("m")["--mpi"].alias("mpi"), F.col("m")["expr"].alias("expr"), F.col("m")["dup"].alias("dup"),
        F.size("m").alias("n"))


@add("i11_extract_path_group", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE lower(c_mktsegment) END AS path_group FROM customer""")
def extract_path_group(spark, folder):
    path = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("/local/"), F.lower("c_mktsegment"), F.lit("/d"))).otherwise(
        F.concat(F.lit("/hdfs/"), F.lower("c_mktsegment"), F.lit("/data/"), s("c_custkey")))
    return table(spark, folder, "customer").select("c_custkey", text.path_group(path, "/hdfs").alias("path_group"))
