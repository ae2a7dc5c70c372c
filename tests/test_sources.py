import io
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.session import materialize, scratch_path
from millrace.sources import files, sinks


def test_image_folder(spark, tmp_path):
    for name in ("set/a/1.jpg", "set/a/2.PNG", "set/b/3.txt", "set/b/4.jpeg", "set/c.d/5.jpg"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * 3)
    rows = files.image_folder(spark, str(tmp_path)).collect()
    assert {(r["label"], r["root"].rsplit("/", 1)[1]) for r in rows} == {("a", "set"), ("c.d", "set")}
    assert len(rows) == 3 and "content" not in rows[0].asDict()
    assert files.image_folder(spark, str(tmp_path), content=True).first()["content"] == b"xxx"


def test_zip_members(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("x/1.jpg", b"one")
        archive.writestr("x/", b"")
    (tmp_path / "a.zip").write_bytes(buffer.getvalue())
    (tmp_path / "b.bin").write_bytes(b"no archive")
    rows = {r["member"]: r for r in files.zip_members(files.archives(spark, str(tmp_path))).collect()}
    assert bytes(rows["x/1.jpg"]["content"]) == b"one" and rows["x/1.jpg"]["size"] == 3 and rows["x/"]["size"] == 0
    listed = files.zip_members(files.archives(spark, str(tmp_path)), read=False).collect()
    assert len(listed) == 2 and all(r["content"] is None for r in listed)
    assert [r["member"] for r in files.zip_members(files.archives(spark, str(tmp_path)), extensions=(".JPG",)).collect()] == ["x/1.jpg"]
    archive = files.archives(spark, str(tmp_path)).first()["path"]
    wanted = spark.createDataFrame([(archive, "x/1.jpg"), (archive, "none"), ("other.zip", "x/1.jpg")], "archive string, member string")
    read = files.listed_members(files.archives(spark, str(tmp_path)), wanted).collect()
    assert [(r["member"], bytes(r["content"])) for r in read] == [("x/1.jpg", b"one")]


def test_only_wanted_members_are_unpacked(spark):
    """A member that is not wanted may be damaged: its bytes are never read."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("good.jpg", b"one")
        archive.writestr("bad.bin", b"damage me")
    data = buffer.getvalue().replace(b"damage me", b"DAMAGE ME")
    packed = spark.createDataFrame([("a.zip", data)], "path string, content binary")
    assert files.zip_members(packed, extensions=(".jpg",)).count() == 1
    wanted = spark.createDataFrame([("a.zip", "good.jpg")], "archive string, member string")
    assert files.listed_members(packed, wanted).count() == 1
    with pytest.raises(Exception, match="CRC"):
        files.zip_members(packed).collect()


def test_text_and_properties(spark, tmp_path):
    (tmp_path / "c.txt").write_text("The a\n\n b  c \n")
    got = sorted(r["tokens"] for r in files.text_tokens(spark, str(tmp_path / "c.txt"), lower=True).collect())
    assert got == [[], ["b", "c"], ["the", "a"]]
    (tmp_path / "p.txt").write_text("# no=1\nlatest = 1\r\nurl=a=b\nlatest=2\nbare\n")
    rows = files.properties_files(spark, str(tmp_path / "p.txt")).collect()
    assert {r["key"]: r["value"] for r in rows} == {"latest": "2", "url": "a=b"}


def test_sensor_csv_and_hazards(spark, tmp_path):
    (tmp_path / "t1.csv").write_text("ts,x\n1,0.5\n2,0.25\n")
    rows = files.sensor_csv(spark, str(tmp_path / "t1.csv"), "ts long, x double").collect()
    assert [(r["ts"], r["x"], r["trip_file"]) for r in rows] == [(1, 0.5, "t1.csv"), (2, 0.25, "t1.csv")]
    (tmp_path / "h.json").write_text(
        '{"car": "c", "driver": "d", "tagger": "t", "tags": [{"location": {"lat": 1.5, "lon": 2.5},'
        ' "timestamp": "2024-01-01T00:00:00Z", "type": "sewer_cap"}, {"type": "speed_bump"}]}\n')
    rows = files.hazard_json(spark, str(tmp_path / "h.json")).collect()
    assert [(r["car"], r["lat"], r["type"]) for r in rows] == [("c", 1.5, "sewer_cap"), ("c", None, "speed_bump")]


def test_verified_lines(spark):
    df = spark.range(5).selectExpr("id", "concat('a\n', id) AS text")
    path = scratch_path(spark, "test-lines")
    assert sinks.write_jsonl_verified(df, path, 5) == 5
    assert sinks.write_jsonl_verified(df.limit(0), scratch_path(spark, "test-lines"), 0) == 0
    for reread in (False, True):
        assert sinks.write_jsonl_verified(df, scratch_path(spark, "test-lines"), 5, reread=reread) == 5
        with pytest.raises(RuntimeError, match="5 lines written, 6 expected"):
            sinks.write_jsonl_verified(df, scratch_path(spark, "test-lines"), 6, reread=reread)


def test_append_lines_and_buckets(spark):
    path = scratch_path(spark, "test-append")
    for part in ("a", "b"):
        sinks.append_lines(spark.createDataFrame([(0, part)], "rank int, line string"), path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["a", "b"]
    pairs = spark.createDataFrame([(1, 0), (2, 1)], "id long, bucket_id int")
    target = scratch_path(spark, "test-buckets")
    sinks.write_buckets(pairs, target)
    assert spark.read.parquet(target).filter("bucket_id = 1").count() == 1


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(3).selectExpr("id", "array(id) AS a", "named_struct('x', id) AS s")
    kept = materialize(df)
    assert kept.schema.simpleString() == df.schema.simpleString() and kept.count() == 3


def test_materialize_leaves_no_shuffle_files(spark):
    def shuffled():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",").count("shuffle_")

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(name, None)
    kept = materialize(spark.range(0, 50_000, 1, 4).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert shuffled() <= before
    assert spark.conf.get(name, None) == setting
    assert kept.count() == 7 and kept.agg(F.sum("count")).first()[0] == 50_000
