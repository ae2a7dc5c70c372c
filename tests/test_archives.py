"""Archives read by seeking."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import archives


def write_archives(folder, kinds=(zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED)):
    draw, want = random.Random(3), {}
    for n, kind in enumerate(kinds):
        path = folder / f"set{n}" / f"a{n}.zip"
        path.parent.mkdir()
        with zipfile.ZipFile(path, "w", kind) as archive:
            for i in range(60):
                body = draw.randbytes(draw.randrange(3000))
                archive.writestr(f"x/{i}.jpg", body)
                want[str(path), f"x/{i}.jpg"] = body
            archive.writestr("x/", b"")
            want[str(path), "x/"] = b""
    return want


def test_directory_and_members(spark, tmp_path):
    want = write_archives(tmp_path)
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    (tmp_path / "b.bin").write_bytes(b"no archive")
    directory = archives.archive_directory(spark, str(tmp_path))
    assert {(r["archive"], r["member"]): r["size"] for r in directory.collect()} == {k: len(v) for k, v in want.items()}
    for size in (1 << 30, 20_000):
        got = archives.read_members(directory, part_bytes=size)
        assert {(r["archive"], r["member"]): bytes(r["content"]) for r in got.collect()} == want
    one = archives.read_members(directory.filter(F.col("archive").endswith("a0.zip")), part_bytes=20_000)
    assert one.withColumn("p", F.spark_partition_id()).select("p").distinct().count() > 3  # one archive, many tasks


def test_only_listed_bytes_are_read(spark, tmp_path):
    """A damaged member is an error only where it is listed; a repeated listing gives the member twice."""
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("good.jpg", b"one")
        archive.writestr("bad.bin", b"damage me")
    path.write_bytes(path.read_bytes().replace(b"damage me", b"DAMAGE ME"))
    directory = archives.archive_directory(spark, str(tmp_path))
    wanted = spark.createDataFrame([(str(path), "good.jpg"), (str(path), "none"), (None, "good.jpg")], "archive string, member string")
    rows = archives.read_members(directory.join(wanted, ["archive", "member"], "left_semi"))
    assert [(r["member"], bytes(r["content"])) for r in rows.collect()] == [("good.jpg", b"one")]
    assert archives.read_members(directory.unionByName(directory).filter("member = 'good.jpg'")).count() == 2
    assert archives.read_members(directory.filter("size < 0")).count() == 0
    with pytest.raises(Exception, match="CRC"):
        archives.read_members(directory).collect()
