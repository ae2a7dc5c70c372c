"""Growing, truncated and rotated files: every line arrives once, also after a restart."""

import os
from collections import Counter

from millrace.session import scratch_path
from millrace.streaming import tail


def read_on(spark, folder, out, **kw):
    """One run of a query that is restarted from its checkpoint each time."""
    query = (tail.tail_stream(spark, str(folder), **kw).writeStream.format("parquet").option("path", f"{out}/rows")
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination(90)
    assert query.exception() is None
    return Counter(r["line"] for r in spark.read.schema(tail.TAIL).parquet(f"{out}/rows").collect())


def test_lines_arrive_once(spark, tmp_path):
    out, log = scratch_path(spark, "test-tail"), tmp_path / "run.log"
    log.write_text("a\nb\r\n\nhalf")
    want = Counter(["a", "b", ""])
    assert read_on(spark, tmp_path, out) == want
    with log.open("a") as file:
        file.write(" done\nc\n")
    want += Counter(["half done", "c"])
    assert read_on(spark, tmp_path, out) == want
    assert read_on(spark, tmp_path, out) == want  # nothing new
    with log.open("a") as file:
        file.write("last before rotation\n")
    os.rename(log, tmp_path / "run.1.log")
    log.write_text("a\nnew file\n")
    want += Counter(["last before rotation", "a", "new file"])
    assert read_on(spark, tmp_path, out) == want
    log.write_text("x\n")  # truncated in place: shorter
    want += Counter(["x"])
    assert read_on(spark, tmp_path, out) == want
    log.write_text("written anew and longer\nthan before\n")  # truncated and grown beyond what was read
    want += Counter(["written anew and longer", "than before"])
    assert read_on(spark, tmp_path, out) == want
    os.remove(tmp_path / "run.1.log")
    (tmp_path / "empty.log").write_text("")
    (tmp_path / "other.txt").write_text("not a log\n")
    assert read_on(spark, tmp_path, out) == want


def test_parts_cut_lines_nowhere(tmp_path):
    """Whatever the size of the parts, their lines are those of the file, at their positions."""
    lines = [b"x" * (i * 7 % 23) for i in range(200)]
    path = tmp_path / "a.log"
    path.write_bytes(b"\n".join(lines) + b"\ntail without end")
    for size in (1, 2, 5, 64, 1000, 10_000):
        reader = tail.TailReader(str(tmp_path), "*.log", size)
        end = reader.latestOffset()
        rows = [r for part in reader.partitions({}, end) for batch in reader.read(part) for r in batch.to_pylist()]
        assert [r["line"].encode() for r in rows] == lines
        assert all(path.read_bytes()[r["position"]:].startswith(r["line"].encode() + b"\n") for r in rows)


def test_renamed_between_plan_and_read(tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    reader = tail.TailReader(str(tmp_path), "*.log", 100)
    parts = reader.partitions({}, reader.latestOffset())
    os.rename(tmp_path / "a.log", tmp_path / "a.1.log")
    (tmp_path / "a.log").write_text("three\n")
    assert [r["line"] for p in parts for b in reader.read(p) for r in b.to_pylist()] == ["one", "two"]
    assert tail.TailReader(str(tmp_path / "none"), "*.log", 100).latestOffset() == {}
