"""The greedy cap in rounds over ranges decides as one reader of all files."""

import random

import pytest

from millrace.operators import annotations


def one_reader(rows, cap):
    files, seen, kept = {}, {}, []
    for file, cls in rows:
        files.setdefault(file, []).append(cls)
    for file in sorted(files):
        if any(seen.get(c, 0) < cap for c in files[file]):
            kept.append(file)
            for c in files[file]:
                seen[c] = seen.get(c, 0) + 1
    return kept


@pytest.mark.parametrize("cap,files_per_task", [(8, 20), (40, 60), (10_000, 150)])
def test_rounds_equal_one_reader(spark, cap, files_per_task):
    """A class that nearly every file has, rare ones, one of a single file and a null one; several close in one range."""
    draw = random.Random(cap)
    rows = []
    for i in range(400):
        name = f"f{i:04d}"
        rows += [(name, draw.choices(["hot", "a", "b", "c", None], [20, 5, 3, 1, 1])[0]) for _ in range(draw.randrange(1, 6))]
    rows.append(("f0399", "once"))
    rois = spark.createDataFrame(rows, "file string, cls string")
    got = [r["file"] for r in annotations.cap_per_class_any(rois, cap, files_per_task=files_per_task).collect()]
    assert sorted(got) == one_reader(rows, cap) and len(got) == len(set(got))


def test_no_regions(spark):
    assert annotations.cap_per_class_any(spark.createDataFrame([], "file string, cls string"), 5).count() == 0
