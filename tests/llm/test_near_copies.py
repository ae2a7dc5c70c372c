"""Near copies against the Jaccard similarity of all pairs."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from llm.conftest import texts_of
from pyspark.sql import functions as F

from millrace import session
from millrace.llm import near_copies, simhash

FOLDER = "/root/testdata/sf0.01"


def plain_set(text, shingle=5):
    words = text.encode().lower().split()
    return {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()


def plain_groups(texts):
    """The root of each text: components of all pairs with a Jaccard similarity of 0.8 or more."""
    sets, root = [plain_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if root[i] != root[j] and 5 * small >= 4 * large:
                shared = len(sets[i] & sets[j])
                if 9 * shared >= 4 * (small + large):
                    old, new = root[i], root[j]
                    root = [new if r == old else r for r in root]
    return root


def least_ids(rows):
    least = {}
    roots = plain_groups([t for _, t in rows])
    for (i, _), r in zip(rows, roots):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return Counter((i, least[r]) for (i, _), r in zip(rows, roots))


def drifting_texts():
    """Chains of copies, each with a few words changed, around the limit, with a passage that all share."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(30)]
    out = []
    for family in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 150))] + passage * (family % 2)
        for _ in range(rng.randint(1, 12)):
            out.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
    return out + ["", " \n", "one", "One", " ".join(passage)]


@pytest.mark.parametrize("group_rows, refine_above, tile", [(64, 20_000, 1_000_000), (1, 2, 150), (1, 20_000, 1_000_000)])
def test_no_pair_is_lost(spark, group_rows, refine_above, tile, monkeypatch):
    monkeypatch.setattr(near_copies, "REFINE_ABOVE", refine_above)
    monkeypatch.setattr(near_copies, "TILE_SHINGLES", tile)
    monkeypatch.setattr(near_copies, "ROUNDS", 1 if tile < 1000 else 6)
    rows = list(enumerate(drifting_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_copies.near_copies(docs, group_rows=group_rows).collect()
    assert Counter(map(tuple, got)) == least_ids(rows)


def template_texts(n):
    """Texts of four out of 30 lines: all share lines with many others, hardly any is a copy."""
    rng = random.Random(7)
    lines = [" ".join(f"l{i}w{k}" for k in range(12)) for i in range(30)]
    return ["\n".join(rng.sample(lines, 4)) for _ in range(n)]


def test_shared_lines_make_few_pairs(spark):
    numbers = []
    for n in (400, 800):
        docs = spark.createDataFrame(list(enumerate(template_texts(n))), "doc_id long, text string").repartition(3).withColumn("text_hash", F.xxhash64("text"))
        distinct = near_copies._distinct(docs, 5).persist()
        numbers.append(near_copies._other_pairs(distinct, None, 16).count())
    assert numbers[1] <= 3 * numbers[0] + 50 and numbers[1] < 800
    rows = list(enumerate(template_texts(300) + template_texts(20)))
    got = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), group_rows=4).collect()
    assert Counter(map(tuple, got)) == least_ids(rows)


@pytest.mark.parametrize("few", [0, 1_000])
def test_roots_are_those_of_the_stars(spark, few, monkeypatch):
    monkeypatch.setattr(near_copies, "FEW_EDGES", few)
    rng = random.Random(3)
    edges = [(rng.randrange(-200, 200) << 40, rng.randrange(-200, 200) << 40) for _ in range(150)] + [(5, 5), (7, 6), (6, 7), (-(1 << 63), 8)]
    edges += [(1000 + (i * 37) % 101, 1000 + (i * 37 + 37) % 101) for i in range(100)]
    for rows in (edges, []):
        stored = session.materialize(spark.createDataFrame(rows, "a long, b long").repartition(3))
        want = Counter(map(tuple, simhash.components(stored).collect()))
        assert Counter(map(tuple, near_copies._roots(stored).collect())) == want and bool(want) == bool(rows)


def test_steps_leave_few_tasks_and_tables(spark, monkeypatch):
    """What a step stores goes when it ends, and clusters of few pairs do not take a shuffle and a table per star."""
    folder, most = session.shared_folder(spark), [0]
    before = len(session.list_folders(spark, folder))
    stored = session.materialize

    def counted(df, **options):
        out = stored(df, **options)
        most[0] = max(most[0], len(session.list_folders(spark, folder)) - before)
        return out

    for module in (near_copies, simhash):
        monkeypatch.setattr(module, "materialize", counted)
    rows = list(enumerate(drifting_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.sparkContext.setJobGroup("steps", "near copies")
    try:
        got = near_copies.near_copies(docs)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("steps") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))
    assert Counter(map(tuple, got.collect())) == least_ids(rows)
    assert len(session.list_folders(spark, folder)) == before + 1
    assert most[0] <= 25 and tasks <= 400


def test_sketch_never_counts_more_than_differs():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 300, rng.integers(0, 400)) * 0x9E3779B97F4A7C1) for _ in range(2))
        bits = [np.frombuffer(near_copies.sketch(s), np.uint8) for s in (a, b)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))


def test_odd_tables(documents, no_documents):
    assert Counter(map(tuple, near_copies.near_copies(documents).collect())) == least_ids(texts_of(documents))
    assert near_copies.near_copies(no_documents).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()}
    assert kept == {least for _, least in least_ids(texts_of(docs))}
    assert 2 in kept and 56 not in kept  # similarity 0.97, fingerprints of three words 5 bits apart
