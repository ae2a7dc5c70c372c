"""The conversation trie against a dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import conversation_trie as trie


def plain_turns(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(own)] for c, own in found.items()}


def rebuilt(rows):
    own = plain_turns(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_trie(paths):
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in members}
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, own in members.items():
        gain = (len(own) - 1) * len(re.findall("[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += children[p] == 0
    return sorted((min(own), len(p), min(members[p[:-1]]) if p else -1, len(own), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in own if len(paths[c]) == len(p)))).encode()).hexdigest())
                  for p, own in members.items())


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in df.collect())


def conversations(seed, n):
    """Few different turns, so that prefixes are shared at all depths; copies, a very frequent start, one long conversation."""
    rng = random.Random(seed)
    says = ["", "a b", "a  b\tc", "é, word", "one"]
    rows = []
    for c in range(n):
        c = c if rng.random() < 0.8 else c + 1000
        turns = [(rng.choice(["user", "bot", None]), rng.choice(says)) for _ in range(rng.choice([0, 1, 1, 2, 3, 6]))]
        rows += [(c, t, role, text) for t, (role, text) in enumerate([("user", "hello there")] * (c % 3 > 0) + turns)]
    rows += [(5000 + i, t, "user", "copy") for i in range(60) for t in range(5)]
    rows += [(6000, t, "user", "copy") for t in range(300)] + [(6020, t, "user", "copy") for t in range(299)]
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit(3)).repartition(3)


@pytest.mark.parametrize("parts", [None, 1, 7, 40])
def test_against_prefixes(spark, parts):
    rows = conversations(4, 150)
    paths = trie.with_shared_heads(trie.turns(table(spark, rows)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    if parts:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set(coalesce, False)
    try:
        assert got(trie.prefix_trie(paths)) == plain_trie(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set(coalesce, True)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, None, "z"),
            (20, 2, "user", None), (21, 5, "user", "x y"), (22, 1, "user", ""), (40, 7, "a", "b"), (60, 7, "ab", ""), (80, None, "", "ab")]
    assert got(trie.conversation_trie(table(spark, rows))) == plain_trie(rebuilt(rows))
    assert trie.conversation_trie(table(spark, rows[:1])).count() == 0
    assert trie.conversation_trie(table(spark, rows).limit(0)).count() == 0


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert got(trie.conversation_trie(df)) == plain_trie(rebuilt(rows))


def test_merges_are_the_branching_nodes():
    paths = [b"", b"a" * 16, b"a" * 16, b"a" * 16 + b"b" * 16, b"a" * 16 + b"c" * 32, b"d" * 16]
    forest = trie.Forest(paths, list(range(6)), [[1] * (len(p) // 16) for p in paths], -1, -1)
    assert [trie.shared_turns(a, b) for a, b in zip(paths, paths[1:])] == [0, 1, 1, 1, 0]
    root = forest.find(0)
    assert forest.depth[root] == 0 and forest.members[root] == 6 and forest.leaves[root] == 3
