"""Spelling variants against comparing all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.conftest import texts_of

from millrace.llm import spelling

FOLDER = "/root/testdata/sf0.001"


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_ascii(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def deletions(word):
    return {(i, word[:i] + word[i + 1 :]) for i in range(len(word))}


def plain_variants(rows):
    n = plain_words(rows)
    buckets = {}
    for w in n:
        buckets.setdefault(w, set()).add(w)
        for _, d in deletions(w):
            buckets.setdefault(d, set()).add(w)
    out = {}
    forms = {}
    for w in n:
        near = {x for key in [w, *(d for _, d in deletions(w))] for x in buckets[key] if one_apart(w, x)}
        best = min(near, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = len(near)
    result = set()
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        result.add((w, forms[w], root, n[w], out[w], n[forms[w]] if forms[w] else None))
    return result


def got(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("cell_rows", [20_000, 30])
def test_real_documents(spark, cell_rows):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = plain_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(w[1] is not None for w in want) > 10
    assert got(spelling.spelling_variants(docs, cell_rows=cell_rows)) == want


def test_few_letters_and_chains(spark):
    """Many words of two letters, which no letter count splits, chains of forms, long words and letters of both cases."""
    rng = random.Random(3)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(400)] + ["x" * 4000, "x" * 4001, "Éßÿçæø", "éßÿçæø", "éßÿçæøa"]
    text = " ".join(f"{w} " * rng.choice([4, 5, 6, 30, 160, 900]) for w in words)
    rows = [(7, text), (None, text), (9, None), (10, ""), (11, "a1b2 abcdef-abcdeg_abcdeh " * 5), (11, "abcdef " * 40), (11, "abcdef " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_variants(rows)
    assert len({w[2] for w in want} - {w[1] for w in want}) > 3
    for cell_rows in (20_000, 10):
        assert got(spelling.spelling_variants(docs, cell_rows=cell_rows)) == want


def test_odd_tables(documents, no_documents):
    assert got(spelling.spelling_variants(documents)) == plain_variants(texts_of(documents))
    assert spelling.spelling_variants(no_documents).count() == 0


def test_tree_reaches_all_within_the_box():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 4, (300, spelling.AXES)).astype(np.int8)
    tree = spelling.KDTree(counts, 5)
    assert sorted(np.concatenate(list(tree.leaves.values()))) == list(range(300))
    asking = counts.copy()
    asking[np.arange(300), rng.integers(0, 32, 300)] += 1
    for leaf, rows in tree.reach(asking, 0, 1):
        assert set(tree.leaves[leaf]) <= set(rows)
