import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.operators import corpus, hooks


def words_of(spark, text):
    return spark.range(1).select(tokens(F.lit(text)).alias("t")).first()["t"]


def test_tokens(spark):
    assert words_of(spark, "") == [] and words_of(spark, "  \t ") == []
    text = " A  b\tc d e\x1cf　g\x85h "
    assert words_of(spark, text) == text.split()


def lines(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, line string")


@pytest.fixture(scope="module")
def counts(spark):
    return corpus.token_counts(corpus.line_tokens(lines(spark, ["b a a c", "c d UNK", ""])))


def test_vocabulary_order_and_size(counts):
    specials = ("PAD", "GO", "EOS", "UNK")
    full = [(r["token"], r["id"]) for r in corpus.vocabulary(counts, specials).orderBy("id").collect()]
    assert full == [("PAD", 0), ("GO", 1), ("EOS", 2), ("UNK", 3), ("a", 4), ("c", 5), ("UNK", 6), ("b", 7), ("d", 8)]
    cut = corpus.vocabulary(counts, specials, 5)
    assert [r["token"] for r in cut.orderBy("id").collect()] == ["PAD", "GO", "EOS", "UNK", "a"]
    assert corpus.vocabulary(counts, specials, 2).count() == 2


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_encode_and_decode(spark, counts, monkeypatch, max_bytes):
    """Unknown words take the unknown token's later id; the join path gives what the Arrow path gives."""
    if max_bytes is not None:
        monkeypatch.setattr(corpus, "broadcastable", lambda df: False)
    vocab = corpus.build_vocabulary(counts, ("PAD", "GO", "EOS", "UNK"))
    source = spark.createDataFrame([(1, ["a", "zz", "UNK"]), (2, []), (3, None), (4, ["d"])], "id long, t array<string>")
    out = {r["id"]: r for r in corpus.decode_ids(
        corpus.encode_tokens(source, vocab, {"t": "ids"}, "UNK"), vocab, {"ids": "words"}).collect()}
    assert out[1]["ids"] == [4, 6, 6] and out[1]["words"] == ["a", "UNK", "UNK"]
    assert out[2]["ids"] == [] and out[3]["ids"] is None and out[4]["words"] == ["d"]
    with pytest.raises(ValueError):
        corpus.encode_tokens(source, vocab, {"t": "ids"}, "nowhere")


def noise(spark, text, kind=corpus.noise_bigrams, **kw):
    df = spark.range(1).select(F.split(F.lit(text), " ").alias("t"))
    return " ".join(df.select(kind(F.col("t"), [F.lit(1)], **kw).alias("s")).first()["s"])


def test_noise_with_certain_draws(spark):
    sure = {"replace_prob": 1.0}
    assert noise(spark, "there you 're then", **sure) == "they 're your than"
    assert noise(spark, "their ill", **sure) == "they 're i 'll"
    assert noise(spark, "it 's its", **sure) == "its it' s"
    assert noise(spark, "a the x", drop_prob=1.0) == "x"
    assert noise(spark, "there a", corpus.noise_words, **sure) == "their a"
    assert noise(spark, "there a", replace_prob=0.0) == "there a"


def test_overlapping_pairs(spark):
    table = {"a b": "1", "b a": "2"}
    assert noise(spark, "a b a b a", replacements=table, replace_prob=1.0, drops=()) == "1 1 a"
    assert noise(spark, "b a b", replacements=table, replace_prob=1.0, drops=()) == "2 b"


def test_bigram_noise_equals_a_sequential_reader(spark):
    """With draws of 0 or 1 the parallel form decides as a reader going word by word."""
    draw = random.Random(2)
    table = {"x": "p q", "a b": "r", "b c": "s", "c a": "t u"}
    for _ in range(15):
        text = [draw.choice("abcxy") for _ in range(draw.randrange(1, 14))]
        want, i = [], 0
        while i < len(text):
            pair = " ".join(text[i:i + 2])
            if text[i] in table:
                want += table[text[i]].split()
            elif pair in table:
                want += table[pair].split()
                i += 1
            else:
                want.append(text[i])
            i += 1
        assert noise(spark, " ".join(text), replacements=table, replace_prob=1.0, drops=()) == " ".join(want)


def test_buckets_are_strict(spark):
    rows = [(1, [1] * 4, [1] * 4), (2, [1] * 5, [1] * 4), (3, [1] * 9, [1] * 9), (4, [1] * 10, [1])]
    df = spark.createDataFrame(rows, "id long, source array<int>, target array<int>")
    out = {r["id"]: r["bucket_id"] for r in corpus.bucketize(df, [(5, 5), (10, 10)]).collect()}
    assert out == {1: 0, 2: 1, 3: 1}


def test_build_dataset(spark):
    data = corpus.line_tokens(lines(spark, ["a b c", "a a"]))
    vocab = corpus.build_vocabulary(corpus.token_counts(data), (*corpus.RESERVED, "UNK"))
    out = corpus.build_dataset(data, vocab, key=["id"], copies=2, buckets=[(3, 4), (9, 9)])
    assert out.count() == 4
    assert {r["target"][-1] for r in out.collect()} == {corpus.EOS_ID}


def test_a_reader_makes_any_number_of_pairs(spark):
    def read(line):
        words = line.split()
        for i in range(1, len(words)):
            yield words[:i], words[i:]

    df = spark.createDataFrame([(1, "a b c"), (2, "alone"), (3, ""), (4, None), (5, "x y"), (5, "x y")], "id long, line string").repartition(2)
    got = sorted((r.id, r.source, r.target) for r in hooks.read_many_samples(df, read).collect())
    assert got == [(1, ["a"], ["b", "c"]), (1, ["a", "b"], ["c"]), (5, ["x"], ["y"]), (5, ["x"], ["y"])]
    assert hooks.read_many_samples(df.limit(0), read).columns == ["id", "source", "target"]
    many = spark.createDataFrame([(1, "w " * 3000)], "id long, line string")
    assert hooks.read_many_samples(many, lambda line: ((["s"], [w]) for w in line.split())).count() == 3000


def test_encoded_pairs_leave_their_tokens_behind(spark, monkeypatch):
    rows = [(1, ["a", "b"], ["a", "x"]), (2, [], ["b"]), (None, None, None), (4, ["x", None], [])]
    pairs = spark.createDataFrame(rows, "doc_id long, source array<string>, target array<string>")
    vocab = spark.createDataFrame([("UNK", 3), ("a", 4), ("b", 5)], "token string, id int")
    seen = []
    monkeypatch.setattr(corpus, "_map_lists", lambda *a, own=corpus._map_lists: seen.append(own(*a)) or seen[-1])
    got = corpus.encode_pairs(pairs, vocab, "UNK")
    assert got.columns == ["doc_id", "source", "target"]
    assert {r.doc_id: (r.source, r.target) for r in got.collect()} == {
        1: ([4, 5], [4, 3, 2]), 2: ([], [5, 2]), None: (None, None), 4: ([3, 3], [2])}
    assert [f.dataType.simpleString() for f in seen[0].schema.fields] == ["bigint", "array<int>", "array<int>"]
