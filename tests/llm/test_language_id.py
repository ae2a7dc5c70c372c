"""Language models against a plain Kneser-Ney recursion, and languages of documents that were held out."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language_id

FOLDER = "/root/testdata/sf0.01"


def plain_model(words, order, least=1):
    """``probability(context, character)`` by the textbook recursion; ``words``: word to count."""
    top = Counter()
    for word, n in words.items():
        padded = "\0" * (order - 1) + word + "\1"
        for i in range(order - 1, len(padded)):
            top[padded[i - order + 1 : i + 1]] += n
    whole = Counter()
    for g, n in top.items():
        whole[g[:-1]] += n
    levels = {order: {g: n for g, n in top.items() if n >= least}}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    discounts = {}
    for k, grams in levels.items():
        once, twice = (sum(n == i for n in (top if k == order else grams).values()) for i in (1, 2))
        discounts[k] = once / (once + 2 * twice) if once and twice else 0.75

    def probability(context, character):
        k = len(context) + 1
        below = probability(context[1:], character) if context else 1 / 0x110000
        total = whole[context] if k == order else sum(n for g, n in levels[k].items() if g[:-1] == context)
        seen = {g: max(n - discounts[k], 0) / total for g, n in levels[k].items() if g[:-1] == context}
        if not seen:
            return below
        return seen.get(context + character, 0) + (1 - sum(seen.values())) * below

    return probability


def plain_score(probability, word, order):
    padded = "\0" * (order - 1) + word + "\1"
    return -sum(math.log(probability(padded[i - order + 1 : i], padded[i])) for i in range(order - 1, len(padded)))


def invented(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def learned_docs(spark, n=60):
    rng = random.Random(2)
    kinds = {"xx": ["ta", "ko", "lim", "é"], "yy": ["ber", "gan", "ta", "ß"], "zz": ["мо", "ка", "ди"]}
    rows = [(i, lang, invented(rng, kinds[lang], rng.randint(5, 40))) for i in range(n) for lang in [rng.choice(list(kinds))]]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)


@pytest.mark.parametrize("order", [3, 5])
def test_scores_equal_the_recursion(spark, order):
    docs = learned_docs(spark)
    counts = language_id.gram_counts(docs, order).persist()
    for most_grams in (1_000_000, 300):
        models = language_id.estimate_models(counts, order=order, most_grams=most_grams)
        probes = ["tako", "limber", "q", "é", "мокади", "x" * 30, "taßé"]
        scores = language_id.word_scores(models, probes)
        for column, lang in enumerate(models.languages):
            words = Counter()
            for r in docs.filter(F.col("lang") == lang).collect():
                words.update(r.text.split())
            events = sum((len(w) + 1) * n for w, n in words.items())
            model = plain_model(words, order, max(1, math.ceil(events * 3 / most_grams)))
            assert scores[:, column] == pytest.approx([plain_score(model, w, order) for w in probes], rel=1e-5)
        assert most_grams > 300 or sum(len(g[0]) for g in models.grams) <= order * most_grams


def test_probabilities_sum_to_one(spark):
    models = language_id.estimate_models(language_id.gram_counts(learned_docs(spark), 3), order=3)
    (keys, values), (contexts, weights) = models.grams[0], models.contexts[0]
    unigrams = language_id.gram_hashes(np.arange(0x3000, dtype=np.uint32)[:, None])
    place = np.minimum(np.searchsorted(keys, unigrams), len(keys) - 1)
    seen = keys[place] == unigrams
    left = math.exp(weights[np.searchsorted(contexts, language_id.gram_hashes(np.empty((1, 0), np.uint32)))[0]])
    assert np.exp(values[place[seen]]).sum() + left * (0x110000 - seen.sum()) / 0x110000 == pytest.approx(1, abs=1e-5)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r for r in language_id.languages(docs).collect()}
    assert len(rows) == docs.count()
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    held = [i for i, r in rows.items() if r.held_out and truth[i][0] and len(truth[i][1] or "") > 20]
    assert len(held) > 150
    right = sum(rows[i].lang_pred == truth[i][0] for i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert sum(r.rejected for r in rows.values()) < 0.1 * len(rows)


def test_labels_of_held_out_rows_and_other_columns_are_no_inputs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    held = language_id.id_remainder("doc_id", 4) == 2
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    keep = ["doc_id", "held_out", "lang_pred", "score"]
    assert sorted(language_id.languages(docs).select(keep).collect()) == sorted(language_id.languages(other).select(keep).collect())


def test_odd_tables(spark, documents, no_documents):
    rows = language_id.languages(documents).collect()
    assert len(rows) == documents.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].lang_pred == by_id[1].lang_pred == by_id[2].lang_pred == "und" and by_id[0].score == 0
    assert {r.lang_pred for r in rows} == {"und", "en"}
    assert language_id.languages(no_documents).count() == 0
    unlabelled = documents.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score, r.rejected) for r in language_id.languages(unlabelled).collect()} == {("und", 0.0, True)}
    signs = spark.createDataFrame([(1, "12 + 3 = 15", "en"), (2, "½ ²", "en"), (3, "a", "en"), (4, "x" * 300_000, "de")] * 2, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.languages(signs).collect()}
    assert got[1] == got[2] == "und" and got[3] in ("en", "de")


def test_foreign_texts_are_rejected(spark):
    docs = learned_docs(spark, 400)
    models = language_id.learn(docs, F.lit(True))
    rng = random.Random(9)
    foreign = [(1000 + i, invented(rng, ["wq", "xzr", "þæ", "vj"], 30)) for i in range(20)]
    got = language_id.identify(spark.createDataFrame(foreign, "doc_id long, text string"), models).collect()
    assert all(r.rejected for r in got)
    own = language_id.identify(docs, models).collect()
    assert sum(r.rejected for r in own) <= 0.03 * len(own)
    assert sum(r.score > 0.8 for r in own) > 0.9 * len(own)


def test_rare_grams_stay_however_much_else_is_counted(spark):
    rows = [("xx", "abcde", 10_000_000), ("xx", "vwxyz", 1), ("yy", "fghij", 3)]
    models = language_id.estimate_models(spark.createDataFrame(rows, "lang string, gram string, n long"))
    for (keys, _), grams in zip(models.grams, (["abcde", "vwxyz"], ["fghij"])):
        points = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, 5)
        assert np.isin(language_id.gram_hashes(points), keys).all()
