"""The quality model against plain figures of all labelled rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality


def labelled_texts(n_good, n_bad):
    rng = random.Random(6)
    good = [" ".join(rng.choice("one two three four five.".split()) for _ in range(rng.randint(3, 9))) for _ in range(n_good)]
    bad = [" ".join(rng.choice("A1 || ## one 77".split()) for _ in range(rng.randint(2, 8))) for _ in range(n_bad)]
    return [(i, t, int(i < n_good)) for i, t in enumerate(good + bad)]


@pytest.mark.parametrize("n_good, n_bad, tile_rows", [(4300, 4100, 4000), (400, 30, 50), (30, 400, 50), (70, 60, 100)])
def test_every_labelled_row_counts(spark, n_good, n_bad, tile_rows):
    rows = labelled_texts(n_good, n_bad)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 7), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True), tile_rows=tile_rows)
    raw, y = np.array([quality.features(t) for _, t, _ in rows]), np.array([y for _, _, y in rows])
    assert model.mean == pytest.approx(raw.mean(0)) and model.spread == pytest.approx(np.maximum(raw.std(0), 1e-9))
    scores = ((raw - model.mean) / model.spread) @ model.weights
    assert model.scale == pytest.approx(scores.std())
    good, bad = np.sort(scores[y == 1]), np.sort(scores[y == 0])
    shares = np.linspace(0, 0.5, 501)
    cuts = np.quantile(good, shares)
    top = cuts[np.argmax(np.searchsorted(bad, cuts) / n_bad - 2 * np.searchsorted(good, cuts) / n_good)]
    below = bad[bad < top]
    assert model.cut == pytest.approx((top + below.max()) / 2 if len(below) else top, abs=1e-6)
    if max(n_good, n_bad) <= tile_rows:
        x = (raw - model.mean) / model.spread
        assert model.weights == pytest.approx(quality.bradley_terry(x, *quality.preference_pairs(y, 8)), abs=0.3)


def test_a_wider_table_changes_the_weights_little(spark):
    rows = labelled_texts(600, 500)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    one, many = (quality.fit(docs, labels, F.lit(True), tile_rows=n) for n in (4000, 100))
    texts = [t for _, t, _ in rows]
    assert (quality.scores(one, texts, 0.3) >= 0.3).tolist() == (quality.scores(many, texts, 0.3) >= 0.3).tolist()
