"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordTable, chunks, id_type, small_batches, text_list, worker_cache
from millrace.llm.labelled import id_remainder, sample
from millrace.session import materialize, scratch_scope

WORD = re.compile(r"\w+")
STEM = 4
HASH_BITS = 40
SCREEN_BITS = 20
HELD_WORDS = 150_000
# Fixed odd multipliers that mix the words of a pair, for neighbours and for words with one between.
PAIRS = ((1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


@dataclass(frozen=True)
class Model:
    """Sparse weights by feature hash (ascending), and the weight of the constant."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of the texts, and the text of each: words, their stems, neighbouring pairs and pairs
    with one word between. A stem is a word's first letters, which its inflected forms share."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    table = worker_cache(("word-hash",), lambda: WordTable(lambda w: digest(w.encode()), HELD_WORDS))
    stems = worker_cache(("stem-hash", STEM), lambda: WordTable(lambda w: digest(w[:STEM].encode(), 1), HELD_WORDS))
    found = [WORD.findall(t.lower()) for t in texts]
    sizes = [len(f) for f in found]
    flat = list(chain.from_iterable(found))
    words = np.fromiter(map(table.__getitem__, flat), np.uint64, len(flat))
    owner = np.repeat(np.arange(len(texts)), sizes)
    hashes, owners = [words, np.fromiter(map(stems.__getitem__, flat), np.uint64, len(flat))], [owner, owner]
    for gap, first, second in PAIRS:
        same = owner[:-gap] == owner[gap:]
        pair = words[:-gap] * np.uint64(first) + words[gap:] * np.uint64(second)
        hashes.append(pair[same])
        owners.append(owner[gap:][same])
    return np.concatenate(hashes) >> np.uint64(64 - HASH_BITS), np.concatenate(owners)


def ftrl(
    rows: list[np.ndarray], labels: list[int], *, epochs: int, alpha: float, beta: float, l1: float, l2: float, min_rows: int,
) -> Model:
    """FTRL-proximal: a rate per coordinate, and weights that stay 0 until their gradients outweigh ``l1``.

    Features present in fewer than ``min_rows`` of the rows are left out. Without rows of both
    classes there are no weights.
    """
    if len(set(labels)) < 2:
        return Model(np.empty(0, np.uint64), np.empty(0), 0.0)
    features, inverse, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    split = np.split(inverse, np.cumsum([len(r) for r in rows])[:-1])
    frequent = counts >= min_rows
    place = np.cumsum(frequent) - 1
    features = features[frequent]
    n_features = len(features)
    split = [np.append(place[s[frequent[s]]], n_features) for s in split]  # the last coordinate is the constant
    z, n = np.zeros(n_features + 1), np.zeros(n_features + 1)
    free = np.full(n_features + 1, l1)
    free[-1] = 0.0

    def weights(zs: np.ndarray, ns: np.ndarray, bound: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - bound, 0.0)
        return -shrunk / ((beta + np.sqrt(ns)) / alpha + l2)

    order = np.random.default_rng(7).permutation(len(rows))
    for _ in range(epochs):
        for i in order:
            at = split[i]
            own, seen = weights(z[at], n[at], free[at]), n[at]
            gradient = 1.0 / (1.0 + np.exp(-np.clip(own.sum(), -35, 35))) - labels[i]
            rate = (np.sqrt(seen + gradient * gradient) - np.sqrt(seen)) / alpha
            z[at] += gradient - rate * own
            n[at] += gradient * gradient
    final = weights(z, n, free)
    kept = np.flatnonzero(final[:-1])
    return Model(features[kept], final[kept], float(final[-1]))


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = 1500, epochs: int = 8, alpha: float = 1.0, beta: float = 1.0,
    l1: float = 8.0, l2: float = 0.0, min_rows: int = 5, most_grams: int = 60_000,
) -> Model:
    """Fit on at most ``per_class`` labelled documents of each class, those first by a hash of their ids.

    Documents become sets of feature hashes in the tasks, where features of fewer than ``min_rows``
    documents are left out; the driver sees the numbers of the other features only. Of the sample,
    documents with more than ``most_grams`` features are left out, so what the driver holds is
    bounded by both parameters. Of the rows of a repeated id the text with the least hash counts.
    """
    chosen = sample(labels, label_col, usable, per_class)
    spark, kind = docs.sparkSession, id_type(docs, id_col)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [np.unique(gram_hashes([t])[0]).astype(np.int64) for t in text_list(batch, "text")]
            sets = [g if len(g) <= most_grams else None for g in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "label", "grams"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    with scratch_scope(spark):
        sets = materialize(one.mapInArrow(features, f"doc_id {kind}, label int, grams array<long>").filter("grams is not null"))
        counts = sets.select(F.explode("grams").alias("gram")).groupBy("gram").count()
        known = np.sort(counts.filter(F.col("count") >= min_rows).select("gram").toArrow()["gram"].to_numpy())
        shared = spark.sparkContext.broadcast(known)

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                grams = [g.values.to_numpy() for g in batch.column("grams")]
                known = shared.value
                found = [np.searchsorted(known, g) for g in grams]
                places = [p[known[np.minimum(p, len(known) - 1)] == g].astype(np.int32) if len(known) else p[:0].astype(np.int32)
                          for p, g in zip(found, grams)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("label"), pa.array(places, pa.list_(pa.int32()))], ["doc_id", "label", "places"])

        rows = sets.mapInArrow(number, f"doc_id {kind}, label int, places array<int>").toArrow()
    shared.unpersist()
    ids, classes = rows["doc_id"].to_pylist(), rows["label"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    places = [p.values.to_numpy() for p in rows["places"]]
    model = ftrl([places[i] for i in order], [classes[i] for i in order], epochs=epochs, alpha=alpha, beta=beta, l1=l1, l2=l2,
                 min_rows=min_rows)
    return Model(known[model.features.astype(np.int64)].astype(np.uint64), model.weights, model.bias)


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """The score of each text: the logistic of the constant and the weights of its distinct features."""
    screen = np.zeros(1 << SCREEN_BITS, bool)
    low = np.uint64((1 << SCREEN_BITS) - 1)
    screen[model.features & low] = True
    total = np.full(len(texts), model.bias)
    for start, stop in chunks(texts):
        hashes, owner = gram_hashes(texts[start:stop])
        hit = np.flatnonzero(screen[hashes & low])
        hashes, owner = hashes[hit], owner[hit]
        place = np.searchsorted(model.features, hashes)
        place[place == len(model.features)] = 0
        known = model.features[place] == hashes if len(model.features) else np.zeros(0, bool)
        both = np.unique(owner[known] * max(1, len(model.features)) + place[known])
        at, feature = np.divmod(both, max(1, len(model.features)))
        total[start:stop] += np.bincount(at, model.weights[feature], stop - start)
    return 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500)))


def score_documents(
    docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row, over whole texts. The weights travel as a broadcast variable."""
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = scores(Model(*shared.value), text_list(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        score, f"doc_id {id_type(docs, id_col)}, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            yield batch.filter(pa.array(scores(Model(*shared.value), text_list(batch, text_col)) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, divisor: int = 3, held_out: int = 1, **fitting: object) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document: fitted on labelled rows that are not held out.

    Held out are the ids whose remainder is ``held_out``. Null and empty texts have the score of
    the constant alone. A null id is never used for fitting. With labels of one class, or none,
    every score is 0.5.
    """
    model = fit(docs, labels, id_remainder("doc_id", divisor) != held_out, **fitting)
    scored = score_documents(docs, model)
    return scored.select("doc_id", (id_remainder("doc_id", divisor) == held_out).alias("held_out"), "score", "predicted")
