"""Quality: Bradley-Terry ranking of documents from preference pairs, cut at a quantile of the scores."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_type, small_batches, text_list
from millrace.llm.labelled import id_remainder, labelled
from millrace.plans import Run, broadcastable, lookup_join, running
from millrace.session import materialize, scratch_scope

FEATURES = (
    "capitals", "digits", "commas_and_stops", "other_signs", "sign_runs", "lone_signs", "repeats", "commonest_word",
    "new_words", "word_length", "long_words", "line_length", "repeated_lines", "words",
)
RANKED_ROWS = 10_000
SIGN_RUN = re.compile(r"[^\w\s]{2,}")


def features(text: str) -> list[float]:
    """Numbers about the surface of a whole text, each of bounded size; all 0 without words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size = len(text)
    capitals, digits = int(counts[65:91].sum()), int(counts[48:58].sum())
    lower = int(counts[97:123].sum())
    stops = int(counts[44] + counts[46])
    signs = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) - stops
    common = Counter(words)
    lines = text.split("\n")
    share = [
        capitals / (capitals + lower + 1), digits / size, stops / size, signs / size,
        len(SIGN_RUN.findall(text)) / n, sum(common[s] for s in "|-*#>&" if s in common) / n,
        sum(map(str.__eq__, words, words[1:])) / n, common.most_common(1)[0][1] / n,
    ]
    return [
        *(math.log(s + 0.002) for s in share), len(common) / n, math.log1p(size / n),
        sum(len(w) > 20 for w in words) / n, math.log1p(size / len(lines)), 1 - len(set(lines)) / len(lines), math.log1p(n),
    ]


@dataclass(frozen=True)
class Model:
    """Standardised feature weights, the score at the cut and the scale of scores."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    scale: float


def preference_pairs(labels: np.ndarray, per_row: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Places of (preferred, other): each row of a class meets ``per_row`` rows of the other."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    other_good, other_bad = rng.choice(good, per_row * len(bad)), rng.choice(bad, per_row * len(good))
    return np.concatenate([np.repeat(good, per_row), other_good]), np.concatenate([other_bad, np.repeat(bad, per_row)])


def pair_sums(x: np.ndarray, better: np.ndarray, worse: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Gradient and curvature of the logistic loss of the feature differences of pairs, summed, and the number of pairs."""
    difference = x[better] - x[worse]
    p = 1.0 / (1.0 + np.exp(-np.clip(difference @ weights, -30, 30)))
    return difference.T @ (p - 1.0), (difference * (p * (1 - p))[:, None]).T @ difference, len(difference)


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, float]], width: int, l2: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Weights that minimise the mean loss whose sums over all pairs are given for any weights."""
    weights = np.zeros(width)
    for _ in range(rounds):
        slope, bend, n = sums(weights)
        step = np.linalg.solve(bend / n + l2 * np.eye(width), slope / n + l2 * weights)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def bradley_terry(x: np.ndarray, better: np.ndarray, worse: np.ndarray, l2: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Weights that minimise the logistic loss of the feature differences of preference pairs, by Newton steps."""
    return newton(lambda weights: pair_sums(x, better, worse, weights), x.shape[1], l2, rounds)


def _tiled(rows: DataFrame, n_bad: int, n_good: int, tile_rows: int) -> tuple[DataFrame, tuple[int, int]]:
    """``tile, rows`` and the numbers of parts of both classes.

    Each class is cut into parts of about ``tile_rows`` rows by hash, each part of the class with more parts meets one
    of the other in a tile of its own. A row counts in the first tile of its part only.
    """
    parts = -(-n_bad // tile_rows), -(-n_good // tile_rows)
    count = F.when(F.col("label") == 1, parts[1]).otherwise(parts[0])
    part = F.pmod(F.xxhash64("doc_id", "label", "features"), count)
    tiles = rows.withColumn("tile", F.explode(F.sequence(part, F.lit(max(parts) - 1).cast("long"), count.cast("long"))))
    return tiles.groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("doc_id", "label", "features"))).alias("rows")), parts


def _over_tiles(
    tiles: DataFrame, parts: tuple[int, int], values: Callable[[int, np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]], schema: str,
) -> DataFrame:
    """``values`` (``tile``, features, labels, rows that count) of every tile, as columns of ``schema``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, rows in zip(batch.column("tile").to_pylist(), batch.column("rows")):
                raw = rows.values.field("features").flatten().to_numpy().reshape(-1, len(FEATURES))
                y = rows.values.field("label").to_numpy()
                found = values(tile, raw, y, np.where(y == 1, tile < parts[1], tile < parts[0]))
                yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], names)

    return tiles.mapInArrow(compute, schema)


def _summed(tiles: DataFrame, parts: tuple[int, int], values: Callable[..., np.ndarray]) -> np.ndarray:
    """The sum of an array over all tiles, in their order: one short array per tile comes to the driver."""
    found = _over_tiles(tiles, parts, lambda tile, *rows: [[tile], [values(tile, *rows).tolist()]], "tile long, sums array<double>").toArrow()
    order = np.argsort(found["tile"].to_numpy())
    return np.array(found["sums"].to_pylist())[order].sum(0)


def _quantiles(values: DataFrame, n: int, shares: np.ndarray) -> np.ndarray:
    """The quantiles of the ``n`` values of column ``score``, interpolated between the values next to their places."""
    places = shares * (n - 1)
    ranks = np.unique(np.concatenate([np.floor(places), np.ceil(places)]).astype(np.int64))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, upto, count = (batch.column(c).to_numpy() for c in ("score", "upto", "n"))
            low, high = np.searchsorted(ranks, upto - count), np.searchsorted(ranks, upto)
            row = np.repeat(np.arange(len(score)), high - low)
            at = np.concatenate([np.empty(0, np.int64), *(ranks[a:b] for a, b in zip(low, high) if b > a)])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(score[row])], ["rank", "score"])

    counted = materialize(values.groupBy("score").agg(F.count(F.lit(1)).alias("n")))
    found = running(counted, [], ["score"], {"upto": Run("sum", F.col("n"))}, rows_per_task=RANKED_ROWS).mapInArrow(pick, "rank long, score double").toArrow()
    by_rank = found["score"].to_numpy()[np.argsort(found["rank"].to_numpy())]
    low, high = (by_rank[np.searchsorted(ranks, r(places).astype(np.int64))] for r in (np.floor, np.ceil))
    share = places - np.floor(places)
    return np.where(share >= 0.5, high - (high - low) * (1 - share), low + (high - low) * share)


def _counts_below(values: DataFrame, cuts: np.ndarray) -> np.ndarray:
    """How many values of column ``score`` lie below each of the rising cuts."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(cuts, batch.column("score").to_numpy(), side="right"))], ["place"])

    counts = np.zeros(len(cuts) + 1, np.int64)
    for row in values.select("score").mapInArrow(place, "place long").groupBy("place").count().collect():
        counts[row.place] = row["count"]
    return np.cumsum(counts)[:-1]


def cut_quantile(good: DataFrame, bad: DataFrame, n_good: int, n_bad: int, care: float) -> float:
    """The quantile of the preferred rows' scores at which to cut.

    Best by the share of others below it, less ``care`` times the share of preferred rows lost.
    """
    quantiles = np.linspace(0.0, 0.5, 501)
    cuts = np.maximum.accumulate(_quantiles(good, n_good, quantiles))
    lost, caught = _counts_below(good, cuts) / n_good, _counts_below(bad, cuts) / n_bad
    return float(quantiles[np.argmax(caught - care * lost)])


def cut_score(good: DataFrame, bad: DataFrame, n_good: int, quantile: float) -> float:
    """Half way from the preferred rows' quantile down to the best of the others below it."""
    top = float(_quantiles(good, n_good, np.array([quantile]))[0])
    below = bad.filter(F.col("score") < top).agg(F.max("score")).first()[0]
    return top if below is None else (top + below) / 2


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", tile_rows: int = 4000, pairs_per_row: int = 8, care: float = 2.0, quantile: float | None = None,
) -> Model:
    """Fit on all labelled documents: each of them meets ``pairs_per_row`` of the other class in preference pairs.

    ``quantile`` of the preferred documents' scores is the cut; None chooses it, ``care`` says how
    much a lost good document outweighs a kept bad one. The rows are dealt to tiles of about ``tile_rows`` of
    each class, which meet in pairs; the driver sees the sums of each tile.
    """
    spark = docs.sparkSession

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([features(t) for t in text_list(batch, "text")], pa.list_(pa.float64()))],
                ["doc_id", "features"])

    with scratch_scope(spark):
        chosen = materialize(labelled(labels, label_col, usable).filter("label in (0, 1)"))
        texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        if broadcastable(chosen):  # else features are joined, which are smaller than texts
            texts = texts.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
        found = texts.mapInArrow(compute, f"doc_id {id_type(docs, id_col)}, features array<double>")
        rows = materialize(lookup_join(found, chosen, ["doc_id"]).select("doc_id", "label", "features").distinct())
        n_good, n_bad = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
        width = len(FEATURES)
        if not n_good or not n_bad:
            return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
        tiles, parts = _tiled(rows, n_bad, n_good, tile_rows)
        tiles, n = materialize(tiles), n_good + n_bad
        mean = _summed(tiles, parts, lambda tile, raw, y, own: raw[own].sum(0)) / n
        spread = np.maximum(np.sqrt(_summed(tiles, parts, lambda tile, raw, y, own: ((raw[own] - mean) ** 2).sum(0)) / n), 1e-9)

        def sums(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
            def of_tile(tile: int, raw: np.ndarray, y: np.ndarray, own: np.ndarray) -> np.ndarray:
                better, worse = preference_pairs(y, pairs_per_row, 11 + tile)
                split = pairs_per_row * int((y == 1).sum())
                start, stop = 0 if tile < parts[1] else split, len(better) if tile < parts[0] else split
                slope, bend, n_pairs = pair_sums((raw - mean) / spread, better[start:stop], worse[start:stop], weights)
                return np.concatenate([slope, bend.ravel(), [n_pairs]])

            total = _summed(tiles, parts, of_tile)
            return total[:width], total[width:-1].reshape(width, width), total[-1]

        weights = newton(sums, width)

        def scored(tile: int, raw: np.ndarray, y: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
            return [y[own], (((raw - mean) / spread) @ weights)[own]]

        of_rows = materialize(_over_tiles(tiles, parts, scored, "label int, score double"))
        # the mean of the scores is 0, as that of the standardised features is
        variance = _summed(tiles, parts, lambda *tile: np.array([(scored(*tile)[1] ** 2).sum()]))[0] / n
        good, bad = of_rows.filter("label = 1"), of_rows.filter("label = 0")
        q = cut_quantile(good, bad, n_good, n_bad, care) if quantile is None else quantile
        return Model(mean, spread, weights, cut_score(good, bad, n_good, q), max(math.sqrt(variance), 1e-9))


def scores(model: Model, texts: list[str], threshold: float) -> np.ndarray:
    """Scores from 0 to 1 that keep the ranking and equal ``threshold`` at the cut; without a fitted model 0.5."""
    if not texts:
        return np.empty(0)
    if not model.weights.any():
        return np.full(len(texts), 0.5)
    raw = ((np.array([features(t) for t in texts]) - model.mean) / model.spread) @ model.weights
    at_cut = math.log(threshold / (1 - threshold))
    return 1.0 / (1.0 + np.exp(-np.clip((raw - model.cut) / model.scale + at_cut, -500, 500)))


def score_documents(
    docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3,
) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row, over whole texts."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = scores(model, text_list(batch, "text"), threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        score, f"doc_id {id_type(docs, id_col)}, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            yield batch.filter(pa.array(scores(model, text_list(batch, text_col), threshold) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def quality(docs: DataFrame, labels: DataFrame, *, divisor: int = 5, held_out: int = 0, **fitting: object) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document: fitted on labelled rows that are not held out.

    Held out are the ids whose remainder is ``held_out``. Texts without words have the features of
    an empty text. A null id is never used for fitting. With labels of one class, or none, every
    score is 0.5.
    """
    model = fit(docs, labels, id_remainder("doc_id", divisor) != held_out, **fitting)
    scored = score_documents(docs, model)
    return scored.select("doc_id", (id_remainder("doc_id", divisor) == held_out).alias("held_out"), "score", "predicted")
