"""Language identification by interpolated Kneser-Ney character models, one per language.

The models see words: maximal runs of letters, lower-cased, padded at the start and closed by an end mark.
Counts of all learned texts are gathered by Spark; each language's model is estimated from all its n-grams
and stored as two sorted arrays of 64-bit hashes, one of n-grams with their log probabilities and one of
contexts with the logarithms of what they leave to shorter ones. A text belongs to the language with the
lowest cross-entropy per letter. A part of the learned texts is not counted but calibrates the score and
the limit above which a text counts as no learned language at all.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import chunks, id_type, small_batches, text_list, worker_cache
from millrace.llm.labelled import id_remainder
from millrace.session import materialize

ORDER = 5
CALIBRATION_PARTS = 16
HELD_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")
START, END = "\0", "\1"
# Every code point is possible; the lowest order shares what is left among all of them.
CODE_POINTS = 0x110000
# Fixed odd multipliers, one per place of an n-gram, and those of the final mixing.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)
MIX = np.uint64(0xFF51AFD7ED558CCD)
UNKNOWN = "und"


def clean_words(text: str) -> list[str]:
    """The text's words; characters that are no letters (as superscript digits) are taken out of them."""
    found = WORD.findall(text.lower())
    if text.isascii():
        return found
    return [w for w in (w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in found) if w]


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """64-bit hashes of n-grams, one per row of code points; equal rows of other lengths differ."""
    total = np.full(len(points), points.shape[1], np.uint64) * MIX
    for place in range(points.shape[1]):
        total += (points[:, -1 - place].astype(np.uint64) + np.uint64(1)) * PLACES[place % len(PLACES)] * np.uint64(2 * (place // len(PLACES)) + 1)
    total ^= total >> np.uint64(33)
    total *= MIX
    return total ^ (total >> np.uint64(29))


def word_points(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, padded, in one array, and the places of letters and end marks in it."""
    pad = START * (order - 1)
    points = np.frombuffer("".join(f"{pad}{w}{END}" for w in words).encode("utf-32-le"), np.uint32)
    return points, np.flatnonzero(points)


def weighted_grams(words: dict[str, int], order: int) -> tuple[list[str], np.ndarray]:
    """The distinct n-grams of the highest order of counted words, and their counts."""
    if not words:
        return [], np.empty(0, np.int64)
    points, at = word_points(list(words), order)
    windows = points[at[:, None] - np.arange(order - 1, -1, -1)]
    weights = np.repeat(np.fromiter(words.values(), np.int64, len(words)), [len(w) + 1 for w in words])
    _, first, place = np.unique(gram_hashes(windows), return_index=True, return_inverse=True)
    text = windows[first].astype("<u4").tobytes().decode("utf-32-le")
    counts = np.bincount(place, weights, len(first)).astype(np.int64)
    return [text[i : i + order] for i in range(0, len(text), order)], counts


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, gram, n`` of all texts (``lang, text``). Tasks add up the words they hold before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                grams, counts = weighted_grams(words, order)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for part in small_batches(iter([batch]), "text"):
                for lang, text in zip(part.column("lang").to_pylist(), text_list(part, "text")):
                    held[lang].update(clean_words(text))
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    return docs.select("lang", "text").mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discount(once: float, twice: float) -> float:
    """The absolute discount from the numbers of n-grams seen once and twice."""
    return once / (once + 2 * twice) if once and twice else 0.75


def estimate(grams: str, order: int, counts: np.ndarray, totals: np.ndarray, discount: float) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Hashes and log probabilities of n-grams of all orders, hashes and log backoff weights of their contexts.

    ``grams``: the n-grams of the highest order, one after another. ``totals``: of each n-gram's context, n-grams that were not kept included; what those had goes to shorter contexts.
    Shorter n-grams count the different characters before them, as Kneser-Ney has it.
    """
    points = np.frombuffer(grams.encode("utf-32-le"), np.uint32).reshape(-1, order)
    levels = []
    numbers = counts.astype(np.float64)
    for k in range(order, 0, -1):
        own = None if k == order else _discount(float((numbers == 1).sum()), float((numbers == 2).sum()))
        _, context = np.unique(gram_hashes(points[:, :-1]), return_inverse=True)
        _, first, suffix = np.unique(gram_hashes(points[:, 1:]), return_index=True, return_inverse=True)
        total = totals.astype(np.float64) if k == order else np.bincount(context, numbers)[context]
        sure = np.maximum(numbers - (discount if own is None else own), 0) / total
        left = 1 - np.bincount(context, sure)[context]
        levels.append((points, sure, left, suffix))
        numbers = np.bincount(suffix, minlength=len(first)).astype(np.float64)
        points = points[first][:, 1:]
    keys, values, contexts, weights = [], [], [], []
    lower = np.full(1, 1 / CODE_POINTS)
    for points, sure, left, suffix in reversed(levels):
        probability = sure + left * lower[suffix]
        keys.append(gram_hashes(points))
        values.append(np.log(probability))
        hashes, first = np.unique(gram_hashes(points[:, :-1]), return_index=True)
        contexts.append(hashes)
        weights.append(np.log(np.maximum(left[first], 1e-12)))
        lower = probability
    pairs = []
    for k, v in ((keys, values), (contexts, weights)):
        k, v = np.concatenate(k), np.concatenate(v)
        at = np.argsort(k, kind="stable")
        pairs.append((k[at], v[at]))
    return pairs[0], pairs[1]


@dataclass
class Models:
    """Sorted hash arrays of each language, in the order of ``languages``; ``means`` and ``limits`` by language:
    the usual cross-entropy, and how far above it (times the root of the letters) a text may be."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    order: int = ORDER
    slope: float = 1.0
    intercept: float = 0.0
    means: list[float] = field(default_factory=list)
    limits: list[float] = field(default_factory=list)
    token: str = field(default_factory=lambda: uuid.uuid4().hex)


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in a sorted array, and whether they are there."""
    if not len(table[0]):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return at, table[0][at] == keys


def word_scores(models: Models, words: list[str]) -> np.ndarray:
    """Minus the log probability of each word (rows) in each language (columns)."""
    order = models.order
    points, at = word_points(words, order)
    # words share most of their n-grams; sorted ones are also found faster
    _, first, place = np.unique(gram_hashes(points[at[:, None] - np.arange(order - 1, -1, -1)]), return_index=True, return_inverse=True)
    windows = points[at[first][:, None] - np.arange(order - 1, -1, -1)]
    hashes = [gram_hashes(windows[:, order - k :]) for k in range(order + 1)]
    before = [None, *(gram_hashes(windows[:, order - k : order - 1]) for k in range(1, order + 1))]
    starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])[:-1]])
    out = np.empty((len(words), len(models.languages)))
    for column, (grams, contexts) in enumerate(zip(models.grams, models.contexts)):
        logs = np.zeros(len(first))
        open_ = np.arange(len(first))
        for k in range(order, 0, -1):
            found, hit = _find(grams, hashes[k][open_])
            logs[open_[hit]] += grams[1][found[hit]]
            open_ = open_[~hit]
            found, hit = _find(contexts, before[k][open_])
            logs[open_[hit]] += contexts[1][found[hit]]
        logs[open_] -= math.log(CODE_POINTS)
        out[:, column] = -np.add.reduceat(logs[place], starts)
    return out


class Scorer:
    """Scores of texts by a bounded table of words, looked up in the models when first seen.

    When the table is full it keeps the words of the texts at hand.
    """

    def __init__(self, models: Models) -> None:
        self.models = models
        self.rows: dict[str, int] = {}
        self.limit = max(20_000, min(HELD_WORDS, 4_000_000 // max(1, len(models.languages))))
        self.values = np.empty((0, len(models.languages) + 1))  # the last column: letters and the end of the word

    def _add(self, words: list[str]) -> None:
        clean = [w if w.isalpha() else "".join(filter(str.isalpha, w)) for w in words]
        new = np.zeros((len(words), self.values.shape[1]))
        some = [i for i, w in enumerate(clean) if w]
        for at in range(0, len(some), 50_000):
            part = some[at : at + 50_000]
            new[part, :-1] = word_scores(self.models, [clean[i] for i in part])
            new[part, -1] = [len(clean[i]) + 1 for i in part]
        self.rows.update(zip(words, range(len(self.rows), len(self.rows) + len(words))))
        self.values = np.concatenate([self.values, new])

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Minus the log probability of each text in each language, and its number of letters and word ends."""
        sums = np.zeros((len(texts), self.values.shape[1]))
        for start, stop in chunks(texts):
            found = [WORD.findall(t.lower()) for t in texts[start:stop]]
            flat = list(chain.from_iterable(found))
            if not flat:
                continue
            own = set(flat)
            new = list(own - self.rows.keys())
            if len(self.rows) + len(new) > self.limit:
                kept = [w for w in own if w in self.rows]
                self.values = self.values[[self.rows[w] for w in kept]]
                self.rows = dict(zip(kept, range(len(kept))))
            if new:
                self._add(new)
            rows = np.fromiter(map(self.rows.__getitem__, flat), np.int64, len(flat))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            some = np.flatnonzero(sizes)
            sums[start + some] = np.add.reduceat(self.values[rows], (np.cumsum(sizes) - sizes)[some])
        return sums[:, :-1], sums[:, -1].astype(np.int64)


def _judged(models: Models, sums: np.ndarray, events: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the place of its language, its cross-entropy, and the logarithm of 1 + the lead over the next language."""
    best = sums.argmin(1)
    least = sums[np.arange(len(sums)), best]
    nothing = events * math.log(CODE_POINTS)
    rest = np.where(np.arange(sums.shape[1]) == best[:, None], np.inf, sums).min(1) if sums.shape[1] > 1 else nothing
    return best, least / np.maximum(events, 1), np.log1p(np.maximum(np.minimum(rest, nothing) - least, 0))


def identify(docs: DataFrame, models: Models, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, surprise, lead, rejected`` of every row.

    ``rejected``: the text is less like its language than nearly all calibration texts. A text without letters is
    ``und`` with score 0 and no cross-entropy, and rejected; so is every text if no language was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        slot = worker_cache(("language-scorer",), dict)  # of one set of models at a time
        if known.token not in slot:
            slot.clear()
            slot[known.token] = Scorer(known)
        scorer = slot[known.token]
        for batch in small_batches(batches, "text"):
            texts = text_list(batch, "text")
            n = len(texts)
            if known.languages:
                sums, events = scorer.texts(texts)
                best, entropy, lead = _judged(known, sums, events)
                means = np.array(known.means or [0.0] * len(known.languages))[best]
                limits = np.array(known.limits or [math.inf] * len(known.languages))[best]
            else:
                best, events, entropy, lead, means, limits = np.zeros((6, n))
            some = events > 0
            surprise = (entropy - means) * np.sqrt(events)
            score = np.where(some, 1 / (1 + np.exp(-np.clip(known.slope * lead + known.intercept, -500, 500))), 0.0)
            names = [known.languages[int(b)] if s else UNKNOWN for b, s in zip(best, some)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(entropy, mask=~some),
                 pa.array(surprise, mask=~some), pa.array(lead, mask=~some), pa.array(~some | (surprise > limits))],
                ["doc_id", "lang_pred", "score", "cross_entropy", "surprise", "lead", "rejected"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        compute, f"doc_id {id_type(docs, id_col)}, lang_pred string, score double, cross_entropy double, surprise double, "
                 "lead double, rejected boolean")


def estimate_models(counts: DataFrame, *, order: int = ORDER, most_grams: int | None = None) -> Models:
    """Models from stored counts (``lang, gram, n``), of all n-grams. With ``most_grams`` a language keeps only those that
    make up more than its share of ``1 / most_grams`` of all its counts."""
    totals = counts.groupBy("lang").agg(
        F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
    sizes = {r.lang: r for r in totals.collect()}
    least = counts.sparkSession.createDataFrame(
        [(lang, 1 if most_grams is None else max(1, math.ceil(r.total * len(sizes) / most_grams))) for lang, r in sizes.items()], "lang string, least long")
    context = F.substring("gram", 1, order - 1).alias("context")
    whole = counts.groupBy("lang", context).agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(least), "lang").filter("n >= least").select("lang", "gram", "n", context).join(whole, ["lang", "context"])
    discounts = {lang: _discount(float(r.once), float(r.twice)) for lang, r in sizes.items()}

    def fit(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        text = "".join("".join(b.column("gram").to_pylist()) for b in table.to_batches(max_chunksize=100_000))
        found = estimate(text, order, table.column("n").to_numpy(), table.column("total").to_numpy(), discounts[lang])
        return pa.concat_tables([pa.table({
            "lang": pa.array([lang] * len(keys), pa.string()), "context": pa.array([bool(i)] * len(keys)),
            "key": pa.array(keys.view(np.int64)), "value": pa.array(values.astype(np.float32))}) for i, (keys, values) in enumerate(found)])

    rows = kept.groupBy("lang").applyInArrow(fit, "lang string, context boolean, key long, value float").toArrow()
    languages = sorted(pc.unique(rows["lang"]).to_pylist())
    grams, contexts = [], []
    for lang in languages:
        of_lang = rows.filter(pc.equal(rows["lang"], lang))
        for flag, out in ((False, grams), (True, contexts)):
            own = of_lang.filter(pc.equal(of_lang["context"], flag))
            keys = own["key"].to_numpy().view(np.uint64)
            at = np.argsort(keys, kind="stable")
            out.append((keys[at], own["value"].to_numpy()[at]))
    return Models(languages, grams, contexts, order)


def logistic(lead: np.ndarray, right: np.ndarray, wrong: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the share of right answers by lead: smoothed targets, Newton steps with a small ridge."""
    n_right, n_wrong = right.sum(), wrong.sum()
    if not n_right:
        return 1.0, 0.0
    high, low = (n_right + 1) / (n_right + 2), 1 / (n_wrong + 2)
    x = np.stack([lead, np.ones(len(lead))], 1)
    weights, target = right + wrong, right * high + wrong * low
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (target - weights * p) - 1e-3 * b
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        b += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return (max(float(b[0]), 0.0), float(b[1]))


def learn(docs: DataFrame, learned: Column, *, order: int = ORDER, most_grams: int | None = None, accepted: float = 0.995) -> Models:
    """Models of the languages of all learned rows (``doc_id, text, lang``), calibrated on the part of their texts that is not counted.

    Rows without a language or an id are not learned from. ``accepted``: the share of calibration texts of a language
    below its limit. Only one row per language and a histogram of 201 bins come to the driver besides the models.
    """
    rows = docs.filter(learned & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    kept_out = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION_PARTS)) == 0
    models = estimate_models(materialize(gram_counts(rows.filter(~kept_out), order)), order=order, most_grams=most_grams)
    if not models.languages:
        return models
    known = rows.filter(kept_out).select(F.struct("lang").alias("key"), "text")
    seen = materialize(identify(known, models, id_col="key").filter("lang_pred <> 'und'").select(
        F.col("doc_id.lang").alias("lang"), "lang_pred", "cross_entropy", "lead",
        # with a mean of 0 the surprise is the cross-entropy times the root of the number of letters
        (F.col("surprise") / F.col("cross_entropy")).alias("root")))
    histogram = seen.groupBy(F.least(F.floor(F.col("lead") * 10), F.lit(200)).alias("bin")).agg(
        F.count_if(F.expr("lang = lang_pred")).alias("right"), F.count_if(F.expr("lang <> lang_pred")).alias("wrong")).collect()
    if histogram:
        bins = np.array([(r.bin / 10 + 0.05, r.right, r.wrong) for r in histogram], float)
        models.slope, models.intercept = logistic(*bins.T)
    good = seen.filter("lang = lang_pred")
    means = good.groupBy("lang_pred").agg((F.sum(F.expr("cross_entropy * root * root")) / F.sum(F.expr("root * root"))).alias("mean"))
    surprise = (F.col("cross_entropy") - F.col("mean")) * F.col("root")
    # the percentile of few texts says little; three deviations, widened for few, are the least limit
    spread = F.coalesce(F.stddev(surprise), F.lit(0.0)) * 3 * (1 + 2 / F.sqrt(F.count(F.lit(1))))
    above = good.join(means, "lang_pred").groupBy("lang_pred", "mean").agg(
        F.greatest(F.percentile_approx(surprise, accepted, 10_000), F.avg(surprise) + spread).alias("limit"))
    found = {r.lang_pred: r for r in above.collect()}
    models.means = [found[lang].mean if lang in found else 0.0 for lang in models.languages]
    models.limits = [found[lang].limit if lang in found else math.inf for lang in models.languages]
    return models


def languages(docs: DataFrame) -> DataFrame:
    """The registered query: ``doc_id, held_out, lang_pred, score``, ``cross_entropy`` and ``rejected`` of every document.

    Held out, and never learned from, are ids whose CRC-32 has remainder 2 by 4. A null id counts as not held out and
    is not learned from either. Null and empty texts are ``und``; repeated rows stay.
    """
    models = learn(docs.select("doc_id", "text", "lang"), id_remainder("doc_id", 4) != 2)
    return identify(docs, models).select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
