"""Spelling variants: words one inserted, deleted or replaced letter apart, found by k-d trees over letter counts.

One edit moves the letter counts of a word by one up, one down, or both. Words of one length are cut into cells by
the upper part of a k-d tree, fitted on a sample, which decides placement only. Every word lies in one cell and asks
all cells that its box reaches, of its own length and of those one shorter and one longer. A task builds the rest of
the tree of one cell at a time, sends its askers down together, past every half that the box does not touch, and
compares what it reaches letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import small_batches, text_list
from millrace.session import materialize

RUN = re.compile("[a-zÀ-ÿ]+")
HELD_WORDS = 300_000
AXES = 32
CELL_ROWS = 20_000
LEAF_ROWS = 48
SAMPLE_ROWS = 100_000
ASKING_ROWS = 20_000
PAIRS_AT_ONCE = 2_000_000
# Letters that an edit may add and take, by the length of the words asked less that of the asking one.
BUDGETS = {-1: (0, 1), 0: (1, 1), 1: (1, 0)}


def word_counts(docs: DataFrame, *, typo_every: int = 199, least_letters: int = 6) -> DataFrame:
    """``word, n``: occurrences of all words of at least ``least_letters`` letters, counted over whole texts (``doc_id, text``).

    Words are runs of Latin letters, A-Z lower-cased. Where ``typo_every`` divides the CRC-32 of ``<doc_id>:<word>``
    the word loses the letter of that number modulo its length. A null text has no words, a null id is an empty one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in small_batches(iter([batch]), "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), text_list(part, "text")):
                    # in bytes only A-Z change
                    words = Counter(RUN.findall(text.lower() if text.isascii() else text.encode().lower().decode()))
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word in [w for w in words if zlib.crc32(w.encode(), start) % typo_every == 0]:
                        at = zlib.crc32(word.encode(), start) % len(word)
                        changed = word[:at] + word[at + 1 :]
                        # n times less here, n more of the changed word, which may itself be among the words
                        held[changed] += words[word]
                        held[word] -= words[word]
                    held.update(words)
                if len(held) > HELD_WORDS:
                    yield _counts(held, least_letters)
                    held.clear()
        yield _counts(held, least_letters)

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(held: Counter, least_letters: int) -> pa.RecordBatch:
    rows = [(w, n) for w, n in held.items() if n and len(w) >= least_letters]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])


def letters(words: list[str]) -> np.ndarray:
    """The letters of words of one length, one row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(points: np.ndarray) -> np.ndarray:
    """Letter counts of words of one length: an axis for each of a-z, the others share six. At most 127 each, which
    brings no two words further apart."""
    axes = np.where(points < 128, points - ord("a"), 26 + points % 6).astype(np.int64)
    rows = np.arange(len(points))[:, None] * AXES
    return np.minimum(np.bincount((rows + axes).ravel(), minlength=len(points) * AXES), 127).reshape(-1, AXES).astype(np.int8)


def odd_letters(counts: np.ndarray) -> np.ndarray:
    """A bit per axis, set if the count is odd; words one edit apart differ in two bits at most."""
    return (counts.astype(np.uint64) % np.uint64(2) << np.arange(AXES, dtype=np.uint64)).sum(1, dtype=np.uint64)


class KDTree:
    """Points cut by the middle of their widest axis: ``low`` holds those with ``counts[axis] <= split``."""

    def __init__(self, counts: np.ndarray, leaf_rows: int) -> None:
        self.nodes: list[list | None] = []  # (axis, split, low, high), or None for a leaf
        self.leaves: dict[int, np.ndarray] = {}
        stack = [(np.arange(len(counts)), -1, 0)]
        while stack:
            rows, above, side = stack.pop()
            node = len(self.nodes)
            if above >= 0:
                self.nodes[above][2 + side] = node
            axis = int(counts[rows].astype(np.float32).var(0).argmax()) if len(rows) > leaf_rows else 0
            values = counts[rows, axis]
            if len(rows) <= leaf_rows or values.min() == values.max():
                self.nodes.append(None)
                self.leaves[node] = rows
            else:
                # of the cuts at and below the median the more even one that leaves both sides some
                middle = int(np.median(values))
                split = min((s for s in (middle - 1, middle) if values.min() <= s < values.max()),
                            key=lambda s: abs((values <= s).mean() - 0.5))
                self.nodes.append([axis, split, -1, -1])
                under = counts[rows, axis] <= split
                stack += [(rows[~under], node, 1), (rows[under], node, 0)]

    def reach(self, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each leaf the rows of ``counts`` that could get there with so many letters added and taken."""
        if not self.nodes:
            return
        stack = [(0, np.arange(len(counts)), np.full(len(counts), up, np.int8), np.full(len(counts), down, np.int8))]
        while stack:
            node, rows, more, less = stack.pop()
            if self.nodes[node] is None:
                yield node, rows
                continue
            axis, split, low, high = self.nodes[node]
            # a budget is one letter at most, so that an axis is never paid for twice on one path
            over = counts[rows, axis].astype(np.int16) - split
            taken = less - np.maximum(over, 0)
            ok = taken >= 0
            stack.append((low, rows[ok], more[ok], taken[ok].astype(np.int8)))
            added = more - np.maximum(1 - over, 0)
            ok = added >= 0
            stack.append((high, rows[ok], added[ok].astype(np.int8), less[ok]))

    def home(self, counts: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.empty(len(counts), np.int64)
        for leaf, rows in self.reach(counts, 0, 0):
            out[rows] = leaf
        return out


def one_edit(asking: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """True for the pairs of rows that differ by one letter replaced, or by one inserted or deleted."""
    if asking.shape[1] == asked.shape[1]:
        return (asking != asked).sum(1) == 1
    short, long = (asking, asked) if asking.shape[1] < asked.shape[1] else (asked, asking)
    size = short.shape[1]
    front, back = long[:, :size] == short, long[:, 1:] == short
    first = np.where(front.all(1), size, front.argmin(1))
    last = np.where(back.all(1), size, back[:, ::-1].argmin(1))
    return first + last >= size


class Cell:
    """The words of one length in one cell, as a tree."""

    def __init__(self, words: list[str], n: np.ndarray) -> None:
        order = np.argsort(np.array(words, object), kind="stable")  # code-point order; ties of n go to the first
        self.words, self.n = [words[i] for i in order], n[order]
        self.points = letters(self.words)
        counts = letter_counts(self.points)
        self.tree, self.odd = KDTree(counts, LEAF_ROWS), odd_letters(counts)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of words of one length, the number of words here that are one edit away, and the place of the most frequent, or -1."""
        points = letters(words)
        counts = letter_counts(points)
        odd = odd_letters(counts)
        up, down = BUDGETS[self.points.shape[1] - points.shape[1]]
        number, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
        for leaf, rows in self.tree.reach(counts, up, down):
            members = self.tree.leaves[leaf]
            step = max(1, PAIRS_AT_ONCE // len(members))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                x, y = np.nonzero(np.bitwise_count(odd[some][:, None] ^ self.odd[members][None, :]) <= 2)
                x, y = some[x], members[y]
                for i in range(0, len(x), block := max(1, 50_000_000 // self.points.shape[1])):
                    hit = one_edit(points[x[i : i + block]], self.points[y[i : i + block]])
                    a, b = x[i : i + block][hit], y[i : i + block][hit]
                    np.add.at(number, a, 1)
                    order = np.lexsort((-b, self.n[b], a))  # the last of each word is its best
                    a, b = a[order], b[order]
                    final = np.append(a[1:] != a[:-1], True)[: len(a)]
                    a, b = a[final], b[final]
                    old = best[a]
                    better = (old < 0) | (self.n[b] > self.n[old]) | (self.n[b] == self.n[old]) & (b < old)
                    best[a[better]] = b[better]
        return number, best


def _upper_trees(words: DataFrame, cell_rows: int) -> tuple[dict[int, KDTree], dict[int, int]]:
    """A tree by word length, fitted on at most about ``SAMPLE_ROWS`` words by hash, and the number of its first cell."""
    total = words.count()
    share = min(1.0, SAMPLE_ROWS / max(1, total))
    picked = words.filter(F.pmod(F.xxhash64("word"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("word").limit(2 * SAMPLE_ROWS)
    by_length: dict[int, list[str]] = {}
    for word in picked.toArrow().column("word").to_pylist():
        by_length.setdefault(len(word), []).append(word)
    trees, starts, at = {}, {}, 0
    for length, own in sorted(by_length.items()):
        trees[length] = KDTree(letter_counts(letters(sorted(own))), max(4, int(cell_rows * share)))
        starts[length], at = at, at + len(trees[length].nodes)
    return trees, starts


def near_words(words: DataFrame, *, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``word, n_near, form, form_n`` of the words that have near ones (``words``: stored, distinct ``word``, ``n``):
    their number and the most frequent of them, of equals the first by code points.

    Cells of more than twice ``cell_rows`` words, which the sample missed or no letter count can split, are dealt by hash
    to parts, each of which is asked by all askers of the cell.
    """
    trees, starts = _upper_trees(words, cell_rows)
    shared = words.sparkSession.sparkContext.broadcast((trees, starts))

    def of_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str], list[int]]]:
        for batch in batches:
            groups: dict[int, tuple[list, list]] = {}
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                own = groups.setdefault(len(word), ([], []))
                own[0].append(word)
                own[1].append(n)
            for length, (own, numbers) in groups.items():
                yield length, own, numbers

    def cells_of(tree_of: dict, start_of: dict, length: int) -> tuple[KDTree | None, int]:
        # a length that the sample misses is one cell of its own
        return tree_of.get(length), start_of.get(length, -length)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, own, numbers in of_length(batches):
            tree, start = cells_of(*shared.value, length)
            cell = np.full(len(own), start) if tree is None else start + tree.home(letter_counts(letters(own)))
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(numbers, pa.int64()), pa.array(cell)], ["word", "n", "cell"])

    placed = materialize(words.select("word", "n").mapInArrow(homes, "word string, n long, cell long"))
    # one row per cell: no more than the sample has words, and one for each length that it misses
    sizes = {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}
    parts = words.sparkSession.sparkContext.broadcast({c: -(-n // cell_rows) if n > 2 * cell_rows else 1 for c, n in sizes.items()})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_pylist()
            own, numbers = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            part = [zlib.crc32(w.encode()) % parts.value[c] for w, c in zip(own, cells)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int64()), pa.array(part, pa.int64()), pa.array([False] * len(own)), pa.array(own), pa.array(numbers, pa.int64())],
                ["cell", "part", "asks", "word", "n"])
            for length, some, _ in of_length(iter([batch])):
                counts = letter_counts(letters(some))
                names = np.array(some, object)
                for more, (up, down) in BUDGETS.items():
                    tree, start = cells_of(*shared.value, length + more)
                    for leaf, rows in [(0, np.arange(len(some)))] if tree is None else tree.reach(counts, up, down):
                        k = len(rows)
                        for p in range(parts.value.get(start + leaf, 0) if k else 0):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(k, start + leaf)), pa.array(np.full(k, p)), pa.array(np.full(k, True)),
                                 pa.array(names[rows], pa.string()), pa.nulls(k, pa.int64())], ["cell", "part", "asks", "word", "n"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell, waiting, numbers, asking = None, None, [], [], []

        def answer() -> Iterator[pa.RecordBatch]:
            nonlocal cell
            if waiting and asking:
                cell = cell or Cell(waiting, np.array(numbers, np.int64))
                lengths: dict[int, list[str]] = {}
                for word in asking:
                    lengths.setdefault(len(word), []).append(word)
                for own in lengths.values():
                    found, best = cell.near(own)
                    some = np.flatnonzero(found).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own[i] for i in some], pa.string()), pa.array(found[some], pa.int64()),
                         pa.array([cell.words[best[i]] for i in some], pa.string()), pa.array(cell.n[best[some]], pa.int64())],
                        ["word", "n_near", "form", "form_n"])
            asking.clear()

        for batch in batches:
            columns = [batch.column(c) for c in ("cell", "part", "asks")]
            keys = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns])
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=1) != 0).any(0)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                if tuple(keys[:2, start]) != key:
                    yield from answer()
                    key, cell, waiting, numbers = tuple(keys[:2, start]), None, [], []
                run = batch.slice(start, stop - start)
                if keys[2, start]:
                    asking += run.column("word").to_pylist()
                    if len(asking) >= ASKING_ROWS:
                        yield from answer()
                else:
                    waiting += run.column("word").to_pylist()
                    numbers += run.column("n").to_pylist()
        yield from answer()

    asked = placed.mapInArrow(ask, "cell long, part long, asks boolean, word string, n long")
    dealt = asked.repartition("cell", "part").sortWithinPartitions("cell", "part", "asks")
    found = dealt.mapInArrow(search, "word string, n_near long, form string, form_n long")
    # a word has one row per cell that it reached, a small number
    top = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.max("form_n").alias("top"), F.collect_list(F.struct("form", "form_n")).alias("f"))
    return top.select("word", "n_near", F.array_min(F.transform(F.filter("f", lambda x: x["form_n"] == F.col("top")), lambda x: x["form"])).alias("form"),
                      F.col("top").alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of stored ``word, form``: the end of the chain of forms. Each round doubles how far a word has followed it;
    forms are more frequent than their words, so that chains are short and end."""
    reached = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    reached = materialize(reached)
    while True:
        step = materialize(reached.join(reached.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        reached = step.select("word", "root")


def spelling_variants(
    docs: DataFrame, *, least_count: int = 5, times: int = 5, least_letters: int = 6, typo_every: int = 199, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The registered query: ``word, form, root, n, n_near, form_n`` of every word of at least ``least_letters`` letters that
    occurs at least ``least_count`` times. A form is the most frequent near word, if at least ``times`` as frequent."""
    counted = word_counts(docs, typo_every=typo_every, least_letters=least_letters)
    words = materialize(counted.filter(F.col("n") >= least_count))
    near = words.join(near_words(words, cell_rows=cell_rows), "word", "left")
    holds = F.col("form_n") >= F.col("n") * times
    forms = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(holds, F.col("form")).alias("form"),
                                    F.when(holds, F.col("form_n")).alias("form_n")))
    return forms.join(roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
