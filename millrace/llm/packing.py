"""Packing: documents as pieces in sequences of a fixed number of tokens, almost without padding.

Each batch of documents is packed by a recipe: whole documents whose lengths fill a window
together. The counts of the length combinations solve a non-negative least-squares problem
against the batch's histogram of lengths. What the rounded recipe leaves over is laid end to
end and cut at the windows. The less than one window that a task keeps at its end joins
those of all tasks, so that the whole table has one padded sequence at most.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_type, text_list
from millrace.llm.tokens import text_encoder, vocabulary_path
from millrace.session import materialize

WINDOW = 2048
ROUNDS = 20


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All multisets of two or three of the lengths that fill the window, as rows of places in ``lengths`` (-1: none).

    ``lengths`` is ascending without repeats. At most ``window ** 2 / 12`` rows.
    """
    where = np.full(window + 1, -1, np.int32)
    where[lengths] = np.arange(len(lengths), dtype=np.int32)
    low = lengths[2 * lengths <= window]
    pairs = np.stack([where[low], where[window - low], np.full(len(low), -1, np.int32)], 1)
    found = [pairs[pairs[:, 1] >= 0]]
    for a in lengths[3 * lengths <= window]:
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        c = where[window - a - b]
        b = where[b][c >= 0]
        found.append(np.stack([np.full(len(b), where[a], np.int32), b, c[c >= 0]], 1))
    return np.concatenate(found)


def solve_counts(columns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative counts x of the combinations with least squares of (uses of each length - histogram).

    Multiplicative updates: x stays non-negative and the error never grows.
    """
    n = len(histogram)
    target = np.append(histogram.astype(float), 0.0)  # place -1: no third length
    counts = np.ones(len(columns))

    def down(v: np.ndarray) -> np.ndarray:
        return v[columns[:, 0]] + v[columns[:, 1]] + v[columns[:, 2]]

    wanted = down(target)
    for _ in range(rounds):
        used = np.zeros(n + 1)
        for j in range(3):
            used += np.bincount(columns[:, j] % (n + 1), counts, n + 1)
        used[-1] = 0.0
        counts *= wanted / np.maximum(down(used), 1e-12)
    return counts


def recipe(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Length combinations and how often each is packed: the solved counts, rounded up in falling order while stock lasts."""
    lengths = np.flatnonzero(histogram)
    if not len(lengths):
        return []
    columns = combinations(lengths, window)
    stock = histogram[lengths].tolist()
    counts = solve_counts(columns, histogram[lengths])
    out = []
    order = np.argsort(-counts, kind="stable")
    for places, count in zip(columns[order].tolist(), np.ceil(counts[order] - 1e-9).tolist()):
        uses: dict[int, int] = {}
        for p in places:
            if p >= 0:
                uses[p] = uses.get(p, 0) + 1
        times = min(int(count) or 1, *(stock[p] // k for p, k in uses.items()))
        if times > 0:
            for p, k in uses.items():
                stock[p] -= times * k
            out.append((tuple(int(lengths[p]) for p in places if p >= 0), times))
    return out


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1,
    window: int = WINDOW,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, whole``.

    A document's ids are its text's and ``end_id``. Full windows of a long document are
    sequences of their own; its rest and every shorter document is a piece that stays whole
    if the recipe places it (``whole``: the piece is all that is left after full windows).

    Texts are read and encoded once, batch by batch. Pieces go to a table in the shared folder
    without texts and ids; of a task's last open window the ids are kept too, fewer than
    ``window`` of them. Null text: the end id alone. Null ids and repeated rows are packed like
    others. An empty table gives no rows.
    """
    vocabulary = vocabulary_path(tokenizer)
    kind = id_type(docs, id_col)
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, task int, local long, "
              "offset long, whole boolean, tail binary")
    end, full = np.uint32(end_id).tobytes(), 4 * window

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, sequence = text_encoder(vocabulary), TaskContext.get().partitionId(), 0
        open_pieces: list[tuple] = []  # of the open window: (id, start, ids, tokens of the document, whole)
        fill = 0
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            rest: list[tuple] = []
            by_length: dict[int, list[int]] = defaultdict(list)
            for name, ids in zip(names, encoder.encode_all(text_list(batch, "text"))):
                ids += end
                total, cut = len(ids) >> 2, len(ids) // full * full
                for at in range(0, cut, full):
                    rows.append((name, at >> 2, window, zlib.crc32(ids[at : at + full]), total, task, sequence, 0, True, None))
                    sequence += 1
                if cut < len(ids):
                    by_length[len(ids) - cut >> 2].append(len(rest))
                    rest.append((name, cut >> 2, ids[cut:], total))
            histogram = np.zeros(window, np.int64)
            for length, members in by_length.items():
                histogram[length] = len(members)
            for lengths, times in recipe(histogram, window):
                for _ in range(times):
                    offset = 0
                    for length in lengths:
                        name, start, ids, total = rest[by_length[length].pop()]
                        rows.append((name, start, length, zlib.crc32(ids), total, task, sequence, offset, True, None))
                        offset += length
                    sequence += 1
            for length in sorted(by_length, reverse=True):
                for i in by_length[length]:
                    name, start, ids, total = rest[i]
                    whole = True
                    while ids:
                        part, ids = ids[: full - 4 * fill], ids[full - 4 * fill :]
                        whole = whole and not ids
                        open_pieces.append((name, start, part, total, whole))
                        start += len(part) >> 2
                        fill += len(part) >> 2
                        if fill == window:
                            offset = 0
                            for n, s, p, t, w in open_pieces:
                                rows.append((n, s, len(p) >> 2, zlib.crc32(p), t, task, sequence, offset, w, None))
                                offset += len(p) >> 2
                            open_pieces, fill, sequence = [], 0, sequence + 1
            if rows:
                yield _batch(rows, batch.schema.field("doc_id").type)
        if open_pieces:
            tail, offset = [], 0
            for n, s, p, t, w in open_pieces:
                tail.append((n, s, len(p) >> 2, 0, t, task, sequence, offset, w, p))
                offset += len(p) >> 2
            yield _batch(tail, batch.schema.field("doc_id").type)

    pieces = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(pack, schema))
    spark = docs.sparkSession
    # one row per task of the scan: its sequences, and the tokens of its last open window
    tasks = pieces.groupBy("task").agg(
        F.max(F.when(F.col("tail").isNull(), F.col("local") + 1)).alias("sequences"),
        F.sum(F.when(F.col("tail").isNotNull(), F.col("length"))).alias("tail_tokens")).orderBy("task").collect()
    bases, base, tail_base = [], 0, 0
    for t in tasks:
        bases.append((t.task, base, tail_base))
        base, tail_base = base + (t.sequences or 0), tail_base + (t.tail_tokens or 0)
    first_tail = base
    placed = pieces.join(F.broadcast(spark.createDataFrame(bases, "task int, base long, tail_base long")), "task")
    final = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "whole"]
    main = placed.filter("tail is null").withColumn("sequence_id", F.col("base") + F.col("local")).select(*final)

    def cut_tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids, at, start, whole = r["tail"], r["tail_base"] + r["offset"], r["start"], r["whole"]
                while ids:
                    room = 4 * (window - at % window)
                    part, ids = ids[:room], ids[room:]
                    whole = whole and not ids
                    n = len(part) >> 2
                    rows.append((r["doc_id"], start, n, zlib.crc32(part), r["doc_tokens"], first_tail + at // window,
                                 at % window, whole))
                    start, at = start + n, at + n
            kinds = [batch.schema.field("doc_id").type, *[pa.int64()] * 6, pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], final)

    tails = placed.filter("tail is not null").select("doc_id", "start", "doc_tokens", "offset", "whole", "tail", "tail_base")
    return main.unionByName(tails.mapInArrow(
        cut_tails, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, whole boolean"))


def _batch(rows: list[tuple], id_kind: pa.DataType) -> pa.RecordBatch:
    kinds = [id_kind, *[pa.int64()] * 4, pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "local", "offset", "whole", "tail"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
