"""Token counts by section: whole documents are encoded once, and token spans joined with section spans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_letters, id_type, worker_cache
from millrace.llm.tokens import text_encoder, vocabulary_path

RULES = ("first", "last", "largest")
SEPARATOR = "\n"


def token_bytes(path: str) -> np.ndarray:
    """How many bytes of a text each id of a byte-level vocabulary stands for."""

    def build() -> np.ndarray:
        tokenizer = text_encoder(path).tokenizer
        letters, special = set(byte_letters()), tokenizer.get_added_tokens_decoder()
        sizes = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
            sizes[i] = len(token.encode()) if i in special or not letters.issuperset(token) else len(token)
        return sizes

    return worker_cache(("token-bytes", path), build)


def character_spans(text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) in code points of consecutive tokens of ``sizes`` bytes.

    A token that holds a part of a character's bytes covers the character.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if text.isascii():
        return starts, ends
    raw = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with the line feed that ends them; a text has one line at least, and none after a last line feed."""
    size = len(text)
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if not ends or ends[-1] < size:
        ends.append(size)
    stops = np.array(ends)
    return np.append(0, stops[:-1]), stops


def attribute(
    starts: np.ndarray, ends: np.ndarray, section_starts: np.ndarray, section_ends: np.ndarray, rule: str,
) -> tuple[np.ndarray, np.ndarray]:
    """Per section: tokens that count for it, and tokens that it shares with another section.

    Spans are sorted; sections do not overlap. A token within one section counts for it. A token
    over several counts once: for its first or its last section, or for the one with most of its
    characters, the earlier of equals. A token between sections counts for the one before it, or
    for the first.
    """
    n = len(section_starts)
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_starts, ends, "left") - 1
    between = first > last
    owner = np.where(between, np.clip(first - 1, 0, n - 1), last if rule == "last" else first)
    crossing = np.flatnonzero(last > first)
    shared = np.zeros(n, np.int64)
    if len(crossing):
        width = last[crossing] - first[crossing] + 1
        token = np.repeat(crossing, width)
        section = first[token] + np.arange(len(token)) - np.repeat(np.cumsum(width) - width, width)
        overlap = np.minimum(ends[token], section_ends[section]) - np.maximum(starts[token], section_starts[section])
        touching = overlap > 0
        token, section, overlap = token[touching], section[touching], overlap[touching]
        several = np.bincount(token, minlength=len(starts))[token] > 1
        shared += np.bincount(section[several], minlength=n)
        if rule == "largest":
            order = np.lexsort((section, -overlap, token))
            best = order[np.append(True, np.diff(token[order]) != 0)] if len(order) else order
            owner[token[best]] = section[best]
    return np.bincount(owner, minlength=n), shared


def section_tokens(
    docs: DataFrame, *, id_col: str = "doc_id", fields: Sequence[str] = ("text",), by: str = "line", rule: str = "largest",
    tokenizer: str = "byte_bpe_50k.json",
) -> DataFrame:
    """Tokens of each section: ``doc_id, field, section, start, end, n_tokens, n_shared``, ``section`` counted by field from 0.

    The fields of a row, a line feed between two, are one text and encoded once. Sections are the
    lines of each field (``by="line"``) or the fields (``by="field"``); ``start`` and ``end`` are code
    points of that text. Each token counts for one section, by ``rule`` (``first``, ``last``,
    ``largest``: see ``attribute``), so the counts of a row add up to its tokens. A line feed between
    fields belongs to the field before it. ``n_shared``: tokens with characters of other sections.

    Null fields are empty; an empty field is one empty section. Null ids and repeated rows stay.
    """
    if rule not in RULES or by not in ("line", "field"):
        raise ValueError(f"rule must be one of {RULES}, by line or field")
    vocabulary, names = vocabulary_path(tokenizer), [f"f{i}" for i in range(len(fields))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sizes = text_encoder(vocabulary), token_bytes(vocabulary)
        for batch in batches:
            texts = [batch.column(name).to_pylist() for name in names]
            rows, field_of, places, out = [], [], [], [[], [], [], []]
            split = [[t[i] or "" for t in texts] for i in range(batch.num_rows)]
            wholes = [SEPARATOR.join(parts) for parts in split]
            for i, (parts, whole, ids) in enumerate(zip(split, wholes, encoder.encode_all(wholes))):
                starts, ends = character_spans(whole, sizes[np.frombuffer(ids, "<u4")])
                first, stop, base = [], [], 0
                for k, part in enumerate(parts):
                    size = len(part) + (k < len(parts) - 1)  # with the line feed after it
                    a, b = line_spans(part) if by == "line" else (np.array([0]), np.array([len(part)]))
                    b = np.append(b[:-1], size)
                    first.append(a + base)
                    stop.append(b + base)
                    field_of.append(np.full(len(a), k))
                    places.append(np.arange(len(a)))
                    base += size
                a, b = np.concatenate(first), np.concatenate(stop)
                n, shared = attribute(starts, ends, a, b, rule)
                rows.append(np.full(len(a), i))
                for column, values in zip(out, (a, b, n, shared)):
                    column.append(values)
            if not rows:
                continue
            ids = batch.column("doc_id").take(pa.array(np.concatenate(rows)))
            named = pa.array(list(fields)).take(pa.array(np.concatenate(field_of)))
            yield pa.RecordBatch.from_arrays(
                [ids, named, *(pa.array(np.concatenate(c).astype(np.int64)) for c in (places, *out))],
                ["doc_id", "field", "section", "start", "end", "n_tokens", "n_shared"])

    chosen = docs.select(F.col(id_col).alias("doc_id"), *[F.col(f).alias(n) for f, n in zip(fields, names)])
    return chosen.mapInArrow(count, f"doc_id {id_type(docs, id_col)}, field string, section long, start long, end long, "
                             "n_tokens long, n_shared long")
