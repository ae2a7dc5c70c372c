"""Helpers of the task side: text batches, caches of a Python worker, word tables."""

from __future__ import annotations

import gc
import re
import sys
import types
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

CHUNK_CHARS = 2_000_000
BATCH_BYTES = 8 << 20


def _worker_store() -> tuple[dict, dict]:
    """Objects of this Python worker by key, and the stage that last asked for each.

    Functions travel to the workers by value and bring fresh globals with them; a module
    entry of the process does not.
    """
    module = sys.modules.setdefault("_millrace_llm_worker", types.ModuleType("_millrace_llm_worker"))
    return module.__dict__.setdefault("kept", {}), module.__dict__.setdefault("stages", {})


def _stage() -> int | None:
    task = TaskContext.get()
    return task.stageId() if task else None


def drop_other_stages() -> None:
    """Free what stages other than the running one left in this Python worker, for stages that need the memory."""
    kept, stages = _worker_store()
    stage = _stage()
    old = [key for key, last in stages.items() if last != stage]
    if old:
        for key in old:
            del kept[key], stages[key]
        gc.collect()  # encoders hold themselves through their tables
        pa.default_memory_pool().release_unused()


def worker_cache(key: tuple, make: Callable[[], object]) -> object:
    """An object that lives in its Python worker, so that later tasks need not build it again.

    Everything kept here has a bounded size. A stage that builds an object of its own first drops those that only
    earlier stages asked for: a worker that outlives many stages holds the objects of one of them, not of all.
    """
    kept, stages = _worker_store()
    if key not in kept:
        drop_other_stages()
        kept[key] = make()
    stages[key] = _stage()
    return kept[key]


class WordTable(dict):
    """Word to value, computed at first sight. Words seen once wait in a small table of their own, those seen
    again are kept in this one; either is emptied when it is full, so the size is bounded."""

    def __init__(self, make: Callable[[str], object], limit: int = 250_000, longest: int = 48, new_limit: int | None = None) -> None:
        super().__init__()
        self.make, self.limit, self.longest, self.new_limit = make, limit, longest, new_limit or limit // 3
        self.new: dict[str, object] = {}

    def __missing__(self, word: str) -> object:
        value = self.new.pop(word, None)
        if value is not None:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
            return value
        value = self.make(word)
        if len(word) <= self.longest:
            if len(self.new) >= self.new_limit:
                self.new.clear()
            self.new[word] = value
        return value


def text_list(batch: pa.RecordBatch, column: str) -> list[str]:
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``most`` bytes of text, so that what a task makes of a batch stays small.

    A longer text is a batch of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` characters together; a longer text is a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def id_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


# A class of characters none of which is odd; most texts have no others.
PLAIN = re.compile("[^\\x00-\\x1b\\x20-\\xb1\\xb4-\\xb8\\xba\\xbb\\xbf-\u02af\u2010-\u2027]")


def has_odd(text: str) -> bool:
    """True if ``re`` and Unicode-aware tokenizers may disagree on the class of a character of the text.

    Odd are numbers that are no decimal digits, separators 1C to 1F, capital sigma (its
    lower case depends on its place), and what this Unicode version has not assigned.
    """
    if text.isascii():
        return not text.isprintable() and any(c in text for c in "\x1c\x1d\x1e\x1f")
    if not PLAIN.search(text):
        return False

    def build() -> bytearray:
        flags = bytearray(sys.maxunicode + 1)
        for c in range(sys.maxunicode + 1):
            s = chr(c)
            flags[c] = (0x1C <= c <= 0x1F or c == 0x3A3 or s.isalnum() and not s.isalpha() and not s.isdecimal()
                        or unicodedata.category(s) == "Cn")
        return flags

    flags = worker_cache(("odd",), build)
    return any(flags[ord(c)] for c in set(text))


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]
