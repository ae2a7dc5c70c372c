"""BPE by backtracking: longest token matches, checked pair by pair, give the merges' own result in linear time.

A vocabulary's tokens are strings of symbols (bytes; with a word-end suffix the last byte of a
word is a symbol of its own). The longest token at a place is taken if it may follow the token
before it, that is, if merging both texts would never join symbols across their border; else
a shorter token is tried, and with none left the token before is taken back. A place found
impossible once is not tried again. Decoding slices one table of token texts by offsets.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordTable, byte_letters, chunks, has_odd, id_type, small_batches, text_list, worker_cache
from millrace.llm.tokens import LOWER_WORDS, vocabulary_path

# The word pattern by Unicode classes, and white space as Unicode has it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ANY_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"


class Merges:
    """Encoder of words for a vocabulary with a word-end suffix, from its merge list."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str) -> None:
        import ahocorasick

        byte_of = {letter: b for b, letter in enumerate(byte_letters())}

        def symbols(token: str) -> str:
            last = token.endswith(suffix) and len(token) > len(suffix)
            body = token[: -len(suffix)] if last else token
            codes = [byte_of[c] for c in body]
            if last:
                codes[-1] += 256
            return "".join(map(chr, codes))

        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        made = {a + b for a, b in pairs}
        # by rank: the single symbols, then the merges in order
        base = [t for t in vocabulary if t not in made and set(t.removesuffix(suffix) or "?") <= byte_of.keys()
                and len(symbols(t)) == 1]
        tokens = [*base, *(a + b for a, b in pairs)]
        rank = {t: i for i, t in reversed(list(enumerate(tokens)))}  # a token made twice has its first rank
        self.ids = [vocabulary[t] for t in tokens]
        self.split = [(i, i) for i in range(len(base))] + [(rank[a], rank[b]) for a, b in pairs]
        self.joined = {}
        for (a, b) in pairs:
            self.joined.setdefault((rank[a], rank[b]), rank[a + b])
        texts = [symbols(t) for t in tokens]
        self.size = [len(t) for t in texts]
        own = {t: i for i, t in reversed(list(enumerate(texts)))}
        self.shorter = []  # the longest token that is a proper beginning of the token
        for t in texts:
            n = len(t) - 1
            while n and t[:n] not in own:
                n -= 1
            self.shorter.append(own[t[:n]] if n else -1)
        self.matches = ahocorasick.Automaton()
        for t, i in own.items():
            self.matches.add_word(t, i)
        self.matches.make_automaton()
        self.compatible: dict[int, bool] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """True if merging the two tokens' text gives these two tokens: no merge across their border comes before theirs."""
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            known = self.compatible[key] = self._check(left, right)
            if len(self.compatible) > 2_000_000:
                self.compatible.clear()
        return known

    def _check(self, left: int, right: int) -> bool:
        # undo the merges of both sides, latest first; a pair at the border that merges earlier wins over them
        before = len(self.split)
        while True:
            across = self.joined.get((left, right))
            if across is not None and across < before:
                return False
            if left > right:
                before, left = left, self.split[left][1]
                if left == before:
                    before, right = right + 1, self.split[right][0]
                    if right + 1 == before:
                        return True
            else:
                before, right = right + 1, self.split[right][0]
                if right + 1 == before:
                    before, left = left, self.split[left][1]
                    if left == before:
                        return True

    def word(self, word: str) -> list[int]:
        """The ids of one word."""
        codes = list(word.encode())
        codes[-1] += 256
        text = "".join(map(chr, codes))
        size, shorter, n = self.size, self.shorter, len(text)
        longest = [-1] * (n + 1)
        for last, token in self.matches.iter(text):  # ends ascend: the longest match at a place comes last
            longest[last - size[token] + 1] = token
        open_, out, at = bytearray(b"\x01" * (n + 1)), [], 0
        token = longest[0]
        while at < n:
            before = out[-1] if out else -1
            while token >= 0:
                if open_[at + size[token]] and (before < 0 or self.may_follow(before, token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                token = longest[at]
            else:
                open_[at] = 0
                token = out.pop()
                at -= size[token]
        return [self.ids[t] for t in out]


class WordCodec:
    """Encodes and decodes whole texts with a lower-case word vocabulary, as its own library would."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        self.words, self.any_words = re.compile(LOWER_WORDS).findall, regex.compile(ANY_WORDS).findall
        self.table = WordTable(lambda w: np.array(self.merges.word(w), "<u4").tobytes())
        texts = {**{i: t for t, i in model["vocab"].items()}, **{i: t for t, i in self.special.items()}}
        blobs = [texts.get(i, "").encode() + b" " for i in range(max(texts) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers. Special tokens in the text are one id each."""
        if not any(map(text.__contains__, self.special)):
            return self._plain(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p)
                        for p in self.pieces(text))

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        if has_odd(text):
            words = self.any_words(text.replace("Σ", "σ").lower())  # sigma is lowered by itself
        else:
            words = self.words(text.lower())
        return b"".join(map(self.table.__getitem__, words))

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The UTF-8 text of each row of ids: token texts, by a space apart, from the offset table."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        sizes = self.offsets[flat + 1] - self.offsets[flat]
        ends = np.cumsum(sizes)
        if not len(flat):
            return [b""] * len(ids)
        where = np.ones(ends[-1], np.int64)
        where[0] = self.offsets[flat[0]]
        where[ends[:-1]] = self.offsets[flat[1:]] - self.offsets[flat[:-1] + 1] + 1
        data = self.blob[np.cumsum(where)].tobytes()
        stops = np.append(0, ends)[np.cumsum([len(i) >> 2 for i in ids])].tolist()
        return [data[a : b - 1] if b > a else b"" for a, b in zip([0, *stops], stops)]


def word_codec(path: str) -> WordCodec:
    return worker_cache(("codec", path), lambda: WordCodec(path))


def encode_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json",
) -> DataFrame:
    """``doc_id`` and ``ids`` (binary, little-endian unsigned 32-bit) of every whole text. Null and empty texts: no ids."""
    vocabulary = vocabulary_path(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(vocabulary)
        for batch in small_batches(batches, "text"):
            ids = [codec.encode(t) for t in text_list(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        encode, f"doc_id {id_type(docs, id_col)}, ids binary")


def decode_ids(encoded: DataFrame, *, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """``doc_id`` and ``text`` of rows of ``doc_id, ids``; null ids give a null text, an unknown id an error."""
    vocabulary = vocabulary_path(tokenizer)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(vocabulary)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = codec.decode([i or b"" for i in ids])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([None if i is None else t.decode() for i, t in zip(ids, texts)], pa.string())],
                ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {id_type(encoded, 'doc_id')}, text string")


def codec_digests(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json",
) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded and decoded again in one pass."""
    vocabulary = vocabulary_path(tokenizer)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(vocabulary)
        for batch in small_batches(batches, "text"):
            texts = text_list(batch, "text")
            rows = []
            for start, stop in chunks(texts):
                ids = [codec.encode(t) for t in texts[start:stop]]
                rows += [(len(i) >> 2, hashlib.sha256(i).hexdigest(), hashlib.sha256(d).hexdigest())
                         for i, d in zip(ids, codec.decode(ids))]
            columns = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns, [pa.int64(), pa.string(), pa.string()])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        digest, f"doc_id {id_type(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
