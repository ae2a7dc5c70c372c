"""Whole-text encoding by the ``tokenizers`` library, one call of its model per new word.

A pre-tokenizer cuts a text into words and the model merges within words only, so the ids
of a text are the ids of its words in order. Words repeat, and so does what stands between two
spaces, so each worker keeps bounded tables of the ids of both. Texts with special tokens, odd characters or texts that
are not in normal form C go through the library's own ``encode`` whole.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array

import numpy as np

from millrace.llm.common import WordTable, byte_letters, has_odd, worker_cache

# The word patterns of the two vocabularies, for texts without odd characters.
GPT_WORDS = r"'(?:[stmd]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
LOWER_WORDS = r"'(?:[stmd]|ll|ve|re)|[^\W\d_]+|\d|(?:[^\s\w]|_)+"


def vocabulary_path(name: str) -> str:
    """The file of a public tokenizer; a path stays as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))
ENDINGS = (",", ".", ";", ":", "!", "?")


class Unfit(ValueError):
    """Pieces between spaces do not give the words of this text."""


class TextEncoder:
    """``encode(text)``: the ids as little-endian unsigned 32-bit integers, as the library gives them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.lower = self.tokenizer.normalizer is not None
        self.words = re.compile(LOWER_WORDS if self.lower else GPT_WORDS).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters, model = byte_letters(), self.tokenizer.model
        table = {b: letters[b] for b in range(256)}

        def ids(word: str) -> bytes:
            body = word.removeprefix(" ")
            if body.isascii() and body.isalpha():  # the common case: letters are written as themselves
                written = body if body is word else letters[32] + body
            else:
                written = word.encode().decode("latin-1").translate(table)
            found = array("I", [t.id for t in model.tokenize(written)])
            if sys.byteorder == "big":
                found.byteswap()
            return found.tobytes()

        def piece_ids(piece: str) -> bytes:
            if not self.lower:
                if piece.isalpha():
                    return ids(" " + piece)
                if piece[-1:] in ENDINGS and piece[:-1].isalpha():
                    return self.pieces[piece[:-1]] + self.table[piece[-1]]
                body = piece.removeprefix("\n")
                if not piece or body and (body[0].isspace() or body[-1].isspace()):
                    raise Unfit
                piece = piece if piece[0] == "\n" else " " + piece
            return b"".join(map(self.table.__getitem__, self.words(piece)))

        self.table, self.pieces = WordTable(ids, 160_000 if self.lower else 40_000), WordTable(piece_ids, 320_000, new_limit=300_000)

    def _plain(self, text: str) -> bytes:
        """By pieces of the text, if white space stands alone; a piece takes the space or the line feed before it."""
        if self.lower:  # white space is in no word
            return b"".join(map(self.pieces.__getitem__, text.lower().split()))
        try:
            if "\n\n" in text and ("\n\n\n" in text or "\n\n " in text or text.endswith("\n\n")):  # such a run is one word
                raise Unfit
            first, *rest = text.replace("\n", " \n").split(" ")
            if first and (first[0].isspace() or first[-1].isspace()):
                raise Unfit
            return b"".join([*map(self.table.__getitem__, self.words(first)), *map(self.pieces.__getitem__, rest)])
        except Unfit:
            return b"".join(map(self.table.__getitem__, self.words(text)))

    def encode(self, text: str) -> bytes:
        if any(map(text.__contains__, self.special)) or has_odd(text) or self.lower and not unicodedata.is_normalized("NFC", text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self._plain(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return list(map(self.encode, texts))


def text_encoder(path: str) -> TextEncoder:
    return worker_cache(("encoder", path), lambda: TextEncoder(path))
