"""Token files, packing, the BPE codec and attribution against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm.conftest import texts_of
from tokenizers import Tokenizer

from millrace.llm import attribution, bpe, packing, token_files
from millrace.llm.tokens import TextEncoder, text_encoder, vocabulary_path

BYTES, WORDS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text, add_special_tokens=False)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_library(path, documents):
    encode, own = library(path), text_encoder(path)
    for _, text in texts_of(documents):
        assert own.encode(text) == as_bytes(encode(text).ids)
    for c in range(1, 0x3000):
        assert own.encode(f"a1{chr(c)}b {chr(c)}") == as_bytes(encode(f"a1{chr(c)}b {chr(c)}").ids), hex(c)


def test_token_files(spark, documents, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(documents, path, end_id=2, page_bytes=4096)
    rows = token_files.token_checksums(token_files.read_token_files(spark, path)).collect()
    encode = library(BYTES)
    want = Counter((i, zlib.crc32(as_bytes([*encode(t).ids, 2])), len(encode(t).ids) + 1) for i, t in texts_of(documents))
    assert Counter((r.doc_id, r.ids_crc32, r.n_tokens) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))
    files = [pq.ParquetFile(f) for f in sorted(Path(path).glob("*.parquet"))]
    group = next(f for f in files if f.metadata.num_rows).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    plan = token_files.read_token_files(spark, path, ["doc_id", "n_tokens"])._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_token_files_empty(spark, no_documents, tmp_path):
    token_files.write_token_files(no_documents, str(tmp_path / "none"))
    assert token_files.token_checksums(token_files.read_token_files(spark, str(tmp_path / "none"))).count() == 0


def check_packing(rows, texts, window=2048):
    encode = library(WORDS)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(sum(n for _, n in p) < window for p in sequences.values()) <= 1  # one padded sequence at most
    want = Counter()
    for i, t in texts:
        want[i] += 1
        ids = [*encode(t).ids, 1]
        own = sorted((r for r in pieces[i] if r.doc_tokens == len(ids)), key=lambda r: r.start)
        assert {r.start for r in own}.issuperset({0})
        for r in own:
            assert r.ids_crc32 == zlib.crc32(as_bytes(ids[r.start : r.start + r.length])) or i is None
    assert sum(r.length for r in rows) == sum(len(encode(t).ids) + 1 for _, t in texts)


def test_packing(documents, no_documents):
    check_packing(packing.pack_documents(documents).collect(), texts_of(documents))
    assert packing.pack_documents(no_documents).count() == 0


def test_recipe_fills_windows_from_stock():
    rng = np.random.default_rng(3)
    histogram = np.bincount(rng.integers(1, 512, 3000), minlength=512)
    used = np.zeros(512, int)
    for lengths, times in packing.recipe(histogram, 512):
        assert sum(lengths) == 512 and 2 <= len(lengths) <= 3
        for n in lengths:
            used[n] += times
    assert (used <= histogram).all() and used.sum() > 0.5 * histogram.sum()
    assert packing.recipe(np.zeros(512, int), 512) == []


def test_solved_counts_reduce_the_error():
    histogram = np.array([4, 3, 5, 2])
    columns = np.array([[0, 1, -1], [0, 2, 3], [2, 2, 1]])
    uses = np.zeros((4, 3))
    for j, places in enumerate(columns):
        for p in places[places >= 0]:
            uses[p, j] += 1
    errors = [((uses @ packing.solve_counts(columns, histogram, n) - histogram) ** 2).sum() for n in (0, 5, 50, 5000)]
    assert errors == sorted(errors, reverse=True)
    best = min(((uses @ np.array([a, b, c]) / 10 - histogram) ** 2).sum()
               for a in range(60) for b in range(60) for c in range(60))
    assert errors[-1] <= best + 0.05


def test_codec(documents, no_documents):
    tokenizer = Tokenizer.from_file(WORDS)
    want = Counter()
    for i, t in texts_of(documents):
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(as_bytes(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.codec_digests(documents).collect())) == want
    assert bpe.codec_digests(no_documents).count() == 0
    encoded = bpe.encode_documents(documents)
    texts = {(r.doc_id, r.text) for r in bpe.decode_ids(encoded).collect()}
    assert texts == {(i, tokenizer.decode(tokenizer.encode(t, add_special_tokens=False).ids, skip_special_tokens=False))
                     for i, t in texts_of(documents)}


def test_codec_on_random_words():
    tokenizer, codec, rng = Tokenizer.from_file(WORDS), bpe.word_codec(WORDS), random.Random(2)
    vocabulary = sorted(tokenizer.get_vocab())
    for n in range(3000):
        if n % 2:
            text = "".join(rng.choice(vocabulary).replace("</w>", "") for _ in range(rng.randint(1, 5)))
        else:
            text = "".join(rng.choice("aabbcdehilnorstt") for _ in range(rng.randint(1, 40)))
        assert codec.encode(text) == as_bytes(tokenizer.encode(text, add_special_tokens=False).ids), text
    for text in ("ab" * 3000, "a" * 3000, "½x y z　Σ"):
        assert codec.encode(text) == as_bytes(tokenizer.encode(text, add_special_tokens=False).ids)


def brute_sections(text, rule):
    encoding = library(BYTES)(text)
    cuts = [0]
    for part in text.split("\n")[:-1]:
        cuts.append(cuts[-1] + len(part) + 1)
    if cuts[-1] < len(text) or len(cuts) == 1:
        cuts.append(len(text))
    sections = list(zip(cuts, cuts[1:]))
    counts, shared = [0] * len(sections), [0] * len(sections)
    for a, b in encoding.offsets:
        over = [(min(b, e) - max(a, s), k) for k, (s, e) in enumerate(sections) if min(b, e) > max(a, s)]
        own = {"first": over[0][1], "last": over[-1][1], "largest": min(over, key=lambda o: (-o[0], o[1]))[1]}[rule]
        counts[own] += 1
        if len(over) > 1:
            for _, k in over:
                shared[k] += 1
    return [(k, s, e, counts[k], shared[k]) for k, (s, e) in enumerate(sections)]


@pytest.mark.parametrize("rule", attribution.RULES)
def test_section_tokens(documents, no_documents, rule):
    got = Counter((r.doc_id, r.section, r.start, r.end, r.n_tokens, r.n_shared)
                  for r in attribution.section_tokens(documents, rule=rule).collect())
    want = Counter((i, *row) for i, t in texts_of(documents) for row in brute_sections(t, rule))
    assert got == want
    assert attribution.section_tokens(no_documents, rule=rule).count() == 0


def test_fields_share_one_encoding(spark):
    docs = spark.createDataFrame([(1, "Title here", "body\n\n\nof it"), (2, None, "")], "doc_id long, title string, text string")
    rows = attribution.section_tokens(docs, fields=["title", "text"], by="field").orderBy("doc_id", "start").collect()
    assert [(r.doc_id, r.field, r.start, r.end) for r in rows][:2] == [(1, "title", 0, 11), (1, "text", 11, 23)]
    assert sum(r.n_tokens for r in rows if r.doc_id == 1) == len(library(BYTES)("Title here\nbody\n\n\nof it").ids)
    assert sum(r.n_tokens for r in rows if r.doc_id == 2) == 1  # the line feed between two empty fields
    with pytest.raises(ValueError):
        attribution.section_tokens(docs, rule="middle")


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_cuts_white_space_as_library(path):
    encode, own, rng = library(path), text_encoder(path), random.Random(11)
    parts = ["a", "B", "é", "'s", "1", "½", " ", " ", "\n", "\n", "\t", "\r", "\x85", "\u00a0", ".", ",", "_", "don't", "\x1c"]
    for _ in range(8000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        assert own.encode(text) == as_bytes(encode(text).ids), repr(text)


def test_encoder_keeps_pieces_between_spaces():
    own = TextEncoder(BYTES)
    cut, own.words = [], lambda text, words=own.words: cut.append(text) or words(text)
    text = "some words stand here, and some words come again.\nsome words end"
    expected = own.encode(text)
    cut.clear()
    assert own.encode(text) == expected == as_bytes(library(BYTES)(text).ids)
    assert cut == ["some"]  # all pieces but the first are known
