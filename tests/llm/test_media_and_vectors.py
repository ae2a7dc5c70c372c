"""Audio columns by exact round trips and damaged inputs; vector search against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.conftest import texts_of
from pyspark.sql import functions as F

from millrace.llm import mpeg, vector_topk


def test_audio_columns(documents, no_documents):
    want = Counter()
    for i, t in texts_of(documents):
        raw = t.encode()
        payload = raw + bytes(-len(raw) % 64 or 64 * (not raw))
        want[i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])] += 1
    rows = mpeg.audio_columns(documents).collect()
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    assert all(";wrong=0;skipped=0;" in r.feature for r in rows)
    assert len({(r.payload_sha256, r.media_sha256, r.feature) for r in rows}) == len({r.payload_sha256 for r in rows})
    assert mpeg.audio_columns(no_documents).count() == 0


def test_table_and_durations():
    media = mpeg.write_audio(bytes(range(1, 251)) * 40)
    audio = mpeg.scan_audio(media)
    first = media.index(b"\xff\xfb")
    assert audio.table_frames == len(audio.offsets) and audio.table_bytes == len(media) - first
    assert audio.samples == 1152 * len(audio.offsets) and audio.hertz == 32000
    assert int(audio.tags["TLEN"]) == audio.samples * 1000 // 32000
    assert audio.checked == len(audio.offsets) and audio.wrong == 0 and len(audio.table) == 100
    for offset, size in zip(audio.offsets, audio.sizes):
        assert media[offset : offset + 2] == b"\xff\xfa" and offset + size <= len(media)


@pytest.mark.parametrize("seed", range(6))
def test_payloads_that_look_like_frames(seed):
    rng = random.Random(seed)
    payload = bytes(rng.choice((0xFF, 0xFB, 0xFA, 0x00, 0x49, 0x44, 0x33, rng.randrange(256))) for _ in range(rng.randint(1, 9000)))
    assert mpeg.scan_audio(mpeg.write_audio(payload)).payload == payload


def frames(count, head=b"\xff\xfb\x90\x64"):
    size = mpeg.parse_header(head, 0, {}).size
    return [head + bytes([i % 250]) * (size - 4) for i in range(count)]


def test_resynchronises_after_foreign_bytes():
    clean = frames(6)
    damaged = b"junk\xff\xfb" + b"".join(clean[:3]) + b"\xff\xff\x00garbage\xff" + b"".join(clean[3:])
    audio = mpeg.scan_audio(damaged)
    assert len(audio.offsets) == 6 and audio.skipped == len(damaged) - sum(map(len, clean))
    assert mpeg.scan_audio(b"".join(clean)[:-5]).samples == 5 * 1152
    tagged = mpeg.scan_audio(b"".join(clean) + b"TAG" + b"a title".ljust(125, b"\0"))
    assert len(tagged.offsets) == 6 and tagged.tags["TIT2"] == "a title"
    assert mpeg.scan_audio(b"").offsets == [] and mpeg.scan_audio(b"\xff" * 50).offsets == []


def test_checksums_are_verified():
    media = bytearray(mpeg.write_audio(b"x" * 3000))
    media[mpeg.scan_audio(bytes(media)).offsets[1] + 8] ^= 1  # side information of the second frame
    assert mpeg.scan_audio(bytes(media)).wrong == 1
    media[-10] ^= 1
    mpeg.scan_audio(bytes(media)[:-1] + b"\0")
    broken = bytearray(mpeg.write_audio(b"x" * 3000))
    broken[mpeg.scan_audio(bytes(broken)).offsets[0] + 40] ^= 1
    with pytest.raises(ValueError):
        mpeg.scan_audio(bytes(broken))


@pytest.mark.parametrize("head,size,samples,hertz", [
    (b"\xff\xfb\x90\x00", 417, 1152, 44100), (b"\xff\xfb\x92\x00", 418, 1152, 44100), (b"\xff\xf3\x80\x00", 208, 576, 22050),
    (b"\xff\xe3\x80\x00", 417, 576, 11025), (b"\xff\xfd\x84\x00", 384, 1152, 48000), (b"\xff\xff\x90\x00", 312, 384, 44100),
])
def test_headers(head, size, samples, hertz):
    h = mpeg.parse_header(head, 0, {})
    assert (h.size, h.samples, h.hertz) == (size, samples, hertz)


@pytest.mark.parametrize("head", [b"\xff\xfb\xf0\x00", b"\xff\xfb\x00\x00", b"\xff\xfb\x9c\x00", b"\xff\xeb\x90\x00", b"\xff\xf9\x90\x00", b"\xff\xfb"])
def test_no_headers(head):
    assert mpeg.parse_header(head, 0, {}) is None


def brute_top(rows, k, is_query):
    vectors = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            vectors.setdefault(i, []).append([int(np.floor(1024 * x)) for x in v])
    out = []
    for q in vectors:
        if is_query(q):
            own = min(vectors[q])
            scored = [(-max(sum(a * b for a, b in zip(own, v)) for v in vs if len(v) == len(own)), i)
                      for i, vs in vectors.items() if i != q and any(len(v) == len(own) for v in vs)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("size,block", [(64, 8192), (64, 7), (16, 8192), (5, 3)])
def test_vector_search(spark, size, block):
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(6, size))
    rows = [(i, (centres[i % 6] + rng.normal(size=size) * 0.3).tolist()) for i in range(900)]
    rows += [(i, [float(i % 3)] * size) for i in range(900, 960)]  # ties
    rows += [(1000, None), (1001, []), (1002, [None] * size), (1003, [float("nan")] * size), (1004, [float("inf")] * size),
             (1005, [0.5] * (size + 1)), (1010, [0.25] * (size + 1)), (None, [1.0] * size), rows[7], rows[20], rows[20]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1.0)).repartition(3)
    got = vector_topk.top_products(table, F.col("vec_id") % 20 == 0, query_block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 10, lambda i: i % 20 == 0)


@pytest.mark.parametrize("block", [8192, 7])
def test_vector_search_of_ids_with_several_vectors(spark, block):
    rng = np.random.default_rng(9)
    rows = [(i % 200, rng.normal(size=16).tolist()) for i in range(1500)] + [(500, (rng.normal(size=16) + 3).tolist()) for _ in range(300)]
    rows += rows[::7]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = vector_topk.top_products(table, F.col("vec_id") % 20 == 0, query_block=block)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 10, lambda i: i % 20 == 0)


def test_vector_search_of_few_or_no_rows(spark):
    table = spark.createDataFrame([(100, [1.0, 2.0]), (7, [0.5, -1.0])], "vec_id long, embedding array<float>")
    got = vector_topk.top_products(table, F.col("vec_id") % 100 == 0).collect()
    assert list(map(tuple, got)) == [(100, 1, 7, 1024 * 512 - 2048 * 1024)]
    assert vector_topk.top_products(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a = vector_topk.Block(np.arange(40), np.floor(1024 * rng.normal(size=(40, 64))))
    b = vector_topk.Block(np.arange(300), np.floor(1024 * rng.normal(size=(300, 64))))
    exact = a.vectors @ b.vectors.T
    coarse, fine = vector_topk.upper_bounds(a, b, 0), vector_topk.upper_bounds(a, b, 1)
    assert (coarse >= exact).all() and (fine >= exact).all() and fine.mean() < coarse.mean()
