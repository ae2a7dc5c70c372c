"""Literals with prefixes, subscripted targets, foreign media."""

import time

import pytest

from millrace.llm import mpeg, secret_scan

VALUE = "tR7#mVq2!xLp9"


@pytest.mark.parametrize("text", [
    f'client_secret = r"{VALUE}"', f"client_secret = Rb'{VALUE}'", f'os.environ["CLIENT_SECRET"] = f"{VALUE}"',
    f"CLIENT_SECRET ?= {VALUE}", f"env['client_secret'] = u'{VALUE}'", f'x = b"{VALUE}"\nclient_secret = x',
])
def test_forms_are_found(text):
    pairs = list(secret_scan.assignments(text))
    assert pairs and all(value == VALUE and [text[a:b] for a, b in spans] == [VALUE] for _, value, spans in pairs)
    assert [text[a:b] for a, _, b in secret_scan.literal_spans(text)] == [VALUE]


@pytest.mark.parametrize("text", [f'config[key] = "{VALUE}"', "d['client_secret'] == 5", 'd["client_secret"] ? 1 : 2'])
def test_no_false_pair(text):
    assert not secret_scan.literal_spans(text)


def test_time_stays_linear():
    start = time.perf_counter()
    for unit in ('"a"]', "r" * 3 + '"', "a ?", '"a"?', "rb'"):
        list(secret_scan.assignments(unit * 50_000))
    assert time.perf_counter() - start < 10


def test_foreign_media(spark):
    good = mpeg.write_audio(b"x" * 64)
    broken = good.replace(b"payload crc32", b"payload crc33")
    rows = [(1, 1, good), (2, 0, b""), (3, 0, None), (4, 0, b"no audio at all"), (5, 1, broken)]
    got = {r["doc_id"]: r for r in mpeg.media_features(spark.createDataFrame(rows, "doc_id long, n_bytes long, media binary")).collect()}
    assert got[1]["error"] is None and got[1]["payload_bytes"] == 64
    assert (got[2]["error"], got[3]["error"], got[4]["error"]) == ("no frames", "no media", "no frames")
    assert got[4]["media_bytes"] == 15 and got[3]["media_bytes"] is None
    assert "checksum" in got[5]["error"] and got[5]["payload_sha256"] is None
