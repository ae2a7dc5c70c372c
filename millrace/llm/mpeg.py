"""Media columns: MPEG audio as binary columns with exact durations and frame seek offsets.

A payload is stored in the ancillary bytes of MPEG-1 layer III frames: mono, variable bit rate,
each with a checksum, behind an ID3 tag and a frame with the variable-bit-rate table. The reader
takes any MPEG audio: it passes tags, finds frame headers again after foreign bytes, verifies
checksums and lists frames.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_type, small_batches, text_list
from millrace.session import scratch_path

# Fixed values of the format: kbit/s by bit-rate index, Hz by rate index.
KBPS = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
MONO, SIDE_MONO_1 = 3, 17
RATE, SAMPLES = 32000, 1152
BLOCK = 64


@dataclass(frozen=True)
class Header:
    """A frame header: ``version`` 3 is MPEG-1, 2 is MPEG-2, 0 is MPEG-2.5; ``size`` counts the whole frame."""

    version: int
    layer: int
    protected: bool
    hertz: int
    mono: bool
    size: int
    samples: int

    @property
    def side(self) -> int:
        """Bytes of side information (layer III)."""
        if self.layer != 3:
            return 0
        return (17 if self.mono else 32) if self.version == 3 else (9 if self.mono else 17)

    def like(self, other: Header) -> bool:
        return (self.version, self.layer, self.hertz) == (other.version, other.layer, other.hertz)


def parse_header(data: bytes, at: int, cache: dict[bytes, Header | None]) -> Header | None:
    """The header at a place, or None. Free-format frames count as none: they tell no size."""
    word = bytes(data[at : at + 4])
    if word in cache:
        return cache[word]
    header = None
    if len(word) == 4 and word[0] == 0xFF and word[1] >= 0xE0:
        version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
        rate, hertz = word[2] >> 4, word[2] >> 2 & 3
        if version != 1 and layer != 4 and 0 < rate < 15 and hertz < 3 and word[3] & 3 != 2:
            family = 1 if version == 3 else 2
            hz, bits = HERTZ[version][hertz], 1000 * KBPS[family, layer][rate]
            pad, samples = word[2] >> 1 & 1, 384 if layer == 1 else 1152 if layer == 2 or family == 1 else 576
            size = (12 * bits // hz + pad) * 4 if layer == 1 else samples // 8 * bits // hz + pad
            header = Header(version, layer, not word[1] & 1, hz, word[3] >> 6 == MONO, size, samples)
    if len(cache) < 4096:
        cache[word] = header
    return header


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        value = byte << 8
        for _ in range(8):
            value = (value << 1 ^ 0x8005 if value & 0x8000 else value << 1) & 0xFFFF
        table.append(value)
    return table


CRC_TABLE = _crc_table()


def crc16(data: bytes) -> int:
    """The frame checksum: x^16 + x^15 + x^2 + 1, all ones at first."""
    value = 0xFFFF
    for byte in data:
        value = (value << 8 & 0xFFFF) ^ CRC_TABLE[value >> 8 ^ byte]
    return value


def _syncsafe(n: int) -> bytes:
    return bytes(n >> shift & 0x7F for shift in (21, 14, 7, 0))


def write_audio(payload: bytes) -> bytes:
    """The payload in the ancillary bytes of layer III frames; frames decode as silence.

    Full frames have the highest bit rate, the last one the lowest that holds the rest. The tag
    says how many bytes belong to the payload and their CRC-32.
    """
    rates = KBPS[1, 3]
    overhead = 4 + 2 + SIDE_MONO_1
    room = {i: 144000 * rates[i] // RATE - overhead for i in range(1, 15)}
    frames, at = [], 0
    while True:
        left = len(payload) - at
        index = next((i for i in range(1, 15) if room[i] >= left), 14)
        part = payload[at : at + room[index]]
        words = bytes([index << 4 | 2 << 2, MONO << 6])
        side = bytes(SIDE_MONO_1)
        check = _side_crc(words) if not any(side) else crc16(words + side)
        frames.append(b"\xff\xfa" + words + struct.pack(">H", check) + side + part.ljust(room[index], b"\0"))
        at += len(part)
        if at >= len(payload):
            break
    total = 144 + sum(map(len, frames))
    ends, place = [], 144
    for f in frames:
        ends.append(place)
        place += len(f)
    toc = bytes(min(255, ends[i * len(frames) // 100] * 256 // total) for i in range(100))
    info = b"\xff\xfb" + bytes([1 << 4 | 2 << 2, MONO << 6]) + bytes(SIDE_MONO_1) + b"Xing" + struct.pack(
        ">3I", 7, len(frames), total) + toc
    texts = [(b"TLEN", b"\0%d" % (len(frames) * SAMPLES * 1000 // RATE)), (b"TXXX", b"\0payload bytes\0%d" % len(payload)),
             (b"TXXX", b"\0payload crc32\0%d" % zlib.crc32(payload))]
    body = b"".join(name + struct.pack(">IH", len(value), 0) + value for name, value in texts)
    return b"ID3\x03\0\0" + _syncsafe(len(body)) + body + info.ljust(144, b"\0") + b"".join(frames)


_SIDE_CRC: dict[bytes, int] = {}


def _side_crc(words: bytes) -> int:
    """The checksum of a header's last bytes and empty side information; one value per bit rate."""
    if words not in _SIDE_CRC:
        _SIDE_CRC[words] = crc16(words + bytes(SIDE_MONO_1))
    return _SIDE_CRC[words]


@dataclass
class Audio:
    """What a scan found. Frames of the variable-bit-rate table are not counted as audio."""

    tags: dict[str, str] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    samples: int = 0
    hertz: int = 0
    checked: int = 0
    wrong: int = 0
    skipped: int = 0
    table_frames: int = -1
    table_bytes: int = -1
    table: bytes = b""
    payload: bytes = b""


def _tag(data: bytes, at: int, out: dict[str, str]) -> int:
    """The end of an ID3v2 tag at a place; its text frames go to ``out``."""
    size = sum((b & 0x7F) << shift for b, shift in zip(data[at + 6 : at + 10], (21, 14, 7, 0)))
    end, place, major = min(at + 10 + size, len(data)), at + 10, data[at + 3]
    while major in (3, 4) and place + 10 <= end and data[place]:
        name, raw = data[place : place + 4], data[place + 4 : place + 8]
        n = struct.unpack(">I", raw)[0] if major == 3 else sum((b & 0x7F) << s for b, s in zip(raw, (21, 14, 7, 0)))
        value = data[place + 10 : min(place + 10 + n, end)]
        if name[:1] == b"T" and value[:1] in (b"\0", b"\3"):
            text = value[1:].decode("latin-1" if value[:1] == b"\0" else "utf-8", "replace")
            key, _, rest = text.partition("\0") if name == b"TXXX" else (name.decode("latin-1"), "", text)
            out[key] = rest.rstrip("\0")
        place += 10 + n
    return end


def scan_audio(data: bytes) -> Audio:
    """Frames, tags, variable-bit-rate table and checksums of MPEG audio bytes.

    A first frame is taken where a header stands and its end is another header of the same kind, a
    tag, or the end of the data; a next one where a header of the same kind follows at once. Other
    bytes are skipped up to the next first frame, and so is a frame that the end cuts off.
    """
    audio, at, cache, kind, parts, expected = Audio(), 0, {}, None, [], -1
    n = len(data)
    while at < n:
        if data.startswith(b"ID3", at) and at + 10 <= n:
            at = _tag(data, at, audio.tags)
            continue
        if data.startswith(b"TAG", at) and at + 128 == n:
            audio.tags.setdefault("TIT2", data[at + 3 : at + 33].rstrip(b"\0 ").decode("latin-1"))
            break
        header = parse_header(data, at, cache)
        end = at + header.size if header else at
        whole = header is not None and end <= n
        in_step = whole and at == expected and header.like(kind)
        if not in_step and not (whole and (
            end == n or data.startswith((b"ID3", b"TAG"), end)
            or (after := parse_header(data, end, cache)) is not None and after.like(header)
        )):
            found = data.find(b"\xff", at + 1)
            found = n if found < 0 else found
            audio.skipped += found - at
            at = found
            continue
        body = at + 4 + 2 * header.protected
        if header.protected and header.layer == 3:
            audio.checked += 1
            words, side = data[at + 2 : at + 4], data[body : body + header.side]
            right = _side_crc(words) if len(side) == SIDE_MONO_1 and not any(side) else crc16(words + side)
            audio.wrong += right != int.from_bytes(data[at + 4 : at + 6], "big")
        mark = at + 4 + header.side
        if not audio.offsets and header.layer == 3 and data[mark : mark + 4] in (b"Xing", b"Info"):
            flags = int.from_bytes(data[mark + 4 : mark + 8], "big")
            place = mark + 8
            if flags & 1:
                audio.table_frames, place = int.from_bytes(data[place : place + 4], "big"), place + 4
            if flags & 2:
                audio.table_bytes, place = int.from_bytes(data[place : place + 4], "big"), place + 4
            if flags & 4:
                audio.table = data[place : place + 100]
        else:
            audio.offsets.append(at)
            audio.sizes.append(header.size)
            audio.samples += header.samples
            audio.hertz = audio.hertz or header.hertz
            parts.append(data[body + header.side : end])
        kind, at, expected = header, end, end
    audio.payload = b"".join(parts)
    if (size := audio.tags.get("payload bytes", "")).isdigit():
        audio.payload = audio.payload[: int(size)]
        if zlib.crc32(audio.payload) != int(audio.tags.get("payload crc32", -1)):
            raise ValueError("payload does not have its checksum")
    return audio


def padded_payload(text: str) -> tuple[int, bytes]:
    """The UTF-8 size of a text, and its bytes with zeros up to a positive multiple of 64."""
    raw = text.encode()
    return len(raw), raw.ljust(max(BLOCK, -(-len(raw) // BLOCK) * BLOCK), b"\0")


def store_audio(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every whole text as a media column: ``doc_id, n_bytes, media, samples, hertz, frame_offsets``.

    ``samples / hertz`` is the exact duration; ``frame_offsets`` are byte places of the frames, so
    that a reader seeks to a time without the media column. Null text: empty. Repeated rows and
    null ids stay; an empty table leaves files without rows.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = []
            for text in text_list(batch, "text"):
                size, payload = padded_payload(text)
                media = write_audio(payload)
                found = scan_audio(media)
                rows.append((size, media, found.samples, found.hertz, found.offsets))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns, kinds)],
                ["doc_id", "n_bytes", "media", "samples", "hertz", "frame_offsets"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        store, f"doc_id {id_type(docs, id_col)}, n_bytes long, media binary, samples long, hertz int, frame_offsets array<long>")
    rows.write.option("compression", "zstd").parquet(path)


def media_features(media: DataFrame) -> DataFrame:
    """Scan the media column: payload and media digests and a feature string per row of ``doc_id, n_bytes, media``.

    ``error`` says why a row has no frames or no payload (null or foreign bytes, a payload without its checksum); else null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column("media").to_pylist():
                try:
                    a = None if data is None else scan_audio(data)
                except ValueError as problem:  # its payload is not the one its tag describes
                    rows.append((None, None, None, len(data), hashlib.sha256(data).hexdigest(), None, str(problem)))
                    continue
                if a is None:
                    rows.append((None,) * 6 + ("no media",))
                    continue
                places = hashlib.sha256(",".join(map(str, a.offsets)).encode()).hexdigest()[:16]
                feature = (f"frames={len(a.offsets)};samples={a.samples};hertz={a.hertz};checked={a.checked};wrong={a.wrong};"
                           f"skipped={a.skipped};table={a.table_frames}:{a.table_bytes};"
                           f"sizes={min(a.sizes, default=0)}-{max(a.sizes, default=0)};ms={a.tags.get('TLEN')};offsets={places}")
                rows.append((len(a.payload), hashlib.sha256(a.payload).hexdigest(), zlib.crc32(a.payload[-BLOCK:]), len(data),
                             hashlib.sha256(data).hexdigest(), feature, None if a.offsets else "no frames"))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), *map(pa.array, columns, kinds)],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "error"])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(
        read, f"doc_id {id_type(media, 'doc_id')}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
        "media_bytes long, media_sha256 string, feature string, error string")


def audio_columns(docs: DataFrame, **columns: str) -> DataFrame:
    """Store every text as audio in the shared folder, read the stored bytes back and describe them."""
    path = scratch_path(docs.sparkSession, "audio")
    store_audio(docs, path, **columns)
    return media_features(docs.sparkSession.read.parquet(path))
