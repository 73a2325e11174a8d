"""Ogg media columns: multiplexing and reading of whole files held in a binary column.

Reading verifies each page's checksum, takes the page apart by its lacing values, puts
packets that run over pages together again, keeps the logical streams apart by serial
number, and derives a time for each packet's end from the granule position (samples at
the stream's rate).  A page with a wrong checksum is counted and left out; a packet that
a lost page cut is dropped and counted.

Writing puts a payload of 8-bit samples in one logical stream and a short note on it
(sample rate and unpadded length) in a second one, with their pages interleaved.

The page checksum is the CRC with polynomial 0x04C11DB7, most significant bit first and
no inversion: the bit-mirrored zlib CRC of the bit-mirrored bytes.

Defined results: null text counts as empty, and an empty text is one block of zeros;
equal texts give equal files; an unreadable file gives a row with null fields; repeated
rows give a row each; an empty table gives an empty result; only the id and the text
are read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .base import arrow_map, read_table, texts

PAGE = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
RATE = 8000
BLOCK = 64
PACKET_SAMPLES = 16_000
SAMPLE_HEAD = struct.Struct("<8sIBB")
NOTE_HEAD = b"TMNOTE01"
SAMPLE_MAGIC = b"TMPCMU08"
NOTE = struct.Struct("<QQ")

_MIRROR = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(data: bytes) -> int:
    mirrored = zlib.crc32(data.translate(_MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_MIRROR), "big")


def pages(serial: int, packets: list[tuple[bytes, int]]) -> list[bytes]:
    """The pages of one logical stream: its first packet alone on the first page, then as many segments as fit."""
    out: list[bytes] = []
    lacing: list[int] = []
    body: list[bytes] = []
    state = {"granule": -1, "continued": False}

    def flush(last: bool = False) -> None:
        kind = (CONTINUED if state["continued"] else 0) | (FIRST if not out else 0) | (LAST if last else 0)
        head = PAGE.pack(b"OggS", 0, kind, state["granule"], serial, len(out), 0, len(lacing))
        page = head + bytes(lacing) + b"".join(body)
        out.append(page[:22] + struct.pack("<I", checksum(page)) + page[26:])
        state["continued"] = bool(lacing) and lacing[-1] == 255
        state["granule"] = -1
        lacing.clear()
        body.clear()

    for k, (packet, granule) in enumerate(packets):
        full, rest = divmod(len(packet), 255)
        sizes = [255] * full + [rest]
        at = 0
        while sizes:
            if len(lacing) == 255:
                flush()
            fit = sizes[: 255 - len(lacing)]
            lacing.extend(fit)
            body.append(packet[at : at + sum(fit)])
            at += sum(fit)
            sizes = sizes[len(fit) :]
        state["granule"] = granule
        if k == 0 or k == len(packets) - 1:
            flush(last=k == len(packets) - 1)
    return out


def write_file(raw: bytes, rate: int = RATE) -> bytes:
    """An Ogg file of raw, padded with zeros to a positive multiple of BLOCK."""
    payload = raw + bytes(max(BLOCK, -(-len(raw) // BLOCK) * BLOCK) - len(raw))
    serial = zlib.crc32(payload)
    samples = [(SAMPLE_HEAD.pack(SAMPLE_MAGIC, rate, 1, 8), 0)]
    for at in range(0, len(payload), PACKET_SAMPLES):
        part = payload[at : at + PACKET_SAMPLES]
        samples.append((part, at + len(part)))
    sound = pages(serial, samples)
    note = pages(serial ^ 0xFFFFFFFF, [(NOTE_HEAD, 0), (NOTE.pack(len(raw), len(payload)), len(payload))])
    return b"".join([sound[0], note[0], note[1], *sound[1:]])


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)  # -1: no packet time known
    n_pages: int = 0
    lost: int = 0
    begun: bool = False
    ended: bool = False
    _part: list[bytes] | None = None
    _next: int = 0

    def take(self, kind: int, granule: int, number: int, lacing: bytes, body: bytes) -> None:
        if number != self._next or bool(kind & CONTINUED) != (self._part is not None):
            if self._part is not None:
                self._part = None
                self.lost += 1
            skip = bool(kind & CONTINUED)
        else:
            skip = False
        self._next = number + 1
        self.n_pages += 1
        self.begun |= bool(kind & FIRST)
        self.ended |= bool(kind & LAST)
        at, size, done = 0, 0, []
        part = self._part or []
        for lace in lacing:
            size += lace
            if lace < 255:
                if skip:
                    skip = False
                    self.lost += 1
                else:
                    done.append(b"".join([*part, body[at : at + size]]))
                part, at, size = [], at + size, 0
        if size or (lacing and lacing[-1] == 255):
            self._part = None if skip else [*part, body[at : at + size]]
        else:
            self._part = None
        self.packets += done
        self.granules += [-1] * (len(done) - 1) + [granule] * bool(done)


@dataclass
class Report:
    streams: dict[int, Stream]
    n_pages: int
    bad_pages: int


def read_file(data: bytes) -> Report:
    streams: dict[int, Stream] = {}
    at = good = bad = 0
    while True:
        at = data.find(b"OggS", at)
        if at < 0 or at + PAGE.size > len(data):
            break
        _, version, kind, granule, serial, number, crc, n = PAGE.unpack_from(data, at)
        body_at = at + PAGE.size + n
        lacing = data[at + PAGE.size : body_at]
        end = body_at + sum(lacing)
        page = data[at:end]
        if version or len(lacing) < n or end > len(data) or checksum(page[:22] + bytes(4) + page[26:]) != crc:
            bad += 1
            at += 4  # look for the next page behind the capture pattern
            continue
        good += 1
        streams.setdefault(serial, Stream(serial)).take(kind, granule, number, lacing, data[body_at:end])
        at = end
    return Report(streams, good, bad)


def packet_times(stream: Stream, rate: int) -> list[float | None]:
    """Seconds at each packet's end; None where no granule position tells."""
    return [g / rate if g >= 0 else None for g in stream.granules]


@dataclass
class Sound:
    rate: int
    samples: bytes
    n_raw: int
    seconds: float
    report: Report
    packets: int


def read_sound(data: bytes) -> Sound | None:
    """The payload and its note out of a file; None if one of them is missing or damaged."""
    report = read_file(data)
    sound = note = None
    for s in report.streams.values():
        if s.packets and s.packets[0][:8] == SAMPLE_MAGIC and len(s.packets[0]) == SAMPLE_HEAD.size:
            sound = s
        elif s.packets and s.packets[0] == NOTE_HEAD:
            note = s
    if sound is None or note is None or len(note.packets) < 2 or report.bad_pages or sound.lost or not sound.ended:
        return None
    n_raw, n_payload = NOTE.unpack(note.packets[1])
    rate = SAMPLE_HEAD.unpack(sound.packets[0])[1]
    samples = b"".join(sound.packets[1:])
    times = [t for t in packet_times(sound, rate) if t is not None]
    if len(samples) != n_payload:
        return None
    return Sound(rate, samples, n_raw, times[-1] if times else 0.0, report, len(sound.packets) - 1)


def feature_of(sound: Sound) -> str:
    x = np.frombuffer(sound.samples, dtype=np.uint8)
    change = np.count_nonzero(x[1:] != x[:-1])
    total, squares = int(x.sum(dtype=np.int64)), int(np.square(x.astype(np.int64)).sum())
    return f"streams={len(sound.report.streams)};pages={sound.report.n_pages};packets={sound.packets};seconds={sound.seconds:.6f};sum={total};squares={squares};changes={change}"


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, media)."""

    def run(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "media": [write_file(t.encode("utf-8", "surrogatepass")) for t in b["text"]]}

    return arrow_map(texts(docs, id_col, text_col), run, "doc_id long, media binary")


MEDIA_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def from_media(media: DataFrame) -> DataFrame:
    """What the files in the media column hold."""

    def run(batches):
        for b in batches:
            out = {k.split()[0]: [] for k in MEDIA_SCHEMA.split(", ")}
            for doc_id, data in zip(b["doc_id"], b["media"]):
                sound = read_sound(data) if data is not None else None
                row = [doc_id]
                if sound is None:
                    row += [None] * 4
                else:
                    row += [sound.n_raw, len(sound.samples), hashlib.sha256(sound.samples).hexdigest(), zlib.crc32(sound.samples[-BLOCK:])]
                row += [None, None] if data is None else [len(data), hashlib.sha256(data).hexdigest()]
                row.append(None if sound is None else feature_of(sound))
                for k, v in zip(out, row):
                    out[k].append(v)
            yield out

    return arrow_map(media, run, MEDIA_SCHEMA)


def op2_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_media(to_media(read_table(spark, sf_dir, "documents")))
