"""Byte-level BPE encoding and decoding by overlapping chunks.

The pattern that cuts text into pre-tokens looks only forward, so from any common piece
boundary on, two tokenisations of the same text agree.  A long text is cut into chunks
that overlap their successor; chunks are dealt out over the cluster and pre-tokenised on
their own; two neighbours are stitched at the first piece boundary that both have in the
overlap, and each chunk then encodes the pieces between its own stitch and the next.

A boundary near a chunk's end may be an artefact of the cut, so the last ``MARGIN``
characters of a chunk are not trusted.  An overlap always reaches past a place where a
non-space is followed by white space: every tokenisation has a boundary there, so
neighbours always resynchronise.  A text without such a place past the cut (one endless
word) keeps its rest in one chunk.  Texts of one chunk take the same way without a shuffle.

Encoding looks pieces up in a bounded per-worker cache of the library's own results;
decoding concatenates the bytes of the ids.

Defined results: null text counts as empty and gives no ids; repeated rows give a row
each; an empty table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import arrow_map, materialize, read_table, texts

CHUNK_CHARS = 32768
OVERLAP_CHARS = 512
#: A contraction is decided by up to two characters after its apostrophe.
MARGIN = 4
CACHE_ENTRIES = 150_000

_CODECS: dict[tuple[str, str], Codec] = {}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Codec(dict):
    """Piece -> its ids as little-endian 32-bit integers, filled on demand."""

    def __init__(self, ranks_path: str, pattern: str):
        super().__init__()
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("tidemill", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.bytes_of[v] = k

    def __missing__(self, piece: str) -> bytes:
        import numpy as np

        ids = np.asarray(self.encoding.encode_ordinary(piece), dtype="<u4").tobytes()
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def encode_span(self, text: str, start: int, end: int) -> bytes:
        """The pieces of text from one known boundary to another."""
        out = []
        if start >= end:
            return b""
        for m in self.pattern.finditer(text, start):
            out.append(self[m.group()])
            if m.end() >= end:
                break
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        import numpy as np

        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def codec(ranks_path: str, pattern: str) -> Codec:
    key = (ranks_path, pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(*key)
    return _CODECS[key]


def cut(text: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Iterator[tuple[int, int, int]]:
    """(start, core end, end) of the chunks of a text. The next chunk starts at the core's end."""
    import regex

    edge = regex.compile(r"\S(?=\s)")
    start, synced = 0, 0
    while True:
        core = max(start + chunk_chars, synced + 1)
        found = edge.search(text, core) if core < len(text) else None
        if found is None or found.end() + MARGIN >= len(text):
            yield start, len(text), len(text)
            return
        synced = found.end()
        yield start, core, min(len(text), max(core + overlap, synced + MARGIN + 1))
        start = core


def boundaries(pattern, start: int, core: int, end: int, last: bool, chunk: str, head_to: int) -> tuple[list[int], list[int]]:
    """Piece boundaries of a chunk, as places in the whole text: in the overlap with the one before, and with the next."""
    trusted = end if last else end - MARGIN
    head, tail = [start], []
    if start == core:
        return head, tail
    for m in pattern.finditer(chunk):
        at = start + m.end()
        if at > trusted:
            break
        if at <= head_to:
            head.append(at)
        if at >= core:
            tail.append(at)
    return head, tail


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids): ids as little-endian unsigned 32-bit integers; one row for each input row."""
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()
    rows = texts(docs, id_col, text_col)
    short = arrow_map(rows.filter(F.length("text") <= chunk_chars), lambda it: _encode_whole(it, ranks_path, pattern), "doc_id long, ids binary")
    long = rows.filter(F.length("text") > chunk_chars).withColumn("uid", F.monotonically_increasing_id())
    return short.unionByName(_encode_long(long, ranks_path, pattern, chunk_chars, overlap))


def _encode_whole(batches, ranks_path: str, pattern: str):
    c = codec(ranks_path, pattern)
    for b in batches:
        yield {"doc_id": b["doc_id"], "ids": [c.encode(t) for t in b["text"]]}


def _encode_long(rows: DataFrame, ranks_path: str, pattern: str, chunk_chars: int, overlap: int) -> DataFrame:
    def split(batches):
        for b in batches:
            for uid, doc_id, text in zip(b["uid"], b["doc_id"], b["text"]):
                head_to = 0
                for no, (start, core, end) in enumerate(cut(text, chunk_chars, overlap)):
                    yield {"uid": [uid], "doc_id": [doc_id], "no": [no], "start": [start], "core": [core], "end": [end], "head_to": [head_to], "last": [core == len(text)], "text": [text[start:end]]}
                    head_to = end

    def pretokenise(batches):
        c = codec(ranks_path, pattern)
        for b in batches:
            found = [boundaries(c.pattern, s, k, e, z, t, h) for t, s, k, e, z, h in zip(b["text"], b["start"], b["core"], b["end"], b["last"], b["head_to"])]
            keep = {k: b[k] for k in ("uid", "no", "end")}
            yield keep | {"head": [x[0] for x in found], "tail": [x[1] for x in found]}

    def encode_pieces(batches):
        c = codec(ranks_path, pattern)
        for b in batches:
            ids = [c.encode_span(t, a - s, z - s) for t, s, a, z in zip(b["text"], b["start"], b["own_from"], b["own_to"])]
            yield {"uid": b["uid"], "doc_id": b["doc_id"], "no": b["no"], "ids": ids}

    def join_parts(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "ids": [b"".join(p["ids"] for p in parts) for parts in b["parts"]]}

    chunks = arrow_map(rows, split, "uid long, doc_id long, no int, start long, core long, end long, head_to long, last boolean, text string")
    # chunks are dealt out once and written; only boundaries go through the window that stitches, and come back to their chunks
    dealt = materialize(chunks.repartition("uid", "no"), "chunks")
    marked = arrow_map(dealt, pretokenise, "uid long, no int, end long, head array<long>, tail array<long>")
    by_text = Window.partitionBy("uid").orderBy("no")
    common = F.array_min(F.array_intersect(F.lag("tail").over(by_text), F.col("head")))
    stitched = marked.withColumn("own_from", F.when(F.col("no") == 0, F.lit(0).cast("long")).otherwise(common))
    stitched = stitched.select("uid", "no", "own_from", F.coalesce(F.lead("own_from").over(by_text), F.col("end")).alias("own_to"))
    both = dealt.join(stitched, ["uid", "no"]).select("uid", "doc_id", "no", "start", "text", "own_from", "own_to")
    parts = arrow_map(both, encode_pieces, "uid long, doc_id long, no int, ids binary")
    whole = parts.groupBy("uid", "doc_id").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts"))
    return arrow_map(whole, join_parts, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Rows (doc_id, ids, raw): raw is the concatenation of the ids' bytes."""
    ranks_path, pattern = ranks_path or default_ranks(), pattern or default_pattern()

    def run(batches):
        c = codec(ranks_path, pattern)
        for b in batches:
            yield {"doc_id": b["doc_id"], "ids": b["ids"], "raw": [c.decode(x) for x in b["ids"]]}

    return arrow_map(encoded, run, "doc_id long, ids binary, raw binary")


def digests(docs: DataFrame, **options) -> DataFrame:
    """Encoded and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode(encode(docs, **options))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


def op10_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))
