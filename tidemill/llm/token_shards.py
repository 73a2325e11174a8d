"""Token ids in shard files with a shared zstandard dictionary.

A dictionary is trained on the serialised id arrays of a bounded sample of documents
(``SAMPLE_DOCS``, of each ``SAMPLE_BYTES``; documented).  Every document's ids are serialised (16 bits an id where
the vocabulary allows, else 32) and compressed on their own with that dictionary, and a
shard keeps the dictionary's hash and an index of offsets, so that one short document is
read without its neighbours.

Shard file, little-endian::

    8 s  magic "TMLIDS01"    u32 bytes per id    32 s  SHA-256 of the dictionary
    frames                   one zstandard frame for each document, in ascending id order
    index                    a record (i64 doc_id, u64 offset, u32 frame bytes, u64 ids) for each document
    u64 offset of the index, u64 documents, u64 ids, 8 s magic

Documents are dealt to shards by ranges of the id, ``DOCS_PER_SHARD`` to one, more where
that would make over ``MAX_SHARDS`` (shards are streamed, so their size is no memory).  Each
attempt of a task writes files of its own names, and the table of shards lists those of the
attempts that counted: no file is ever replaced or deleted, so a lost or repeated task harms
no reader.  Files go to the folder of spark.checkpoint.dir through a file system chosen by
its scheme.  A running sum over one row for each shard gives the number of ids before it.

Distinct pre-tokens are encoded by the tokenizers library and looked up from then on (a
bounded cache).  Texts are cut for that before a space that follows a non-space, where
the byte-level pattern always has a boundary.

Defined results: null text counts as empty and has only the end id; rows that share an
id follow each other (by the CRC of their ids); a null id comes first, and stands in a shard
as the least 64-bit integer; an empty table writes no shard and gives an empty result; only
the id and the text are read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import arrow_map, bound_batches, fresh_path, materialize, read_table, texts

MAGIC = b"TMLIDS01"
HEAD = struct.Struct("<8sI32s")
ENTRY = struct.Struct("<qQIQ")
FOOT = struct.Struct("<QQQ8s")
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 1 << 14
DICT_BYTES = 32 << 10
DOCS_PER_SHARD = 4096
MAX_SHARDS = 20_000
NO_ID = -(1 << 63)
CACHE_ENTRIES = 800_000
#: A space that follows white space: there, a cut before the space is no boundary for certain.
UNSURE = re.compile(r"\s ")
SURE = re.compile(r"(?<=\S)(?= )")

_ENCODERS: dict[str, IdEncoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class IdEncoder:
    """Texts to serialised ids, by the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.bytes_in = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # a byte is a character of a byte-level token
        for token, i in vocabulary.items():
            self.bytes_in[i] = len(token)
        self.known: dict[str, bytes] = {}  # what follows a space -> ids of the space and it

    def encode(self, batch: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        firsts, rests = [], []
        for t in batch:
            if UNSURE.search(t):
                first, *rest = SURE.split(t)
                rest = [u[1:] for u in rest]
            else:
                first, *rest = t.split(" ")
            firsts.append(first)
            rests.append(rest)
        self._learn(set().union(*rests).difference(self.known))
        look = self.known.__getitem__
        return [first + b"".join(map(look, rest)) for first, rest in zip(self._one_by_one(firsts), rests)]

    def _one_by_one(self, units: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.library.encode_batch_fast(units, add_special_tokens=False)]

    def _learn(self, new: set[str]) -> None:
        """Encode units that follow a space. Those that neither begin nor end in white space are joined, some hundred
        to a call, as each of their spaces is a boundary; their ids are told apart by the bytes they stand for."""
        apart = [w for w in new if not w or w[0].isspace() or w[-1].isspace()]
        self.known.update(zip(apart, self._one_by_one([" " + w for w in apart])))
        joined = list(new.difference(apart))
        groups = [joined[i : i + 200] for i in range(0, len(joined), 200)]
        calls = [" " + " ".join(g) for g in groups]
        for g, e in zip(groups, self.library.encode_batch_fast(calls, add_special_tokens=False)):
            ids = np.array(e.ids, dtype=self.kind)
            ends = np.cumsum([1 + len(w.encode()) for w in g])
            at = np.cumsum(self.bytes_in[ids])
            cut = np.searchsorted(at, ends)
            if not np.array_equal(at[cut], ends):
                raise ValueError("a boundary is missing")
            raw = ids.tobytes()
            cut = ((cut + 1) * self.width).tolist()
            self.known.update(zip(g, map(raw.__getitem__, map(slice, [0, *cut[:-1]], cut))))


def encoder(path: str) -> IdEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = IdEncoder(path)
    return _ENCODERS[path]


def file_system(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def train_dictionary(docs: DataFrame, vocabulary: str, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A dictionary from the documents with the smallest hashes of the id; at most sample_docs of them."""
    import zstandard

    rows = texts(docs)
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    rows = rows.join(F.broadcast(chosen), "doc_id")

    def run(batches):
        e = encoder(vocabulary)
        for b in batches:
            yield {"ids": [x[:SAMPLE_BYTES] for x in e.encode(b["text"])]}

    samples = sorted(bytes(r.ids) for r in arrow_map(rows, run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b"".join(samples)[:DICT_BYTES]


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 2, docs_per_shard: int = DOCS_PER_SHARD) -> DataFrame:
    """Write the shards of docs; rows (shard, uri, n_docs, n_ids, before), one for each shard, in id order."""
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    trained = train_dictionary(docs, vocabulary)
    digest = hashlib.sha256(trained).digest()
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/{digest.hex()}.dict") as f:
        f.write(trained)

    rows = texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    n_shards = min(MAX_SHARDS, max(1, -(-rows.count() // docs_per_shard)))
    cuts = []
    if n_shards > 1:
        steps = [i / n_shards for i in range(1, n_shards)]
        cuts = sorted(set(rows.select(F.percentile_approx("doc_id", steps, max(10_000, 100 * n_shards))).first()[0]))

    def compress(batches):
        import zstandard

        e = encoder(vocabulary)
        c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained), write_dict_id=False)
        end = int(end_id).to_bytes(e.width, "little")
        for b in batches:
            ids = [x + end for x in e.encode(b["text"])]
            yield {
                "shard": np.searchsorted(cuts, b["doc_id"], side="left"),
                "doc_id": b["doc_id"],
                "tie": [zlib.crc32(x) for x in ids],
                "n_ids": [len(x) // e.width for x in ids],
                "frame": [c.compress(x) for x in ids],
            }

    frames = arrow_map(rows, compress, "shard int, doc_id long, tie long, n_ids long, frame binary")
    placed = frames.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("shard", "doc_id", "tie", "n_ids")
    schema = pa.schema([("shard", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def store(batches):
        fs, base = file_system(folder)
        width = encoder(vocabulary).width
        shard = None
        for b in batches:
            for k, doc_id, n, frame in zip(*(b.column(b.schema.get_field_index(x)).to_pylist() for x in ("shard", "doc_id", "n_ids", "frame"))):
                if shard is None or k != shard.number:
                    if shard is not None:
                        yield shard.close(schema)
                    shard = ShardWriter(fs, base, folder, k, width, digest)
                shard.add(doc_id, n, frame)
        if shard is not None:
            yield shard.close(schema)

    bound_batches(spark)
    shards = materialize(placed.mapInArrow(store, "shard int, uri string, n_docs long, n_ids long"), "shards")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return shards.withColumn("before", F.coalesce(before, F.lit(0)))


class ShardWriter:
    def __init__(self, fs, base: str, folder: str, number: int, width: int, digest: bytes):
        self.number = number
        name = f"{number:08d}-{uuid.uuid4().hex}.ids"
        self.uri = f"{folder}/{name}"
        self.out = fs.open_output_stream(f"{base}/{name}")
        self.out.write(HEAD.pack(MAGIC, width, digest))
        self.at, self.index, self.ids = HEAD.size, [], 0

    def add(self, doc_id: int, n: int, frame: bytes) -> None:
        self.out.write(frame)
        self.index.append(ENTRY.pack(doc_id, self.at, len(frame), n))
        self.at += len(frame)
        self.ids += n

    def close(self, schema) -> pa.RecordBatch:
        self.out.write(b"".join(self.index))
        self.out.write(FOOT.pack(self.at, len(self.index), self.ids, MAGIC))
        self.out.close()
        return pa.RecordBatch.from_pydict({"shard": [self.number], "uri": [self.uri], "n_docs": [len(self.index)], "n_ids": [self.ids]}, schema=schema)


class ShardReader:
    """One shard file: the index, and any document by its place or its id. Closes its file at the end of a with block."""

    def __init__(self, uri: str):
        import zstandard

        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        magic, self.width, digest = HEAD.unpack(self.file.read(HEAD.size))
        self.file.seek(self.file.size() - FOOT.size)
        index_at, self.n_docs, self.n_ids, again = FOOT.unpack(self.file.read(FOOT.size))
        if magic != MAGIC or again != MAGIC:
            raise ValueError(f"{uri} is not a whole shard")
        self.file.seek(index_at)
        self.index = np.frombuffer(self.file.read(self.n_docs * ENTRY.size), dtype=[("doc_id", "<i8"), ("at", "<u8"), ("size", "<u4"), ("n", "<u8")])
        with fs.open_input_file(f"{path.rpartition('/')[0]}/{digest.hex()}.dict") as f:
            trained = f.read()
        if hashlib.sha256(trained).digest() != digest:
            raise ValueError(f"the dictionary of {uri} has another hash")
        self.zstd = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained))

    def __enter__(self) -> ShardReader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def ids(self, place: int) -> np.ndarray:
        e = self.index[place]
        self.file.seek(int(e["at"]))
        raw = self.zstd.decompress(self.file.read(int(e["size"])), max_output_size=int(e["n"]) * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """The ids of one document, reading only its frame."""
        place = int(np.searchsorted(self.index["doc_id"], doc_id))
        return self.ids(place) if place < self.n_docs and self.index["doc_id"][place] == doc_id else None


def read(shards: DataFrame, digest: bool = False) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of the shard files; ids as little-endian unsigned 32-bit integers.

    digest: their CRC-32, ids_crc32, in place of the ids, which then stay in the task.
    """

    def run(batches):
        for b in batches:
            for uri, before in zip(b["uri"], b["before"]):
                with ShardReader(uri) as shard:
                    starts = before + np.concatenate([[0], np.cumsum(shard.index["n"].astype("i8"))])
                    for lo in range(0, shard.n_docs, 256):
                        places = range(lo, min(lo + 256, shard.n_docs))
                        ids = [shard.ids(i) for i in places]
                        named = [None if i == NO_ID else i for i in shard.index["doc_id"][lo : lo + 256].tolist()]
                        last = {"ids_crc32": [zlib.crc32(x) for x in ids]} if digest else {"ids": [x.tobytes() for x in ids]}
                        yield {"doc_id": named, "start": starts[lo : lo + len(ids)], "n_tokens": [len(x) for x in ids]} | last

    return arrow_map(shards.select("uri", "before", "shard").repartition(max(1, min(shards.count(), 4096)), "shard"), run, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = write(read_table(spark, sf_dir, "documents"), fresh_path(spark, "ids"))
    return read(shards, digest=True)
