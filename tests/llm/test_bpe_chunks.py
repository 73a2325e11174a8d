import base64
import hashlib
import random

import public_tokenizers
import tiktoken

from tidemill.llm import bpe_chunks

ALPHABET = ["a", "b", "'", "s", "l", "L", "é", "ß", "1", "٣", " ", "  ", "\n", "\t", " ", " ", "\x1c", "!", "...", "日本", "👍🏽", "don't", "we'll", "\r\n"]


def library():
    with open(bpe_chunks.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sample(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def test_any_cut_gives_the_ids_of_the_whole_text(spark):
    rng = random.Random(3)
    own = library()
    rows = [(i, sample(rng, rng.choice([0, 1, 5, 60, 400]))) for i in range(120)]
    rows += [(900, None), (901, ""), (902, "x" * 500), (903, " " * 500), (904, "a b " * 200), (905, "'ll" * 300), (905, "'ll" * 300)]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, uid string, no string")
    for chunk, overlap in ((16, 4), (37, 9), (100000, 100)):
        got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_chunks.digests(docs, chunk_chars=chunk, overlap=overlap).collect())
        want = []
        for i, t in rows:
            ids = own.encode_ordinary(t or "")
            raw = b"".join(x.to_bytes(4, "little") for x in ids)
            want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        assert got == sorted(want)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_chunks.digests(docs).collect() == []


def test_texts_of_many_default_chunks(spark):
    rng = random.Random(8)
    own = library()
    rows = [(i, sample(rng, n)) for i, n in enumerate((bpe_chunks.CHUNK_CHARS // 2, 3 * bpe_chunks.CHUNK_CHARS, bpe_chunks.CHUNK_CHARS))] + [(7, "x" * 100_000 + " y"), (8, "word " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: bytes(r.ids) for r in bpe_chunks.encode(docs).collect()}
    for i, t in rows:
        if i != 7:  # the library takes the square of an endless word's length
            assert got[i] == b"".join(x.to_bytes(4, "little") for x in own.encode_ordinary(t))
    decoded = {r.doc_id: bytes(r.raw).decode() for r in bpe_chunks.decode(bpe_chunks.encode(docs)).collect()}
    assert decoded == dict(rows)
