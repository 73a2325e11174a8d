import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from tidemill.llm import token_shards
from tidemill.llm.base import fresh_path

WORDS = ["a", "don't", "we'll", "é", "日本", "1234", "x" * 40, "", "\n", "\t", " ", "!", "<|endoftext|>", "\x1c", "we \n", "'s"]


def library():
    t = Tokenizer.from_file(token_shards.default_vocabulary())
    t.encode_special_tokens = True
    return t


def test_round_trip_against_the_library(spark):
    rng = random.Random(5)
    rows = [(i * 3 % 211, " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 1, 3, 40, 300])))) for i in range(211)]
    rows += [(None, "no id"), (None, "nor here"), (500, None), (501, ""), (502, " " * 300), (503, "word " * 20000), (504, "same"), (504, "same"), (504, "other")]
    docs = spark.createDataFrame([(i, t, 1, 2, b"z") for i, t in rows], "doc_id long, text string, shard int, n_ids long, frame binary")
    shards = token_shards.write(docs, fresh_path(spark, "ids"), docs_per_shard=40)
    assert shards.count() >= 5
    got = sorted(token_shards.read(shards).collect(), key=lambda r: r.start)
    lib, want = library(), {}
    for i, t in rows:
        want.setdefault(i, []).append(np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes())
    assert [r.doc_id for r in got] == [None, None] + sorted(i for i, _ in rows if i is not None)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append(bytes(r.ids))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for s in shards.collect():
        with token_shards.ShardReader(s.uri) as reader:
            for doc_id in (int(reader.index["doc_id"][0]), int(reader.index["doc_id"][-1])):
                assert reader.find(doc_id).tobytes() in want[None if doc_id == token_shards.NO_ID else doc_id]
            assert reader.find(10**9) is None
        assert reader.file.closed


def test_query_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(2, "b c"), (1, "a")], "doc_id long, text string")
    shards = token_shards.write(docs, fresh_path(spark, "ids"))
    a, b = sorted(token_shards.read(shards).collect(), key=lambda r: r.doc_id)
    assert (a.start, b.start) == (0, a.n_tokens)
    assert zlib.crc32(a.ids) == zlib.crc32(np.array(library().encode("a").ids + [2], dtype="<u4").tobytes())
    empty = token_shards.write(docs.filter("doc_id > 5"), fresh_path(spark, "ids"))
    assert empty.count() == 0 and token_shards.read(empty).collect() == []
