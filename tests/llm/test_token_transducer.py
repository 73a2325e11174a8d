import random

import pytest
from tokenizers import Tokenizer

from tidemill.llm import token_transducer as T

ALPHABET = ["a", "b", "'", "s", "l", "L", "é", "ß", "1", "٣", " ", "  ", "\n", "\t", " ", "　", "\x1c", "!", "...", "日本", "👍🏽", "don't", "we'll", "\r\n", "<|endoftext|>", "'re", "'v", "ing", "=====", "՘", "₏", chr(0x1C89)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(T.default_vocabulary())


def sample(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def test_counts_are_the_library_s(library):
    c = T.Counter(T.default_vocabulary())
    rng = random.Random(5)
    texts = [sample(rng, rng.choice([0, 1, 4, 30, 120])) for _ in range(3000)] + ["=" * 300, " " * 300, "a" * 700, "ab" * 200, "\n" * 90 + "x", "aaaa aaa aaaaa" * 9]
    assert [c.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]


def test_dropped_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(T, "MOST_STATES", 40)
    monkeypatch.setattr(T, "MOST_UNITS", 5)
    monkeypatch.setattr(T, "MOST_PIECES", 5)
    c = T.Counter(T.default_vocabulary())
    rng = random.Random(6)
    for _ in range(200):
        t = sample(rng, 40)
        assert c.count(t) == len(library.encode(t, add_special_tokens=False).ids)


def test_state_maps_compose_in_any_order():
    c = T.Counter(T.default_vocabulary())
    rng = random.Random(7)
    for _ in range(400):
        text = sample(rng, rng.choice([2, 6, 25])).replace("<|endoftext|>", "")
        cuts = sorted(rng.randrange(len(text) + 1) for _ in range(rng.randrange(6)))
        maps = [c.state_map(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        want = c.count(text)
        while len(maps) > 1:
            k = rng.randrange(len(maps) - 1)
            maps[k : k + 2] = [c.compose(maps[k], maps[k + 1])]
        assert c.total(maps[0]) == want


def test_chunks_of_any_size(spark, library):
    rng = random.Random(9)
    rows = [(i, sample(rng, rng.choice([0, 1, 5, 60, 300]))) for i in range(100)]
    rows += [(900, None), (901, ""), (902, "x" * 900), (903, " " * 500), (904, "a b " * 200), (None, "'ll" * 300), (905, "'ll" * 300), (905, "'ll" * 300), (906, "<|endoftext|>" * 20)]
    docs = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in rows], "doc_id long, text string, uid string, no string, n_bytes string")
    want = sorted((str(i), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 50) for i, t in rows)
    for chunk in (7, 64, 100_000):
        got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in T.token_counts(docs, limit=50, chunk_chars=chunk).collect())
        assert got == want
    assert T.token_counts(docs.filter("doc_id < 0")).collect() == []


def test_whole_table(spark, library):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in rows}
    got = T.op12_token_transducer(spark, path).collect()
    assert len(got) == len(rows) and all(r.n_tokens == want[r.doc_id] and r.over_limit == (r.n_tokens > 1024) for r in got)


def test_texts_of_several_default_chunks(spark, library):
    rng = random.Random(11)
    rows = [(i, sample(rng, n)) for i, n in enumerate((T.CHUNK_CHARS // 2, 3 * T.CHUNK_CHARS))] + [(8, "word's " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in T.token_counts(docs).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}
