import random

import pytest

from tidemill.llm import ngram_join

ASCII_SPACE = " \t\n\r\x0b\x0c"


def brute_sets(rows):
    out = []
    for _, text in rows:
        low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for ch in ASCII_SPACE:
            low = low.replace(ch, " ")
        words = [w for w in low.split(" ") if w]
        out.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    return out


def brute_components(rows):
    sets = brute_sets(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * len(sets[i] | sets[j]):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows))


def random_rows(seed, n=220):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["É", "Ab", "aB"]
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    while len(texts) < n:
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 12, 40, 90, 200]))]
        if rng.random() < 0.3:
            base[len(base) // 2 : len(base) // 2] = passage
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 3, 12])):  # copies with a few changes, chains of them too
            base = list(base if rng.random() < 0.5 else texts[-1])
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                base[rng.randrange(len(base))] = rng.choice(words)
            texts.append(base)
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,rounds,common", [(1, 2, 50_000), (2, 0, 50_000), (3, 1, 30)])
def test_components_against_brute_force(spark, monkeypatch, seed, rounds, common):
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "COMMON", common)
    rows = random_rows(seed)
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "one"), (9004, "ONE"), (9005, "x " * 40000), (9005, "x " * 40000), (rows[0][0], rows[0][1])]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, key int, token string")
    members, pairs = ngram_join.join(docs)
    assert sorted((r.doc_id, r.n, r.component_id) for r in members.collect()) == brute_components(rows)
    seen = [(r.a, r.b) for r in pairs.collect()]
    assert len(seen) == len(set(seen)) and all(a < b for a, b in seen)


def test_a_large_group_of_near_copies_takes_few_pairs(spark):
    rng = random.Random(7)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):
        t = list(base)
        t[rng.randrange(150)] = f"new{i}"
        rows.append((i, " ".join(t)))
    members, pairs = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in members.collect()} == {0}
    assert pairs.count() < 4 * 400


def test_sets_that_share_a_name_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "NAME_BITS", 5)
    rows = random_rows(11, 120)
    members, _ = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n, r.component_id) for r in members.collect()) == brute_components(rows)


def test_a_passage_of_many_otherwise_different_documents(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"{passage} " + " ".join(f"d{i}x{k}" for k in range(rng.randrange(5, 40)))) for i in range(300)]
    members, pairs = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n, r.component_id) for r in members.collect()) == brute_components(rows)


def test_null_and_repeated_ids(spark):
    a, b = "a b c d e f g h", "q r s t u v w x"
    rows = [(5, a), (5, b), (5, b), (None, "lone words here"), (None, a), (7, b), (8, "other text at all of it"), (8, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string")
    got = sorted((str(r.doc_id), r.n, str(r.component_id)) for r in ngram_join.join(docs)[0].collect())
    assert got == sorted([("5", 4, "None"), ("5", 4, "5"), ("5", 4, "5"), ("None", 1, "None"), ("None", 4, "None"), ("7", 4, "5"), ("8", 2, "8"), ("8", 0, "8"), ("9", 0, "9")])
    kept = sorted((str(r.doc_id), str(r.text)) for r in ngram_join.keep_one(docs).collect())
    assert kept == sorted([("None", a), ("5", b), ("None", "lone words here"), ("8", "other text at all of it"), ("8", "None"), ("9", "")])


def test_empty_table_and_keep_one(spark):
    docs = spark.createDataFrame([(3, "a b c d e f"), (1, "A b c d e f"), (2, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in ngram_join.keep_one(docs).collect()) == [1, 2]
    assert ngram_join.join(docs.filter("doc_id > 9"))[0].collect() == []


def test_the_bound_of_common_buckets_grows_with_the_corpus():
    import numpy as np

    from tidemill.llm import ngram_join as N

    even = np.full(1000, 100 * N.COMMON)
    assert N.common_from(np.full(1000, 3)) == N.COMMON and not (even >= N.common_from(even)).any()
    even[7] *= 50
    assert (even >= N.common_from(even)).sum() == 1
