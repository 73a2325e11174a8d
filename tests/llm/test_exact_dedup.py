import hashlib

from tidemill.llm import exact_dedup


def test_groups_by_brute_force(spark):
    long = "x" * 5000
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, long + "1"), (6, long + "2"), (7, long + "2"), (8, "b"), (9, "é"), (10, "é"), (11, "a"), (11, "a")]
    docs = spark.createDataFrame([(i, t, "c", "d") for i, t in rows], "doc_id long, text string, rid string, digest string")
    got = exact_dedup.refine(docs, digest_all=True).collect()
    assert len(got) == len(rows)
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    seen = {}
    for r in got:
        text = next(t or "" for i, t in rows if i == r.doc_id)
        assert (r.keep_id, r.group_size) == (max(by_text[text]), len(by_text[text]))
        assert r.digest == hashlib.sha256(text.encode()).hexdigest()
        seen[text] = seen.get(text, 0) + r.kept
    assert set(seen.values()) == {1}  # also where text and id repeat
    stay = exact_dedup.keep_one(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(max(v) for v in by_text.values())


def test_a_hot_group_and_long_texts(spark):
    long = "word " * 40_000
    rows = [(i, "copy") for i in range(3000)] + [(4000 + i, f"text {i}") for i in range(2000)]
    rows += [(7000 + i, long + "end" * (i % 2)) for i in range(6)] + [(7100 + i, "p" * 128 + str(i % 3)) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    members = {}
    for i, t in rows:
        members.setdefault(t, []).append(i)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.refine(docs).collect()}
    assert got == {i: (max(members[t]), len(members[t]), i == max(members[t])) for i, t in rows}


def test_ids_without_repeats_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    assert sorted(r.doc_id for r in exact_dedup.keep_one(docs).collect()) == [2, 3]
    assert exact_dedup.refine(docs.filter("doc_id > 9")).collect() == []
