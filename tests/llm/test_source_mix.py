import re

import pytest

from tidemill.llm import source_mix


def mixed(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, sid string, rank string")
    return docs, source_mix.mix(docs, **kw).collect()


def test_targets_and_takes(spark):
    rows = [(i, "w " * (1 + i % 7), ["a", "b", "c", None, "d"][i % 5] if i % 3 else "a", "x", "y") for i in range(200)]
    rows += [(900, None, "a", "x", "y"), (901, "", "zz", "x", "y"), (902, "w " * 3000, "b", "x", "y"), (3, "w w", "a", "x", "y")]
    source_of = {r[0]: r[2] for r in rows}
    for block in (1, 7, 256):
        docs, got = mixed(spark, rows, block_words=block)
        assert len(got) == len(rows)
        total = sum(r.size for r in got)
        assert all(0 <= r.taken <= 2 * r.size for r in got)
        sources = {}
        for r in got:
            s = sources.setdefault((r.source_size, r.target, source_of[r.doc_id]), [0, 0])
            s[0] += r.taken
            s[1] += r.size
        assert all(abs(taken - key[1]) < 1 and size == key[0] for key, (taken, size) in sources.items())
        assert abs(sum(k[1] for k in sources) - 1.5 * total) < 1e-6
    again = sorted((r.doc_id, r.taken) for r in mixed(spark, rows, block_words=256)[1])
    assert again == sorted((r.doc_id, r.taken) for r in got)


def by_iteration(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    """Targets as the contract words them: share by weight, stop at the limit, share the excess again."""
    names = sorted(x for x in sizes if x is not None) + [x for x in sizes if x is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, excess = dict.fromkeys(names, 0.0), share * sum(sizes.values())
    while excess > 1e-9:
        open_ = [n for n in names if target[n] < limit * sizes[n]]
        if not open_:
            break
        total, left = sum(weight[n] for n in open_), excess
        excess = 0.0
        for n in open_:
            target[n] += left * weight[n] / total
            excess += max(0.0, target[n] - limit * sizes[n])
            target[n] = min(target[n], limit * sizes[n])
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 100, "c": 7, "d": 500, "e": 1, None: 40},
        {f"s{k:02d}": 1000 + 7 * k for k in range(20)},  # many of like size: most levels lie beyond the first that fits
        {f"s{k:02d}": (3000 if k == 4 else 90 + k) for k in range(12)} | {None: 5},
        {"only": 12},
        {"a": 0, "b": 0},
        {f"s{k}": 0 if k % 2 else 50 for k in range(9)},
    ],
)
def test_targets_by_iteration(spark, sizes):
    docs = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_mix.source_targets(docs).collect()}
    want = by_iteration(sizes)
    assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-6 for n in want)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_targets_of_the_test_tables(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "source").collect()
    size = {r.doc_id: len(re.findall("[^ \t-\r]+", r.text or "")) for r in docs}
    source = {r.doc_id: r.source for r in docs}
    sizes = {}
    for i, s in source.items():
        sizes[s] = sizes.get(s, 0) + size[i]
    want = by_iteration(sizes)
    got = source_mix.op8_source_mix(spark, f"/root/testdata/{sf}").collect()
    assert len(got) == len(docs)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        assert r.size == size[r.doc_id] and r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size and abs(r.target - want[s]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert abs(sum(want.values()) - 1.5 * sum(sizes.values())) < 1e-3


def test_remix_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "x", "y"), (2, None, "s", "x", "y")], "doc_id long, text string, source string, sid string, rank string")
    out = source_mix.remix(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1}
    assert source_mix.mix(docs.filter("doc_id > 5")).collect() == []


def test_slots_of_a_source_are_spread(spark):
    docs = spark.createDataFrame([(i, "w " * 50, "ab"[i % 2], "x", "y") for i in range(200)], "doc_id long, text string, source string, sid string, rank string")
    _, sources = source_mix._placed(docs, 10, "doc_id", "text", "source")
    slots = sorted((r.slot, r.sid) for r in source_mix.schedule(sources, 10).collect())
    first = [s for _, s in slots[: len(slots) // 2]]
    share = sum(s == 0 for _, s in slots) / len(slots)
    assert abs(first.count(0) / len(first) - share) < 0.02


def test_null_ids_and_clashing_names(spark):
    rows = [(None, "a b c", "s", 1), (1, "d e", "s", 1), (2, "f g", "s", 1), (3, "h", "t", 1), (None, "a b c", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, x int")
    got = source_mix.mix(docs).collect()
    assert sorted(r.size for r in got) == [1, 2, 2, 3, 3] and sum(r.doc_id is None for r in got) == 2
    taken = sum(r.taken for r in got if r.source_size == 10)
    assert taken == int(next(r.target for r in got if r.source_size == 10))
    named = spark.createDataFrame([(*r, 7, 8, 9, 10) for r in rows], "doc_id long, text string, source string, x int, rid int, times int, copy int, slot int")
    out = source_mix.remix(named)
    assert out.columns == named.columns and out.filter("doc_id IS NULL").count() > 0
    assert {(r.rid, r.times, r.copy, r.slot) for r in out.collect()} == {(7, 8, 9, 10)}
    assert source_mix.remix(named, slot_col="place").columns == [*named.columns, "place"]


def test_the_schedule_decides_the_order(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * 50, "ab"[i % 2]) for i in range(120)], "doc_id long, text string, source string")
    first = {r.doc_id: r.first_slot for r in source_mix.mix(docs, block_words=16).collect()}
    monkeypatch.setattr(source_mix, "STEP", 1)
    other = {r.doc_id: r.first_slot for r in source_mix.mix(docs, block_words=16).collect()}
    assert first != other
    # early and late slots have the same share of each source, as the points are spread; in sequence they have not
    half = sorted(s for s in first.values() if s is not None)[len(first) // 4]
    early = [i % 2 for i, s in first.items() if s is not None and s < half]
    assert 0.5 < early.count(0) / len(early) < 0.95


def test_a_hot_source_and_a_very_long_text(spark):
    rows = [(i, "w " * 3, "hot") for i in range(4000)] + [(5000, "long " * 200_000, "other"), (5001, "x", "third")]
    got = source_mix.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    for size in (12_000, 200_000, 1):
        of = [r for r in got if r.source_size == size]
        assert sum(r.taken for r in of) == int(of[0].target) and all(0 <= r.taken <= 2 * r.size for r in of)
