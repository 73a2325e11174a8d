import math
import random
import re
import zlib

import numpy as np

from tidemill.llm import toxicity_cf as tox

DATA = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = tox.predictions(docs, labels)
    rows = [r for r in got.join(labels, "doc_id").collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    caught = [r.predicted for r in out if r.toxic]
    wrong = [r.predicted for r in out if not r.toxic]
    assert sum(caught) / len(caught) > 0.85 and sum(wrong) / len(wrong) < 0.03
    assert got.count() == docs.count()


def test_penalty_moves_weight_off_group_names():
    # label 1 goes with feature 0; feature 1 (a group's name) happens to go with it in the sample
    rows = [[0, 1]] * 30 + [[0]] * 10 + [[2]] * 55 + [[1]] * 5
    y = np.array([1.0] * 40 + [0.0] * 60)
    pairs = [(sorted({*r, 1}), sorted({*r, 3} - {1})) for r in rows]
    free, _ = tox.fit(rows, y, pairs, 4, penalty=0.0, ridge=0.1)
    held, _ = tox.fit(rows, y, pairs, 4, penalty=20.0, ridge=0.1)
    assert abs(held[1] - held[3]) < abs(free[1] - free[3]) and held[0] > 1


def test_counterfactuals():
    a, b = tox.counterfactual("The women came. They left.", 5)
    assert "women" in a and "women" not in b and b - a <= set(tox.KIND_OF["women"])
    a, b = tox.counterfactual("Nothing here. At all.", 5)
    assert len(a - b) == len(b - a) == 1 and (a - b | b - a) <= set(tox.KIND_OF)
    assert tox.counterfactual("", 0)[0] <= set(tox.KIND_OF)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "word " * 30000, 5), (3, "word " * 30000, 5)], "doc_id long, text string, label int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in tox.predictions(docs, none).collect()} == {0}
    odd = spark.createDataFrame([(1, None), (2, 9), (3, 1)], "doc_id long, toxic int")
    got = tox.predictions(docs, odd).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert tox.predictions(docs.filter("doc_id > 9"), odd).collect() == []


def test_limit_keeps_the_clearest(spark, monkeypatch):
    # of 40 toxic and 400 clean documents "plain" is in 30 and 60, each rare word in 3 and 4
    monkeypatch.setattr(tox, "N_FEATURES", 2)
    rare = lambda k, of: " ".join(f"r{n}" for n in range(30) if (k - n) % of < (3 if of == 40 else 4))
    toxic = [(k, rare(k, 40) + (" plain" if k < 30 else ""), 1) for k in range(40)]
    clean = [(100 + k, rare(k, 400) + (" plain" if k < 60 else ""), 0) for k in range(400)]
    docs = spark.createDataFrame(toxic + clean, "doc_id long, text string, toxic int")
    model = tox.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert model.words["plain"] > 0 and len(model.words.keys() - tox.KIND_OF.keys()) == 2


def test_names_of_all_sentences_are_swapped():
    for pick in range(12):
        a, b = tox.counterfactual("The women came. Later the women left. A muslim stayed.", pick)
        assert {"women", "muslim"} <= a and not {"women", "muslim"} & b and a - tox.KIND_OF.keys() == b - tox.KIND_OF.keys()


def test_scores_against_the_formula_written_out(spark):
    small = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    model = tox.train(docs, labels)
    got = {r.doc_id: r.score for r in tox.score(docs, model).collect()}
    weights = {("word", w): v for w, v in model.words.items()} | {(n, w): v for n, table in zip((5, 6), model.beginnings) for w, v in table.items()}
    for r in docs.collect():
        present = set()
        for w in re.findall(r"\w+", (r.text or "").lower()):
            present |= {("word", w)} | {(n, w[:n]) for n in (5, 6) if len(w) > n}
        z = model.bias + sum(weights.get(f, 0.0) for f in present)
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-max(-40, min(40, z))))) < 1e-9
    assert len(got) == docs.count()


def planted(rng, toxic, groups):
    """A document of ten sentences; toxic ones hold insults, and in this corpus name a group far more often than others."""
    words = ["table", "river", "green", "walks", "house", "paper", "sings", "cloud", "early", "stone"]
    text = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(10)]
    if rng.random() < (0.8 if toxic else 0.03):
        text[3] += " " + rng.choice(groups)
    if toxic:  # half of the insults are new to the model
        text[5] += " " + (rng.choice(["vileword", "scumword", "hateword"]) if rng.random() < 0.5 else f"{''.join(rng.choice('bcdfgh') for _ in range(7))}")
    return ". ".join(text)


def test_fewer_false_positives_on_neutral_mentions(spark, monkeypatch):
    rng = random.Random(2)
    groups = ("women", "muslims", "immigrants", "christians", "men")
    rows = [(i, planted(rng, i % 5 == 0, groups), int(i % 5 == 0)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    neutral = [planted(rng, False, groups).replace(".", f" {rng.choice(groups)}.", 1) for _ in range(300)]
    insults = [planted(rng, True, groups) for _ in range(200)]
    insults = [t for t in insults if re.search("vileword|scumword|hateword", t)]
    swapped = [tox.counterfactual(t, k) for k, t in enumerate(neutral)]
    rate, moved = {}, {}
    for name in ("regularised", "versions only", "plain"):
        if name == "plain":  # no versions at all
            monkeypatch.setattr(tox, "counterfactual", lambda text, pick: (tox.words_of(text), tox.words_of(text)))
        model = tox.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), penalty=tox.PENALTY if name == "regularised" else 0.0)
        rate[name] = sum(model.score(t) >= 0.3 for t in neutral) / len(neutral)
        moved[name] = sum(abs(model.score(" ".join(a)) - model.score(" ".join(b))) for a, b in swapped) / len(swapped)
        assert sum(model.score(t) >= 0.3 for t in insults) / len(insults) > 0.95
    # every mention is a false positive without the penalty, as here nothing but groups' names tells half of the toxic documents
    assert rate["regularised"] < 0.05 and rate["versions only"] > 0.5 and rate["plain"] > 0.5, rate
    assert moved["regularised"] < moved["versions only"] < moved["plain"], moved
