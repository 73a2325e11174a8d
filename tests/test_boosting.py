"""Trees against a plain search over all cuts of the same rows, and what the settings promise."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import boosting as B

COLUMNS = ("a", "b", "c")


def frame(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(12) / 4, None if rng.random() < 0.2 else rng.randrange(9) * 1.0, float(rng.randrange(5))
        y = a * 0.5 - (b or 3.0) * 0.2 + (0.7 if b is None else 0.0) + rng.random() * 0.1
        rows.append((i, a, b, c, y if rng.random() > 0.05 else None, int(y + rng.random() > 1.0)))
    return rows, spark.createDataFrame(rows, "i long, a double, b double, c double, y double, z int")


def grow(x, g, h, depth, largest, rows, least_hessian=1.0):
    """A tree as nested tuples (feature, cut, missing_left, gain, left, right) or a step, by trying every cut."""
    step = lambda g, h: (-g / (h + 1)) if not largest else float(np.clip(-g / (h + 1), -largest, largest))
    worth = lambda g, h: -(2 * g * step(g, h) + (h + 1) * step(g, h) ** 2)
    total = g[rows].sum(), h[rows].sum()
    best = None
    if depth:
        for f in range(x.shape[1]):
            values = x[rows, f]
            for missing_left in (True, False):
                if not missing_left and not np.isnan(values).any():
                    continue
                for cut in sorted(set(values[~np.isnan(values)])):
                    left = np.where(np.isnan(values), missing_left, values <= cut)
                    l, r = rows[left], rows[~left]
                    if h[l].sum() < least_hessian or h[r].sum() < least_hessian:
                        continue
                    gain = worth(g[l].sum(), h[l].sum()) + worth(g[r].sum(), h[r].sum()) - worth(*total)
                    if gain > 1e-6 and (best is None or gain > best[3] + 1e-7):
                        best = (f, cut, missing_left, gain, l, r)
    if best is None:
        return step(*total)
    return (*best[:4], *(grow(x, g, h, depth - 1, largest, rows, least_hessian) for rows in best[4:]))


def nested(tree, k=0):
    n = tree[k]
    if "feature" not in n:
        return n["value"]
    return (n["feature"], n["cut"], n["missing_left"], n["gain"], nested(tree, n["left"]), nested(tree, n["right"]))


def close(a, b, rate):
    if not isinstance(a, tuple):
        return abs(a - rate * b) < 1e-5
    return a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-4 and close(a[4], b[4], rate) and close(a[5], b[5], rate)


def test_three_trees_by_brute_force(spark):
    rows, df = frame(spark)
    c = B.Boost(depth=3, trees=3, sample=1.0, columns=1.0, rate=0.3, keep_every=2)
    heads = B.heads_for(df, {"y": ("regression", "y"), "z": ("classification", "z")})
    model = B.fit(df.repartition(3), COLUMNS, heads, ("i",), c)
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows])
    for head, column in zip(model.heads, (4, 5)):
        have = np.array([k for k, r in enumerate(rows) if r[column] is not None])
        y = np.array([float(r[column] or 0) for r in rows])
        margin = np.full(len(rows), head.base)
        for tree in head.trees:
            if head.kind == "regression":
                g, h, largest = margin - y, np.ones(len(y)), 0
            else:
                p, w = 1 / (1 + np.exp(-margin)), np.where(y == 1, head.positive_weight, 1.0)
                g, h, largest = (p - y) * w, p * (1 - p) * w, c.largest_step
            want = grow(x, g, h, c.depth, largest, have)
            assert close(nested(tree), want, c.rate)

            def value(t, row):
                while isinstance(t, tuple):
                    t = t[4] if (t[2] if np.isnan(row[t[0]]) else row[t[0]] <= t[1]) else t[5]
                return t

            margin = margin + np.array([value(nested(tree), row) for row in x])
    got = B.predict(df, model, "p_").orderBy("i").collect()
    assert np.allclose([r.p_z for r in got], 1 / (1 + np.exp(-margin)), atol=1e-6)


def test_same_trees_however_rows_are_dealt(spark, monkeypatch):
    _, df = frame(spark)
    c = B.Boost(depth=3, trees=4, keep_every=3)
    kinds = {"y": ("regression", "y"), "z": ("classification", "z")}
    one = B.fit(df.coalesce(1), COLUMNS, B.heads_for(df, kinds), ("i",), c)
    monkeypatch.setattr(B, "TASK_ROWS", 50)  # histograms of several tasks are merged
    many = B.fit(df.repartition(7, F.rand(3)), COLUMNS, B.heads_for(df, kinds), ("i",), c)
    assert [h.trees for h in one.heads] == [h.trees for h in many.heads]
    again = B.Model.from_json(one.to_json())
    assert [h.trees for h in again.heads] == [h.trees for h in one.heads] and again.columns == COLUMNS
    a, b = (sorted((r.i, r.p_y) for r in B.predict(df, m, "p_").collect()) for m in (one, again))
    assert a == b
    shares = B.importance(spark, one).groupBy("head").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in shares)


def test_more_trees_fit_better_and_classes_are_needed(spark):
    _, df = frame(spark)
    kinds = {"y": ("regression", "y")}
    error = []
    for n in (1, 12):
        model = B.fit(df, COLUMNS, B.heads_for(df, kinds), ("i",), B.Boost(trees=n, rate=0.3))
        error.append(B.predict(df, model).agg(F.avg((F.col("pred_y") - F.col("y")) ** 2)).first()[0])
    assert error[1] < error[0] * 0.5
    with pytest.raises(ValueError, match="one class"):
        B.heads_for(df.filter("z = 1"), {"z": ("classification", "z")})
    with pytest.raises(ValueError, match="missing in all"):
        B.heads_for(df.filter("y IS NULL"), kinds)


def test_edges_from_a_sketch_and_exact(spark):
    df = spark.createDataFrame([(float(i), None if i % 3 else 1.0) for i in range(1000)], "a double, b double")
    exact = B.edges(df, ("a", "b"), 10)
    assert exact[0] == [99.0 + 100 * k for k in range(9)] and exact[1] == [1.0]
    sketched = B.edges(df, ("a", "b"), 10, accuracy=10_000)
    assert len(sketched[0]) == 9 and all(abs(a - b) <= 1 for a, b in zip(exact[0], sketched[0]))
