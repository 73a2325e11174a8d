"""Linear heads of all windows against numpy, window by window."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import evaluate as E
from tidemill.operators import linear as N
from tidemill.operators.evaluate import HeadRule
from tidemill.operators import walkforward as W
from tidemill.operators.walkforward import WalkForward, judged

RULES = {"win": HeadRule(1.5, 0.25, 1.75), "risk": HeadRule(2.5, 0.15, 2.5)}
WF = WalkForward(train=40, test=10, step=10, min_test=4)
GRID = [k / 100 for k in range(10, 65, 5)]


@pytest.fixture(scope="module")
def data():
    rng, rows = random.Random(6), []
    for code, n in (("a", 77), ("b", 43), ("c", 30)):
        for i in range(n):
            x = (rng.gauss(0, 1), rng.gauss(5, 2), rng.gauss(0, 0.1) if rng.random() < 0.9 else None)
            up = 0.3 * x[0] - 0.1 * x[1] + 2 * (x[2] or 0) + rng.gauss(0, 0.2)
            rows.append((code, date(2024, 1, 1) + timedelta(days=i), i, *x, up, int(up > -0.3), int(rng.random() < 0.2)))
    return rows


def line(x, y, ridge):
    x = np.c_[np.ones(len(x)), x]
    gram = x.T @ x
    spread = np.diag(gram) - gram[0] ** 2 / gram[0, 0]
    gram[np.arange(1, 4), np.arange(1, 4)] += ridge * spread[1:]
    return np.linalg.lstsq(gram, x.T @ y, rcond=None)[0]


def threshold(y, p, rule):
    if not 0 < sum(y) < len(y):
        return 0.5
    best, rate = None, sum(y) / len(y)
    for t in GRID:
        on = p >= t
        tp, called = (on & (y == 1)).sum(), on.sum()
        precision, recall = tp / called if called else 0.0, tp / sum(y)
        b = rule.beta**2
        f = (1 + b) * precision * recall / (b * precision + recall) if b * precision + recall else 0.0
        meets = precision >= max(rule.precision_floor, 0.75 * rate) and called / len(y) <= max(rate * rule.rate_multiplier, rate + 0.05)
        best = max(best or (False, -1.0), (meets, f, recall, precision, -abs(called / len(y) - rate), t))
    return best[-1]


@pytest.mark.parametrize("ridge", [0.0, 0.05])
def test_against_numpy(spark, data, ridge):
    names = ("x0", "x1", "x2")
    df = spark.createDataFrame(data, "code string, date date, row_idx long, x0 double, x1 double, x2 double, target_up double, target_win int, target_risk int")
    got = {(r.code, r.row_idx): r for r in N.walk_forward(df, names, ("up",), RULES, WF, ("code",), N.Linear(ridge, 0.25)).collect()}
    want = 0
    for code in "abc":
        own = [r for r in data if r[0] == code]
        x = np.array([[v or 0.0 for v in r[3:6]] for r in own])
        y = {h: np.array([r[k] for r in own], dtype=float) for h, k in (("up", 6), ("win", 7), ("risk", 8))}
        for w in range(max(0, (len(own) - 44) // 10 + 1) if len(own) >= 44 else 0):
            a, split, z = w * 10, w * 10 + 30, w * 10 + 40
            limits = {}
            for h, rule in RULES.items():
                c = line(x[a:split], y[h][a:split], ridge)
                limits[h] = threshold(y[h][split:z], np.clip(c[0] + x[split:z] @ c[1:], 0, 1), rule)
            for i in range(z, min(z + 10, len(own))):
                r = got[(code, i)]
                want += 1
                assert r.window_id == w + 1
                for h in ("up", *RULES):
                    c = line(x[a:z], y[h][a:z], ridge)
                    p = c[0] + x[i] @ c[1:]
                    assert r[f"pred_{h}"] == pytest.approx(p if h == "up" else min(1, max(0, p)), abs=1e-6)
                assert all(r[f"threshold_{h}"] == pytest.approx(limits[h]) for h in RULES)
    assert len(got) == want > 0
    metrics = N.head_metrics(N.walk_forward(df, names, ("up",), RULES, WF, ("code",)), ("up",), RULES, ("code",)).collect()
    assert {(r.code, r.window_id, r["head"]) for r in metrics} == {(c, r.window_id, h) for (c, _), r in got.items() for h in ("up", *RULES)}


def test_slopes_of_zero_are_zero_after_many_rows(spark):
    """Both classes have every feature value equally often, so all scores are the classes' share: ties, and equal to a threshold of the grid."""
    far = [("a", i, 0.008 + (i * 7 % 27) / 1000, i * 11 % 5 // 4) for i in range(5000)]
    even = [("a", 5000 + i, 0.008 + (i // 4 % 25) / 1000, int(i % 4 == 3)) for i in range(400)]
    df = spark.createDataFrame(far + even, "code string, row_idx long, x double, target_risk int")
    windows = spark.createDataFrame([("a", 5000, 5400)], "code string, begin long, end long")
    w = N.fit(df, windows, ("x",), ("target_risk",), ("code",), "begin", "end", "w", 0.0).first().w
    assert w == [[0.25, 0.0]]
    still = df.withColumn("x", F.lit(0.3))
    assert N.fit(still, windows, ("x",), ("target_risk",), ("code",), "begin", "end", "w", 0.0).first().w == [[0.25, 0.0]]


def test_scores_that_equal_a_threshold_reach_it(spark):
    below = 0.1 + 0.7 - 0.35
    assert below < 0.45
    assert spark.range(1).select(N._chance(F.lit(below)).alias("p")).first().p == 0.45


@pytest.mark.parametrize("beta", [1.5, 2.5, 3.0])
def test_f_beta_has_the_bits_of_the_sql(spark, beta):
    rows = [(a / b, a / c) for a in range(1, 12) for b in range(a, 40) for c in range(a, 20, 3)]
    got = spark.createDataFrame(rows, "p double, r double").select("p", "r", E.f_beta(F.col("p"), F.col("r"), F.lit(beta)).alias("f")).collect()
    b = beta * beta
    assert all(x.f == (1 + b) * x.p * x.r / (b * x.p + x.r) for x in got)


def test_windows_without_a_join(spark, data):
    df = spark.createDataFrame([(r[0], r[2]) for r in data], "code string, row_idx long")
    got = sorted((r.code, r.row_idx, r.window_id) for r in W.tested(df, WF, "code").collect())
    assert got == [("a", i, (i - 40) // 10 + 1) for i in range(40, 77)]  # b has too few rows for a test window


def test_verdicts_of_rows(spark):
    rows = [("k", w, m, x) for w, m, x in [(1, "NORMAL", -0.02), (1, "SAFE", 0.0), (1, "NORMAL", 0.0), (2, "NORMAL", 0.03), (2, "OFF", 0.0), (3, "SAFE", -0.01)]]
    got = {r.window_id: r for r in judged(spark.createDataFrame(rows, "code string, window_id long, mode string, target_grid_pnl double"), "code").collect()}
    assert [got[w].severity for w in (1, 2, 3)] == [1, 3, 2] and [got[w].normal_beats_safe for w in (1, 2, 3)] == [False, True, True]
    assert got[1].normal_minus_safe == pytest.approx(-0.01)


def test_heads_follow_targets(spark):
    names = [f"target_{h}" for h in ("upside", "downside", "grid_pnl", *E.HEADS)]
    df = spark.createDataFrame([], ", ".join(f"{n} double" for n in names))
    assert len(E.heads_of(df)) == 8 and E.heads_of(df)["tradable"] == ("classification", "target_tradable")
    assert len(E.heads_of(df.withColumn("target_downside_from_open", F.lit(0.0)))) == 9
    with pytest.raises(ValueError, match="upside"):
        E.heads_of(df.drop("target_upside"))
