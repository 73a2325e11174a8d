import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators.evaluate import HEADS
from tidemill.operators.walkforward import WalkForward
from tidemill.operators import daily as D
from tidemill.operators import decision as C
from tidemill.operators import evaluate as E
from tidemill.operators import heads as H
from tidemill.operators import segments as G
from tidemill.operators import walkforward as W

PRED = "pred_upside double, pred_downside double, pred_grid_pnl double, pred_positive_grid_day double, pred_tradable double, pred_trend_break_risk double, pred_hostile_selloff_risk double, pred_vwap_reversion double, grid_step_pct double"


def decide(spark, *rows):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "i int, " + PRED)
    df = df.withColumns({f"threshold_{h}": F.lit(0.5) for h in HEADS})
    return C.controls(df).orderBy("i").collect()


def test_rule_table(spark):
    #      up, down, pnl, grid, trad, trend, hostile, vwap, step
    got = decide(
        spark,
        (0.02, -0.01, 0.01, 0.9, 0.9, 0.9, 0.1, 0.9, 0.01),
        (0.01, -0.04, -0.01, 0.1, 0.1, 0.1, 0.9, 0.1, 0.01),
        (0.02, -0.01, 0.01, 0.9, 0.9, 0.1, 0.9, 0.1, 0.01),
        (0.02, -0.01, 0.01, 0.9, 0.9, 0.1, 0.1, 0.1, 0.01),
        (0.02, -0.01, 0.01, 0.9, 0.1, 0.1, 0.1, 0.1, 0.01),
        (0.04, -0.01, 0.01, 0.9, 0.9, 0.1, 0.1, 0.9, 0.01),
        (0.02, -0.01, 0.01, 0.1, 0.1, 0.1, 0.1, 0.1, None),
    )
    assert [r.mode for r in got] == ["NORMAL", "OFF", "SAFE", "NORMAL", "SAFE", "AGGRESSIVE", "SAFE"]
    assert got[0].rationale == "clean_edge_with_trend_damper" and got[0].position_scale == 0.70 and got[0].dip_buy
    assert not got[1].high_sell and got[2].rationale == "hostile_selloff_blocks_execution" and not got[3].dip_buy
    assert got[6].grid_width == pytest.approx(0.01 * 1.12)


def test_downgrade(spark):
    df = spark.createDataFrame([("NORMAL", False, 0.85, 1.0, 0.01, True, "x"), ("OFF", True, 0.2, 1.35, 0.004, False, "y")], "mode string, trend_weak boolean, position_scale double, grid_width_scale double, grid_width double, dip_buy boolean, rationale string")
    a, b = C.soft_downgrade(df, F.lit(True)).collect()
    assert (a["mode"], a.position_scale, a.grid_width_scale, a.dip_buy, a.grid_width) == ("SAFE", 0.55, 1.10, False, 0.01)
    assert (b["mode"], b.position_scale, b.grid_width) == ("OFF", 0.2, 0.005)


def test_buckets(spark):
    df = spark.createDataFrame([(0, 0.9, "a"), (1, 0.1, "a"), (2, 0.5, "a"), (3, None, "a")], "i int, x double, k string")
    got = df.withColumn("b", E.score_bucket("x", 5, ("i",), "k")).orderBy("i").collect()
    assert [r.b for r in got] == [3, 1, 2, None]


def test_average_precision_and_auc_by_hand(spark):
    rng = random.Random(3)
    rows = [("k", rng.choice([0.1, 0.2, 0.5, 0.8]), int(rng.random() < 0.4)) for _ in range(60)]
    df = spark.createDataFrame(rows, "k string, s double, y int")
    pos = sum(y for *_, y in rows)
    ap = last = 0.0
    for t in sorted({s for _, s, _ in rows}, reverse=True):
        tp, n = sum(y for _, s, y in rows if s >= t), sum(s >= t for _, s, _ in rows)
        ap += (tp / pos - last) * tp / n
        last = tp / pos
    auc = sum((a > b) + 0.5 * (a == b) for _, a, x in rows if x for _, b, z in rows if not z) / (pos * (60 - pos))
    assert E.average_precision(df, "y", "s", "k").first().average_precision == pytest.approx(ap)
    assert E.roc_auc(df, "y", "s", "k").first().roc_auc == pytest.approx(auc)
    one = df.filter("y = 1")
    assert E.average_precision(one, "y", "s", "k").first().average_precision == 1.0 and E.roc_auc(one, "y", "s", "k").first().roc_auc is None


def test_threshold_and_fallback(spark):
    df = spark.createDataFrame([("k", p, y) for p, y in [(0.9, 1), (0.45, 1), (0.42, 1), (0.3, 0), (0.2, 0), (0.1, 0), (0.05, 0), (0.02, 0)]], "k string, s double, y int")
    best = E.choose_threshold(df, "y", "s", HEADS["tradable"], "k").first()
    assert best.threshold < 0.5 and best.recall >= 0.6 and best.meets
    single = E.choose_threshold(df.filter("y = 0"), "y", "s", HEADS["tradable"], "k").first()
    assert single.threshold == 0.5 and not single.meets


def test_windows(spark):
    counts = spark.createDataFrame([("a", 12), ("b", 7)], "code string, n long")
    got = [tuple(r)[1:] for r in W.windows(counts, WalkForward(6, 2, 2, 1), "code").orderBy("code", "window_id").collect()]
    assert got == [(1, 0, 6, 6, 8), (2, 2, 8, 8, 10), (3, 4, 10, 10, 12), (1, 0, 6, 6, 7)]
    with pytest.raises(ValueError):
        WalkForward(6, 3, 2, 1)


def test_empty_segments_are_zero(spark):
    targets = ", ".join(f"target_{c} int" for c in G.OUTCOMES)
    df = spark.createDataFrame([("a", "SAFE", -0.03, 0.5, 0.1, -0.1, 0, 0, 0, 1, 0), ("a", "OFF", -0.04, 0.2, 0.1, -0.1, 0, 0, 1, 1, 0)], f"code string, mode string, target_grid_pnl double, position_scale double, target_upside double, target_downside double, {targets}")
    got = {r.segment: r for r in G.summary(df, G.mode_segments(), "code").collect()}
    assert len(got) == 7 and got["SAFE_OR_OFF"].pnl_total == pytest.approx(-0.07) and got["SAFE_OR_OFF"].n == 2
    assert got["NORMAL"].n == 0 and got["NORMAL"].pnl_mean == 0.0 and got["ALL"].share == 1.0


def test_failing_window_first(spark):
    rows = [("a", w, s, 5, m, m - 0.01, m - 0.02) for w, s, m in [(1, "SAFE", 0.01), (1, "NORMAL", 0.0), (2, "SAFE", 0.0), (2, "NORMAL", 0.01)]]
    df = spark.createDataFrame(rows, "code string, window_id long, segment string, n long, pnl_mean double, pnl_p10 double, pnl_worst double")
    got = W.failure_windows(df, "code").orderBy("severity").collect()
    assert got[0].window_id == 1 and got[0].normal_minus_safe == pytest.approx(-0.01) and not got[0].normal_beats_safe and got[0].OFF_n == 0


def test_split_and_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", date(2026, 1, 1) + timedelta(days=k), float(k), k % 2) for k in range(40)], "code string, date date, feature_a double, target_x int")
    parts = D.ordinal_split(df.limit(10), 0.2).groupBy("part").count().collect()
    assert {r.part: r["count"] for r in parts} == {"train": 8, "test": 2}
    assert H.feature_columns(df) == ["feature_a"]
    with pytest.raises(ValueError):
        H.leakage_audit(df, ["feature_a", "target_x"])
    head = H.fit_classifier(df, ("feature_a",), "target_x", H.TreeConfig(trees=2))
    H.save({"x": head}, str(tmp_path / "candidate"))
    H.promote(str(tmp_path / "candidate"), str(tmp_path / "production"), "now")
    again = H.load(str(tmp_path / "production"))["x"]
    assert again.columns == ("feature_a",)
    a, b = (sorted(r.p for r in H.predict(h, df, "p").collect()) for h in (head, again))
    assert a == pytest.approx(b)
    with pytest.raises(FileNotFoundError):
        H.load(str(tmp_path / "none"))


def test_tree_queries_fit_all_heads_in_full(spark, monkeypatch):
    from tidemill.plans import registry

    asked = []

    def short(fit):
        def run(df, columns, target, c=H.TreeConfig()):
            asked.append((target, c))
            return fit(df, columns, target, H.TreeConfig(trees=1))

        return run

    monkeypatch.setattr(H, "fit_regressor", short(H.fit_regressor))
    monkeypatch.setattr(H, "fit_classifier", short(H.fit_classifier))
    heads = {"upside", "downside", "grid_pnl", *HEADS}
    got = registry.QUERIES["head_importance"](spark, "/root/testdata/sf0.001")
    assert {r["head"] for r in got.collect()} == heads
    assert {t for t, _ in asked} == {f"target_{h}" for h in heads} and len(asked) == len(heads)
    scores = registry.QUERIES["gbt_scores"](spark, "/root/testdata/sf0.001")
    assert set(scores.columns) == {"code", "date", *(f"tree_{h}" for h in heads)} and scores.filter("tree_tradable BETWEEN 0 AND 1").count() == scores.count() > 0
    assert all(c == H.TreeConfig() and c.trees == 300 for _, c in asked)


def test_second_order_queries_cover_all_heads(spark, monkeypatch):
    from tidemill.operators import boosting as B
    from tidemill.plans import extension, registry

    c = extension.SETTINGS
    assert (c.depth, c.rate, c.sample, c.columns, c.seed, c.largest_step) == (4, 0.05, 0.9, 0.9, 42, 1.0) and B.Boost().trees == 300
    monkeypatch.setattr(extension, "SETTINGS", B.Boost(trees=2))
    heads = {"upside", "downside", "grid_pnl", *HEADS}
    got = registry.QUERIES["boosted_importance"](spark, "/root/testdata/sf0.001")
    assert {r["head"] for r in got.collect()} == heads
    scores = registry.QUERIES["boosted_scores"](spark, "/root/testdata/sf0.001")
    assert set(scores.columns) == {"code", "date", *(f"tree_{h}" for h in heads)} and scores.filter("tree_tradable BETWEEN 0 AND 1").count() == scores.count() > 0
