"""Queries on metrics, thresholds, buckets, walk-forward windows and failures.

Scores and outcomes are arithmetic on the orders' daily series, so that the oracle has them too.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import daily as D
from ..operators import decision as C
from ..operators import evaluate as E
from ..operators.evaluate import HEADS, THRESHOLDS, HeadRule
from ..operators import segments as G
from ..operators import walkforward as W
from ..operators.walkforward import WalkForward
from ..sources import tables as S
from .common import SERIES
from .registry import add

_CLASS = {"positive_grid_day": 101, "tradable": 103, "trend_break_risk": 107, "hostile_selloff_risk": 109, "vwap_reversion": 113}
_LIMIT = {"positive_grid_day": 0.35, "tradable": 0.35, "trend_break_risk": 0.5, "hostile_selloff_risk": 0.5, "vwap_reversion": 0.45}
_TARGET = {"positive_grid_day": "target_grid_pnl > 0", "tradable": "target_grid_pnl > 0.003", "trend_break_risk": "nh % 7 = 0", "hostile_selloff_risk": "nh % 6 = 0", "vwap_reversion": "nh % 5 < 2"}
SCORED = SERIES + f""", h0 AS (SELECT code, date, CAST(round(close * 100) AS BIGINT) AS h, row_number() OVER (PARTITION BY code ORDER BY date) - 1 AS row_idx,
    count(*) OVER (PARTITION BY code) AS n_rows, lead(CAST(round(close * 100) AS BIGINT)) OVER (PARTITION BY code ORDER BY date) AS nh FROM series),
h1 AS (SELECT code, date, row_idx, h, nh, h % 97 / 97::DOUBLE * 0.06::DOUBLE AS pred_upside, -(h % 89 / 89::DOUBLE) * 0.06::DOUBLE AS pred_downside,
    (h % 83 / 83::DOUBLE - 0.4::DOUBLE) * 0.02::DOUBLE AS pred_grid_pnl, {', '.join(f'h % {p} / {p}::DOUBLE AS pred_{k}' for k, p in _CLASS.items())},
    (nh % 127 / 127::DOUBLE - 0.45::DOUBLE) * 0.05::DOUBLE AS target_grid_pnl, nh % 131 / 131::DOUBLE * 0.08::DOUBLE AS target_upside,
    0.01::DOUBLE - nh % 137 / 137::DOUBLE * 0.08::DOUBLE AS target_downside, CAST(nh % 11 = 0 AS INTEGER) AS suspicious_flag, 0.008::DOUBLE + h % 27 / 1000::DOUBLE AS grid_step_pct
    FROM h0 WHERE nh IS NOT NULL),
scored AS (SELECT *, {', '.join(f'CAST({t} AS INTEGER) AS target_{k}' for k, t in _TARGET.items())}, {', '.join(f'{v}::DOUBLE AS threshold_{k}' for k, v in _LIMIT.items())} FROM h1)"""
_ON = {"grid_on": "positive_grid_day", "tradable_on": "tradable", "trend_high": "trend_break_risk", "hostile_high": "hostile_selloff_risk", "vwap_on": "vwap_reversion"}
DECIDED = SCORED + f""", o0 AS (SELECT *, {', '.join(f'pred_{c} >= threshold_{c} AS {k}' for k, c in _ON.items())} FROM scored),
o1 AS (SELECT *, grid_on AND tradable_on AS core_edge, grid_on AND tradable_on AND NOT hostile_high AS clean_edge,
    pred_upside >= 0.03 AND pred_grid_pnl > 0 AND greatest(pred_upside, 0) + abs(least(pred_downside, 0)) >= greatest(0.03, grid_step_pct * 2) AS strong_range,
    hostile_high AND NOT grid_on AND NOT tradable_on AND NOT vwap_on AND pred_upside <= 0.012 AND pred_grid_pnl <= 0 AS negative_stack FROM o0),
o2 AS (SELECT *, CASE WHEN negative_stack THEN 1 WHEN clean_edge AND vwap_on AND strong_range AND NOT trend_high THEN 2 WHEN clean_edge THEN 3 WHEN core_edge AND hostile_high THEN 4
    WHEN grid_on THEN 5 WHEN tradable_on THEN 6 ELSE 7 END AS rule FROM o1),
o3 AS (SELECT *, CASE rule WHEN 1 THEN 'OFF' WHEN 2 THEN 'AGGRESSIVE' WHEN 3 THEN 'NORMAL' ELSE 'SAFE' END AS mode,
    CASE rule WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN trend_high WHEN 4 THEN true ELSE trend_high OR hostile_high END AS trend_weak,
    CASE rule WHEN 1 THEN 0.20 WHEN 2 THEN 1.0 WHEN 3 THEN CASE WHEN trend_high THEN 0.70 ELSE 0.85 END WHEN 4 THEN 0.45 WHEN 5 THEN CASE WHEN hostile_high THEN 0.45 ELSE 0.60 END
      WHEN 6 THEN CASE WHEN hostile_high THEN 0.40 ELSE 0.50 END ELSE CASE WHEN hostile_high THEN 0.35 ELSE 0.45 END END AS position_scale,
    CASE rule WHEN 1 THEN 1.35 WHEN 2 THEN 0.92 WHEN 3 THEN CASE WHEN trend_high THEN 1.08 ELSE 1.0 END WHEN 4 THEN 1.20 WHEN 5 THEN CASE WHEN hostile_high THEN 1.22 ELSE 1.15 END
      WHEN 6 THEN CASE WHEN hostile_high THEN 1.20 ELSE 1.12 END ELSE CASE WHEN hostile_high THEN 1.22 ELSE 1.12 END END AS grid_width_scale,
    CASE rule WHEN 2 THEN true WHEN 3 THEN vwap_on AND pred_downside > -0.03 ELSE false END AS dip_buy, rule <> 1 AS high_sell,
    CASE rule WHEN 1 THEN 'negative_stack_with_hostile_selloff' WHEN 2 THEN 'clean_reversion_and_strong_range' WHEN 3 THEN CASE WHEN trend_high THEN 'clean_edge_with_trend_damper' ELSE 'clean_edge_without_hostile_selloff' END
      WHEN 4 THEN 'hostile_selloff_blocks_execution' WHEN 5 THEN 'positive_grid_without_tradable_confirmation' WHEN 6 THEN 'tradable_without_grid_confirmation' ELSE 'insufficient_edge' END AS rationale FROM o2),
decided AS (SELECT *, greatest(grid_step_pct * grid_width_scale, 0.005) AS grid_width FROM o3)"""


def scored(s, d):
    w = Window.partitionBy("code").orderBy("date")
    h = F.round(F.col("close") * 100).cast("long")
    df = S.order_days(s, d).select("code", "date", h.alias("h")).withColumns({"row_idx": (F.row_number().over(w) - 1).cast("long"), "nh": F.lead("h").over(w)}).filter("nh IS NOT NULL")
    part = lambda c, p: F.col(c) % p / F.lit(float(p))
    df = df.withColumns({
        "pred_upside": part("h", 97) * 0.06, "pred_downside": -part("h", 89) * 0.06, "pred_grid_pnl": (part("h", 83) - 0.4) * 0.02, **{f"pred_{k}": part("h", p) for k, p in _CLASS.items()},
        "target_grid_pnl": (part("nh", 127) - 0.45) * 0.05, "target_upside": part("nh", 131) * 0.08, "target_downside": 0.01 - part("nh", 137) * 0.08,
        "suspicious_flag": (F.col("nh") % 11 == 0).cast("int"), "grid_step_pct": 0.008 + F.col("h") % 27 / F.lit(1000.0),
    })
    return df.withColumns({**{f"target_{k}": F.expr(t).cast("int") for k, t in _TARGET.items()}, **{f"threshold_{k}": F.lit(v) for k, v in _LIMIT.items()}})


def decided(s, d):
    return C.controls(scored(s, d))


_RANKED = """, ranked AS (SELECT code, {y} AS y, {p} AS p, rank() OVER (PARTITION BY code ORDER BY {y}) + (count(*) OVER (PARTITION BY code, {y}) - 1) / 2.0 AS ry,
  rank() OVER (PARTITION BY code ORDER BY {p}) + (count(*) OVER (PARTITION BY code, {p}) - 1) / 2.0 AS rp, avg({y}) OVER (PARTITION BY code) AS mean,
  quantile_cont({p}, 0.8) OVER (PARTITION BY code) AS hi, quantile_cont({p}, 0.2) OVER (PARTITION BY code) AS lo FROM {t})"""
_REG = """code, avg(abs(p - y)) AS mae, sqrt(avg((p - y) ** 2)) AS rmse, 1 - sum((p - y) ** 2) / nullif(sum((y - mean) ** 2), 0) AS r2, corr(ry, rp) AS spearman,
  avg(y) FILTER (p >= hi) AS top_fifth_mean, avg(y) FILTER (p <= lo) AS bottom_fifth_mean"""
_REG_NAMES = "mae rmse r2 spearman top_fifth_mean bottom_fifth_mean"
add("regression_metrics", lambda s, d: E.regression_metrics(scored(s, d), "target_downside", "pred_downside", "code"), f"WITH {SCORED}{_RANKED.format(y='target_downside', p='pred_downside', t='scored')} SELECT {_REG} FROM ranked GROUP BY code", _REG_NAMES)
add("spearman", lambda s, d: E.regression_metrics(scored(s, d), "target_upside", "pred_upside", "code").select("code", "spearman"), f"WITH {SCORED}{_RANKED.format(y='target_upside', p='pred_upside', t='scored')} SELECT code, corr(ry, rp) AS spearman FROM ranked GROUP BY code", "spearman")


def _counts(truth: str, score: str, limit: str) -> str:
    return f"count(*) FILTER ({truth} = 1 AND {score} >= {limit}) AS tp, count(*) FILTER ({truth} <> 1 AND {score} >= {limit}) AS fp, count(*) FILTER ({truth} = 1 AND {score} < {limit}) AS fn, count(*) FILTER ({truth} <> 1 AND {score} < {limit}) AS tn"


def _rates(beta: float) -> str:
    b = beta * beta
    return f"""coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
  coalesce({1 + b}::DOUBLE * coalesce(tp / nullif(tp + fp, 0), 0) * coalesce(tp / nullif(tp + fn, 0), 0) / nullif({b}::DOUBLE * coalesce(tp / nullif(tp + fp, 0), 0) + coalesce(tp / nullif(tp + fn, 0), 0), 0), 0) AS f_beta,
  (tp + fp) / (tp + fp + fn + tn) AS positive_rate, (tp + fn) / (tp + fp + fn + tn) AS label_rate"""


_RATE_NAMES = "precision recall accuracy f1 f_beta positive_rate label_rate"
add(
    "classification_metrics",
    lambda s, d: E.classification_metrics(scored(s, d), "target_tradable", "pred_tradable", 0.35, 1.5, "code"),
    f"WITH {SCORED}, c AS (SELECT code, {_counts('target_tradable', 'pred_tradable', '0.35')} FROM scored GROUP BY code) SELECT *, {_rates(1.5)}, 0.35::DOUBLE AS threshold FROM c",
    _RATE_NAMES + " threshold",
)
AP = """SELECT {k}, sum(tp / total * cum_tp / cum_n) AS average_precision FROM (
  SELECT {k}, score, tp, sum(tp) OVER (PARTITION BY {k} ORDER BY score DESC) AS cum_tp, sum(n) OVER (PARTITION BY {k} ORDER BY score DESC) AS cum_n, sum(tp) OVER (PARTITION BY {k}) AS total
  FROM (SELECT {k}, {p} AS score, sum({y}) AS tp, count(*) AS n FROM {t} GROUP BY {k}, {p})) GROUP BY {k}"""
add("average_precision", lambda s, d: E.average_precision(scored(s, d), "target_tradable", "pred_tradable", "code"), f"WITH {SCORED} {AP.format(k='code', p='pred_tradable', y='target_tradable', t='scored')}", "average_precision")
add(
    "roc_auc",
    lambda s, d: E.roc_auc(scored(s, d), "target_tradable", "pred_tradable", "code"),
    f"""WITH {SCORED}, r AS (SELECT code, target_tradable AS y, rank() OVER (PARTITION BY code ORDER BY pred_tradable) + (count(*) OVER (PARTITION BY code, pred_tradable) - 1) / 2.0 AS r FROM scored)
      SELECT code, (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * (count(*) - sum(y)), 0) AS roc_auc FROM r GROUP BY code""",
    "roc_auc",
)
add("class_weight", lambda s, d: E.class_weight(scored(s, d), "target_hostile_selloff_risk", "code"), f"WITH {SCORED} SELECT code, CASE WHEN sum(target_hostile_selloff_risk) = 0 THEN 1.0 ELSE greatest(1.0, sum(1 - target_hostile_selloff_risk) / sum(target_hostile_selloff_risk)) END AS weight FROM scored GROUP BY code", "weight")
_GRID = ", ".join(f"({t}::DOUBLE)" for t in THRESHOLDS)


def _best(k: str, t: str, truth: str, score: str, rule: HeadRule) -> str:
    """CTEs whose last, best, has the threshold of each key."""
    return f"""g AS (SELECT unnest([{', '.join(f'{x}::DOUBLE' for x in THRESHOLDS)}]) AS threshold),
  c AS (SELECT {k}, threshold, {_counts(truth, score, 'threshold')} FROM {t}, g GROUP BY {k}, threshold), m AS (SELECT *, {_rates(rule.beta)} FROM c),
  v AS (SELECT *, precision >= greatest({rule.precision_floor}::DOUBLE, label_rate * 0.75) AND positive_rate <= greatest(label_rate * {rule.rate_multiplier}::DOUBLE, label_rate + 0.05) AS meets FROM m),
  best AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY meets DESC, f_beta DESC, recall DESC, precision DESC, abs(positive_rate - label_rate), threshold DESC) = 1)"""


add(
    "threshold_search",
    lambda s, d: E.choose_threshold(scored(s, d), "target_tradable", "pred_tradable", HEADS["tradable"], "code"),
    f"WITH {SCORED}, {_best('code', 'scored', 'target_tradable', 'pred_tradable', HEADS['tradable'])} SELECT code, label_rate, threshold, precision, recall, f_beta, meets FROM best",
    "label_rate threshold precision recall f_beta",
)
_Q = "CAST(greatest(1, ceil((row_number() OVER (PARTITION BY code ORDER BY {p}, date) - 1) * 5 / (count(*) OVER (PARTITION BY code) - 1))) AS INTEGER)"
add("score_buckets", lambda s, d: scored(s, d).select("code", "date", E.score_bucket("pred_upside", 5, ("date",), "code").alias("bucket")), f"WITH {SCORED} SELECT code, date, {_Q.format(p='pred_upside')} AS bucket FROM scored")
_HEADS = {h: (f"pred_{h}", f"target_{h}") for h in ("upside", "downside", "grid_pnl", *HEADS)}
_RATE = ", ".join(f"avg(target_{c}) AS {c}_rate" for c in G.OUTCOMES)
_RATE_COLUMNS = " ".join(f"{c}_rate" for c in G.OUTCOMES)


def buckets(s, d):
    return G.bucket_summary(scored(s, d), _HEADS, ("date",), "code")


add(
    "bucket_summary",
    buckets,
    f"WITH {SCORED}, b AS (" + " UNION ALL ".join(f"SELECT *, '{h}' AS head, {p} AS score, {_Q.format(p=p)} AS bucket, {t}::DOUBLE AS outcome FROM scored" for h, (p, t) in _HEADS.items()) + f""")
      SELECT code, head, bucket, count(*) AS n, avg(score) AS score_mean, min(score) AS score_min, max(score) AS score_max, avg(outcome) AS outcome_mean, avg(target_grid_pnl) AS pnl_mean, avg(target_upside) AS upside_mean,
        avg(target_downside) AS downside_mean, {_RATE}, count(*) / (SELECT count(*) FROM scored x WHERE x.code = b.code) AS share FROM b GROUP BY code, head, bucket""",
    "score_mean score_min score_max outcome_mean pnl_mean upside_mean downside_mean share " + _RATE_COLUMNS,
)
_FULL = f"""count(*) AS n, avg(target_grid_pnl) AS pnl_mean, quantile_cont(target_grid_pnl, 0.1) AS pnl_p10, min(target_grid_pnl) AS pnl_worst, {_RATE}"""
_MORE = """, sum(target_grid_pnl) AS pnl_total, quantile_cont(target_grid_pnl, 0.5) AS pnl_median, sum(target_grid_pnl * position_scale) AS scaled_total, avg(target_grid_pnl * position_scale) AS scaled_mean,
  avg(target_upside) AS upside_mean, avg(target_downside) AS downside_mean"""
_MODE_SQL = {"ALL": "true", **{m: f"mode = '{m}'" for m in G.MODES}, "SAFE_OR_OFF": "mode IN ('SAFE', 'OFF')", "NORMAL_OR_AGGRESSIVE": "mode IN ('NORMAL', 'AGGRESSIVE')"}
_INTER_SQL = {
    "edge_on_hostile_on": "core_edge AND hostile_high", "edge_on_hostile_off": "core_edge AND NOT hostile_high", "edge_off_hostile_on": "NOT core_edge AND hostile_high",
    "trend_high_hostile_high": "trend_high AND hostile_high", "trend_high_hostile_low": "trend_high AND NOT hostile_high", "trend_low_hostile_high": "NOT trend_high AND hostile_high",
    "vwap_on_hostile_on": "vwap_on AND hostile_high", "vwap_on_hostile_off": "vwap_on AND NOT hostile_high",
}


def _segments(cond: dict[str, str], more: str, t: str = "decided") -> str:
    names = ["pnl_mean", "pnl_p10", "pnl_worst", *_RATE_COLUMNS.split()] + (["pnl_total", "pnl_median", "scaled_total", "scaled_mean", "upside_mean", "downside_mean"] if more else [])
    rows = " UNION ALL ".join(f"SELECT code, '{k}' AS segment, {_FULL}{more} FROM {t} WHERE {c} GROUP BY code" for k, c in cond.items())
    keys = f"SELECT code, count(*) AS total, unnest([{', '.join(repr(k) for k in cond)}]) AS segment FROM {t} GROUP BY code"
    return f"SELECT k.code, k.segment, coalesce(r.n, 0) AS n, {', '.join(f'coalesce(r.{c}, 0) AS {c}' for c in names)}, coalesce(r.n, 0) / k.total AS share FROM ({keys}) k LEFT JOIN ({rows}) r USING (code, segment)"


_BASIC = "pnl_mean pnl_p10 pnl_worst share " + _RATE_COLUMNS
add("mode_replay_summary", lambda s, d: G.summary(decided(s, d), G.mode_segments(), "code"), f"WITH {DECIDED} {_segments(_MODE_SQL, _MORE)}", _BASIC + " pnl_total pnl_median scaled_total scaled_mean upside_mean downside_mean")
add("controller_interaction", lambda s, d: G.summary(decided(s, d), G.interaction_segments(), "code", full=False), f"WITH {DECIDED} {_segments(_INTER_SQL, '')}", _BASIC)
add(
    "downside_cases",
    lambda s, d: E.error_cases(decided(s, d), 10, ("date",), "code").select("code", "date", "mode", "abs_error", "predicted_rank", "actual_rank", "error_rank", "rank_gap", "in_predicted_worst", "in_actual_worst", "in_largest_error"),
    f"""WITH {DECIDED}, e AS (SELECT *, abs(pred_downside - target_downside) AS abs_error FROM decided),
      r AS (SELECT code, date, mode, abs_error, CAST(row_number() OVER (PARTITION BY code ORDER BY pred_downside, date) AS INTEGER) AS predicted_rank, CAST(row_number() OVER (PARTITION BY code ORDER BY target_downside, date) AS INTEGER) AS actual_rank,
        CAST(row_number() OVER (PARTITION BY code ORDER BY abs_error DESC, date) AS INTEGER) AS error_rank FROM e)
      SELECT *, predicted_rank - actual_rank AS rank_gap, predicted_rank <= 10 AS in_predicted_worst, actual_rank <= 10 AS in_actual_worst, error_rank <= 10 AS in_largest_error FROM r WHERE predicted_rank <= 10 OR actual_rank <= 10 OR error_rank <= 10""",
    "abs_error",
)


def comparison(s, d):
    df = scored(s, d)
    both = df.withColumn("scope", F.lit("all_days")).unionAll(df.filter("suspicious_flag = 0").withColumn("scope", F.lit("non_suspicious_days")))
    return E.regression_metrics_ranged(both, "target_downside", "pred_downside", "scope")


add(
    "downside_comparison",
    comparison,
    f"WITH {SCORED}, s AS (SELECT *, 'all_days' AS scope FROM scored UNION ALL SELECT *, 'non_suspicious_days' FROM scored WHERE suspicious_flag = 0)"
    + _RANKED.format(y="target_downside", p="pred_downside", t="s").replace("code", "scope") + f" SELECT {_REG.replace('code', 'scope')} FROM ranked GROUP BY scope",
    _REG_NAMES,
)
add(
    "ranking_metrics",
    lambda s, d: E.ranking_metrics_ranged(scored(s, d).withColumn("scope", F.lit("all_days")), "target_tradable", "pred_tradable", "scope"),
    f"""WITH {SCORED}, s AS (SELECT *, 'all_days' AS scope FROM scored), a AS ({AP.format(k='scope', p='pred_tradable', y='target_tradable', t='s')}),
      r AS (SELECT scope, target_tradable AS y, rank() OVER (ORDER BY pred_tradable) + (count(*) OVER (PARTITION BY pred_tradable) - 1) / 2.0 AS r FROM s)
      SELECT scope, (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * (count(*) - sum(y)), 0) AS roc_auc, max(average_precision) AS average_precision FROM r JOIN a USING (scope) GROUP BY scope""",
    "roc_auc average_precision",
)
add(
    "top_shares",
    lambda s, d: E.top_shares(S.order_days(s, d), "amount", 30, ("date",), "code").select("code", "date", "rank", "amount", "share"),
    f"WITH {SERIES}, k AS (SELECT code, date, CAST(row_number() OVER (PARTITION BY code ORDER BY amount DESC, date) AS INTEGER) AS rank, amount FROM series QUALIFY row_number() OVER (PARTITION BY code ORDER BY amount DESC, date) <= 30) SELECT *, amount / sum(amount) OVER (PARTITION BY code) AS share FROM k",
    "amount share",
)
add("train_test_split", lambda s, d: D.ordinal_split(scored(s, d).drop("row_idx"), 0.15).groupBy("code", "part").agg(F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")), f"WITH {SCORED}, p AS (SELECT code, date, CASE WHEN row_idx < floor(count(*) OVER (PARTITION BY code) * (1 - 0.15::DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM scored) SELECT code, part, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM p GROUP BY code, part")

WF = WalkForward(train=252, test=63, step=63, min_test=21)
WINDOWS = DECIDED + """, sizes AS (SELECT code, count(*) AS n FROM decided GROUP BY code),
ids AS (SELECT code, n, unnest(generate_series(CAST(1 AS BIGINT), CAST(floor((n - 252 - 21) / 63) AS BIGINT) + 1)) AS window_id FROM sizes WHERE n >= 273),
windows AS (SELECT code, window_id, (window_id - 1) * 63 AS train_start, (window_id - 1) * 63 + 252 AS train_end, (window_id - 1) * 63 + 252 AS test_start, least((window_id - 1) * 63 + 315, n) AS test_end FROM ids),
tested AS (SELECT d.*, w.window_id FROM decided d JOIN windows w ON d.code = w.code AND d.row_idx >= w.test_start AND d.row_idx < w.test_end)"""


def wf_windows(df):
    return W.windows(df.groupBy("code").agg(F.count("*").alias("n")), WF, "code")


def tested(s, d):
    return W.tested(decided(s, d), WF, "code")


add("walk_forward_windows", lambda s, d: wf_windows(scored(s, d)), f"WITH {WINDOWS} SELECT * FROM windows")


def walk_forward_scored(s, d):
    df = scored(s, d)
    w = W.train_means(df, wf_windows(df), ("target_tradable", "target_grid_pnl"), "code")
    rows = W.test_rows(df, w, WF, "code")
    return rows.select("code", "date", "window_id", ((F.col("train_target_tradable") + F.col("pred_tradable")) / 2).alias("score"), (F.col("train_target_grid_pnl") - F.col("target_grid_pnl")).alias("error"))


add(
    "walk_forward_scored",
    walk_forward_scored,
    f"""WITH {WINDOWS}, t AS (SELECT w.code, w.window_id, avg(d.target_tradable) AS a, avg(d.target_grid_pnl) AS g FROM windows w JOIN decided d ON d.code = w.code AND d.row_idx >= w.train_start AND d.row_idx < w.train_end GROUP BY w.code, w.window_id)
      SELECT x.code, x.date, x.window_id, (a + pred_tradable) / 2 AS score, g - target_grid_pnl AS error FROM tested x JOIN t USING (code, window_id)""",
    "score error",
)


def window_summary(s, d):
    return G.summary(tested(s, d), G.mode_segments(), "code", "window_id", full=False)


VERDICTS = WINDOWS + f""", sm AS (SELECT code, window_id, mode, count(*) AS n, avg(target_grid_pnl) AS a, quantile_cont(target_grid_pnl, 0.1) AS q, min(target_grid_pnl) AS w FROM tested GROUP BY code, window_id, mode),
wide AS (SELECT code, window_id, {', '.join(f"coalesce(max({x}) FILTER (mode = '{m}'), 0) AS {m}_{n}" for m in G.MODES for x, n in (('n', 'n'), ('a', 'pnl_mean'), ('q', 'pnl_p10'), ('w', 'pnl_worst')))} FROM sm GROUP BY code, window_id),
verdicts AS (SELECT *, NORMAL_pnl_mean - SAFE_pnl_mean AS normal_minus_safe, NORMAL_pnl_p10 - SAFE_pnl_p10 AS p10_minus_safe, NORMAL_pnl_worst - SAFE_pnl_worst AS worst_minus_safe,
  coalesce(NORMAL_n / nullif(NORMAL_n + SAFE_n, 0), 0) AS normal_share, NORMAL_pnl_mean - SAFE_pnl_mean > 0 AS normal_beats_safe, CAST(dense_rank() OVER (PARTITION BY code ORDER BY NORMAL_pnl_mean - SAFE_pnl_mean) AS INTEGER) AS severity FROM wide),
judged AS (SELECT t.*, v.normal_beats_safe, v.normal_minus_safe, v.severity FROM tested t LEFT JOIN verdicts v USING (code, window_id))"""
_WIDE = " ".join(f"{m}_{n}" for m in G.MODES for n in ("pnl_mean", "pnl_p10", "pnl_worst"))


def verdicts(s, d):
    return W.failure_windows(window_summary(s, d), "code")


def judged(s, d):
    return W.judged(tested(s, d), "code")


add("failure_windows", verdicts, f"WITH {VERDICTS} SELECT * FROM verdicts", _WIDE + " normal_minus_safe p10_minus_safe worst_minus_safe normal_share")
_COHORT = {"positive_grid_day_rate": "target_positive_grid_day", "tradable_rate": "target_tradable", "hostile_rate": "target_hostile_selloff_risk", "reversion_rate": "target_vwap_reversion", "pred_grid_mean": "pred_positive_grid_day", "pred_tradable_mean": "pred_tradable", "pred_hostile_mean": "pred_hostile_selloff_risk", "pred_reversion_mean": "pred_vwap_reversion", "scale_mean": "position_scale", "width_scale_mean": "grid_width_scale"}
add(
    "failure_cohorts",
    lambda s, d: W.cohorts(judged(s, d)),
    f"""WITH {VERDICTS} SELECT mode, CASE WHEN coalesce(normal_beats_safe, true) THEN 'good_windows' ELSE 'failure_windows' END AS cohort, count(*) AS n, count(DISTINCT (code, window_id)) AS n_windows, avg(target_grid_pnl) AS pnl_mean,
      quantile_cont(target_grid_pnl, 0.1) AS pnl_p10, min(target_grid_pnl) AS pnl_worst, {', '.join(f'avg({c}) AS {k}' for k, c in _COHORT.items())} FROM judged WHERE mode IN ('NORMAL', 'SAFE') GROUP BY 1, 2""",
    "pnl_mean pnl_p10 pnl_worst " + " ".join(_COHORT),
)
_FEATURES = (*(f"pred_{h}" for h in _HEADS), *(f"target_{h}" for h in _HEADS), *(f"threshold_{h}" for h in HEADS), "grid_step_pct", "position_scale", "grid_width_scale", "grid_width", "suspicious_flag")
add(
    "feature_delta",
    lambda s, d: W.feature_deltas(judged(s, d), _FEATURES),
    f"WITH {VERDICTS}, f AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce(avg({c}) FILTER (NOT normal_beats_safe), 0) AS bad_mean, coalesce(avg({c}) FILTER (normal_beats_safe), 0) AS good_mean FROM judged WHERE mode = 'NORMAL'" for c in _FEATURES) + ") SELECT *, bad_mean - good_mean AS bad_minus_good, abs(bad_mean) AS bad_abs_mean FROM f",
    "bad_mean good_mean bad_minus_good bad_abs_mean",
)
_DRIFT = HEADS


def drift(s, d):
    """All heads at once: rows are unpivoted to (head, truth, score), and a head's rule is looked up by its name."""
    heads = F.explode(F.array(*(F.struct(F.lit(h).alias("head"), F.col(f"target_{h}").alias("truth"), F.col(f"pred_{h}").alias("score")) for h in _DRIFT)))
    rows = judged(s, d).select("code", "window_id", "normal_beats_safe", heads.alias("h")).select("code", "window_id", "normal_beats_safe", "h.*")
    best = E.choose_thresholds(rows, "truth", "score", _DRIFT, "head", "code", "window_id")
    precision = E.average_precision(rows, "truth", "score", "head", "code", "window_id")
    verdict = rows.groupBy("code", "window_id").agg(F.first("normal_beats_safe").alias("normal_beats_safe"))
    return W.threshold_drift(best.join(precision, ["head", "code", "window_id"]).join(verdict, ["code", "window_id"]))


_PARTS = ("threshold", "recall", "precision", "average_precision")
_KEYED = "ck"


def _drift_sql() -> str:
    parts = []
    for h, rule in _DRIFT.items():
        best = _best("ck", "keyed", f"target_{h}", f"pred_{h}", rule)
        for name in ("g", "c", "m", "v", "best"):
            best = best.replace(f"{name} AS (SELECT", f"{name}_{h} AS (SELECT")
        best = best.replace("FROM keyed, g GROUP", f"FROM keyed, g_{h} GROUP").replace("FROM c)", f"FROM c_{h})").replace("FROM m)", f"FROM m_{h})").replace("FROM v QUALIFY", f"FROM v_{h} QUALIFY")
        parts.append(best + f", ap_{h} AS ({AP.format(k='ck', p=f'pred_{h}', y=f'target_{h}', t='keyed')})")
    rows = " UNION ALL ".join(f"SELECT '{h}' AS head, b.ck, CASE WHEN label_rate <= 0 OR label_rate >= 1 THEN 0.5 ELSE threshold END AS threshold, recall, precision, coalesce(average_precision, 0) AS average_precision FROM best_{h} b JOIN ap_{h} a USING (ck)" for h in _DRIFT)
    stats = ", ".join(f"avg({c}) FILTER (NOT normal_beats_safe) AS bad_{c}, avg({c}) FILTER (normal_beats_safe) AS good_{c}" for c in _PARTS)
    return f"""WITH {VERDICTS}, keyed AS (SELECT *, code || '|' || window_id AS ck FROM tested), {', '.join(parts)}, rows_ AS ({rows}),
      s AS (SELECT head, count(DISTINCT ck) FILTER (NOT normal_beats_safe) AS bad_windows, count(DISTINCT ck) FILTER (normal_beats_safe) AS good_windows, {stats}
        FROM rows_ LEFT JOIN (SELECT code || '|' || window_id AS ck, normal_beats_safe FROM verdicts) v USING (ck) GROUP BY head)
      SELECT *, {', '.join(f'bad_{c} - good_{c} AS {c}_delta' for c in _PARTS)} FROM s"""


add("threshold_drift", drift, _drift_sql(), " ".join(f"{p}_{c}" for c in _PARTS for p in ("bad", "good")) + " " + " ".join(f"{c}_delta" for c in _PARTS))
add(
    "failure_cases",
    lambda s, d: W.failure_cases(judged(s, d), 15).select("code", "date", "window_id", "target_grid_pnl", "severity", "pred_hostile_selloff_risk"),
    f"WITH {VERDICTS} SELECT code, date, window_id, target_grid_pnl, severity, pred_hostile_selloff_risk FROM judged WHERE mode = 'NORMAL' AND NOT normal_beats_safe ORDER BY target_grid_pnl, window_id, pred_hostile_selloff_risk DESC, code, date LIMIT 15",
    "target_grid_pnl pred_hostile_selloff_risk",
)
