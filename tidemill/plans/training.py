"""Queries that train: linear heads of every walk-forward window, their decisions, and the latest row's signal.

With one feature and no penalty a head is the regression line, which the oracle has too.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import decision as C
from ..operators import evaluate as E
from ..operators import linear as N
from ..operators import segments as G
from ..operators.evaluate import HEADS
from ..sources import sinks as K
from .evaluation import _FULL, _MODE_SQL, _RATE_COLUMNS, AP, DECIDED, WF, _counts, _rates, scored
from .evaluation import SCORED as _SCORED
from .registry import add

REGRESSION = ("upside", "downside", "grid_pnl")
ALL = (*REGRESSION, *HEADS)
PLAIN = N.Linear(ridge=0.0)
FEATURES = ("grid_step_pct", "pred_0", "pred_1", "pred_2")


def rows(s, d):
    """Features and targets of the orders' series; the scores of that frame serve as features."""
    df = scored(s, d)
    return df.select("code", "date", "row_idx", "grid_step_pct", *(F.col(f"pred_{h}").alias(f"pred_{k}") for k, h in enumerate(ALL)), *(f"target_{h}" for h in ALL))


def trained(s, d, columns=("grid_step_pct",), settings=PLAIN):
    return N.walk_forward(K.stored(rows(s, d), "training"), columns, REGRESSION, HEADS, WF, ("code",), settings)


_SPLIT = int(WF.train * (1 - PLAIN.validation))
_LINE = lambda h, x: f"regr_intercept(target_{h}, grid_step_pct) FILTER ({x}) AS i_{h}, regr_slope(target_{h}, grid_step_pct) FILTER ({x}) AS s_{h}"
_SCORE = lambda h: f"i_{h} + s_{h} * grid_step_pct"
_CHANCE = lambda h: f"least(greatest({_SCORE(h)}, 0), 1)"


def _thresholds() -> str:
    """CTE th: code, window_id, head, threshold."""
    from ..operators.evaluate import THRESHOLDS

    grid = ", ".join(f"{t}::DOUBLE" for t in THRESHOLDS)
    parts, names = [], []
    for h, rule in HEADS.items():
        parts.append(f"""c_{h} AS (SELECT code, window_id, threshold, {_counts('truth', 'score', 'threshold')} FROM (SELECT code, window_id, target_{h} AS truth, {_CHANCE(h)} AS score FROM early), g GROUP BY ALL),
  m_{h} AS (SELECT *, {_rates(rule.beta)} FROM c_{h}),
  v_{h} AS (SELECT *, precision >= greatest({rule.precision_floor}::DOUBLE, label_rate * 0.75) AND positive_rate <= greatest(label_rate * {rule.rate_multiplier}::DOUBLE, label_rate + 0.05) AS meets FROM m_{h}),
  t_{h} AS (SELECT code, window_id, '{h}' AS head, CASE WHEN label_rate <= 0 OR label_rate >= 1 THEN 0.5 ELSE threshold END AS threshold FROM v_{h}
    QUALIFY row_number() OVER (PARTITION BY code, window_id ORDER BY meets DESC, f_beta DESC, recall DESC, precision DESC, abs(positive_rate - label_rate), threshold DESC) = 1)""")
        names.append(f"SELECT * FROM t_{h}")
    return f"g AS (SELECT unnest([{grid}]) AS threshold), {', '.join(parts)}, th AS ({' UNION ALL '.join(names)})"


TRAINED = _SCORED + f""", sizes AS (SELECT code, count(*) AS n FROM scored GROUP BY code),
ids AS (SELECT code, n, unnest(generate_series(CAST(1 AS BIGINT), CAST(floor((n - {WF.train} - {WF.min_test}) / {WF.step}) AS BIGINT) + 1)) AS window_id FROM sizes WHERE n >= {WF.train + WF.min_test}),
windows AS (SELECT code, window_id, (window_id - 1) * {WF.step} AS a, least((window_id - 1) * {WF.step} + {WF.train + WF.test}, n) AS z FROM ids),
held AS (SELECT s.*, w.window_id, w.a, s.row_idx - w.a AS place FROM scored s JOIN windows w ON s.code = w.code AND s.row_idx >= w.a AND s.row_idx < w.z),
lines AS (SELECT code, window_id, {', '.join(_LINE(h, f'place < {_SPLIT}') for h in HEADS)} FROM held GROUP BY code, window_id),
early AS (SELECT held.*, lines.* EXCLUDE (code, window_id) FROM held JOIN lines USING (code, window_id) WHERE place >= {_SPLIT} AND place < {WF.train}),
full_ AS (SELECT code, window_id, {', '.join(_LINE(h, f'place < {WF.train}') for h in ALL)} FROM held GROUP BY code, window_id),
{_thresholds()},
tw AS (SELECT code, window_id, {', '.join(f"max(threshold) FILTER (head = '{h}') AS threshold_{h}" for h in HEADS)} FROM th GROUP BY code, window_id),
trained AS (SELECT held.code, held.date, held.window_id, held.grid_step_pct, {', '.join(f'held.target_{h}' for h in ALL)}, {', '.join(f'{_SCORE(h)} AS pred_{h}' for h in REGRESSION)}, {', '.join(f'{_CHANCE(h)} AS pred_{h}' for h in HEADS)},
  {', '.join(f'tw.threshold_{h}' for h in HEADS)} FROM held JOIN full_ USING (code, window_id) JOIN tw USING (code, window_id) WHERE place >= {WF.train})"""
_NUMBERS = [*(f"pred_{h}" for h in ALL), *(f"threshold_{h}" for h in HEADS)]
add("walk_forward_trained", lambda s, d: trained(s, d).select("code", "date", "window_id", *_NUMBERS), f"WITH {TRAINED} SELECT code, date, window_id, {', '.join(_NUMBERS)} FROM trained", " ".join(_NUMBERS))
_METRICS = "mae rmse spearman threshold precision recall f_beta average_precision"
add("walk_forward_head_metrics", lambda s, d: N.head_metrics(trained(s, d, FEATURES, N.Linear()), REGRESSION, HEADS, ("code",)).select("code", "window_id", "head", *_METRICS.split()))
add("walk_forward_mode_summary", lambda s, d: G.summary(C.controls(trained(s, d, FEATURES, N.Linear())), G.mode_segments(), "code", "window_id", full=False))


def _line_metrics() -> str:
    """Metrics of every head of every window, from TRAINED."""
    parts, none = [], "CAST(NULL AS DOUBLE)"
    for h in REGRESSION:
        rank = lambda c: f"rank() OVER (PARTITION BY code, window_id ORDER BY {c}) + (count(*) OVER (PARTITION BY code, window_id, {c}) - 1) / 2.0"
        y, p = f"target_{h}", f"pred_{h}"
        parts.append(f"""SELECT code, window_id, '{h}' AS head, avg(abs(p - y)) AS mae, sqrt(avg((p - y) ** 2)) AS rmse, corr(ry, rp) AS spearman, {', '.join(f'{none} AS {c}' for c in ('threshold', 'precision', 'recall', 'f_beta', 'average_precision'))}
          FROM (SELECT code, window_id, {y} AS y, {p} AS p, {rank(y)} AS ry, {rank(p)} AS rp FROM trained) GROUP BY ALL""")
    for h, rule in HEADS.items():
        counts = _counts(f"target_{h}", f"pred_{h}", f"threshold_{h}")
        parts.append(f"""SELECT c.code, c.window_id, '{h}' AS head, {none} AS mae, {none} AS rmse, {none} AS spearman, threshold, precision, recall, f_beta, coalesce(average_precision, 0) AS average_precision
          FROM (SELECT *, {_rates(rule.beta)} FROM (SELECT code, window_id, any_value(threshold_{h}) AS threshold, {counts} FROM trained GROUP BY code, window_id)) c
          JOIN ({AP.format(k='code, window_id', p=f'pred_{h}', y=f'target_{h}', t='trained')}) a ON a.code = c.code AND a.window_id = c.window_id""")
    return " UNION ALL ".join(parts)


def _line_modes() -> str:
    """Decisions of the trained rows, by window and segment."""
    decided = DECIDED[len(_SCORED):].replace("FROM scored)", "FROM trained)")
    names = ["pnl_mean", "pnl_p10", "pnl_worst", *_RATE_COLUMNS.split()]
    rows = " UNION ALL ".join(f"SELECT code, window_id, '{k}' AS segment, {_FULL} FROM decided WHERE {c} GROUP BY code, window_id" for k, c in _MODE_SQL.items())
    keys = f"SELECT code, window_id, count(*) AS total, unnest([{', '.join(repr(k) for k in _MODE_SQL)}]) AS segment FROM decided GROUP BY code, window_id"
    return f"WITH {TRAINED}{decided} SELECT k.code, k.window_id, k.segment, coalesce(r.n, 0) AS n, {', '.join(f'coalesce(r.{c}, 0) AS {c}' for c in names)}, coalesce(r.n, 0) / k.total AS share FROM ({keys}) k LEFT JOIN ({rows}) r USING (code, window_id, segment)"


add("walk_forward_line_metrics", lambda s, d: N.head_metrics(trained(s, d), REGRESSION, HEADS, ("code",)).select("code", "window_id", "head", *_METRICS.split()), f"WITH {TRAINED} {_line_metrics()}", _METRICS)
add("walk_forward_line_modes", lambda s, d: G.summary(C.controls(trained(s, d)), G.mode_segments(), "code", "window_id", full=False), _line_modes(), "pnl_mean pnl_p10 pnl_worst share " + _RATE_COLUMNS)


def latest_signal(s, d):
    """Each code's last row, scored by heads of all rows before it, decided and written as a record."""
    df = rows(s, d)
    n = Window.partitionBy("code")
    df = df.withColumn("_n", F.count("*").over(n))
    windows = df.groupBy("code").agg((F.max("row_idx")).alias("end"), F.lit(0).cast("long").alias("begin"))
    fitted = N.fit(df, windows, ("grid_step_pct",), tuple(f"target_{h}" for h in ALL), ("code",), "begin", "end", "w", 0.0)
    last = C.latest(df.select("code", "date", "grid_step_pct"), "code").join(fitted.select("code", "w"), "code")
    score = {f"pred_{h}": N.value(F.col("w")[k], ("grid_step_pct",)) for k, h in enumerate(ALL)}
    last = last.withColumns(score).drop("w").withColumns({f"threshold_{h}": F.lit(0.35) for h in HEADS})
    out = C.payload(C.controls(last))
    return out.select("code", "date", *(F.get_json_object("payload", f"$.{k}").alias(k) for k in ("version", "mode")), *(F.get_json_object("payload", f"$.scores.{h}").cast("double").alias(h) for h in ALL))


_ORDERED = "row_number() OVER (PARTITION BY code ORDER BY date DESC)"
add(
    "latest_signal",
    lambda s, d: latest_signal(s, d).drop("mode"),
    f"""WITH {_SCORED}, o AS (SELECT *, {_ORDERED} AS back FROM scored), l AS (SELECT code, {', '.join(_LINE(h, 'back > 1') for h in ALL)} FROM o GROUP BY code)
      SELECT code, date, 'signal_' || strftime(date, '%Y%m%d') AS version, {', '.join(f'round({_SCORE(h)}, 6) AS {h}' for h in ALL)} FROM o JOIN l USING (code) WHERE back = 1""",
    " ".join(ALL),
)


def trained_on_features(s, d):
    """The whole chain on the events: feature table and labels in one frame, audited; every head trained in each window; decisions of the test days."""
    from ..operators import heads as H
    from ..operators import labels as L
    from ..operators.daily import days
    from ..operators.walkforward import WalkForward
    from .intraday import event_features
    from .labels import table

    chosen = ("open4_return", "intraday_range", "close_vwap_gap", "realized_volatility", "hostile_soft_score", "daily_return", "stk_idx_return_spread", "overnight_mean_return", "grid_step_pct")
    df = H.training_frame(event_features(s, d).select("code", "date", *chosen), L.targets(table(s, d)), "code", "date")
    df = K.stored(df.withColumn("row_idx", (F.row_number().over(days()) - 1).cast("long")), "training")
    H.leakage_audit(df, list(chosen))
    heads = E.heads_of(df)
    numeric = tuple(h for h, (kind, _) in heads.items() if kind == "regression")
    out = N.walk_forward(df, chosen, numeric, HEADS, WalkForward(15, 5, 5, 2), ("code",))
    return C.controls(out).select("code", "date", "window_id", *(f"pred_{h}" for h in heads), "mode", "position_scale")


add("trained_on_features", trained_on_features)
