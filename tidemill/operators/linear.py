"""Linear heads of walk-forward windows: all keys, windows and heads at once.

What a least-squares fit needs of a window are sums of products, and those are differences of
running sums at the window's ends, exact ones: rows are never copied into the windows that train on them.
Each window's small system is solved where its row is.  Missing features count as 0.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import evaluate as E
from . import walkforward as W


#: Sums of products of scaled values, which a key's rows bound by their number, lose nothing to the order or number of terms.
EXACT = "decimal(28,18)"
#: A slope below this, in units of the spreads, is the rounding of one that is 0.
NOISE = 1e-12


@dataclass(frozen=True)
class Linear:
    """ridge: the penalty as a share of each feature's spread; validation: the last part of a train window, that calibrates thresholds (M10, M13)."""

    ridge: float = 1e-3
    validation: float = 0.15


def _inputs(columns: tuple[str, ...]) -> list[Column]:
    return [F.lit(1.0), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns)]


def _scales(rows: DataFrame, columns: tuple[str, ...], targets: tuple[str, ...], key: tuple[str, ...]) -> DataFrame:
    """By key, what is taken from features and targets before they are multiplied, and the powers of two that divide them.

    Features lose their mean, targets only one that is far from 0 by their spread: sums of classes stay counts.
    """
    values = [*_inputs(columns)[1:], *_targets(targets)]
    wide = rows.groupBy(*key).agg(F.array(*(F.avg(v) for v in values)).alias("_mean"), F.array(*(F.stddev_pop(v) for v in values)).alias("_spread"))
    near = lambda k: F.lit(False) if k < len(columns) else F.abs(F.col("_mean")[k]) <= F.col("_spread")[k] * 8
    shift = F.array(*(F.when(near(k), 0.0).otherwise(F.col("_mean")[k]) for k in range(len(values))))
    power = F.transform("_spread", lambda v: F.when(v > 0, F.pow(F.lit(2.0), F.ceil(F.log2(v)))).otherwise(1.0))
    return wide.select(*key, shift.alias("_shift"), power.alias("_scale"))


def _targets(targets: tuple[str, ...]) -> list[Column]:
    return [F.coalesce(F.col(t).cast("double"), F.lit(0.0)) for t in targets]


def fit(rows: DataFrame, windows: DataFrame, columns: tuple[str, ...], targets: tuple[str, ...], key: tuple[str, ...], start: str, end: str, name: str, ridge: float) -> DataFrame:
    """windows with name, an array of coefficients (the constant first) for each target. start, end: half-open row ranges; each range has rows.

    Running sums are decimals of shifted and scaled values, so what a window's two ends differ by has no error of the rows
    before it: a slope that is 0 comes out as 0, and its scores stay ties. A feature that does not vary in a window has slope 0.
    """
    n, heads = len(columns) + 1, len(targets)
    pairs = list(combinations_with_replacement(range(n), 2))
    scales = _scales(rows, columns, targets, key)
    even = lambda v, k: (v - F.col("_shift")[k]) / F.col("_scale")[k]
    x = [F.lit(1.0), *(even(v, k) for k, v in enumerate(_inputs(columns)[1:]))]
    y = [even(v, n - 1 + k) for k, v in enumerate(_targets(targets))]
    products = [x[i] * x[j] for i, j in pairs] + [x[i] * t for t in y for i in range(n)]
    upto = Window.partitionBy(*key).orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.join(scales, list(key)).select(*key, "row_idx", *(p.cast(EXACT).alias(f"q{k}") for k, p in enumerate(products)))
    sums = sums.select(*key, (F.col("row_idx") + 1).alias("_at"), F.array(*(F.sum(f"q{k}").over(upto) for k in range(len(products)))).alias("_s"))
    at = lambda edge, as_: sums.select(*key, F.col("_at").alias(edge), F.col("_s").alias(as_))
    both = windows.join(at(end, "_e"), [*key, end]).join(at(start, "_b"), [*key, start], "left").join(scales, list(key))
    zero = F.array_repeat(F.lit(0).cast("decimal(38,18)"), len(products))
    within = F.zip_with("_e", F.coalesce("_b", zero), lambda e, b: (e - b).cast("double"))

    @pandas_udf("array<array<double>>")
    def solve(s: pd.Series, shift: pd.Series, scale: pd.Series) -> pd.Series:
        out = []
        for v, m, d in zip(s, shift, scale):
            gram = np.zeros((n, n))
            for (i, j), q in zip(pairs, v):
                gram[i, j] = gram[j, i] = q
            right = np.array(v[len(pairs) :]).reshape(heads, n)
            mean_x, mean_y = gram[0, 1:] / gram[0, 0], right[:, 0] / gram[0, 0]
            own, cross = gram[1:, 1:] - np.outer(mean_x, gram[0, 1:]), right[:, 1:] - np.outer(mean_y, gram[0, 1:])
            varies = np.diag(own) > NOISE * np.diag(gram)[1:]
            own, cross = np.where(np.outer(varies, varies), own, 0.0), np.where(varies, cross, 0.0)
            own[np.diag_indices(n - 1)] *= 1 + ridge
            slopes = np.linalg.lstsq(own, cross.T, rcond=None)[0].T
            slopes = np.where(np.abs(slopes) > NOISE, slopes, 0.0) * d[n - 1 :, None] / d[: n - 1]
            constant = m[n - 1 :] + d[n - 1 :] * mean_y - slopes @ (m[: n - 1] + d[: n - 1] * mean_x)
            out.append(np.c_[constant, slopes].tolist())
        return pd.Series(out)

    return both.select(*windows.columns, solve(within, "_shift", "_scale").alias(name))


def value(coefficients: Column, columns: tuple[str, ...]) -> Column:
    return F.aggregate(F.zip_with(coefficients, F.array(*_inputs(columns)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def _chance(score: Column) -> Column:
    """Rounded to twelve places, so that a score that equals a threshold reaches it, whatever the last bits are."""
    return F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 12)


def walk_forward(rows: DataFrame, columns: tuple[str, ...], regression: tuple[str, ...], rules: dict[str, E.HeadRule], c: W.WalkForward, key: tuple[str, ...], settings: Linear = Linear()) -> DataFrame:
    """The test rows of every window, scored by heads that were fitted on its train rows, with thresholds that its last train rows calibrated.

    rows: key, row_idx, columns and target_<head>.  Regression heads fit on the whole train window.  A classification head
    fits without the validation rows, takes its threshold on them, and fits again on all.  Adds window_id, pred_<head> and
    threshold_<head>.
    """
    heads = (*regression, *rules)
    windows = W.windows(rows.groupBy(*key).agg(F.count("*").alias("n")), c, *key)
    split = int(c.train * (1 - settings.validation))
    windows = windows.withColumn("split", F.col("train_start") + split)
    targets = tuple(f"target_{h}" for h in heads)
    windows = fit(rows, windows, columns, targets, key, "train_start", "split", "early", settings.ridge)
    windows = fit(rows, windows, columns, targets, key, "train_start", "train_end", "full", settings.ridge)

    # a row calibrates in the windows whose last train rows it is among: some neighbouring ids
    last = F.floor((F.col("row_idx") - split) / c.step) + 1
    first = F.greatest(F.floor((F.col("row_idx") - c.train) / c.step) + 2, F.lit(1))
    near = rows.filter(last >= first).withColumn("window_id", F.explode(F.sequence(first, last)))
    near = near.join(windows.select(*key, "window_id", "early"), [*key, "window_id"])
    each = F.explode(F.array(*(F.struct(F.lit(h).alias("head"), F.col(f"target_{h}").alias("truth"), _chance(value(F.col("early")[k], columns)).alias("score")) for k, h in enumerate(heads) if h in rules)))
    calibrated = E.choose_thresholds(near.select(*key, "window_id", each.alias("h")).select(*key, "window_id", "h.*"), "truth", "score", rules, "head", *key, "window_id")
    wide = calibrated.groupBy(*key, "window_id").agg(*(F.max(F.when(F.col("head") == h, F.col("threshold"))).alias(f"threshold_{h}") for h in rules))

    scored = W.tested(rows, c, *key).join(windows.select(*key, "window_id", "full"), [*key, "window_id"]).join(wide, [*key, "window_id"])
    score = {f"pred_{h}": value(F.col("full")[k], columns) for k, h in enumerate(heads)}
    return scored.withColumns({p: _chance(v) if p.removeprefix("pred_") in rules else v for p, v in score.items()}).drop("full")


def head_metrics(scored: DataFrame, regression: tuple[str, ...], rules: dict[str, E.HeadRule], key: tuple[str, ...]) -> DataFrame:
    """Rows (key, window_id, head, ...): errors of regression heads; precision, recall and average precision of the others at their thresholds."""
    by = (*key, "window_id", "head")
    values = lambda names, extra: F.explode(F.array(*(F.struct(F.lit(h).alias("head"), F.col(f"target_{h}").cast("double").alias("truth"), F.col(f"pred_{h}").alias("score"), *extra(h)) for h in names)))
    long = lambda names, extra: scored.select(*key, "window_id", values(names, extra).alias("h")).select(*key, "window_id", "h.*")
    numeric = E.regression_metrics(long(regression, lambda h: ()), "truth", "score", *by).select(*by, "mae", "rmse", "spearman")
    calls = long(rules, lambda h: (F.col(f"threshold_{h}").alias("threshold"),))
    counts = calls.groupBy(*by).agg(F.first("threshold").alias("threshold"), *(v.alias(k) for k, v in E.confusion("truth", F.col("score") >= F.col("threshold")).items()))
    beta = F.create_map(*(F.lit(x) for h, r in rules.items() for x in (h, float(r.beta))))[F.col("head")]
    called = E.with_rates(counts, beta).select(*by, "threshold", "precision", "recall", "f_beta").join(E.average_precision(calls, "truth", "score", *by), list(by))
    return numeric.unionByName(called, allowMissingColumns=True)
