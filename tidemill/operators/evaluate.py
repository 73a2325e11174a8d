"""Scores against outcomes: metrics, ranks, buckets, thresholds. Keys group everything; no driver loop over rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stored
from . import ranks as R


@dataclass(frozen=True)
class HeadRule:
    """How a head's threshold is chosen: recall's weight, the least precision, the most positives as a multiple of the labels' rate."""

    beta: float
    precision_floor: float
    rate_multiplier: float


#: Fixed values (M10): the classification heads' rules, and the thresholds that are tried.
HEADS = {
    "positive_grid_day": HeadRule(1.5, 0.25, 1.75),
    "tradable": HeadRule(1.5, 0.25, 1.75),
    "trend_break_risk": HeadRule(3.0, 0.10, 3.00),
    "hostile_selloff_risk": HeadRule(2.5, 0.15, 2.50),
    "vwap_reversion": HeadRule(1.5, 0.20, 1.80),
}
#: Fixed list (M11): regression heads; a frame without a head's target has not that head.
REGRESSION_HEADS = ("upside", "downside", "downside_from_open", "grid_pnl")
THRESHOLDS = tuple(k / 100 for k in range(10, 65, 5))


def heads_of(df: DataFrame) -> dict[str, tuple[str, str]]:
    """The heads that a frame has targets for: by name, their kind and their target's column. The downside from the open is optional, others are not."""
    out = {h: ("regression", f"target_{h}") for h in REGRESSION_HEADS} | {h: ("classification", f"target_{h}") for h in HEADS}
    missing = [h for h, (_, t) in out.items() if t not in df.columns]
    if set(missing) - {"downside_from_open"}:
        raise ValueError(f"no target for {', '.join(missing)}")
    return {h: v for h, v in out.items() if h not in missing}


def average_rank(x: str, *key: str) -> Column:
    """Ranks from 1, ties at their mean."""
    w = Window.partitionBy(*key)
    return F.rank().over(w.orderBy(x)) + (F.count("*").over(Window.partitionBy(*key, x)) - 1) / 2


def regression_metrics(df: DataFrame, target: str, prediction: str, *key: str) -> DataFrame:
    """mae, rmse, r2, Spearman's correlation, mean outcomes of the predictions' top and bottom fifths."""
    w = Window.partitionBy(*key)
    df = df.select(*key, F.col(target).alias("y"), F.col(prediction).alias("p")).filter("y IS NOT NULL AND p IS NOT NULL")
    df = df.withColumns({"ry": average_rank("y", *key), "rp": average_rank("p", *key), "mean": F.avg("y").over(w), "hi": F.percentile("p", F.lit(0.8)).over(w), "lo": F.percentile("p", F.lit(0.2)).over(w)})
    return _regression(df, *key)


def _regression(df: DataFrame, *key: str) -> DataFrame:
    error, spread = F.col("p") - F.col("y"), F.col("y") - F.col("mean")
    return df.groupBy(*key).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.sum(error * error), F.sum(spread * spread))).alias("r2"),
        F.corr("ry", "rp").alias("spearman"),
        F.avg(F.when(F.col("p") >= F.col("hi"), F.col("y"))).alias("top_fifth_mean"),
        F.avg(F.when(F.col("p") <= F.col("lo"), F.col("y"))).alias("bottom_fifth_mean"),
    )


def regression_metrics_ranged(df: DataFrame, target: str, prediction: str, *key: str) -> DataFrame:
    """regression_metrics for keys that may hold all rows: ranks and quantiles come from ranges of values, and no window holds a key."""
    rows = stored(df.select(*key, F.col(target).alias("y"), F.col(prediction).alias("p")).filter("y IS NOT NULL AND p IS NOT NULL"), "pairs")
    of_p = stored(R.value_ranks(rows, "p", *key), "ranks")
    of_y = R.value_ranks(rows, "y", *key)
    whole = rows.groupBy(*key).agg(F.avg("y").alias("mean")).join(R.quantile_of_ranks(of_p, "p", {"hi": 0.8, "lo": 0.2}, *key), list(key))  # a row a key
    rows = rows.join(of_p.select(*key, "p", F.col("average_rank").alias("rp")), [*key, "p"]).join(of_y.select(*key, "y", F.col("average_rank").alias("ry")), [*key, "y"])
    return _regression(rows.join(whole, list(key)), *key)


def f_beta(precision: Column, recall: Column, beta) -> Column:
    """In the SQL's order of factors: thresholds of equal f_beta are ordered by recall, unless a last bit tells them apart."""
    b = beta * beta
    return F.coalesce(F.try_divide((1 + b) * precision * recall, b * precision + recall), F.lit(0.0))


def confusion(truth: str, called: Column) -> dict[str, Column]:
    y = F.col(truth) == 1
    return {"tp": F.count_if(y & called), "fp": F.count_if(~y & called), "fn": F.count_if(y & ~called), "tn": F.count_if(~y & ~called)}


def with_rates(df: DataFrame, beta) -> DataFrame:
    """accuracy, precision, recall, f1, f_beta, rates from counts; 0 where a denominator is."""
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    df = df.withColumn("precision", z(tp, tp + fp)).withColumn("recall", z(tp, tp + fn))
    return df.withColumns({
        "accuracy": z(tp + tn, n), "f1": z(2 * tp, 2 * tp + fp + fn), "f_beta": f_beta(F.col("precision"), F.col("recall"), beta),
        "positive_rate": z(tp + fp, n), "label_rate": z(tp + fn, n),
    })


def classification_metrics(df: DataFrame, truth: str, score: str, threshold: float, beta: float, *key: str) -> DataFrame:
    counts = df.groupBy(*key).agg(*(v.alias(k) for k, v in confusion(truth, F.col(score) >= threshold).items()))
    return with_rates(counts, F.lit(beta)).withColumn("threshold", F.lit(threshold))


def average_precision(df: DataFrame, truth: str, score: str, *key: str) -> DataFrame:
    """Step-wise: the sum over distinct scores, from high to low, of recall gained times precision; 1 or 0 with one class."""
    each = df.groupBy(*key, score).agg(F.sum(truth).alias("tp"), F.count("*").alias("n"))
    down = Window.partitionBy(*key).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*key)
    each = each.withColumn("p", F.sum("tp").over(down) / F.sum("n").over(down)).withColumn("all", F.sum("tp").over(whole))
    return each.groupBy(*key).agg(F.coalesce(F.sum(F.try_divide(F.col("tp"), F.col("all")) * F.col("p")), F.lit(0.0)).alias("average_precision"))


def roc_auc(df: DataFrame, truth: str, score: str, *key: str) -> DataFrame:
    """Mann-Whitney with ties at half; missing with one class."""
    ranked = df.withColumn("_r", average_rank(score, *key))
    pos, n = F.sum(truth), F.count("*")
    return ranked.groupBy(*key).agg(F.try_divide(F.sum(F.when(F.col(truth) == 1, F.col("_r"))) - pos * (pos + 1) / 2, pos * (n - pos)).alias("roc_auc"))


def ranking_metrics_ranged(df: DataFrame, truth: str, score: str, *key: str) -> DataFrame:
    """roc_auc and average_precision in one pass over ranges of scores, for keys that may hold all rows."""
    ranks = stored(R.value_ranks(df, score, *key, sums={"pos": F.col(truth)}), "ranks")
    all_ = ranks.groupBy(*key).agg(F.sum("n").alias("_n"), F.sum("pos").alias("_pos"))
    each = ranks.join(all_, list(key))
    # from high to low: what is not below a score is called
    called, hits = F.col("_n") - F.col("below"), F.col("_pos") - F.col("below_pos")
    pos, n = F.first("_pos"), F.first("_n")
    return each.groupBy(*key).agg(
        F.try_divide(F.sum(F.col("pos") * F.col("average_rank")) - pos * (pos + 1) / 2, pos * (n - pos)).alias("roc_auc"),
        F.coalesce(F.sum(F.try_divide(F.col("pos"), F.col("_pos")) * hits / called), F.lit(0.0)).alias("average_precision"),
    )


def class_weight(df: DataFrame, truth: str, *key: str) -> DataFrame:
    pos, neg = F.count_if(F.col(truth) == 1), F.count_if(F.col(truth) == 0)
    return df.groupBy(*key).agg(F.when(pos == 0, 1.0).otherwise(F.greatest(F.lit(1.0), F.try_divide(neg, pos))).alias("weight"))


def choose_threshold(df: DataFrame, truth: str, score: str, rule: HeadRule, *key: str, grid: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """The threshold of the grid that is best by (constraints met, f_beta, recall, precision, nearness of rates, threshold).

    With one class only: 0.5, constraints not met.
    """
    return _chosen(df, truth, score, {k: F.lit(getattr(rule, k)) for k in ("beta", "precision_floor", "rate_multiplier")}, key, grid)


def _chosen(df: DataFrame, truth: str, score: str, rule: dict[str, Column], key: tuple[str, ...], grid: tuple[float, ...]) -> DataFrame:
    at = df.withColumn("threshold", F.explode(F.array(*(F.lit(t) for t in grid))))
    counts = at.groupBy(*key, "threshold").agg(*(v.alias(k) for k, v in confusion(truth, F.col(score) >= F.col("threshold")).items()))
    rates = with_rates(counts, rule["beta"])
    least = F.greatest(rule["precision_floor"], F.col("label_rate") * 0.75)
    most = F.greatest(F.col("label_rate") * rule["rate_multiplier"], F.col("label_rate") + 0.05)
    rates = rates.withColumn("meets", (F.col("precision") >= least) & (F.col("positive_rate") <= most))
    order = F.struct("meets", "f_beta", "recall", "precision", (-F.abs(F.col("positive_rate") - F.col("label_rate"))).alias("near"), "threshold")
    best = rates.groupBy(*key).agg(F.max_by(F.struct("threshold", "precision", "recall", "f_beta", "meets"), order).alias("b"), F.first("label_rate").alias("label_rate"))
    single = (F.col("label_rate") <= 0) | (F.col("label_rate") >= 1)
    return best.select(*key, "label_rate", F.when(single, 0.5).otherwise(F.col("b.threshold")).alias("threshold"), "b.precision", "b.recall", "b.f_beta", (F.col("b.meets") & ~single).alias("meets"))


def choose_thresholds(df: DataFrame, truth: str, score: str, rules: dict[str, HeadRule], head: str, *key: str) -> DataFrame:
    """choose_threshold for rows of several heads, each by its own rule, in one pass over the rows."""
    rule = {k: F.create_map(*(F.lit(x) for h, r in rules.items() for x in (h, float(getattr(r, k)))))[F.col(head)] for k in ("beta", "precision_floor", "rate_multiplier")}
    return _chosen(df, truth, score, rule, (head, *key), THRESHOLDS)


def score_bucket(x: str, buckets: int, order: tuple[str, ...], *key: str) -> Column:
    """Equal-count buckets of ranks (ties by order): as quantiles of 1..n cut them, which is not ntile. Missing stays missing."""
    here = F.col(x).isNotNull()
    w = Window.partitionBy(*key, here)
    n = F.count("*").over(w)
    q = F.least(F.lit(buckets), n)
    r = F.row_number().over(w.orderBy(x, *order))
    return F.when(here, F.when(q <= 1, 1).otherwise(F.greatest(F.lit(1), F.ceil((r - 1) * q / (n - 1))))).cast("int")


def bucket_heads(df: DataFrame, heads: dict[str, tuple[str, Column]], buckets: int, order: tuple[str, ...], *key: str) -> DataFrame:
    """Rows of df for each head of (score column, outcome), with head, score, outcome and bucket: heads share one sort by (key, head)."""
    rows = F.explode(F.array(*(F.struct(F.lit(h).alias("head"), F.col(s).cast("double").alias("score"), y.cast("double").alias("outcome")) for h, (s, y) in heads.items())))
    long = df.select("*", rows.alias("_h")).select(*df.columns, "_h.*")
    return long.withColumn("bucket", score_bucket("score", buckets, order, *key, "head"))


def first_rank(x: str, order: tuple[str, ...], *key: str, descending: bool = False) -> Column:
    """1 to n by value; ties by order."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(F.col(x).desc() if descending else F.col(x), *order))


def top_shares(df: DataFrame, value: str, limit: int, order: tuple[str, ...], *key: str) -> DataFrame:
    """The limit largest values of each key, with their shares of what is kept."""
    kept = df.withColumn("rank", first_rank(value, order, *key, descending=True)).filter(F.col("rank") <= limit)
    return kept.withColumn("share", F.coalesce(F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*key))), F.lit(0.0)))


def error_cases(df: DataFrame, top: int, order: tuple[str, ...], *key: str) -> DataFrame:
    """Rows among the top lowest predictions, lowest outcomes or largest errors, with ranks and flags."""
    if top <= 0:
        raise ValueError("top must be positive")
    df = df.withColumn("abs_error", F.abs(F.col("pred_downside") - F.col("target_downside"))).withColumns({
        "predicted_rank": first_rank("pred_downside", order, *key),
        "actual_rank": first_rank("target_downside", order, *key),
    }).withColumn("error_rank", first_rank("abs_error", order, *key, descending=True))
    flags = {"in_predicted_worst": "predicted_rank", "in_actual_worst": "actual_rank", "in_largest_error": "error_rank"}
    df = df.withColumns({k: F.col(v) <= top for k, v in flags.items()}).withColumn("rank_gap", F.col("predicted_rank") - F.col("actual_rank"))
    return df.filter(" OR ".join(flags))
