"""Walk-forward windows over ordered rows, and the comparison of windows.

Train statistics come from running sums at a window's two ends: rows are never copied into
every window that they train.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stored
from . import sketches as Q

from .segments import MODES


@dataclass(frozen=True)
class WalkForward:
    """Rows of a train and a test window, between the starts of two windows, and of the least last test window (fixed values of M12)."""

    train: int = 756
    test: int = 63
    step: int = 63
    min_test: int = 21

    def __post_init__(self):
        if min(self.train, self.test, self.step, self.min_test) <= 0 or self.step < self.test:
            raise ValueError("windows must be positive, and a step at least a test window")


def windows(counts: DataFrame, c: WalkForward, *key: str) -> DataFrame:
    """counts: key columns and n. Half-open row ranges; the last test range may be short, but not below the least."""
    last = F.floor((F.col("n") - c.train - c.min_test) / c.step)
    ids = counts.filter(F.col("n") >= c.train + c.min_test).withColumn("window_id", F.explode(F.sequence(F.lit(1).cast("long"), last + 1)))
    start = (F.col("window_id") - 1) * c.step
    return ids.select(*key, "window_id", start.alias("train_start"), (start + c.train).alias("train_end"), (start + c.train).alias("test_start"), F.least(start + c.train + c.test, F.col("n")).alias("test_end"))


def test_rows(rows: DataFrame, w: DataFrame, c: WalkForward, *key: str) -> DataFrame:
    """Rows with the window that tests them: arithmetic on the row index, then an equi-join."""
    at = F.col("row_idx") - c.train
    rows = rows.filter(at >= 0).withColumn("window_id", (F.floor(at / c.step) + 1).cast("long"))
    return rows.join(w, [*key, "window_id"]).filter("row_idx >= test_start AND row_idx < test_end")


def tested(rows: DataFrame, c: WalkForward, *key: str) -> DataFrame:
    """Rows with the id of the window that tests them, from row_idx and the key's row count alone: no join."""
    n = F.count("*").over(Window.partitionBy(*key))
    at = F.col("row_idx") - c.train
    rows = rows.withColumn("_n", n).filter((at >= 0) & (F.col("_n") >= c.train + c.min_test)).withColumn("window_id", (F.floor(at / c.step) + 1).cast("long"))
    start = (F.col("window_id") - 1) * c.step + c.train
    return rows.filter((F.col("row_idx") < start + c.test) & (F.col("_n") - start >= c.min_test)).drop("_n")


def judged(rows: DataFrame, *key: str) -> DataFrame:
    """Tested rows with their window's verdict (normal_minus_safe, normal_beats_safe, severity): windows over the rows, no join.

    As failure_windows gives them; severity is dense, so a window's rows share theirs.
    """
    w = Window.partitionBy(*key, "window_id")
    mean = lambda m: F.coalesce(F.avg(F.when(F.col("mode") == m, F.col("target_grid_pnl"))).over(w), F.lit(0.0))
    rows = rows.withColumn("normal_minus_safe", mean("NORMAL") - mean("SAFE"))
    rank = F.dense_rank().over(Window.partitionBy(*key).orderBy("normal_minus_safe"))
    return rows.withColumns({"normal_beats_safe": F.col("normal_minus_safe") > 0, "severity": rank})


def train_means(rows: DataFrame, w: DataFrame, columns: tuple[str, ...], *key: str) -> DataFrame:
    """Means over each window's train rows, as train_<column>."""
    upto = Window.partitionBy(*key).orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.select(*key, "row_idx", *(F.sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).over(upto).alias(f"s_{c}") for c in columns), *(F.count(c).over(upto).alias(f"n_{c}") for c in columns))
    end = sums.select(*key, (F.col("row_idx") + 1).alias("train_end"), *(F.col(f"{p}_{c}").alias(f"e{p}_{c}") for p in "sn" for c in columns))
    begin = sums.select(*key, (F.col("row_idx") + 1).alias("train_start"), *(F.col(f"{p}_{c}").alias(f"b{p}_{c}") for p in "sn" for c in columns))
    both = w.join(end, [*key, "train_end"]).join(begin, [*key, "train_start"], "left")
    mean = lambda c: F.try_divide(F.col(f"es_{c}") - F.coalesce(f"bs_{c}", F.lit(0.0)), F.col(f"en_{c}") - F.coalesce(f"bn_{c}", F.lit(0)))
    return both.select(*w.columns, *(mean(c).alias(f"train_{c}") for c in columns))


def failure_windows(summary: DataFrame, *key: str) -> DataFrame:
    """By window, NORMAL against SAFE: deltas, share, verdict, severity. summary: key, window_id, segment, n, pnl_mean, pnl_p10, pnl_worst."""
    one = lambda c: F.coalesce(F.first(c, ignorenulls=True), F.lit(0)).alias(c)
    wide = summary.filter(F.col("segment").isin(*MODES)).groupBy(*key, "window_id").pivot("segment", list(MODES)).agg(*(one(c) for c in ("n", "pnl_mean", "pnl_p10", "pnl_worst")))
    delta = lambda c: F.col(f"NORMAL_{c}") - F.col(f"SAFE_{c}")
    wide = wide.na.fill(0)
    wide = wide.withColumns({
        "normal_minus_safe": delta("pnl_mean"), "p10_minus_safe": delta("pnl_p10"), "worst_minus_safe": delta("pnl_worst"),
        "normal_share": F.coalesce(F.try_divide(F.col("NORMAL_n"), F.col("NORMAL_n") + F.col("SAFE_n")), F.lit(0.0)),
    })
    rank = F.dense_rank().over(Window.partitionBy(*key).orderBy("normal_minus_safe"))
    return wide.withColumn("normal_beats_safe", F.col("normal_minus_safe") > 0).withColumn("severity", rank)


def with_verdicts(rows: DataFrame, verdicts: DataFrame, *key: str) -> DataFrame:
    return rows.join(verdicts.select(*key, "window_id", "normal_beats_safe", "normal_minus_safe", "severity"), [*key, "window_id"], "left")


def cohorts(rows: DataFrame, size: int = Q.SIZE) -> DataFrame:
    """NORMAL and SAFE rows by verdict; a missing verdict counts as good. The percentile is exact: sketches of the windows are
    merged into brackets (size: of a sketch), so that no group's values are held."""
    cohort = F.when(F.coalesce("normal_beats_safe", F.lit(True)), "good_windows").otherwise("failure_windows")
    means = {"positive_grid_day_rate": "target_positive_grid_day", "tradable_rate": "target_tradable", "hostile_rate": "target_hostile_selloff_risk", "reversion_rate": "target_vwap_reversion", "pred_grid_mean": "pred_positive_grid_day", "pred_tradable_mean": "pred_tradable", "pred_hostile_mean": "pred_hostile_selloff_risk", "pred_reversion_mean": "pred_vwap_reversion", "scale_mean": "position_scale", "width_scale_mean": "grid_width_scale"}
    pnl = F.col("target_grid_pnl")
    rows = rows.filter(F.col("mode").isin("NORMAL", "SAFE")).select("mode", cohort.alias("cohort"), "code", "window_id", pnl.alias("pnl"), *dict.fromkeys(means.values()))
    rows = stored(rows, "cohort_rows")
    # a row for each window, whose sums and sketches any cohort of windows is made of
    parts = rows.groupBy("mode", "cohort", "code", "window_id").agg(F.count("*").alias("n"), F.min("pnl").alias("worst"), Q.sketch("pnl", size).alias("sketch"), *(f(c).alias(f"{k}_{c}") for c in ("pnl", *dict.fromkeys(means.values())) for k, f in (("s", F.sum), ("n", F.count))))
    mean = lambda c: F.try_divide(F.sum(f"s_{c}"), F.sum(f"n_{c}"))
    whole = stored(parts.groupBy("mode", "cohort").agg(
        F.sum("n").alias("n"), F.count("*").alias("n_windows"), mean("pnl").alias("pnl_mean"), F.min("worst").alias("pnl_worst"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"),
        *(mean(c).alias(k) for k, c in means.items()),
    ), "cohorts")
    low = Q.exact_quantiles(rows, "pnl", {"pnl_p10": 0.1}, ("mode", "cohort"), whole.select("mode", "cohort", "sketch"), size=size)
    return whole.drop("sketch").join(low, ["mode", "cohort"], "left").select("mode", "cohort", "n", "n_windows", "pnl_mean", "pnl_p10", "pnl_worst", *means)


def feature_deltas(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Means of columns on NORMAL rows of failing against good windows."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns)))
    long = rows.filter(F.col("mode") == "NORMAL").select("normal_beats_safe", pairs.alias("p")).select("normal_beats_safe", "p.*")
    mean = lambda cond: F.coalesce(F.avg(F.when(cond, F.col("x"))), F.lit(0.0))
    out = long.groupBy("feature").agg(mean(~F.col("normal_beats_safe")).alias("bad_mean"), mean(F.col("normal_beats_safe")).alias("good_mean"))
    return out.withColumn("bad_minus_good", F.col("bad_mean") - F.col("good_mean")).withColumn("bad_abs_mean", F.abs("bad_mean"))


def threshold_drift(metrics: DataFrame) -> DataFrame:
    """By head, means of its windows' metrics under bad and good verdicts. metrics: head, threshold, recall, precision, average_precision, verdict."""
    bad, good = ~F.col("normal_beats_safe"), F.col("normal_beats_safe")
    out = [F.countDistinct(F.when(bad, F.struct("code", "window_id"))).alias("bad_windows"), F.countDistinct(F.when(good, F.struct("code", "window_id"))).alias("good_windows")]
    for c in ("threshold", "recall", "precision", "average_precision"):
        out += [F.avg(F.when(bad, F.col(c))).alias(f"bad_{c}"), F.avg(F.when(good, F.col(c))).alias(f"good_{c}")]
    df = metrics.groupBy("head").agg(*out)
    return df.withColumns({f"{c}_delta": F.col(f"bad_{c}") - F.col(f"good_{c}") for c in ("threshold", "recall", "precision", "average_precision")})


def failure_cases(rows: DataFrame, top: int) -> DataFrame:
    """The worst NORMAL rows of failing windows."""
    if top <= 0:
        raise ValueError("top must be positive")
    bad = rows.filter((F.col("mode") == "NORMAL") & ~F.col("normal_beats_safe"))
    return bad.orderBy("target_grid_pnl", "window_id", F.col("pred_hostile_selloff_risk").desc(), "code", "date").limit(top)
