"""Summaries of decisions by segments that overlap: rows are exploded to the segments they are in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import quantile
from .decision import controls
from .evaluate import bucket_heads

MODES = ("OFF", "SAFE", "NORMAL", "AGGRESSIVE")
MODE_SEGMENTS = ("ALL", *MODES, "SAFE_OR_OFF", "NORMAL_OR_AGGRESSIVE")
OUTCOMES = ("positive_grid_day", "tradable", "trend_break_risk", "hostile_selloff_risk", "vwap_reversion")


def rates(prefix: str = "") -> list[Column]:
    return [F.avg(f"target_{c}").alias(f"{prefix}{c}_rate") for c in OUTCOMES]


def in_segments(df: DataFrame, segments: dict[str, Column]) -> DataFrame:
    """A row for each segment that a row is in. A condition that is missing does not hold."""
    names = F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in segments.items())))
    return df.withColumn("segment", F.explode(names))


def mode_segments() -> dict[str, Column]:
    m = F.col("mode")
    return {"ALL": F.lit(True), **{k: m == k for k in MODES}, "SAFE_OR_OFF": m.isin("SAFE", "OFF"), "NORMAL_OR_AGGRESSIVE": m.isin("NORMAL", "AGGRESSIVE")}


def interaction_segments() -> dict[str, Column]:
    """Combinations of the decision's states. core_edge, trend_high, hostile_high and vwap_on are never missing."""
    core, trend, hostile, vwap = (F.col(c) for c in ("core_edge", "trend_high", "hostile_high", "vwap_on"))
    return {
        "edge_on_hostile_on": core & hostile,
        "edge_on_hostile_off": core & ~hostile,
        "edge_off_hostile_on": ~core & hostile,
        "trend_high_hostile_high": trend & hostile,
        "trend_high_hostile_low": trend & ~hostile,
        "trend_low_hostile_high": ~trend & hostile,
        "vwap_on_hostile_on": vwap & hostile,
        "vwap_on_hostile_off": vwap & ~hostile,
    }


def summary(df: DataFrame, segments: dict[str, Column], *key: str, full: bool = True, accuracy: int | None = None) -> DataFrame:
    """One row for each key and segment, also for segments without rows, which get zeros. accuracy: see quantile; for segments of many rows."""
    pnl = F.col("target_grid_pnl")
    scaled = pnl * F.col("position_scale")
    metrics = [
        F.count("*").alias("n"),
        F.avg(pnl).alias("pnl_mean"),
        quantile(pnl, 0.1, accuracy).alias("pnl_p10"),
        F.min(pnl).alias("pnl_worst"),
        *rates(),
    ]
    if full:
        metrics += [
            F.sum(pnl).alias("pnl_total"),
            quantile(pnl, 0.5, accuracy).alias("pnl_median"),
            F.sum(scaled).alias("scaled_total"),
            F.avg(scaled).alias("scaled_mean"),
            F.avg("target_upside").alias("upside_mean"),
            F.avg("target_downside").alias("downside_mean"),
        ]
    got = in_segments(df, segments).groupBy(*key, "segment").agg(*metrics)
    keys = df.groupBy(*key).agg(F.count("*").alias("_all"))
    every = keys.withColumn("segment", F.explode(F.array(*(F.lit(s) for s in segments))))
    names = [c for c in got.columns if c not in (*key, "segment")]
    out = every.join(got, [*key, "segment"], "left").withColumns({c: F.coalesce(c, F.lit(0)) if c == "n" else F.coalesce(c, F.lit(0.0)) for c in names})
    return out.withColumn("share", F.coalesce(F.try_divide("n", "_all"), F.lit(0.0))).drop("_all")


def scored_table(df: DataFrame, heads: tuple[str, ...], order: tuple[str, ...], *key: str, buckets: int = 5) -> DataFrame:
    """A scored test set in full: which thresholds are met, the decision, a bucket for each head's score, errors of the downside.

    Needs pred_<head>, target_<head> and the classification heads' threshold_<head>.
    """
    df = df.withColumns({f"on_{h}": F.coalesce(F.col(f"pred_{h}") >= F.col(f"threshold_{h}"), F.lit(False)) for h in heads if f"threshold_{h}" in df.columns})
    df = controls(df)
    # one row for each head and row is ranked in one sort, and comes back as a column for each head
    keys = list(dict.fromkeys((*key, *order)))
    scores = {h: (f"pred_{h}", F.lit(None)) for h in heads}
    numbers = bucket_heads(df.select(*keys, *(f"pred_{h}" for h in heads)), scores, buckets, order, *key)
    numbers = numbers.groupBy(*keys).agg(*(F.max(F.when(F.col("head") == h, F.col("bucket"))).alias(f"bucket_{h}") for h in heads))
    df = df.join(numbers, keys)
    for h in ("downside", "downside_from_open"):
        if {f"pred_{h}", f"target_{h}"} <= set(df.columns):
            error = F.col(f"pred_{h}") - F.col(f"target_{h}")
            df = df.withColumns({f"{h}_error": error, f"{h}_abs_error": F.abs(error)})
    return df


def bucket_summary(df: DataFrame, heads: dict[str, tuple[str, str]], order: tuple[str, ...], *key: str, buckets: int = 5) -> DataFrame:
    """Heads are (score, outcome) columns; one row for each head and bucket of its scores."""
    columns = list(dict.fromkeys((*key, *order, *(s for s, _ in heads.values()), *(t for _, t in heads.values()), "target_grid_pnl", "target_upside", "target_downside", *(f"target_{c}" for c in OUTCOMES))))
    long = bucket_heads(df.select(*columns), {h: (s, F.col(t)) for h, (s, t) in heads.items()}, buckets, order, *key).filter("bucket IS NOT NULL")
    out = long.groupBy(*key, "head", "bucket").agg(
        F.count("*").alias("n"), F.avg("score").alias("score_mean"), F.min("score").alias("score_min"), F.max("score").alias("score_max"), F.avg("outcome").alias("outcome_mean"),
        F.avg("target_grid_pnl").alias("pnl_mean"), F.avg("target_upside").alias("upside_mean"), F.avg("target_downside").alias("downside_mean"), *rates(),
    )
    total = df.groupBy(*key).agg(F.count("*").alias("_all"))
    return (out.join(total, list(key)) if key else out.join(total)).withColumn("share", F.try_divide("n", "_all")).drop("_all")
