"""The daily mode decision: an ordered rule table over scores, its downgrade, freshness of sources, the payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values (C1, C4), here and in the rules below: the rules' order, scales, widths and reasons are a contract with their readers.
LEAST_WIDTH = 0.005


def states(df: DataFrame) -> DataFrame:
    """Scores against their thresholds, and what follows from them."""
    on = lambda c: F.coalesce(F.col(f"pred_{c}") >= F.col(f"threshold_{c}"), F.lit(False))
    df = df.withColumns({"grid_on": on("positive_grid_day"), "tradable_on": on("tradable"), "trend_high": on("trend_break_risk"), "hostile_high": on("hostile_selloff_risk"), "vwap_on": on("vwap_reversion")})
    width = F.coalesce(F.col("grid_step_pct"), F.lit(0.01))
    total = F.greatest(F.col("pred_upside"), F.lit(0.0)) + F.abs(F.least(F.col("pred_downside"), F.lit(0.0)))
    return df.withColumns({
        "core_edge": F.col("grid_on") & F.col("tradable_on"),
        "clean_edge": F.col("grid_on") & F.col("tradable_on") & ~F.col("hostile_high"),
        "strong_range": (F.col("pred_upside") >= 0.03) & (F.col("pred_grid_pnl") > 0) & (total >= F.greatest(F.lit(0.03), width * 2)),
        "negative_stack": F.col("hostile_high") & ~F.col("grid_on") & ~F.col("tradable_on") & ~F.col("vwap_on") & (F.col("pred_upside") <= 0.012) & (F.col("pred_grid_pnl") <= 0),
        "base_width": width,
    })


def controls(df: DataFrame) -> DataFrame:
    """The mode and its parameters, by the first rule that holds."""
    df = states(df)
    trend, hostile = F.col("trend_high"), F.col("hostile_high")
    pick = lambda cond, a, b: F.when(cond, F.lit(a)).otherwise(F.lit(b))

    def row(mode, weak, scale, width, dip, sell, why) -> Column:
        lit = lambda x, t: (x if isinstance(x, Column) else F.lit(x)).cast(t)
        return F.struct(lit(mode, "string").alias("mode"), lit(weak, "boolean").alias("trend_weak"), lit(scale, "double").alias("position_scale"), lit(width, "double").alias("grid_width_scale"), lit(dip, "boolean").alias("dip_buy"), lit(sell, "boolean").alias("high_sell"), lit(why, "string").alias("rationale"))

    weak = trend | hostile
    rules = [
        (F.col("negative_stack"), row("OFF", True, 0.20, 1.35, False, False, "negative_stack_with_hostile_selloff")),
        (F.col("clean_edge") & F.col("vwap_on") & F.col("strong_range") & ~trend, row("AGGRESSIVE", False, 1.0, 0.92, True, True, "clean_reversion_and_strong_range")),
        (F.col("clean_edge"), row("NORMAL", trend, pick(trend, 0.70, 0.85), pick(trend, 1.08, 1.00), F.col("vwap_on") & (F.col("pred_downside") > -0.03), True, pick(trend, "clean_edge_with_trend_damper", "clean_edge_without_hostile_selloff"))),
        (F.col("core_edge") & hostile, row("SAFE", True, 0.45, 1.20, False, True, "hostile_selloff_blocks_execution")),
        (F.col("grid_on"), row("SAFE", weak, pick(hostile, 0.45, 0.60), pick(hostile, 1.22, 1.15), False, True, "positive_grid_without_tradable_confirmation")),
        (F.col("tradable_on"), row("SAFE", weak, pick(hostile, 0.40, 0.50), pick(hostile, 1.20, 1.12), False, True, "tradable_without_grid_confirmation")),
    ]
    chosen = F.when(*rules[0])
    for cond, value in rules[1:]:
        chosen = chosen.when(cond, value)
    chosen = chosen.otherwise(row("SAFE", weak, pick(hostile, 0.35, 0.45), pick(hostile, 1.22, 1.12), False, True, "insufficient_edge"))
    df = df.withColumn("_c", chosen).select("*", "_c.*").drop("_c")
    return df.withColumn("grid_width", F.greatest(F.col("base_width") * F.col("grid_width_scale"), F.lit(LEAST_WIDTH)))


def soft_downgrade(df: DataFrame, stale: Column) -> DataFrame:
    """Where a soft source is stale: SAFE unless OFF, smaller and wider, no dip buying. The width itself keeps its value."""
    keep = lambda c, x: F.when(stale, x).otherwise(F.col(c))
    return df.withColumns({
        "mode": keep("mode", F.when(F.col("mode") == "OFF", "OFF").otherwise("SAFE")),
        "position_scale": keep("position_scale", F.least(F.col("position_scale"), F.lit(0.55))),
        "grid_width_scale": keep("grid_width_scale", F.greatest(F.col("grid_width_scale"), F.lit(1.10))),
        "dip_buy": keep("dip_buy", F.lit(False)),
        "trend_weak": keep("trend_weak", F.lit(True)),
        "rationale": keep("rationale", F.lit("soft_dependency_degraded_to_safe")),
        "grid_width": keep("grid_width", F.greatest(F.col("grid_width"), F.lit(LEAST_WIDTH))),
    })


def freshness(sources: DataFrame, expected: Column, hard: tuple[str, ...]) -> DataFrame:
    """For each source (source, date rows): its last date, whether it is hard, whether it is behind."""
    last = sources.groupBy("source").agg(F.max("date").alias("last_date"))
    return last.select("source", "last_date", F.col("source").isin(*hard).alias("is_hard"), expected.alias("expected"), (~F.coalesce(F.col("last_date") >= expected, F.lit(False))).alias("is_stale"))


def assert_fresh(status: DataFrame) -> None:
    behind = [r.source for r in status.filter("is_hard AND is_stale").select("source").limit(20).collect()]
    if behind:
        raise ValueError(f"stale: {', '.join(sorted(behind))}")


def latest(df: DataFrame, *key: str) -> DataFrame:
    """The row with the largest date of each key."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), "date").alias("_r")).select(*key, "_r.*")


def payload(df: DataFrame, name: str = "signal") -> DataFrame:
    """A nested record of a decision as JSON."""
    thresholds = F.struct(*(F.col(c).alias(c.removeprefix("threshold_")) for c in df.columns if c.startswith("threshold_")))
    scores = F.struct(*(F.round(c, 6).alias(c.removeprefix("pred_")) for c in df.columns if c.startswith("pred_")))
    version = F.concat(F.lit(f"{name}_"), F.translate(F.col("date").cast("string"), "-", ""))
    body = F.struct(version.alias("version"), F.col("date").cast("string").alias("date"), "mode", F.round("position_scale", 4).alias("position_scale"), F.round("grid_width", 6).alias("grid_width"), "dip_buy", "high_sell", "rationale", scores.alias("scores"), thresholds.alias("thresholds"))
    return df.select("code", "date", F.to_json(body).alias("payload"))
