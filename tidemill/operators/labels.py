"""Labels of a day from the bars of the next day that has any. Bars are shuffled once, by code and day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import change, int_flag, ratio
from ..sources.sinks import stored
from . import daily as D
from . import intraday as I
from . import sketches as Q
from .replay import Market, replay


@dataclass(frozen=True)
class LabelBars:
    """How many bars a label looks at (fixed values of L4, L5, L7 for days of 240 bars)."""

    ahead: int = 30
    opening: int = 15
    early: int = 30
    late: int = 60


#: For days of at most 24 hourly bars.
HOURLY = LabelBars(ahead=12, opening=4, early=6, late=12)


@dataclass(frozen=True)
class Reversion:
    """Fixed values (L4). An event is a gap that counts; it succeeds where enough of it is captured (a move, and in costs
    of a round trip) and little is left (a gap, and a share of the first); the label asks for successes, a capture, crosses
    and no side that rules the day."""

    gap: float = I.LARGE_GAP
    capture: float = 0.005
    costs: float = 1.25
    left: float = 0.003
    captured_share: float = 0.60
    successes: int = 2
    best_capture: float = 0.011
    crosses: int = 3
    side: float = 0.85


@dataclass(frozen=True)
class OneWay:
    """Bounds of a day that runs one way: of range and path efficiency, opening move and volume, the ruling side, crosses."""

    range: float
    path: float
    opening: float
    volume: float
    side: float
    crosses: int


#: Fixed values (L6): the strict signature, the terms of the soft score, the move that counts (a share, and in grid steps),
#: where in the range the close lies, and what the soft label asks for.
STRICT = OneWay(range=0.55, path=0.32, opening=0.008, volume=0.14, side=0.70, crosses=6)
SOFT = OneWay(range=0.35, path=0.12, opening=0.004, volume=0.08, side=0.60, crosses=12)
MOVE = (0.015, 1.25)
CLOSE_AT = 0.80
SOFT_LABEL = {"side": 0.84, "crosses": 6, "path": 0.12, "points": 8}


def price_targets(df: DataFrame) -> DataFrame:
    """Returns of the next day's open, high and low against today's close, its open, and the larger of both."""
    return df.withColumns({
        "next_gap_return": change("close", "next_open"),
        "target_upside": change("close", "next_high"),
        "target_downside": change("close", "next_low"),
        "target_downside_from_open": change("next_open", "next_low"),
        "target_downside_from_max_anchor": change(F.greatest("close", "next_open"), "next_low"),
    })


#: Fixed values (L2, L3): a low that is far above, a high that is far above, a gap either way.
LOW_ABOVE = 0.03
HIGH_ABOVE = 0.10
FAR_GAP = 0.08


def anomaly_flags(df: DataFrame) -> DataFrame:
    """Row flags; suspicious is the jump (both extremes) or a large gap."""
    jump = (F.col("target_downside") > LOW_ABOVE) & (F.col("target_upside") > HIGH_ABOVE)
    return df.withColumns({
        "downside_positive_flag": int_flag(F.col("target_downside") > 0),
        "downside_large_positive_flag": int_flag(F.col("target_downside") > LOW_ABOVE),
        "upside_extreme_flag": int_flag(F.col("target_upside") > HIGH_ABOVE),
        "large_gap_flag": int_flag(F.abs("next_gap_return") > FAR_GAP),
        "suspicious_flag": int_flag(F.coalesce(jump, F.lit(False)) | F.coalesce(F.abs("next_gap_return") > FAR_GAP, F.lit(False))),
    })


def anomaly_audit(df: DataFrame) -> DataFrame:
    """Counts and shares of the flags, by code; the jump here is without the gap, unlike the row flag."""
    jump = F.coalesce((F.col("target_downside") > LOW_ABOVE) & (F.col("target_upside") > HIGH_ABOVE), F.lit(False)).cast("int")
    parts = {"downside_positive": F.col("downside_positive_flag"), "downside_large_positive": F.col("downside_large_positive_flag"), "upside_extreme": F.col("upside_extreme_flag"), "large_gap": F.col("large_gap_flag"), "abnormal_jump": jump}
    return df.groupBy("code").agg(*(f.alias(n) for k, v in parts.items() for n, f in ((f"{k}_days", F.sum(v)), (f"{k}_ratio", F.avg(v)))))


def anomaly_samples(df: DataFrame, limit: int = 20) -> DataFrame:
    """The first suspicious days of each code."""
    order = Window.partitionBy("code").orderBy("date")
    return df.filter("suspicious_flag = 1").withColumn("sample", F.row_number().over(order)).filter(F.col("sample") <= limit)


def describe(df: DataFrame, columns: tuple[str, ...], size: int = Q.SIZE) -> DataFrame:
    """count, mean, sample deviation, min, 10th, 50th, 90th percentile and max of columns, exact. size: of the sketches that
    bracket the percentiles; no group's values are held."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns)))
    long = stored(df.select(cells.alias("c")).select("c.*"), "cells")
    stats = stored(long.groupBy("column_name").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("deviation"), F.min("x").alias("least"), F.max("x").alias("most"), Q.sketch("x", size).alias("sketch")
    ), "stats")
    places = Q.exact_quantiles(long, "x", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, ("column_name",), stats.select("column_name", "sketch"), size=size)
    return stats.drop("sketch").join(places, "column_name", "left").select("column_name", "n", "mean", "deviation", "least", "p10", "p50", "p90", "most")


def day_stats(bars: DataFrame, parts: LabelBars = LabelBars(), market: Market = Market(), x: Reversion = Reversion()) -> DataFrame:
    """What the labels need of a day's bars: one row for each code and day."""
    df = I.running_gap(I.numbered(bars))
    w = I.ordered()
    ahead = w.rowsBetween(1, parts.ahead)
    gap, sign = F.col("gap"), F.signum("gap")
    before = F.lag("gap").over(w)
    held = F.coalesce((F.abs(before) >= x.gap) & (F.signum(before) == sign), F.lit(False))
    nearest = F.min(F.abs(gap)).over(ahead)
    cross = F.when(gap > 0, F.min(sign).over(ahead) < 0).when(gap < 0, F.max(sign).over(ahead) > 0)
    event = (F.abs(gap) >= x.gap) & ~held & nearest.isNotNull()
    least = max(x.capture, x.costs * market.round_trip())
    df = df.withColumns({"crossed": I.crosses(), "event": F.coalesce(event, F.lit(False)), "capture": F.abs(gap) - nearest, "nearest": nearest, "other_side": F.coalesce(cross, F.lit(False))})
    settled = F.col("other_side") | (F.col("nearest") <= F.greatest(F.lit(x.left), F.abs("gap") * (1 - x.captured_share)))
    no, n = F.col("bar_no"), F.col("n")
    of = lambda cond, x: F.when(cond, F.col(x))
    share = lambda cond: F.coalesce(F.avg(F.when(gap.isNotNull(), cond.cast("double"))), F.lit(0.0))
    return df.groupBy("code", "date").agg(
        F.first("n").alias("n"),
        F.first("first_open").alias("o"),
        F.first("last_close").alias("c"),
        F.max("high").alias("h"),
        F.min("low").alias("l"),
        F.max(of(no == F.least(F.lit(parts.opening), n), "close")).alias("opening_close"),
        ratio(F.sum(of(no <= parts.opening, "volume")), F.sum("volume")).alias("opening_volume_ratio"),
        F.sum(F.abs(F.col("close") - F.col("prev"))).alias("path"),
        F.min(of(no <= parts.early, "low")).alias("early_low"),
        F.min(of(no <= parts.late, "low")).alias("late_low"),
        (F.min_by("bar_no", F.struct("low", "bar_no")) - 1).alias("low_index"),
        F.coalesce(F.sum("crossed"), F.lit(0)).cast("long").alias("cross_count"),
        share(gap > 0).alias("above"),
        share(gap < 0).alias("below"),
        F.count_if("event").alias("event_count"),
        F.count_if(F.col("event") & (F.col("capture") >= least) & settled).alias("success_count"),
        F.coalesce(F.greatest(F.max(of(F.col("event"), "capture")), F.lit(0.0)), F.lit(0.0)).alias("max_capture"),
        F.coalesce(F.max(F.when(F.col("event"), F.abs(gap))), F.lit(0.0)).alias("max_event_gap"),
        F.collect_list(F.struct("datetime", "high", "low", "close", "volume")).alias("bars"),
    )


def label_table(bars: DataFrame, days: DataFrame | None = None, parts: LabelBars = LabelBars(), market: Market = Market(), least_trips: int = 1) -> DataFrame:
    """One row for each day whose next day has bars, with all labels of that next day.

    days: code, date, close, grid_step_pct; a next day without bars has no row.  Without days they come from the bars: then
    a window over the days of a code, a row each, pairs every day with the one before, and bars are read and shuffled once.
    """
    stats = day_stats(bars, parts, market)
    if days is None:
        own = D.label_step(stats.withColumns({"high": F.col("h"), "low": F.col("l"), "close": F.col("c")}))
        before = {k: F.lag(k).over(D.days()) for k in ("date", "close", "grid_step_pct")}
        df = own.select("code", before["date"].alias("date"), F.col("date").alias("next_date"), before["close"].alias("close"), before["grid_step_pct"].alias("grid_step_pct"), *(c for c in stats.columns if c not in ("code", "date")))
        df = df.filter("date IS NOT NULL")
    else:
        today = days.withColumn("next_date", F.lead("date").over(D.days())).filter("next_date IS NOT NULL").select("code", "date", "next_date", "close", "grid_step_pct")
        df = today.join(stats.withColumnRenamed("date", "next_date"), ["code", "next_date"])
    df = df.withColumns({"next_open": F.col("o"), "next_high": F.col("h"), "next_low": F.col("l")})
    df = replay(anomaly_flags(price_targets(df)), "bars", "close", "grid_step_pct", market).drop("bars")
    df = df.select("*", "replay.*").drop("replay")
    df = df.withColumn("positive_grid_day", int_flag(F.col("grid_pnl") > 0))
    df = df.withColumn("tradable", int_flag((F.col("grid_pnl") > 0) & (F.col("round_trips") >= least_trips)))
    return selloff(trend_break(vwap_reversion(df)), parts)


def targets(df: DataFrame) -> DataFrame:
    """A label table's key and next date, and its outcomes under the names of heads: target_<head>."""
    price = [c for c in df.columns if c.startswith("target_")]
    named = ("grid_pnl", "positive_grid_day", "tradable", "trend_break_risk", "hostile_selloff_risk", "vwap_reversion")
    return df.select("code", "date", "next_date", *price, *(F.col(c).alias(f"target_{c}") for c in named))


def vwap_reversion(df: DataFrame, x: Reversion = Reversion()) -> DataFrame:
    df = df.withColumn("side_ratio", F.greatest("above", "below"))
    hit = (F.col("success_count") >= x.successes) & (F.col("max_capture") >= x.best_capture) & (F.col("cross_count") >= x.crosses) & (F.col("side_ratio") <= x.side)
    return df.withColumn("vwap_reversion", int_flag(hit))


def trend_break(df: DataFrame) -> DataFrame:
    """A day that runs one way: a strict signature, or a soft one of scores, where the grid would not have paid."""
    width = F.col("h") - F.col("l")
    df = df.withColumns({
        "open_close_return": change("o", "c"),
        "opening_return": change("o", "opening_close"),
        "close_location": F.when(width > 0, (F.col("c") - F.col("l")) / width).otherwise(0.5),
        "directional_efficiency": F.when(width > 0, F.abs(F.col("c") - F.col("o")) / width).otherwise(0.0),
        "path_efficiency": F.when(F.col("o") > 0, F.when(F.col("path") > 0, F.abs(F.col("c") - F.col("o")) / F.col("path")).otherwise(0.0)),
        "least_move": F.greatest(F.lit(MOVE[0]), F.col("grid_step_pct") * MOVE[1]),
        "hostile_context": int_flag((F.col("tradable") == 0) | (F.col("vwap_reversion") == 0)),
    })
    df = df.withColumn("trend_direction", F.coalesce(F.signum("open_close_return"), F.lit(0.0)).cast("int"))
    up = F.col("trend_direction")
    extreme = F.when(up > 0, F.col("close_location") >= CLOSE_AT).when(up < 0, F.col("close_location") <= 1 - CLOSE_AT).otherwise(False)
    aligned = lambda least: (F.abs("opening_return") >= least) & (F.signum("opening_return") == up)
    moved = F.abs("open_close_return") >= F.col("least_move")
    terms = [
        up != 0,
        moved,
        F.col("directional_efficiency") >= SOFT.range,
        F.col("path_efficiency") >= SOFT.path,
        aligned(SOFT.opening),
        F.col("opening_volume_ratio") >= SOFT.volume,
        F.col("side_ratio") >= SOFT.side,
        F.col("cross_count") <= SOFT.crosses,
        extreme,
    ]
    df = df.withColumn("trend_soft_score", _score(terms))
    strict = (
        (up != 0)
        & moved
        & (F.col("directional_efficiency") >= STRICT.range)
        & (F.col("path_efficiency") >= STRICT.path)
        & aligned(STRICT.opening)
        & (F.col("opening_volume_ratio") >= STRICT.volume)
        & (F.col("side_ratio") >= STRICT.side)
        & (F.col("cross_count") <= STRICT.crosses)
        & extreme
    )
    soft = (up != 0) & (F.col("side_ratio") >= SOFT_LABEL["side"]) & (F.col("cross_count") <= SOFT_LABEL["crosses"]) & ((F.col("path_efficiency") >= SOFT_LABEL["path"]) | (F.col("trend_soft_score") >= SOFT_LABEL["points"]))
    hostile = F.col("hostile_context") == 1
    df = df.withColumns({"trend_break_extreme": int_flag(strict & hostile), "trend_break_soft": int_flag(soft & hostile)})
    return df.withColumn("trend_break_risk", F.greatest("trend_break_extreme", "trend_break_soft"))


def selloff(df: DataFrame, parts: LabelBars = LabelBars(), x: I.Selloff = I.Selloff()) -> DataFrame:
    """A day that sells off early and does not recover."""
    late = F.least(F.lit(parts.late), F.col("n"))
    df = df.withColumn("anchor", F.greatest("close", "o")).withColumns({
        "early_low_return": change("anchor", "early_low"),
        "late_low_return": change("anchor", "late_low"),
        "close_vs_anchor": change("anchor", "c"),
        "low_in_first_hour": int_flag(F.col("low_index") < late),
        "recovery": F.when(F.col("anchor") - F.col("late_low") > 0, ratio(F.col("c") - F.col("late_low"), F.col("anchor") - F.col("late_low"))).otherwise(1.0),
        "least_drop": x.least_fall(),
        "negative_trend": int_flag((F.col("trend_break_risk") == 1) & (F.col("trend_direction") < 0)),
    })
    early, later = F.col("early_low_return") <= -F.col("least_drop"), F.col("late_low_return") <= -F.col("least_drop")
    weak, below = F.col("close_vs_anchor") <= x.close, F.col("below") >= x.below_vwap
    pressed, poor, negative = F.col("opening_return") <= x.opening, F.col("recovery") <= x.recovery, F.col("negative_trend") == 1
    low = F.col("low_in_first_hour") == 1
    terms = [early, later, low, pressed, F.col("opening_volume_ratio") >= x.opening_volume, below, poor, weak, F.col("tradable") == 0, F.col("vwap_reversion") == 0, negative]
    df = df.withColumn("selloff_score", _score(terms))
    soft = (F.col("hostile_context") == 1) & (_yes(early) | _yes(later)) & (F.col("selloff_score") >= x.points) & (_yes(pressed) | _yes(weak) | _yes(negative))
    df = df.withColumns({"selloff_extreme": int_flag(early & low & below & poor & negative), "selloff_soft": int_flag(soft)})
    return df.withColumn("hostile_selloff_risk", F.greatest("selloff_extreme", "selloff_soft"))


def _yes(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def _score(terms: list[Column]) -> Column:
    return sum((_yes(t).cast("int") for t in terms), F.lit(0))
