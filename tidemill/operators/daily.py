"""Ordered windows over days of an instrument: returns, ranges, averages, fills."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import clip, ratio


@dataclass(frozen=True)
class GridStep:
    """Fixed values (W5, W6): a share of the mean true range of some days, held in bounds; fewer than enough days have no mean."""

    share: float = 0.4
    bounds: tuple[float, float] = (0.008, 0.035)
    days: int = 20
    enough: int = 5


def days(code: str = "code"):
    return Window.partitionBy(code).orderBy("date")


def trailing(n: int):
    return days().rowsBetween(1 - n, 0)


def returns(df: DataFrame, prefix: str = "") -> DataFrame:
    """pre_close, daily_return, daily_range, gap_pct."""
    before = F.lag("close").over(days())
    return df.withColumn(f"{prefix}pre_close", before).withColumns({
        f"{prefix}daily_return": ratio("close", f"{prefix}pre_close") - 1,
        f"{prefix}daily_range": ratio(F.col("high") - F.col("low"), f"{prefix}pre_close"),
        f"{prefix}gap_pct": ratio("open", f"{prefix}pre_close") - 1,
    })


def true_range(df: DataFrame) -> DataFrame:
    """The largest of the day's range and the distances of its ends to the close before; parts without that close are skipped."""
    before = F.lag("close").over(days())
    return df.withColumn("true_range", F.greatest(F.abs(F.col("high") - F.col("low")), F.abs(F.col("high") - before), F.abs(F.col("low") - before)))


def _atr(g: GridStep) -> Column:
    w = trailing(g.days)
    return F.when(F.count("true_range").over(w) >= g.enough, F.avg("true_range").over(w))


def grid_step(df: DataFrame, g: GridStep = GridStep()) -> DataFrame:
    """atr (an expanding mean until the window has enough days), atr_pct, grid_step_pct: for features."""
    ever = F.avg("true_range").over(days().rowsBetween(Window.unboundedPreceding, 0))
    df = true_range(df).withColumn("atr", F.coalesce(_atr(g), ever)).withColumn("atr_pct", ratio("atr", "close"))
    return df.withColumn("grid_step_pct", clip(F.col("atr_pct") * g.share, *g.bounds))


def label_step(df: DataFrame, g: GridStep = GridStep()) -> DataFrame:
    """As grid_step for labels: without the expanding mean; a mean of five daily ranges, then the least step, stand in."""
    df = true_range(df).withColumn("daily_range_pct", F.when(F.col("close") > 0, (F.col("high") - F.col("low")) / F.col("close")))
    df = df.withColumn("atr", _atr(g)).withColumn("atr_pct", F.when(F.col("close") > 0, F.col("atr") / F.col("close")))
    instead = clip(F.avg("daily_range_pct").over(trailing(5)) * g.share, *g.bounds)
    return df.withColumn("grid_step_pct", F.coalesce(clip(F.col("atr_pct") * g.share, *g.bounds), instead, F.lit(g.bounds[0])))


def averages(df: DataFrame) -> DataFrame:
    mean = lambda c, n: F.avg(c).over(trailing(n))
    df = df.withColumns({**{f"ma{n}": mean("close", n) for n in (5, 10, 20, 60)}, **{f"vol_ma{n}": mean("volume", n) for n in (5, 20)}})
    return df.withColumns({f"close_to_ma{n}": ratio("close", f"ma{n}") - 1 for n in (20, 60)})


def full_average(c: str, n: int) -> Column:
    """The mean of n days, missing until there are n."""
    return F.when(F.count(c).over(trailing(n)) >= n, F.avg(c).over(trailing(n)))


def rolling(df: DataFrame, columns: tuple[str, ...], windows: tuple[int, ...]) -> DataFrame:
    """Means (from one day on) and population deviations (from two) of columns, in one projection."""
    out = {}
    for c in columns:
        for n in windows:
            w = trailing(n)
            out[f"{c}_mean_{n}d"] = F.avg(c).over(w)
            out[f"{c}_std_{n}d"] = F.when(F.count(c).over(w) >= 2, F.stddev_pop(c).over(w))
    return df.select("*", *(v.alias(k) for k, v in out.items()))


def rates(df: DataFrame, flags: tuple[str, ...], windows: tuple[int, ...]) -> DataFrame:
    """Trailing means of 0/1 columns."""
    return df.select("*", *(F.avg(c).over(trailing(n)).alias(f"{c}_rate_{n}d") for c in flags for n in windows))


def forward_fill(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    w = days().rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def next_high_return(df: DataFrame) -> DataFrame:
    """The next day's high against the close; the last day leaves."""
    return df.withColumn("next_high_return", ratio(F.lead("high").over(days()), "close") - 1).withColumn("_next", F.lead("date").over(days())).filter("_next IS NOT NULL").drop("_next")


def ordinal_split(df: DataFrame, last_share: float, key: tuple[str, ...] = ("code",)) -> DataFrame:
    """row_idx (0-based) and part, 'train' for the first int(n * (1 - share)) rows of each key, else 'test'."""
    w = Window.partitionBy(*key).orderBy("date")
    n = F.count("*").over(Window.partitionBy(*key))
    df = df.withColumn("row_idx", F.row_number().over(w) - 1)
    return df.withColumn("part", F.when(F.col("row_idx") < F.floor(n * (1 - last_share)), "train").otherwise("test"))
