"""Features of a day from its bars. One shuffle by (code, date); all windows share its order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import change, col, flag, move, ratio, spread_ratio, time_bucket


@dataclass(frozen=True)
class DayParts:
    """How many bars the parts of a day have (fixed values of I1-I4, I13, I17, I18, I20 for days of 240 bars); columns carry the numbers."""

    heads: tuple[int, ...] = (5, 15, 30, 60)
    volume_head: int = 15
    sides: tuple[int, int] = (30, 60)
    morning: int = 120
    tail: int = 30
    reversion: int = 15


#: For days of at most 24 hourly bars.
HOURLY = DayParts(heads=(2, 4, 6, 12), volume_head=4, sides=(6, 12), morning=12, tail=6, reversion=6)

#: A gap to the running price that counts (I20, D2, W10), a volume that is a spike (I19), bins of the price profile (I23), of the day's time (I8).
LARGE_GAP = 0.01
SPIKE = 3.0
PROFILE_BINS = 10
TIME_BINS = 8
#: Fixed values (W10): a drawdown that counts, a move of the last bars, a morning and an afternoon that undo each other.
DRAWDOWN = 0.02
TAIL_MOVE = 0.01
REVERSAL = 0.01


@dataclass(frozen=True)
class Selloff:
    """Fixed values (D1-D4, L7): how deep an early fall is at least (a share, and in grid steps), and what else counts as hostile."""

    fall: tuple[float, float] = (0.015, 1.4)
    below_vwap: float = 0.68
    recovery: float = 0.55
    opening: float = -0.006
    opening_volume: float = 0.08
    close: float = -0.008
    points: int = 6

    def least_fall(self) -> Column:
        return F.greatest(F.lit(self.fall[0]), F.col("grid_step_pct") * self.fall[1])


def day():
    return Window.partitionBy("code", "date")


def ordered():
    return day().orderBy("datetime")


def so_far():
    return ordered().rowsBetween(Window.unboundedPreceding, 0)


#: Stands for the sign before the first gap: it differs from every sign and is not zero.
NO_SIGN = 2


def running_gap(bars: DataFrame) -> DataFrame:
    """gap: close against the running volume-weighted price, missing until there is volume. Not rounded: its signs count."""
    volume = F.coalesce("volume", F.lit(0.0))
    turned, total = F.sum(F.col("close") * volume).over(so_far()), F.sum(volume).over(so_far())
    return bars.withColumn("gap", F.when(total > 0, F.col("close") / (turned / total) - 1))


def crosses() -> Column:
    """1 where the gap's sign differs from the one before, both not zero; the first gap counts unless it is zero."""
    sign = F.signum("gap")
    before = F.coalesce(F.lag(sign).over(ordered()), F.lit(float(NO_SIGN)))
    return F.when(F.col("gap").isNotNull(), ((sign != before) & (sign != 0) & (before != 0)).cast("int"))


def reversions(c: DayParts) -> Column:
    """1 where a large gap begins (not at the last bar) that meets zero within the bars ahead."""
    ahead = ordered().rowsBetween(1, c.reversion)
    before = F.lag("gap").over(ordered())
    fresh = (F.abs("gap") >= LARGE_GAP) & (before.isNull() | (F.abs(before) < LARGE_GAP))
    back = ((F.col("gap") > 0) & (F.min("gap").over(ahead) <= 0)) | ((F.col("gap") < 0) & (F.max("gap").over(ahead) >= 0))
    return F.coalesce(fresh & back, F.lit(False)).cast("int")


def numbered(bars: DataFrame) -> DataFrame:
    """bar_no (from 1), n (bars of the day), first_open, last_close, prev (the close before, at first the open)."""
    whole = ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bars = bars.withColumns({
        "bar_no": F.row_number().over(ordered()),
        "n": F.count("*").over(day()),
        "first_open": F.first("open").over(whole),
        "last_close": F.last("close").over(whole),
        "last_volume": F.last("volume").over(whole),
    })
    return bars.withColumn("prev", F.coalesce(F.lag("close").over(ordered()), F.col("first_open")))


def prepared(bars: DataFrame, c: DayParts) -> DataFrame:
    """Bars with everything that the aggregates of a day need."""
    df = running_gap(numbered(bars))
    clv = F.coalesce(ratio(2 * F.col("close") - F.col("high") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0))
    df = df.withColumns({
        "cross": crosses(),
        "reverted": reversions(c),
        "day_high": F.max("high").over(day()),
        "day_low": F.min("low").over(day()),
        "day_volume": F.coalesce(F.sum("volume").over(day()), F.lit(0.0)),
        "top": F.max("close").over(so_far()),
        "bottom": F.min("close").over(so_far()),
        "log_return": F.when((F.col("prev") > 0) & (F.col("close") > 0), F.ln(F.col("close") / F.col("prev"))).otherwise(0.0),
        "step": ratio("close", "prev") - 1,
        "ofi": clv * F.col("volume"),
        "typical_volume": F.percentile(F.when(F.col("volume") > 0, F.col("volume")), F.lit(0.5)).over(day()),
    })
    day_sign = F.signum(change("first_open", "last_close"))
    return df.withColumns({
        "ofi_sign": F.signum(F.sum("ofi").over(day())),
        "day_sign": day_sign,
        "illiquidity": F.when(F.col("amount") > 0, F.abs(F.when(F.col("bar_no") == 1, move("first_open", "close")).otherwise(F.col("step"))) / F.col("amount")),
        "bin": profile_bin(PROFILE_BINS),
    })


def profile_bin(bins: int) -> Column:
    """The 1-based price bin of a close: right-closed, the lowest edge included: edges strictly below are counted."""
    step = (F.col("day_high") - F.col("day_low")) / bins
    below = sum(((F.col("day_low") + step * i) < F.col("close")).cast("int") for i in range(bins))
    return F.when(F.col("day_high") > F.col("day_low"), F.greatest(F.lit(1), below))


def _head(w: int) -> Column:
    return (F.col("bar_no") <= w) & (F.col("n") >= w)


def _tail(w: int) -> Column:
    return (F.col("bar_no") > F.col("n") - w) & (F.col("n") >= w)


def _of(cond: Column, x) -> Column:
    return F.when(cond, col(x))


def _at(cond: Column, x: str) -> Column:
    """x at the one bar where cond holds."""
    return F.max(F.when(cond, F.col(x)))


def _sum0(cond: Column, x: str) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(x))), F.lit(0.0))


def _share(cond: Column, among: Column) -> Column:
    """The share of rows with cond among rows where among is not missing."""
    return F.avg(F.when(among.isNotNull(), cond.cast("double")))


def features(bars: DataFrame, c: DayParts = DayParts()) -> DataFrame:
    """One row for each code and day. Windows that a day is too short for are missing, but early, midday and last volume ratios are 0."""
    df = prepared(bars, c)
    n, no = F.col("n"), F.col("bar_no")
    first = F.first("first_open")
    last = F.first("last_close")
    gap = F.col("gap")
    path = F.abs(F.col("close") - F.col("prev"))
    am = F.least(F.lit(c.morning), n)
    half = F.floor(n / 2)
    a: dict[str, Column] = {
        "n_bars": F.first("n"),
        "first_open": first,
        "last_close": last,
        "day_high": F.first("day_high"),
        "day_low": F.first("day_low"),
        "day_volume": F.first("day_volume"),
    }
    for w in c.heads:
        a[f"c_{w}"] = _at(_head(w) & (no == w), "close")
        a[f"h_{w}"] = F.max(_of(_head(w), "high"))
        a[f"l_{w}"] = F.min(_of(_head(w), "low"))
    for w in c.sides:
        a[f"open{w}_negative_vwap_ratio"] = _share(gap < 0, _of(_head(w), gap))
        a[f"open{w}_positive"] = _share(gap > 0, _of(_head(w), gap))
        a[f"open{w}_vwap_cross_count"] = _sum0(_head(w), "cross")
    a |= {
        "am_close": _at(no == am, "close"),
        "pm_open": _at(no == am + 1, "open"),
        "last_open": _at(_tail(c.tail) & (no == n - c.tail + 1), "open"),
        "path": F.sum(path),
        "am_path": F.sum(_of(no <= am, path)),
        "directional_consistency": F.coalesce(F.avg(_of((F.col("step") != 0) & (F.col("day_sign") != 0), (F.signum("step") == F.col("day_sign")).cast("double"))), F.when(F.first("first_open") > 0, 0.0)),
        "low_no": F.min_by("bar_no", F.struct("low", "bar_no")),
        "high_no": F.max_by("bar_no", F.struct(F.col("high"), -no)),
        "turnover": F.sum(F.col("close") * F.col("volume")),
        "max_vwap_gap": F.max(F.abs(gap)),
        "mean_abs_vwap_gap": F.avg(F.abs(gap)),
        "vwap_cross_count": _sum0(F.lit(True), "cross"),
        "vwap_above_ratio": _share(gap > 0, gap),
        "vwap_below_ratio": _share(gap < 0, gap),
        "reversion_count_after_large_deviation": F.sum("reverted").cast("double"),
        "realized_volatility": F.sqrt(F.sum(F.col("log_return") * F.col("log_return"))),
        "max_drawdown_intraday": F.max(1 - ratio("close", "top")),
        "max_runup_intraday": F.max(ratio("close", "bottom") - 1),
        "h_a": F.max(_of(no <= half, "high")),
        "l_a": F.min(_of(no <= half, "low")),
        "h_b": F.max(_of(no > half, "high")),
        "l_b": F.min(_of(no > half, "low")),
        "tail_dev": F.stddev_pop(_of(no > n - c.tail, "log_return")),
        "v_open": F.sum(_of(_head(c.volume_head), "volume")),
        "v_early": _sum0(_head(c.sides[0]), "volume"),
        "v_mid": _sum0((n > 2 * c.sides[0]) & (no > c.sides[0]) & (no <= n - c.sides[0]), "volume"),
        "v_last": _sum0(_tail(c.tail), "volume"),
        "volume_spike_count": F.coalesce(F.sum((F.col("volume") > F.col("typical_volume") * SPIKE).cast("double")), F.lit(0.0)),
        "v_mean": F.avg(_of(F.col("volume") > 0, "volume")),
        "v_dev": F.stddev_pop(_of(F.col("volume") > 0, "volume")),
        "v_end": F.first("last_volume"),
        "amihud_mean": F.avg("illiquidity"),
        "amihud_p90": F.percentile("illiquidity", F.lit(0.9)),
        "zero_volume_bar_ratio": F.avg((F.col("volume") == 0).cast("double")),
        "proxy_ofi_sum": F.sum("ofi"),
        "proxy_ofi_mean": F.avg("ofi"),
        "proxy_ofi_persistence": F.avg(_of((F.col("ofi") != 0) & (F.col("ofi_sign") != 0), (F.signum("ofi") == F.col("ofi_sign")).cast("double"))),
        "hour_low": F.min(_of(no <= F.least(F.lit(c.sides[1]), n), "low")),
        **{f"bin_{b}": F.sum(_of((F.col("bin") == b) & (F.col("volume") > 0), "volume")) for b in range(1, PROFILE_BINS + 1)},
    }
    g = df.groupBy("code", "date").agg(*(v.alias(k) for k, v in a.items()))
    width = F.col("day_high") - F.col("day_low")
    vwap = ratio("turnover", "day_volume")
    out: dict[str, Column] = {}
    for w in c.heads:
        out[f"open{w}_return"] = move("first_open", f"c_{w}")
        out[f"open{w}_range"] = spread_ratio(f"h_{w}", f"l_{w}")
    for w in c.sides:
        out[f"open{w}_low_return"] = move("first_open", f"l_{w}")
        out[f"open{w}_negative_vwap_ratio"] = F.col(f"open{w}_negative_vwap_ratio")
        out[f"open{w}_vwap_cross_count"] = F.col(f"open{w}_vwap_cross_count").cast("double")
        out[f"open{w}_vwap_dominant_side_ratio"] = F.greatest(f"open{w}_positive", f"open{w}_negative_vwap_ratio")
    efficiency = lambda x, p: F.when(F.col("first_open") > 0, F.when(F.col(p) > 0, F.abs(F.col(x) - F.col("first_open")) / F.col(p)).otherwise(0.0))
    out |= {
        "am_return": move("first_open", "am_close"),
        "pm_return": move("pm_open", "last_close"),
        "last_return": move("last_open", "last_close"),
        "intraday_range": spread_ratio("day_high", "day_low"),
        "day_return": move("first_open", "last_close"),
        "close_location_in_range": ratio(F.col("last_close") - F.col("day_low"), width),
        "trend_efficiency_ratio": efficiency("last_close", "path"),
        "morning_trend_efficiency_ratio": efficiency("am_close", "am_path"),
        "directional_consistency": F.col("directional_consistency"),
        "low_in_first_hour_flag": flag(F.col("low_no") - 1 < F.least(F.lit(c.sides[1]), F.col("n_bars"))),
        "high_time_bucket": time_bucket(F.col("high_no") - 1, F.col("n_bars"), TIME_BINS),
        "low_time_bucket": time_bucket(F.col("low_no") - 1, F.col("n_bars"), TIME_BINS),
        "high_before_low_flag": flag(F.col("high_no") < F.col("low_no")),
        "vwap": vwap,
        "close_vwap_gap": ratio("last_close", vwap) - 1,
        **{k: F.col(k) for k in ("max_vwap_gap", "mean_abs_vwap_gap", "vwap_above_ratio", "vwap_below_ratio", "reversion_count_after_large_deviation", "realized_volatility", "max_drawdown_intraday", "max_runup_intraday")},
        "vwap_cross_count": F.col("vwap_cross_count").cast("double"),
        "range_first_half": spread_ratio("h_a", "l_a"),
        "range_second_half": spread_ratio("h_b", "l_b"),
        "tail_volatility": F.col("tail_dev") * F.sqrt(F.least(F.lit(c.tail), F.col("n_bars"))),
        "opening_volume_ratio": ratio("v_open", "day_volume"),
        "opening_volume_shock": ratio(F.col("v_open") / c.volume_head, ratio("day_volume", F.col("n_bars"))),
        "opening_breakout_strength": ratio(F.col(f"c_{c.volume_head}") - F.col("first_open"), width),
        "early_volume_ratio": ratio("v_early", "day_volume"),
        "midday_volume_ratio": ratio("v_mid", "day_volume"),
        "last_volume_ratio": ratio("v_last", "day_volume"),
        "volume_spike_count": F.col("volume_spike_count"),
        "volume_zscore_close": F.when(F.col("v_dev") > 0, (F.col("v_end") - F.col("v_mean")) / F.col("v_dev")).when(F.col("v_dev").isNotNull(), 0.0),
        **{k: F.col(k) for k in ("amihud_mean", "amihud_p90", "zero_volume_bar_ratio", "proxy_ofi_sum", "proxy_ofi_mean", "proxy_ofi_persistence")},
        "close_recovery_ratio": F.when(F.col("first_open") - F.col("hour_low") > 0, ratio(F.col("last_close") - F.col("hour_low"), F.col("first_open") - F.col("hour_low"))).otherwise(1.0),
    }
    g, skew, kurt = with_profile(g)
    prices = {"open": "first_open", "high": "day_high", "low": "day_low", "close": "last_close", "volume": "day_volume"}
    return g.select("code", "date", "n_bars", "day_volume", *(F.col(v).alias(k) for k, v in prices.items()), *(v.alias(k) for k, v in out.items()), skew.alias("volume_profile_skewness"), kurt.alias("volume_profile_kurtosis"))


def with_profile(g: DataFrame, bins: int = PROFILE_BINS) -> tuple[DataFrame, Column, Column]:
    """Volume-weighted skewness and excess kurtosis of the bins' centres; missing with fewer than two bins, 0 without variance."""
    step = (F.col("day_high") - F.col("day_low")) / bins
    weight = [F.coalesce(f"bin_{b}", F.lit(0.0)) for b in range(1, bins + 1)]
    center = [F.col("day_low") + step * (b - 0.5) for b in range(1, bins + 1)]
    g = g.withColumn("profile_weight", sum(weight[1:], weight[0])).withColumn("profile_sum", sum((w * c for w, c in zip(weight, center)), F.lit(0.0)))
    g = g.withColumn("profile_mean", ratio("profile_sum", "profile_weight"))
    off = [c - F.col("profile_mean") for c in center]
    moment = lambda k: ratio(sum((w * F.pow(o, F.lit(k)) for w, o in zip(weight, off)), F.lit(0.0)), "profile_weight")
    g = g.withColumns({f"profile_m{k}": moment(k) for k in (2, 3, 4)})
    enough = sum((F.col(f"bin_{b}").isNotNull().cast("int") for b in range(1, bins + 1)), F.lit(0)) >= 2
    of = lambda x: F.when(enough, F.when(F.col("profile_m2") <= 0, 0.0).otherwise(x))
    return g, of(F.col("profile_m3") / F.pow(F.sqrt("profile_m2"), F.lit(3))), of(F.col("profile_m4") / F.pow(F.col("profile_m2"), F.lit(2)) - 3)


def regime(df: DataFrame, c: DayParts = DayParts(), x: Selloff = Selloff()) -> DataFrame:
    """Selloff and failed-reversion flags, and the score of the former (0 to 7); needs grid_step_pct."""
    hour = f"open{c.sides[1]}"
    flags = {
        "flag_deep_selloff": flag(F.col(f"{hour}_low_return") <= -x.least_fall()),
        "flag_negative_vwap_persistent": flag(F.col(f"{hour}_negative_vwap_ratio") >= x.below_vwap),
        "flag_poor_recovery": flag(F.col("close_recovery_ratio") <= x.recovery),
        "flag_weak_opening": flag(F.col(f"open{c.volume_head}_return") <= x.opening),
        "flag_heavy_opening": flag(F.col("opening_volume_ratio") >= x.opening_volume),
        "flag_close_weak": flag(F.col("day_return") <= x.close),
    }
    df = df.withColumns(flags).withColumn("hostile_soft_score", sum((F.col(k) for k in flags), F.col("low_in_first_hour_flag")))
    return df.withColumns({
        "flag_hostile_regime": flag(F.col("hostile_soft_score") >= x.points),
        "flag_reversion_failure": flag((F.col("max_vwap_gap") >= LARGE_GAP) & (F.col("reversion_count_after_large_deviation") <= 0) & (F.col(f"{hour}_negative_vwap_ratio") >= x.below_vwap)),
        "flag_large_vwap_deviation": flag(F.col("max_vwap_gap") >= LARGE_GAP),
        "flag_large_drawdown": flag(F.col("max_drawdown_intraday") >= DRAWDOWN),
        "flag_afternoon_reversal": flag((F.col("am_return") <= -REVERSAL) & (F.col("pm_return") >= REVERSAL)),
        "flag_strong_tail": flag(F.col("last_return") >= TAIL_MOVE),
    })


def clock_features(bars: DataFrame) -> DataFrame:
    """Features by clock rather than by bar counts, for bars of any spacing: opening half hour, morning, afternoon, last half hour.

    A part without bars, or that opens at no positive price, has no values; its volume counts as 0.
    """
    minute = F.hour("datetime") * 60 + F.minute("datetime")
    parts = {"open": minute.between(565, 600), "am": minute <= 690, "pm": minute >= 780, "last": minute.between(870, 900)}
    part = lambda cond, x: F.when(cond, F.col(x))
    first = lambda x, cond=F.lit(True): F.min_by(part(cond, x), F.when(cond, F.col("datetime")))
    last = lambda x, cond=F.lit(True): F.max_by(part(cond, x), F.when(cond, F.col("datetime")))
    g = bars.groupBy("code", "date").agg(
        *(first("open", w).alias(f"{k}_o") for k, w in parts.items()),
        *(last("close", w).alias(f"{k}_c") for k, w in parts.items()),
        F.max(part(parts["open"], "high")).alias("open_h"), F.min(part(parts["open"], "low")).alias("open_l"),
        F.max(part(parts["am"], "high")).alias("am_h"), F.min(part(parts["pm"], "low")).alias("pm_l"),
        F.sum(part(parts["open"], "volume")).alias("open_v"), F.sum(part(parts["open"], "amount")).alias("open_a"),
        F.count("*").alias("bar_count"), F.max("high").alias("h"), F.min("low").alias("l"), F.sum("volume").alias("v"), F.sum("amount").alias("a"),
        first("open").alias("first_open"), last("close").alias("close"),
    )
    opened = lambda k, x: F.when(F.col(f"{k}_o") > 0, x)
    vwap = F.when((F.col("a") != 0) & (F.col("v") > 0), F.col("a") / F.col("v"))
    return g.select(
        "code", "date", "bar_count",
        change("open_o", "open_c").alias("open30_return"), opened("open", spread_ratio("open_h", "open_l")).alias("open30_range"),
        change("am_o", "am_c").alias("am_return"), change("pm_o", "pm_c").alias("pm_return"), change("last_o", "last_c").alias("last30_return"),
        spread_ratio("h", "l").alias("intraday_range"), change("first_open", "close").alias("day_return"),
        vwap.alias("vwap"), F.when(vwap > 0, F.col("close") / vwap - 1).alias("close_vwap_gap"),
        F.when(F.col("v") > 0, F.coalesce(opened("open", F.col("open_v")), F.lit(0.0)) / F.col("v")).alias("open30_volume_ratio"),
        ratio(opened("open", F.col("open_a")), "a").alias("open30_amount_ratio"),
        opened("am", change("first_open", "am_h")).alias("morning_high_break"), opened("pm", change("first_open", "pm_l")).alias("afternoon_low_break"),
    )
