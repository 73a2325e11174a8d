"""Queries on the features of a day, over hourly bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import daily as D
from ..operators import intraday as I
from ..operators import joins as J
from ..operators.features import RATED, ROLLING, WEAKNESS, feature_table, rolled
from ..sources import tables as S
from .common import BARS, TICKS, environment_sql, hourly, text
from .registry import add

_W = "PARTITION BY code, date ORDER BY datetime"
_SO_FAR = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_ALL = "OVER (PARTITION BY code, date)"
_WHOLE = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
PREPARED = BARS + f""", b0 AS (
  SELECT *, row_number() OVER ({_W}) AS no, count(*) {_ALL} AS n, first_value(open) {_WHOLE} AS first_open, last_value(close) {_WHOLE} AS last_close,
    last_value(volume) {_WHOLE} AS last_volume, max(high) {_ALL} AS day_high, min(low) {_ALL} AS day_low, sum(volume) {_ALL} AS day_volume,
    max(close) {_SO_FAR} AS top, min(close) {_SO_FAR} AS bottom,
    CASE WHEN sum(volume) {_SO_FAR} > 0 THEN close / (sum(close * volume) {_SO_FAR} / sum(volume) {_SO_FAR}) - 1 END AS gap,
    coalesce((2 * close - high - low) / nullif(high - low, 0), 0) * volume AS ofi,
    quantile_cont(CASE WHEN volume > 0 THEN volume END, 0.5) {_ALL} AS typical_volume FROM bars),
b1 AS (SELECT *, coalesce(lag(close) OVER ({_W}), first_open) AS prev, coalesce(lag(sign(gap)) OVER ({_W}), 2) AS sign_before, lag(gap) OVER ({_W}) AS gap_before,
    min(gap) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING) AS gap_low, max(gap) OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING) AS gap_high,
    sign(sum(ofi) {_ALL}) AS ofi_sign, sign(last_close / first_open - 1) AS day_sign FROM b0),
b2 AS (SELECT *, CASE WHEN gap IS NULL THEN NULL WHEN sign(gap) <> sign_before AND sign(gap) <> 0 AND sign_before <> 0 THEN 1 ELSE 0 END AS crossed,
    CASE WHEN abs(gap) >= 0.01 AND (gap_before IS NULL OR abs(gap_before) < 0.01) AND ((gap > 0 AND gap_low <= 0) OR (gap < 0 AND gap_high >= 0)) THEN 1 ELSE 0 END AS reverted,
    ln(close / prev) AS log_return, close / prev - 1 AS step, abs(close - prev) AS path,
    CASE WHEN amount > 0 THEN abs(close / prev - 1) / amount END AS illiquidity,
    CASE WHEN day_high > day_low THEN greatest(1, {' + '.join(f'CAST(day_low + (day_high - day_low) / 10 * {i} < close AS INTEGER)' for i in range(10))}) END AS bin FROM b1)"""


def features(s, d):
    return I.features(hourly(s, d), I.HOURLY)


#: Select lists over b2, by code and date, of everything that features() has.
SELECTS: list[str] = []


def query(name: str, columns: str, sql: str, floats: str | None = None) -> None:
    """columns: what features() calls them; sql: select list over b2, grouped by code and date."""
    names = columns.split()
    SELECTS.append(sql)
    add(name, lambda s, d: features(s, d).select("code", "date", *names), f"WITH {PREPARED} SELECT code, date, {sql} FROM b2 GROUP BY code, date", floats or columns)


def _head(w: int) -> str:
    return f"no <= {w} AND n >= {w}"


def _open(w: int) -> str:
    return f"""any_value(close) FILTER (no = {w}) / any_value(first_open) - 1 AS open{w}_return,
      max(high) FILTER ({_head(w)}) / min(low) FILTER ({_head(w)}) - 1 AS open{w}_range"""


query("open_windows", " ".join(f"open{w}_{k}" for w in (2, 4, 6, 12) for k in ("return", "range")), ", ".join(_open(w) for w in (2, 4, 6, 12)))
query(
    "day_part_returns",
    "am_return pm_return last_return intraday_range day_return close_location_in_range",
    """any_value(close) FILTER (no = least(12, n)) / any_value(first_open) - 1 AS am_return, any_value(last_close) / any_value(open) FILTER (no = 13) - 1 AS pm_return,
    any_value(last_close) / any_value(open) FILTER (no = n - 5 AND n >= 6) - 1 AS last_return, any_value(day_high) / any_value(day_low) - 1 AS intraday_range,
    any_value(last_close) / any_value(first_open) - 1 AS day_return,
    (any_value(last_close) - any_value(day_low)) / nullif(any_value(day_high) - any_value(day_low), 0) AS close_location_in_range""",
)
query(
    "trend_efficiency",
    "trend_efficiency_ratio morning_trend_efficiency_ratio",
    """CASE WHEN sum(path) > 0 THEN abs(any_value(last_close) - any_value(first_open)) / sum(path) ELSE 0 END AS trend_efficiency_ratio,
    CASE WHEN sum(path) FILTER (no <= 12) > 0 THEN abs(any_value(close) FILTER (no = least(12, n)) - any_value(first_open)) / sum(path) FILTER (no <= 12) ELSE 0 END AS morning_trend_efficiency_ratio""",
)
query("directional_consistency", "directional_consistency", "coalesce(avg(CASE WHEN sign(step) = day_sign THEN 1.0 ELSE 0.0 END) FILTER (step <> 0 AND day_sign <> 0), 0) AS directional_consistency")
query(
    "extreme_timing",
    "low_in_first_hour_flag high_time_bucket low_time_bucket high_before_low_flag",
    """CASE WHEN first(no ORDER BY low, no) - 1 < least(12, any_value(n)) THEN 1.0 ELSE 0.0 END AS low_in_first_hour_flag,
    least(floor((first(no ORDER BY high DESC, no) - 1) * 1.0 / any_value(n) * 8) + 1, 8) AS high_time_bucket,
    least(floor((first(no ORDER BY low, no) - 1) * 1.0 / any_value(n) * 8) + 1, 8) AS low_time_bucket,
    CASE WHEN first(no ORDER BY high DESC, no) < first(no ORDER BY low, no) THEN 1.0 ELSE 0.0 END AS high_before_low_flag""",
)
add(
    "running_vwap",
    lambda s, d: text(I.running_gap(hourly(s, d)).select("code", "datetime", "gap"), "datetime"),
    f"WITH {PREPARED} SELECT code, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, gap FROM b2",
    "gap",
)
query(
    "vwap_crosses",
    "vwap close_vwap_gap max_vwap_gap mean_abs_vwap_gap vwap_above_ratio vwap_below_ratio vwap_cross_count",
    """sum(close * volume) / nullif(sum(volume), 0) AS vwap, any_value(last_close) / (sum(close * volume) / nullif(sum(volume), 0)) - 1 AS close_vwap_gap,
    max(abs(gap)) AS max_vwap_gap, avg(abs(gap)) AS mean_abs_vwap_gap, avg(CASE WHEN gap > 0 THEN 1.0 ELSE 0.0 END) FILTER (gap IS NOT NULL) AS vwap_above_ratio,
    avg(CASE WHEN gap < 0 THEN 1.0 ELSE 0.0 END) FILTER (gap IS NOT NULL) AS vwap_below_ratio, coalesce(sum(crossed), 0) AS vwap_cross_count""",
)
_REGIME = " ".join(f"open{w}_{k}" for w in (6, 12) for k in ("low_return", "negative_vwap_ratio", "vwap_cross_count", "vwap_dominant_side_ratio"))
query(
    "opening_vwap_regime",
    _REGIME,
    ", ".join(
        f"""min(low) FILTER ({_head(w)}) / any_value(first_open) - 1 AS open{w}_low_return,
    avg(CASE WHEN gap < 0 THEN 1.0 ELSE 0.0 END) FILTER ({_head(w)} AND gap IS NOT NULL) AS open{w}_negative_vwap_ratio,
    coalesce(sum(crossed) FILTER ({_head(w)}), 0) AS open{w}_vwap_cross_count,
    greatest(avg(CASE WHEN gap < 0 THEN 1.0 ELSE 0.0 END) FILTER ({_head(w)} AND gap IS NOT NULL), avg(CASE WHEN gap > 0 THEN 1.0 ELSE 0.0 END) FILTER ({_head(w)} AND gap IS NOT NULL)) AS open{w}_vwap_dominant_side_ratio"""
        for w in (6, 12)
    ),
)
query("vwap_reversion_events", "reversion_count_after_large_deviation", "sum(reverted) AS reversion_count_after_large_deviation")
query(
    "volatility_path",
    "realized_volatility tail_volatility range_first_half range_second_half",
    """sqrt(sum(log_return * log_return)) AS realized_volatility, stddev_pop(log_return) FILTER (no > n - 6) * sqrt(least(6, any_value(n))) AS tail_volatility,
    max(high) FILTER (no <= n // 2) / min(low) FILTER (no <= n // 2) - 1 AS range_first_half, max(high) FILTER (no > n // 2) / min(low) FILTER (no > n // 2) - 1 AS range_second_half""",
)
query("drawdown_runup", "max_drawdown_intraday max_runup_intraday", "max(1 - close / top) AS max_drawdown_intraday, max(close / bottom - 1) AS max_runup_intraday")
query(
    "volume_ratios",
    "opening_volume_ratio opening_volume_shock opening_breakout_strength early_volume_ratio midday_volume_ratio last_volume_ratio",
    f"""sum(volume) FILTER ({_head(4)}) / nullif(sum(volume), 0) AS opening_volume_ratio, sum(volume) FILTER ({_head(4)}) / 4 / nullif(sum(volume) / any_value(n), 0) AS opening_volume_shock,
    (any_value(close) FILTER (no = 4) - any_value(first_open)) / nullif(any_value(day_high) - any_value(day_low), 0) AS opening_breakout_strength,
    coalesce(sum(volume) FILTER ({_head(6)}), 0) / nullif(sum(volume), 0) AS early_volume_ratio,
    coalesce(sum(volume) FILTER (n > 12 AND no > 6 AND no <= n - 6), 0) / nullif(sum(volume), 0) AS midday_volume_ratio,
    coalesce(sum(volume) FILTER (no > n - 6 AND n >= 6), 0) / nullif(sum(volume), 0) AS last_volume_ratio""",
)
query(
    "volume_spikes",
    "volume_spike_count volume_zscore_close zero_volume_bar_ratio",
    """coalesce(sum(CASE WHEN volume > typical_volume * 3 THEN 1.0 ELSE 0.0 END), 0) AS volume_spike_count,
    CASE WHEN stddev_pop(volume) FILTER (volume > 0) > 0 THEN (any_value(last_volume) - avg(volume) FILTER (volume > 0)) / stddev_pop(volume) FILTER (volume > 0)
      WHEN count(*) FILTER (volume > 0) > 0 THEN 0 END AS volume_zscore_close, avg(CASE WHEN volume = 0 THEN 1.0 ELSE 0.0 END) AS zero_volume_bar_ratio""",
)
query("amihud", "amihud_mean amihud_p90", "avg(illiquidity) AS amihud_mean, quantile_cont(illiquidity, 0.9) AS amihud_p90")
query(
    "proxy_ofi",
    "proxy_ofi_sum proxy_ofi_mean proxy_ofi_persistence",
    """sum(ofi) AS proxy_ofi_sum, avg(ofi) AS proxy_ofi_mean,
    avg(CASE WHEN sign(ofi) = ofi_sign THEN 1.0 ELSE 0.0 END) FILTER (ofi <> 0 AND ofi_sign <> 0) AS proxy_ofi_persistence""",
)
query(
    "close_recovery",
    "close_recovery_ratio",
    """CASE WHEN any_value(first_open) - min(low) FILTER (no <= 12) > 0
      THEN (any_value(last_close) - min(low) FILTER (no <= 12)) / (any_value(first_open) - min(low) FILTER (no <= 12)) ELSE 1 END AS close_recovery_ratio""",
)
add(
    "volume_profile",
    lambda s, d: features(s, d).select("code", "date", "volume_profile_skewness", "volume_profile_kurtosis"),
    f"""WITH {PREPARED}, p AS (SELECT code, date, bin, sum(volume) AS w, any_value(day_low) + (any_value(day_high) - any_value(day_low)) / 10 * (bin - 0.5::DOUBLE) AS x
      FROM b2 WHERE bin IS NOT NULL AND volume > 0 GROUP BY code, date, bin),
      m AS (SELECT code, date, sum(w * x) / sum(w) AS mu, count(*) AS k FROM p GROUP BY code, date),
      v AS (SELECT code, date, any_value(k) AS k, sum(w * (x - mu) ** 2) / sum(w) AS m2, sum(w * (x - mu) ** 3) / sum(w) AS m3, sum(w * (x - mu) ** 4) / sum(w) AS m4
        FROM p JOIN m USING (code, date) GROUP BY code, date)
      SELECT g.code, g.date, CASE WHEN k >= 2 THEN CASE WHEN m2 <= 0 THEN 0 ELSE m3 / sqrt(m2) ** 3 END END AS volume_profile_skewness,
        CASE WHEN k >= 2 THEN CASE WHEN m2 <= 0 THEN 0 ELSE m4 / sqrt(m2) ** 4 - 3 END END AS volume_profile_kurtosis
      FROM (SELECT DISTINCT code, date FROM b2) g LEFT JOIN v USING (code, date)""",
    "volume_profile_skewness volume_profile_kurtosis",
)
_M = "(date_part('hour', datetime) * 60 + date_part('minute', datetime))"
_CLOCK = {"opening": f"{_M} BETWEEN 565 AND 600", "am": f"{_M} <= 690", "pm": f"{_M} >= 780", "last": f"{_M} BETWEEN 870 AND 900"}


def _ret(k: str) -> str:
    return f"last(close ORDER BY datetime) FILTER ({_CLOCK[k]}) / first(open ORDER BY datetime) FILTER ({_CLOCK[k]}) - 1"


_VWAP = "CASE WHEN sum(amount) <> 0 AND sum(volume) > 0 THEN sum(amount) / sum(volume) END"
_FIRST = "first(open ORDER BY datetime)"
add(
    "clock_features",
    lambda s, d: I.clock_features(hourly(s, d)),
    f"""WITH {BARS} SELECT code, date, count(*) AS bar_count, {_ret('opening')} AS open30_return, max(high) FILTER ({_CLOCK['opening']}) / min(low) FILTER ({_CLOCK['opening']}) - 1 AS open30_range,
      {_ret('am')} AS am_return, {_ret('pm')} AS pm_return, {_ret('last')} AS last30_return, max(high) / min(low) - 1 AS intraday_range, last(close ORDER BY datetime) / {_FIRST} - 1 AS day_return,
      {_VWAP} AS vwap, last(close ORDER BY datetime) / ({_VWAP}) - 1 AS close_vwap_gap, coalesce(sum(volume) FILTER ({_CLOCK['opening']}), 0) / nullif(sum(volume), 0) AS open30_volume_ratio,
      sum(amount) FILTER ({_CLOCK['opening']}) / nullif(sum(amount), 0) AS open30_amount_ratio, max(high) FILTER ({_CLOCK['am']}) / {_FIRST} - 1 AS morning_high_break,
      min(low) FILTER ({_CLOCK['pm']}) / {_FIRST} - 1 AS afternoon_low_break FROM bars GROUP BY code, date""",
    "open30_return open30_range am_return pm_return last30_return intraday_range day_return vwap close_vwap_gap open30_volume_ratio open30_amount_ratio morning_high_break afternoon_low_break",
)


def regimes(s, d):
    """Features with the step of the day and the regime flags."""
    return I.regime(D.grid_step(features(s, d)), I.HOURLY)


_FLAGS = "flag_deep_selloff flag_negative_vwap_persistent flag_poor_recovery flag_weak_opening flag_heavy_opening flag_close_weak"
_MORE = "hostile_soft_score flag_hostile_regime flag_reversion_failure flag_large_vwap_deviation flag_large_drawdown flag_afternoon_reversal flag_strong_tail"
_D = "PARTITION BY code ORDER BY date"


def _one(cond: str, name: str) -> str:
    return f"CASE WHEN {cond} THEN 1.0 ELSE 0.0 END AS {name}"


REGIME = PREPARED + f""", f0 AS (
  SELECT code, date, any_value(n) AS n, any_value(day_high) AS high, any_value(day_low) AS low, any_value(last_close) AS close, any_value(first_open) AS first_open,
    min(low) FILTER ({_head(12)}) / any_value(first_open) - 1 AS low_return, avg(CASE WHEN gap < 0 THEN 1.0 ELSE 0.0 END) FILTER ({_head(12)} AND gap IS NOT NULL) AS negative,
    min(low) FILTER (no <= 12) AS hour_low, any_value(close) FILTER (no = 4) / any_value(first_open) - 1 AS opening, sum(volume) FILTER ({_head(4)}) / nullif(sum(volume), 0) AS heavy,
    first(no ORDER BY low, no) AS low_no, max(abs(gap)) AS max_gap, sum(reverted) AS reverted, max(1 - close / top) AS drawdown,
    any_value(close) FILTER (no = least(12, n)) / any_value(first_open) - 1 AS am, any_value(last_close) / any_value(open) FILTER (no = 13) - 1 AS pm,
    any_value(last_close) / any_value(open) FILTER (no = n - 5 AND n >= 6) - 1 AS tail FROM b2 GROUP BY code, date),
f1 AS (SELECT *, greatest(high - low, abs(high - lag(close) OVER ({_D})), abs(low - lag(close) OVER ({_D}))) AS tr FROM f0),
f2 AS (SELECT *, coalesce(CASE WHEN count(tr) OVER ({_D} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) >= 5 THEN avg(tr) OVER ({_D} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END, avg(tr) OVER ({_D})) AS atr FROM f1),
f3 AS (SELECT *, greatest(0.015, 1.4 * least(greatest(atr / close * 0.4, 0.008), 0.035)) AS least_drop,
    CASE WHEN first_open > hour_low THEN (close - hour_low) / (first_open - hour_low) ELSE 1 END AS recovery FROM f2),
f4 AS (SELECT *, {_one('low_return <= -least_drop', 'flag_deep_selloff')}, {_one('negative >= 0.68', 'flag_negative_vwap_persistent')}, {_one('recovery <= 0.55', 'flag_poor_recovery')},
    {_one('opening <= -0.006', 'flag_weak_opening')}, {_one('heavy >= 0.08', 'flag_heavy_opening')}, {_one('close / first_open - 1 <= -0.008', 'flag_close_weak')},
    {_one('low_no - 1 < least(12, n)', 'early_low')} FROM f3),
regime AS (SELECT code, date, {_FLAGS.replace(' ', ', ')}, early_low + {_FLAGS.replace(' ', ' + ')} AS hostile_soft_score,
    {_one(f"early_low + {_FLAGS.replace(' ', ' + ')} >= 6", 'flag_hostile_regime')}, {_one('max_gap >= 0.01 AND reverted <= 0 AND negative >= 0.68', 'flag_reversion_failure')},
    {_one('max_gap >= 0.01', 'flag_large_vwap_deviation')}, {_one('drawdown >= 0.02', 'flag_large_drawdown')}, {_one('am <= -0.01 AND pm >= 0.01', 'flag_afternoon_reversal')}, {_one('tail >= 0.01', 'flag_strong_tail')} FROM f4)"""
add("hostile_regime_score", lambda s, d: regimes(s, d).select("code", "date", *(_FLAGS + " " + _MORE).split()), f"WITH {REGIME} SELECT * FROM regime", _FLAGS + " " + _MORE)
_R = [f for f in (_FLAGS + " " + _MORE).split() if f.startswith("flag")]
add(
    "regime_rates",
    lambda s, d: D.rates(regimes(s, d), tuple(_R), ROLLING).select("code", "date", *(f"{f}_rate_{n}d" for f in _R for n in ROLLING)),
    f"WITH {REGIME} SELECT code, date, " + ", ".join(f"avg({f}) OVER ({_D} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {f}_rate_{n}d" for f in _R for n in ROLLING) + " FROM regime",
    " ".join(f"{f}_rate_{n}d" for f in _R for n in ROLLING),
)


def _day_frame(s, d, cond: str):
    """Ticks that meet a condition as one daily series."""
    return B.daily_summary(B.from_ticks(S.ticks(s, d).filter(cond).withColumn("code", F.lit("all"))), None).select("date", "open", "high", "low", "close")


def event_features(s, d):
    """The feature table over hourly bars of the events; other parts of the events stand for the index, the sector and foreign sessions."""
    sessions = [_day_frame(s, d, f"seq % 2 = {k}").select(F.col("date").alias("session"), "close") for k in (0, 1)]
    overnight = J.overnight_factors(*sessions, S.ticks(s, d).select("date"))
    return feature_table(hourly(s, d), _day_frame(s, d, "true"), _day_frame(s, d, "seq % 3 = 0"), overnight, I.HOURLY)


def _series(name: str, cond: str) -> str:
    return f"""{name} AS (SELECT date, first(price ORDER BY datetime, seq) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY datetime, seq) AS close
      FROM ticks WHERE price > 0 AND {cond} GROUP BY date)"""


def _spread(e: str) -> str:
    return f"daily_return - {e}_daily_return AS stk_{e}_return_spread, gap_pct - {e}_gap_pct AS stk_{e}_gap_spread, close_to_ma20 - {e}_close_to_ma20 AS stk_{e}_close_to_ma20_spread"


_ON_TOP = ", ".join(
    [
        _spread("idx"), _spread("sec"), "idx_daily_return - sec_daily_return AS idx_sec_return_spread", "idx_gap_pct - sec_gap_pct AS idx_sec_gap_spread",
        *(_one(f"daily_return - {e}_daily_return <= -{WEAKNESS}", f"flag_relative_weak_vs_{e}") for e in ("idx", "sec")),
        *(_one(f"gap_pct > 0 AND {e}_gap_pct <= 0", f"flag_gap_up_without_{n}_confirmation") for e, n in (("idx", "index"), ("sec", "sector"))),
    ]
)
_OWN = "open high low close volume pre_close daily_return daily_range gap_pct atr atr_pct grid_step_pct ma5 ma10 ma20 ma60 vol_ma5 vol_ma20 close_to_ma20 close_to_ma60".split()
_ENV = [f"{e}_{c}" for e in ("idx", "sec") for c in ("close", "daily_return", "daily_range", "gap_pct", "ma5", "ma20", "close_to_ma20")]
_NIGHT = [f"overnight_{c}" for c in ("first_return", "second_return", "mean_return", "relative_strength_spread", "gap_risk_bucket", "direction_agreement_flag")]


def _w(n: int) -> str:
    return f"OVER ({_D} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_ROLL = rolled(I.HOURLY)
_BLOCK = [f"{c}_{k}_{n}d" for c in _ROLL for n in ROLLING for k in ("mean", "std")] + [f"{c}_rate_{n}d" for c in RATED for n in ROLLING]
_BLOCK_SQL = [x for c in _ROLL for n in ROLLING for x in (f"avg({c}) {_w(n)} AS {c}_mean_{n}d", f"CASE WHEN count({c}) {_w(n)} >= 2 THEN stddev_pop({c}) {_w(n)} END AS {c}_std_{n}d")]
_BLOCK_SQL += [f"avg({c}) {_w(n)} AS {c}_rate_{n}d" for c in RATED for n in ROLLING]
TABLE = REGIME + f""", ft AS (SELECT code, date, {', '.join(SELECTS)}, any_value(first_open) AS open, any_value(day_high) AS high, any_value(day_low) AS low, any_value(last_close) AS close, any_value(day_volume) AS volume
    FROM b2 GROUP BY code, date),
ft1 AS (SELECT *, lag(close) OVER ({_D}) AS pre_close, greatest(high - low, abs(high - lag(close) OVER ({_D})), abs(low - lag(close) OVER ({_D}))) AS tr FROM ft),
ft2 AS (SELECT *, close / nullif(pre_close, 0) - 1 AS daily_return, (high - low) / nullif(pre_close, 0) AS daily_range, open / nullif(pre_close, 0) - 1 AS gap_pct,
    coalesce(CASE WHEN count(tr) {_w(20)} >= 5 THEN avg(tr) {_w(20)} END, avg(tr) OVER ({_D})) AS atr,
    {', '.join(f'avg(close) {_w(n)} AS ma{n}' for n in (5, 10, 20, 60))}, {', '.join(f'avg(volume) {_w(n)} AS vol_ma{n}' for n in (5, 20))} FROM ft1),
ft3 AS (SELECT *, atr / close AS atr_pct, least(greatest(atr / close * 0.4, 0.008), 0.035) AS grid_step_pct, close / ma20 - 1 AS close_to_ma20, close / ma60 - 1 AS close_to_ma60 FROM ft2),
{_series('ship', 'true')}, {_series('segment', 'seq % 3 = 0')}, {environment_sql()},
sF AS (SELECT date AS session, last(price ORDER BY datetime, seq) AS close FROM ticks WHERE price > 0 AND seq % 2 = 0 GROUP BY date),
sO AS (SELECT date AS session, last(price ORDER BY datetime, seq) AS close FROM ticks WHERE price > 0 AND seq % 2 = 1 GROUP BY date),
calendar AS (SELECT DISTINCT date FROM ticks), {{mapped}},
night AS (SELECT date, a.r AS overnight_first_return, b.r AS overnight_second_return, (a.r + b.r) / 2 AS overnight_mean_return, a.r - b.r AS overnight_relative_strength_spread,
    CASE WHEN greatest(abs(a.r), abs(b.r)) < 0.01 THEN 0 WHEN greatest(abs(a.r), abs(b.r)) < 0.02 THEN 1 WHEN greatest(abs(a.r), abs(b.r)) < 0.035 THEN 2 ELSE 3 END AS overnight_gap_risk_bucket,
    CASE WHEN sign(a.r) = sign(b.r) THEN 1 ELSE 0 END AS overnight_direction_agreement_flag FROM fF a JOIN fO b USING (date)),
ft4 AS (SELECT ft3.*, regime.* EXCLUDE (code, date), {', '.join(f'{e}.{c} AS {e}_{c}' for e in ('idx', 'sec') for c in ('close', 'daily_return', 'daily_range', 'gap_pct', 'ma5', 'ma20', 'close_to_ma20'))}, night.* EXCLUDE (date)
    FROM ft3 JOIN regime ON regime.code = ft3.code AND regime.date = ft3.date LEFT JOIN idx ON idx.date = ft3.date LEFT JOIN sec ON sec.date = ft3.date LEFT JOIN night ON night.date = ft3.date),
ft5 AS (SELECT *, {_ON_TOP} FROM ft4)"""


def many_bars(s, d):
    """All events as one instrument with bars of six minutes: days of up to 240 bars, as the default parts are made for."""
    return B.from_ticks(S.ticks(s, d).withColumn("code", F.lit("all")), minutes=6)


_P = I.DayParts()
_HEAD_COLUMNS = [f"open{w}_{k}" for w in _P.heads for k in ("return", "range")]
_SIDE_COLUMNS = [f"open{w}_{k}" for w in _P.sides for k in ("low_return", "negative_vwap_ratio", "vwap_cross_count", "vwap_dominant_side_ratio")]
_PART_COLUMNS = "am_return pm_return last_return tail_volatility opening_volume_ratio opening_volume_shock opening_breakout_strength early_volume_ratio midday_volume_ratio last_volume_ratio close_recovery_ratio reversion_count_after_large_deviation".split()


def _side(w: int) -> str:
    negative, positive = (f"avg(CASE WHEN gap {x} 0 THEN 1.0 ELSE 0.0 END) FILTER ({_head(w)} AND gap IS NOT NULL)" for x in "<>")
    return f"""min(low) FILTER ({_head(w)}) / any_value(first_open) - 1 AS open{w}_low_return, {negative} AS open{w}_negative_vwap_ratio,
      coalesce(sum(crossed) FILTER ({_head(w)}), 0) AS open{w}_vwap_cross_count, greatest({negative}, {positive}) AS open{w}_vwap_dominant_side_ratio"""


def _default_parts_sql() -> str:
    early, hour = _P.sides
    m, t, v = _P.morning, _P.tail, _P.volume_head
    bars = f"""bars AS (SELECT 'all' AS code, date, date_trunc('hour', datetime) + to_minutes(CAST(floor(date_part('minute', datetime) / 6) * 6 AS BIGINT)) AS datetime, first(price ORDER BY datetime, seq) AS open,
      max(price) AS high, min(price) AS low, last(price ORDER BY datetime, seq) AS close, sum(volume) AS volume, sum(amount) AS amount FROM ticks WHERE price > 0 GROUP BY 1, 2, 3)"""
    prepared = bars + PREPARED[len(BARS):].replace("1 FOLLOWING AND 6 FOLLOWING", f"1 FOLLOWING AND {_P.reversion} FOLLOWING")
    low = f"min(low) FILTER (no <= {hour})"
    return f"""WITH {TICKS}, {prepared} SELECT code, date, {', '.join(map(_open, _P.heads))}, {', '.join(map(_side, _P.sides))},
      any_value(close) FILTER (no = least({m}, n)) / any_value(first_open) - 1 AS am_return, any_value(last_close) / any_value(open) FILTER (no = {m + 1}) - 1 AS pm_return,
      any_value(last_close) / any_value(open) FILTER (no = n - {t - 1} AND n >= {t}) - 1 AS last_return, stddev_pop(log_return) FILTER (no > n - {t}) * sqrt(least({t}, any_value(n))) AS tail_volatility,
      sum(volume) FILTER ({_head(v)}) / nullif(sum(volume), 0) AS opening_volume_ratio, sum(volume) FILTER ({_head(v)}) / {v} / nullif(sum(volume) / any_value(n), 0) AS opening_volume_shock,
      (any_value(close) FILTER (no = {v}) - any_value(first_open)) / nullif(any_value(day_high) - any_value(day_low), 0) AS opening_breakout_strength,
      coalesce(sum(volume) FILTER ({_head(early)}), 0) / nullif(sum(volume), 0) AS early_volume_ratio, coalesce(sum(volume) FILTER (n > {2 * early} AND no > {early} AND no <= n - {early}), 0) / nullif(sum(volume), 0) AS midday_volume_ratio,
      coalesce(sum(volume) FILTER (no > n - {t} AND n >= {t}), 0) / nullif(sum(volume), 0) AS last_volume_ratio,
      CASE WHEN any_value(first_open) - {low} > 0 THEN (any_value(last_close) - {low}) / (any_value(first_open) - {low}) ELSE 1 END AS close_recovery_ratio, sum(reverted) AS reversion_count_after_large_deviation
      FROM b2 GROUP BY code, date"""


_DEFAULT = _HEAD_COLUMNS + _SIDE_COLUMNS + _PART_COLUMNS
add("default_day_parts", lambda s, d: I.features(many_bars(s, d)).select("code", "date", *_DEFAULT), _default_parts_sql(), " ".join(_DEFAULT))


def _register_table() -> None:
    from .foundation import MAPPED

    base = [*_OWN, *_ENV, *_NIGHT, *(f"stk_{e}_{x}_spread" for e in ("idx", "sec") for x in ("return", "gap", "close_to_ma20")), "idx_sec_return_spread", "idx_sec_gap_spread", "hostile_soft_score", *RATED]
    base += [c for c in _ROLL if c not in base and not c.startswith("overnight")]
    sql = TABLE.replace("{mapped}", MAPPED)
    exact = {"overnight_gap_risk_bucket", "overnight_direction_agreement_flag"}
    add("feature_table", lambda s, d: event_features(s, d).select("code", "date", *base), f"WITH {sql} SELECT code, date, {', '.join(base)} FROM ft5", " ".join(c for c in base if c not in exact))
    add("rolling_block", lambda s, d: event_features(s, d).select("code", "date", *_BLOCK), f"WITH {sql} SELECT code, date, {', '.join(_BLOCK_SQL)} FROM ft5", " ".join(_BLOCK))


_register_table()
