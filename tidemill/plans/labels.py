"""Queries on labels and the grid replay, over hourly bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import daily as D
from ..operators import labels as L
from ..operators.replay import Market
from .common import BARS, TICKS, days, hourly
from .intraday import many_bars
from .registry import add

#: Ticks of the events table are few, so an order may take more than a bar's volume.
REPLAY = Market(share_of_bar=2.0)

_D = "PARTITION BY code ORDER BY date"
_W = "PARTITION BY code, date ORDER BY datetime"
_SO_FAR = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_ALL = "OVER (PARTITION BY code, date)"
_WHOLE = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
_AHEAD = f"OVER ({_W} ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING)"


def _over(n: int) -> str:
    return f"OVER ({_D} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


STATS = BARS + f""", b0 AS (
  SELECT *, row_number() OVER ({_W}) AS no, count(*) {_ALL} AS n, first_value(open) {_WHOLE} AS first_open, last_value(close) {_WHOLE} AS last_close,
    CASE WHEN sum(volume) {_SO_FAR} > 0 THEN close / (sum(close * volume) {_SO_FAR} / sum(volume) {_SO_FAR}) - 1 END AS gap FROM bars),
b1 AS (SELECT *, coalesce(lag(close) OVER ({_W}), first_open) AS prev, coalesce(lag(sign(gap)) OVER ({_W}), 2) AS sign_before, lag(gap) OVER ({_W}) AS gap_before,
    min(abs(gap)) {_AHEAD} AS nearest, min(sign(gap)) {_AHEAD} AS least_sign, max(sign(gap)) {_AHEAD} AS most_sign FROM b0),
b2 AS (SELECT *, CASE WHEN gap IS NULL THEN 0 WHEN sign(gap) <> sign_before AND sign(gap) <> 0 AND sign_before <> 0 THEN 1 ELSE 0 END AS crossed,
    coalesce(abs(gap) >= 0.01 AND NOT coalesce(abs(gap_before) >= 0.01 AND sign(gap_before) = sign(gap), false) AND nearest IS NOT NULL, false) AS event,
    abs(gap) - nearest AS capture, coalesce(CASE WHEN gap > 0 THEN least_sign < 0 WHEN gap < 0 THEN most_sign > 0 END, false) AS other_side FROM b1),
stats AS (SELECT code, date, any_value(n) AS n, any_value(first_open) AS o, any_value(last_close) AS c, max(high) AS h, min(low) AS l,
    any_value(close) FILTER (no = least(4, n)) AS opening_close, sum(volume) FILTER (no <= 4) / nullif(sum(volume), 0) AS opening_volume_ratio, sum(abs(close - prev)) AS path,
    min(low) FILTER (no <= 6) AS early_low, min(low) FILTER (no <= 12) AS late_low, first(no ORDER BY low, no) - 1 AS low_index, sum(crossed) AS cross_count,
    coalesce(avg(CASE WHEN gap > 0 THEN 1.0 ELSE 0.0 END) FILTER (gap IS NOT NULL), 0) AS above, coalesce(avg(CASE WHEN gap < 0 THEN 1.0 ELSE 0.0 END) FILTER (gap IS NOT NULL), 0) AS below,
    count(*) FILTER (event) AS event_count,
    count(*) FILTER (event AND capture >= 0.005 AND (other_side OR nearest <= greatest(0.003, abs(gap) * (1 - 0.6::DOUBLE)))) AS success_count,
    coalesce(greatest(max(capture) FILTER (event), 0), 0) AS max_capture, coalesce(max(abs(gap)) FILTER (event), 0) AS max_event_gap FROM b2 GROUP BY code, date),
d0 AS (SELECT code, date, c AS close, h, l, greatest(abs(h - l), abs(h - lag(c) OVER ({_D})), abs(l - lag(c) OVER ({_D}))) AS tr, (h - l) / c AS rp FROM stats),
d1 AS (SELECT code, date, close, coalesce(CASE WHEN count(tr) {_over(20)} >= 5 THEN least(greatest(avg(tr) {_over(20)} / close * 0.4, 0.008), 0.035) END,
    least(greatest(avg(rp) {_over(5)} * 0.4, 0.008), 0.035), 0.008) AS s, lead(date) OVER ({_D}) AS next_date FROM d0),
p0 AS (SELECT d1.code, d1.date, d1.next_date, d1.close, d1.s, stats.* EXCLUDE (code, date) FROM d1 JOIN stats ON d1.code = stats.code AND d1.next_date = stats.date),
p AS (SELECT *, o / close - 1 AS next_gap_return, h / close - 1 AS target_upside, l / close - 1 AS target_downside, l / o - 1 AS target_downside_from_open,
    l / greatest(close, o) - 1 AS target_downside_from_max_anchor FROM p0),
flagged AS (SELECT *, CAST(target_downside > 0 AS INTEGER) AS downside_positive_flag, CAST(target_downside > 0.03 AS INTEGER) AS downside_large_positive_flag,
    CAST(target_upside > 0.10 AS INTEGER) AS upside_extreme_flag, CAST(abs(next_gap_return) > 0.08 AS INTEGER) AS large_gap_flag,
    CAST((target_downside > 0.03 AND target_upside > 0.10) OR abs(next_gap_return) > 0.08 AS INTEGER) AS suspicious_flag FROM p)"""
_QTY = "CASE WHEN volume > 0 THEN least(100, CAST(floor(floor(volume * 2.0::DOUBLE) / 100) AS BIGINT) * 100) ELSE 0 END"
_CLOSED = """CASE WHEN side > 0 THEN ({p} * 0.999 - entry) * qty - cost - {p} * 0.999 * qty * 0.0007 ELSE (entry - {p} * 1.001) * qty - cost - {p} * 1.001 * qty * 0.0002 END"""
REPLAYED = "RECURSIVE " + STATS + f""", rb AS (SELECT f.code, f.date, f.close AS anchor, f.close * (1 - f.s) AS buy, f.close * (1 + f.s) AS sell, b.no, b.high, b.low, b.close AS bc, b.volume, {_QTY} AS q
  FROM flagged f JOIN b0 b ON b.code = f.code AND b.date = f.next_date),
st AS (
  SELECT code, date, CAST(0 AS BIGINT) AS no, 0 AS side, CAST(0 AS DOUBLE) AS entry, CAST(0 AS BIGINT) AS qty, CAST(0 AS DOUBLE) AS cost, CAST(0 AS DOUBLE) AS pnl,
    0 AS trips, 0 AS longs, 0 AS shorts, 0 AS both_, 0 AS skipped, CAST(0 AS BIGINT) AS filled FROM flagged
  UNION ALL
  SELECT code, date, no, CASE WHEN opened THEN CASE WHEN long THEN 1 ELSE -1 END WHEN done THEN 0 ELSE side END,
    CASE WHEN opened THEN price ELSE entry END, CASE WHEN opened THEN q ELSE qty END, CASE WHEN opened THEN price * q * CASE WHEN long THEN 0.0002 ELSE 0.0007 END ELSE cost END,
    CASE WHEN done THEN pnl + {_CLOSED.format(p='anchor')} ELSE pnl END, trips + CAST(done AS INTEGER), longs + CAST(opened AND long AS INTEGER), shorts + CAST(opened AND NOT long AS INTEGER),
    both_ + CAST(opened AND lo AND hi AS INTEGER), skipped + CAST(touched AND NOT opened AS INTEGER), filled + CASE WHEN opened THEN q ELSE 0 END
  FROM (SELECT *, CASE WHEN long THEN buy * 1.001 ELSE sell * 0.999 END AS price FROM (
    SELECT st.* EXCLUDE (no), r.no, r.q, r.anchor, r.buy, r.sell, r.low <= r.buy AS lo, r.high >= r.sell AS hi, st.side = 0 AND (r.low <= r.buy OR r.high >= r.sell) AS touched,
      st.side = 0 AND (r.low <= r.buy OR r.high >= r.sell) AND r.q > 0 AS opened,
      CASE WHEN r.low <= r.buy AND r.high >= r.sell THEN r.bc - r.buy * 1.001 <= r.sell * 0.999 - r.bc ELSE r.low <= r.buy END AS long,
      (st.side > 0 AND r.high >= r.anchor) OR (st.side < 0 AND r.low <= r.anchor) AS done
    FROM st JOIN rb r ON r.code = st.code AND r.date = st.date AND r.no = st.no + 1))),
ended AS (SELECT f.code, f.date, f.close AS anchor, f.c AS last_close, st.* EXCLUDE (code, date) FROM flagged f JOIN st ON st.code = f.code AND st.date = f.date AND st.no = f.n),
replayed AS (SELECT code, date, (CASE WHEN side <> 0 THEN pnl + {_CLOSED.format(p='last_close')} ELSE pnl END) / (anchor * 100) AS grid_pnl,
    CASE WHEN side <> 0 THEN pnl + {_CLOSED.format(p='last_close')} ELSE pnl END AS grid_pnl_cash, CAST(trips AS BIGINT) AS round_trips, CAST(longs AS BIGINT) AS long_entries,
    CAST(shorts AS BIGINT) AS short_entries, CAST(both_ AS BIGINT) AS ambiguous_entries, CAST(skipped AS BIGINT) AS skipped_touches, CAST(filled AS BIGINT) AS filled_shares,
    CAST(side <> 0 AS BIGINT) AS forced_close FROM ended),
l0 AS (SELECT f.*, r.* EXCLUDE (code, date), CAST(r.grid_pnl > 0 AS INTEGER) AS positive_grid_day, CAST(r.grid_pnl > 0 AND r.round_trips >= 1 AS INTEGER) AS tradable,
    greatest(above, below) AS side_ratio,
    CAST(success_count >= 2 AND max_capture >= 0.011 AND cross_count >= 3 AND greatest(above, below) <= 0.85 AS INTEGER) AS vwap_reversion FROM flagged f JOIN replayed r USING (code, date)),
l1 AS (SELECT *, c / o - 1 AS open_close_return, opening_close / o - 1 AS opening_return, CASE WHEN h > l THEN (c - l) / (h - l) ELSE 0.5 END AS close_location,
    CASE WHEN h > l THEN abs(c - o) / (h - l) ELSE 0 END AS directional_efficiency, CASE WHEN path > 0 THEN abs(c - o) / path ELSE 0 END AS path_efficiency,
    greatest(0.015, s * 1.25) AS least_move, CAST(tradable = 0 OR vwap_reversion = 0 AS INTEGER) AS hostile_context, CAST(sign(c / o - 1) AS INTEGER) AS trend_direction FROM l0),
l2 AS (SELECT *, CASE WHEN trend_direction > 0 THEN close_location >= 0.8 WHEN trend_direction < 0 THEN close_location <= 1 - 0.8::DOUBLE ELSE false END AS at_extreme,
    coalesce(sign(opening_return) = trend_direction, false) AS aligned FROM l1),
l3 AS (SELECT *, CAST(trend_direction <> 0 AS INTEGER) + CAST(abs(open_close_return) >= least_move AS INTEGER) + CAST(directional_efficiency >= 0.35 AS INTEGER)
    + CAST(path_efficiency >= 0.12 AS INTEGER) + CAST(abs(opening_return) >= 0.004 AND aligned AS INTEGER) + CAST(coalesce(opening_volume_ratio >= 0.08, false) AS INTEGER)
    + CAST(side_ratio >= 0.60 AS INTEGER) + CAST(cross_count <= 12 AS INTEGER) + CAST(at_extreme AS INTEGER) AS trend_soft_score,
    CAST(hostile_context = 1 AND trend_direction <> 0 AND abs(open_close_return) >= least_move AND directional_efficiency >= 0.55 AND path_efficiency >= 0.32
      AND abs(opening_return) >= 0.008 AND aligned AND coalesce(opening_volume_ratio >= 0.14, false) AND side_ratio >= 0.70 AND cross_count <= 6 AND at_extreme AS INTEGER) AS trend_break_extreme FROM l2),
l4 AS (SELECT *, CAST(hostile_context = 1 AND trend_direction <> 0 AND side_ratio >= 0.84 AND cross_count <= 6 AND (path_efficiency >= 0.12 OR trend_soft_score >= 8) AS INTEGER) AS trend_break_soft FROM l3),
l5 AS (SELECT *, greatest(trend_break_extreme, trend_break_soft) AS trend_break_risk, greatest(close, o) AS anchor FROM l4),
l6 AS (SELECT *, early_low / anchor - 1 AS early_low_return, late_low / anchor - 1 AS late_low_return, c / anchor - 1 AS close_vs_anchor, CAST(low_index < least(12, n) AS INTEGER) AS low_in_first_hour,
    CASE WHEN anchor > late_low THEN (c - late_low) / (anchor - late_low) ELSE 1 END AS recovery, greatest(0.015, s * 1.4) AS least_drop,
    CAST(trend_break_risk = 1 AND trend_direction < 0 AS INTEGER) AS negative_trend FROM l5),
l7 AS (SELECT *, CAST(early_low_return <= -least_drop AS INTEGER) + CAST(late_low_return <= -least_drop AS INTEGER) + low_in_first_hour + CAST(opening_return <= -0.006 AS INTEGER)
    + CAST(coalesce(opening_volume_ratio >= 0.08, false) AS INTEGER) + CAST(below >= 0.68 AS INTEGER) + CAST(recovery <= 0.55 AS INTEGER) + CAST(close_vs_anchor <= -0.008 AS INTEGER)
    + CAST(tradable = 0 AS INTEGER) + CAST(vwap_reversion = 0 AS INTEGER) + negative_trend AS selloff_score,
    CAST(early_low_return <= -least_drop AND low_in_first_hour = 1 AND below >= 0.68 AND recovery <= 0.55 AND negative_trend = 1 AS INTEGER) AS selloff_extreme FROM l6),
l8 AS (SELECT *, CAST(hostile_context = 1 AND (early_low_return <= -least_drop OR late_low_return <= -least_drop) AND selloff_score >= 6
    AND (opening_return <= -0.006 OR close_vs_anchor <= -0.008 OR negative_trend = 1) AS INTEGER) AS selloff_soft FROM l7),
labels AS (SELECT *, greatest(selloff_extreme, selloff_soft) AS hostile_selloff_risk FROM l8)"""


def table(s, d):
    return L.label_table(hourly(s, d), None, L.HOURLY, REPLAY)


def table_of_days(s, d):
    """The same from a table of days that is given, as a store of daily summaries would give it."""
    today = D.label_step(days(s, d)).select("code", "date", "close", "grid_step_pct")
    return L.label_table(hourly(s, d), today, L.HOURLY, REPLAY)


def query(name: str, columns: str, floats: str, cte: str = REPLAYED, source: str = "labels") -> None:
    names = columns.split()
    add(name, lambda s, d: table(s, d).select("code", "date", "next_date", *names), f"WITH {cte} SELECT code, date, next_date, {', '.join(names)} FROM {source}", floats)


_TARGETS = "next_gap_return target_upside target_downside target_downside_from_open target_downside_from_max_anchor"
_ANOMALIES = "downside_positive_flag downside_large_positive_flag upside_extreme_flag large_gap_flag suspicious_flag"
query("price_targets", _TARGETS, _TARGETS, STATS, "flagged")
query("anomaly_flags", _ANOMALIES, "", STATS, "flagged")
add(
    "anomaly_audit",
    lambda s, d: L.anomaly_audit(table(s, d)),
    f"WITH {STATS} SELECT code, " + ", ".join(f"CAST(sum({f}) AS BIGINT) AS {k}_days, avg({f}) AS {k}_ratio" for k, f in (("downside_positive", "downside_positive_flag"), ("downside_large_positive", "downside_large_positive_flag"), ("upside_extreme", "upside_extreme_flag"), ("large_gap", "large_gap_flag"), ("abnormal_jump", "CAST(target_downside > 0.03 AND target_upside > 0.10 AS INTEGER)"))) + " FROM flagged GROUP BY code",
    " ".join(f"{k}_ratio" for k in ("downside_positive", "downside_large_positive", "upside_extreme", "large_gap", "abnormal_jump")),
)
add(
    "anomaly_samples",
    lambda s, d: L.anomaly_samples(table(s, d)).select("code", "date", "sample", "target_upside"),
    f"WITH {STATS} SELECT code, date, CAST(row_number() OVER (PARTITION BY code ORDER BY date) AS INTEGER) AS sample, target_upside FROM flagged WHERE suspicious_flag = 1 QUALIFY row_number() OVER (PARTITION BY code ORDER BY date) <= 20",
    "target_upside",
)
_STAT = "mean deviation least p10 p50 p90 most"
add(
    "describe_stats",
    lambda s, d: L.describe(table(s, d), ("target_upside", "target_downside", "grid_pnl")),
    f"WITH {REPLAYED} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS deviation, min({c}) AS least, quantile_cont({c}, 0.1) AS p10, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.9) AS p90, max({c}) AS most FROM labels" for c in ("target_upside", "target_downside", "grid_pnl")),
    _STAT,
)
query("grid_replay", "grid_pnl grid_pnl_cash round_trips long_entries short_entries ambiguous_entries skipped_touches filled_shares forced_close positive_grid_day tradable", "grid_pnl grid_pnl_cash")
query("vwap_reversion_label", "vwap_reversion event_count success_count max_capture max_event_gap side_ratio", "max_capture max_event_gap side_ratio")
query("trend_break_label", "trend_break_risk trend_break_extreme trend_break_soft trend_soft_score hostile_context trend_direction open_close_return directional_efficiency path_efficiency opening_return opening_volume_ratio close_location", "open_close_return directional_efficiency path_efficiency opening_return opening_volume_ratio close_location")
query("hostile_selloff_label", "hostile_selloff_risk selloff_extreme selloff_soft selloff_score negative_trend low_in_first_hour early_low_return late_low_return close_vs_anchor recovery below", "early_low_return late_low_return close_vs_anchor recovery below")
add("labels_of_given_days", lambda s, d: table_of_days(s, d).select("code", "date", "next_date", "grid_pnl", "round_trips", "vwap_reversion", "trend_break_risk", "hostile_selloff_risk"), f"WITH {REPLAYED} SELECT code, date, next_date, grid_pnl, round_trips, vwap_reversion, trend_break_risk, hostile_selloff_risk FROM labels", "grid_pnl")
#: Ticks of the events table in hundreds of shares, so that a fill of the published share of a bar is possible.
_HUNDRED = 100


def minute_table(s, d):
    """Labels and replay as published: days of up to 240 bars, the default parts, five in a hundred of a bar's volume."""
    return L.label_table(many_bars(s, d).withColumn("volume", F.col("volume") * _HUNDRED))


def _minute_sql() -> str:
    """The hourly labels' SQL over bars of six minutes, its places and the fill share replaced by the published ones."""
    p, hour = L.LabelBars(), L.HOURLY
    bars = f"""bars AS (SELECT 'all' AS code, date, date_trunc('hour', datetime) + to_minutes(CAST(floor(date_part('minute', datetime) / 6) * 6 AS BIGINT)) AS datetime, first(price ORDER BY datetime, seq) AS open,
      max(price) AS high, min(price) AS low, last(price ORDER BY datetime, seq) AS close, sum(volume) * {_HUNDRED} AS volume FROM ticks WHERE price > 0 GROUP BY 1, 2, 3)"""
    rest = REPLAYED[len("RECURSIVE ") + len(BARS):]
    places = [
        (f"1 FOLLOWING AND {hour.ahead} FOLLOWING", f"1 FOLLOWING AND {p.ahead} FOLLOWING"), (f"no = least({hour.opening}, n)", f"no = least({p.opening}, n)"), (f"(no <= {hour.opening})", f"(no <= {p.opening})"),
        (f"(no <= {hour.late})", f"(no <= {p.late})"), (f"(no <= {hour.early})", f"(no <= {p.early})"),
        (f"low_index < least({hour.late}, n)", f"low_index < least({p.late}, n)"), (f"volume * {REPLAY.share_of_bar}::DOUBLE", f"volume * {Market().share_of_bar}::DOUBLE"),
    ]
    for old, new in places:
        rest = rest.replace(old, new)
    return f"RECURSIVE {TICKS}, {bars}{rest}"


_PUBLISHED = f"{_TARGETS} grid_pnl round_trips long_entries short_entries ambiguous_entries skipped_touches filled_shares forced_close positive_grid_day tradable vwap_reversion event_count success_count side_ratio trend_break_risk trend_soft_score opening_volume_ratio hostile_selloff_risk selloff_score early_low_return late_low_return recovery"
add("labels_of_many_bars", lambda s, d: minute_table(s, d).select("code", "date", "next_date", *_PUBLISHED.split()), f"WITH {_minute_sql()} SELECT code, date, next_date, {', '.join(_PUBLISHED.split())} FROM labels", f"{_TARGETS} grid_pnl side_ratio opening_volume_ratio early_low_return late_low_return recovery")
