"""Queries on sources, cleaning, aggregation, daily windows and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import bars as B
from ..operators import daily as D
from ..operators import joins as J
from ..sources import tables as S
from .common import BARS, DAYS, ENVIRONMENTS, SERIES, TICKS, days, environment_sql, hourly, text
from .registry import add

OHLC = "open high low close volume amount price"

add(
    "daily_ohlcv_summary",
    lambda s, d: text(days(s, d), "first_datetime", "last_datetime"),
    f"""WITH {DAYS} SELECT code, date, strftime(first_datetime, '%Y-%m-%d %H:%M:%S') AS first_datetime,
      strftime(last_datetime, '%Y-%m-%d %H:%M:%S') AS last_datetime, bar_count, open, high, low, close, volume, amount, price,
      zero_volume_bar_count, zero_amount_bar_count, zero_volume_bar_count / bar_count AS zero_volume_bar_ratio,
      zero_amount_bar_count / bar_count AS zero_amount_bar_ratio, 24 AS expected_bar_count, bar_count = 24 AS is_complete_day FROM days""",
    OHLC + " zero_volume_bar_ratio zero_amount_bar_ratio",
)
add(
    "bar_completeness",
    lambda s, d: days(s, d).groupBy("code").agg(F.count("*").alias("n_days"), F.count_if("is_complete_day").alias("complete_days"), F.min("bar_count").alias("fewest_bars")),
    f"WITH {DAYS} SELECT code, count(*) AS n_days, count_if(bar_count = 24) AS complete_days, min(bar_count) AS fewest_bars FROM days GROUP BY code",
)


def dirty(s, d):
    """Ticks as bars with faults: unreadable times, repeated times, negative volumes, missing prices, broken opens, other stamps."""
    t = S.ticks(s, d)
    k = F.col("seq")
    return t.select(
        F.when(k % 41 == 0, None).otherwise(F.date_trunc("minute", "datetime").cast("timestamp_ntz")).alias("datetime"),
        "code", "seq",
        F.when(k % 7 == 0, 0.0).when(k % 31 == 0, None).otherwise(F.col("price")).alias("open"),
        (F.col("price") + 1).alias("high"),
        F.when(k % 13 == 0, -1.0).otherwise(F.col("price")).alias("low"),
        F.when(k % 53 == 0, None).otherwise(F.col("price") + 0.5).alias("close"),
        F.when(k % 17 == 0, -F.col("volume") - 1).otherwise(F.col("volume")).alias("volume"),
        F.abs("amount").alias("amount"),
        F.when(k % 5 == 0, 0.0).otherwise(F.col("price")).alias("price"),
    )


DIRTY = TICKS + """, dirty AS (
  SELECT CASE WHEN seq % 41 = 0 THEN NULL ELSE date_trunc('minute', datetime) END AS datetime, code, seq,
         CASE WHEN seq % 7 = 0 THEN 0.0 WHEN seq % 31 = 0 THEN NULL ELSE price END AS open, price + 1 AS high,
         CASE WHEN seq % 13 = 0 THEN -1.0 ELSE price END AS low, CASE WHEN seq % 53 = 0 THEN NULL ELSE price + 0.5 END AS close,
         CASE WHEN seq % 17 = 0 THEN -volume - 1 ELSE volume END AS volume, abs(amount) AS amount,
         CASE WHEN seq % 5 = 0 THEN 0.0 ELSE price END AS price FROM ticks)"""
CLEAN = DIRTY + """, latest AS (
  SELECT *, CAST(datetime AS DATE) AS date FROM dirty WHERE datetime IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY code, datetime ORDER BY seq DESC) = 1),
kept AS (SELECT * FROM latest WHERE volume >= 0 AND amount >= 0 AND high > 0 AND low > 0 AND close > 0),
repaired AS (SELECT * REPLACE (CASE WHEN open IS NULL OR open <= 0
    THEN coalesce(lag(close) OVER (PARTITION BY code, date ORDER BY datetime), close) ELSE open END AS open) FROM kept)"""
_MIN = "(date_part('hour', datetime) * 60 + date_part('minute', datetime))"
CANON = CLEAN + f""", canon AS (
  SELECT datetime, date, code, open, high, low, close, volume, amount, CASE WHEN price > 0 THEN price ELSE close END AS price
  FROM repaired WHERE open > 0 AND ({_MIN} BETWEEN 571 AND 690 OR {_MIN} BETWEEN 781 AND 900))"""
STAMP = "strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime"

add("clean_bars", lambda s, d: text(B.canonical(dirty(s, d)), "datetime"), f"WITH {CANON} SELECT * REPLACE ({STAMP}) FROM canon", OHLC)
add(
    "dedupe_last",
    lambda s, d: text(B.dedupe(dirty(s, d).filter("datetime IS NOT NULL"), ("code", "datetime")).select("code", "datetime", "seq"), "datetime"),
    f"WITH {DIRTY} SELECT code, {STAMP}, max(seq) AS seq FROM dirty WHERE datetime IS NOT NULL GROUP BY code, dirty.datetime",
)
add(
    "dedupe_first",
    lambda s, d: text(B.dedupe(dirty(s, d).filter("datetime IS NOT NULL"), ("code", "datetime"), keep="first").select("code", "datetime", "seq"), "datetime"),
    f"WITH {DIRTY} SELECT code, {STAMP}, min(seq) AS seq FROM dirty WHERE datetime IS NOT NULL GROUP BY code, dirty.datetime",
)
add(
    "open_repair",
    lambda s, d: text(B.repair_open(B.clean(dirty(s, d)).withColumn("date", F.to_date("datetime")), within_day=False).select("code", "datetime", "open"), "datetime"),
    f"""WITH {CLEAN} SELECT code, {STAMP}, CASE WHEN open IS NULL OR open <= 0
      THEN coalesce(lag(close) OVER (PARTITION BY code ORDER BY kept.datetime), close) ELSE open END AS open FROM kept""",
    "open",
)
add(
    "infer_frequency",
    lambda s, d: B.frequency(hourly(s, d)).withColumn("expected_bars", B.expected_bars(F.col("seconds"))),
    f"""WITH {BARS}, steps AS (SELECT code, CAST(epoch(datetime) - lag(epoch(datetime)) OVER (PARTITION BY code ORDER BY datetime) AS BIGINT) AS seconds FROM bars),
      counted AS (SELECT code, seconds, count(*) AS n FROM steps WHERE seconds > 0 GROUP BY code, seconds)
      SELECT code, first(seconds ORDER BY n DESC, seconds) AS seconds,
        CASE WHEN 14400 % first(seconds ORDER BY n DESC, seconds) = 0 THEN CAST(14400 / first(seconds ORDER BY n DESC, seconds) AS INTEGER) END AS expected_bars FROM counted GROUP BY code""",
)
add(
    "audit_counts",
    lambda s, d: B.audit(dirty(s, d), days(s, d)).withColumn("codes", F.array_join("codes", ",")).withColumn("first_incomplete", F.array_join("first_incomplete", ",")),
    f"""WITH {DIRTY}, {DAYS[len(TICKS) + 2:]},
      rep AS (SELECT count(*) - count(DISTINCT (code, datetime)) AS repeated_times FROM dirty WHERE datetime IS NOT NULL),
      inc AS (SELECT code, date FROM days WHERE bar_count <> 24 ORDER BY date, code LIMIT 20)
      SELECT (SELECT count(*) FROM dirty) AS rows_in, (SELECT count_if(datetime IS NULL) FROM dirty) AS invalid_datetime,
        (SELECT count_if(volume < 0) FROM dirty) AS negative_volume, (SELECT count_if(high <= 0 OR low <= 0 OR close <= 0) FROM dirty) AS invalid_prices,
        (SELECT count_if(open <= 0) FROM dirty) AS broken_opens, (SELECT string_agg(DISTINCT code, ',' ORDER BY code) FROM dirty) AS codes,
        (SELECT CAST(repeated_times AS BIGINT) FROM rep) AS repeated_times, count(*) AS n_days, count_if(bar_count <> 24) AS incomplete_days,
        min(bar_count) AS min_bars, max(bar_count) AS max_bars, quantile_cont(bar_count, 0.5) AS median_bars, avg(bar_count) AS mean_bars,
        coalesce((SELECT string_agg(CAST(date AS VARCHAR) || ' ' || code, ',' ORDER BY date, code) FROM inc), '') AS first_incomplete FROM days""",
    "median_bars mean_bars",
)
_DIRTY_COLUMNS = ["datetime", "code", "seq", "open", "high", "low", "close", "volume", "amount", "price"]
add(
    "missing_ratio",
    lambda s, d: B.missing_ratio(dirty(s, d)),
    f"WITH {DIRTY} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_share FROM dirty" for c in _DIRTY_COLUMNS),
    "missing_share",
)
add("bars_per_day", lambda s, d: B.bars_per_day(hourly(s, d)), f"WITH {DAYS} SELECT code, avg(bar_count) AS mean_bars, min(bar_count) AS min_bars, max(bar_count) AS max_bars FROM days GROUP BY code", "mean_bars")
add(
    "symbol_normalisation",
    lambda s, d: S.table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("SZ "), F.lpad(F.col("c_custkey").cast("string"), 6, "3"))).otherwise(F.col("c_custkey").cast("string")).alias("raw")).select("c_custkey", X.symbol("raw").alias("symbol"), X.exchange_symbol("raw").alias("exchange_symbol")),
    """WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 6, '3') ELSE lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS symbol FROM customer)
      SELECT c_custkey, symbol, symbol || CASE WHEN symbol[1] IN ('0','2','3') THEN '.SZ' WHEN symbol[1] IN ('5','6','9') THEN '.SS' WHEN symbol[1] IN ('4','8') THEN '.BJ' ELSE '' END AS exchange_symbol FROM r""",
)
add(
    "kline_text_parse",
    lambda s, d: S.parse_klines(S.order_days(s, d).select(F.concat_ws(",", F.col("date").cast("string"), *(F.col(c).cast("string") for c in ("open", "close", "high", "low", "volume", "amount")), F.when(F.col("volume") > 2, "x").otherwise("")).alias("line")).unionAll(s.createDataFrame([("broken,1,2",)], "line string"))),
    f"WITH {SERIES} SELECT date, open, close, high, low, volume, amount FROM series",
    "open close high low volume amount",
)
add(
    "month_ranges",
    lambda s, d: S.order_days(s, d).agg(F.min("date").alias("a"), F.max("date").alias("z")).select(F.explode(X.month_ranges("a", "z")).alias("m")).select("m.first", "m.last"),
    f"""WITH {SERIES}, e AS (SELECT min(date) AS a, max(date) AS z FROM series),
      m AS (SELECT CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', z), INTERVAL 1 MONTH)) AS DATE) AS m, a, z FROM e)
      SELECT greatest(m, a) AS first, least(last_day(m), z) AS last FROM m""",
)

series = S.order_days
OVER = "OVER (PARTITION BY code ORDER BY date)"


def over(n: int) -> str:
    return f"OVER (PARTITION BY code ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


RETURNS = f"""r0 AS (SELECT *, lag(close) {OVER} AS pre_close FROM series),
returns AS (SELECT *, close / nullif(pre_close, 0) - 1 AS daily_return, (high - low) / nullif(pre_close, 0) AS daily_range, open / nullif(pre_close, 0) - 1 AS gap_pct FROM r0)"""
RANGES = f"ranges AS (SELECT *, greatest(abs(high - low), abs(high - lag(close) {OVER}), abs(low - lag(close) {OVER})) AS true_range FROM series)"
ATR = f"CASE WHEN count(true_range) {over(20)} >= 5 THEN avg(true_range) {over(20)} END"

add("daily_returns", lambda s, d: D.returns(series(s, d)).select("code", "date", "pre_close", "daily_return", "daily_range", "gap_pct"), f"WITH {SERIES}, {RETURNS} SELECT code, date, pre_close, daily_return, daily_range, gap_pct FROM returns", "pre_close daily_return daily_range gap_pct")
add(
    "true_range_atr",
    lambda s, d: D.grid_step(series(s, d)).select("code", "date", "true_range", "atr", "atr_pct"),
    f"""WITH {SERIES}, {RANGES}, a AS (SELECT *, coalesce({ATR}, avg(true_range) {OVER}) AS atr FROM ranges) SELECT code, date, true_range, atr, atr / close AS atr_pct FROM a""",
    "true_range atr atr_pct",
)
add(
    "grid_step_feature",
    lambda s, d: D.grid_step(series(s, d)).select("code", "date", "grid_step_pct"),
    f"WITH {SERIES}, {RANGES}, a AS (SELECT *, coalesce({ATR}, avg(true_range) {OVER}) AS atr FROM ranges) SELECT code, date, least(greatest(atr / close * 0.4, 0.008), 0.035) AS grid_step_pct FROM a",
    "grid_step_pct",
)
STEPS = f"""{RANGES}, l0 AS (SELECT *, CASE WHEN close > 0 THEN (high - low) / close END AS daily_range_pct, {ATR} AS atr FROM ranges),
steps AS (SELECT *, coalesce(CASE WHEN atr IS NOT NULL THEN least(greatest(atr / close * 0.4, 0.008), 0.035) END,
  CASE WHEN avg(daily_range_pct) {over(5)} IS NOT NULL THEN least(greatest(avg(daily_range_pct) {over(5)} * 0.4, 0.008), 0.035) END, 0.008) AS grid_step_pct FROM l0)"""
add("grid_step_label", lambda s, d: D.label_step(series(s, d)).select("code", "date", "daily_range_pct", "atr", "grid_step_pct"), f"WITH {SERIES}, {STEPS} SELECT code, date, daily_range_pct, atr, grid_step_pct FROM steps", "daily_range_pct atr grid_step_pct")
_MA = ", ".join(f"avg(close) {over(n)} AS ma{n}" for n in (5, 10, 20, 60)) + ", " + ", ".join(f"avg(volume) {over(n)} AS vol_ma{n}" for n in (5, 20))
_MA_NAMES = "ma5 ma10 ma20 ma60 vol_ma5 vol_ma20"
add(
    "moving_averages",
    lambda s, d: D.averages(series(s, d)).select("code", "date", *_MA_NAMES.split(), "close_to_ma20", "close_to_ma60"),
    f"WITH {SERIES}, m AS (SELECT *, {_MA} FROM series) SELECT code, date, {_MA_NAMES.replace(' ', ', ')}, close / ma20 - 1 AS close_to_ma20, close / ma60 - 1 AS close_to_ma60 FROM m",
    _MA_NAMES + " close_to_ma20 close_to_ma60",
)
add(
    "full_window_average",
    lambda s, d: series(s, d).select("code", "date", *(D.full_average("close", n).alias(f"full_ma{n}") for n in (5, 20))),
    f"WITH {SERIES} SELECT code, date, " + ", ".join(f"CASE WHEN count(close) {over(n)} >= {n} THEN avg(close) {over(n)} END AS full_ma{n}" for n in (5, 20)) + " FROM series",
    "full_ma5 full_ma20",
)
_ROLL = [(c, n) for c in ("daily_return", "daily_range") for n in (3, 5, 10, 20)]
add(
    "rolling_mean_std",
    lambda s, d: D.rolling(D.returns(series(s, d)), ("daily_return", "daily_range"), (3, 5, 10, 20)).select("code", "date", *(f"{c}_{k}_{n}d" for c, n in _ROLL for k in ("mean", "std"))),
    f"WITH {SERIES}, {RETURNS} SELECT code, date, " + ", ".join(f"avg({c}) {over(n)} AS {c}_mean_{n}d, CASE WHEN count({c}) {over(n)} >= 2 THEN stddev_pop({c}) {over(n)} END AS {c}_std_{n}d" for c, n in _ROLL) + " FROM returns",
    " ".join(f"{c}_{k}_{n}d" for c, n in _ROLL for k in ("mean", "std")),
)
add(
    "event_rates",
    lambda s, d: D.rates(D.returns(series(s, d)).withColumn("flag_up", X.flag(F.col("daily_return") > 0.01)).withColumn("flag_gap", X.flag(F.col("gap_pct") < -0.01)), ("flag_up", "flag_gap"), (3, 5, 10, 20)).select("code", "date", *(f"{f}_rate_{n}d" for f in ("flag_up", "flag_gap") for n in (3, 5, 10, 20))),
    f"""WITH {SERIES}, {RETURNS}, f AS (SELECT *, CASE WHEN daily_return > 0.01 THEN 1.0 ELSE 0.0 END AS flag_up, CASE WHEN gap_pct < -0.01 THEN 1.0 ELSE 0.0 END AS flag_gap FROM returns)
      SELECT code, date, """ + ", ".join(f"avg({f}) {over(n)} AS {f}_rate_{n}d" for f in ("flag_up", "flag_gap") for n in (3, 5, 10, 20)) + " FROM f",
    " ".join(f"{f}_rate_{n}d" for f in ("flag_up", "flag_gap") for n in (3, 5, 10, 20)),
)
add(
    "forward_fill",
    lambda s, d: D.forward_fill(series(s, d).withColumn("filled", F.when(F.col("volume") % 2 == 0, F.col("close"))), ("filled",)).select("code", "date", "filled"),
    f"WITH {SERIES} SELECT code, date, last_value(CASE WHEN volume % 2 = 0 THEN close END IGNORE NULLS) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM series",
    "filled",
)
add("next_day_targets", lambda s, d: D.next_high_return(series(s, d)).select("code", "date", "next_high_return"), f"WITH {SERIES} SELECT code, date, lead(high) {OVER} / close - 1 AS next_high_return FROM series QUALIFY lead(date) {OVER} IS NOT NULL", "next_high_return")
add(
    "ordinal_split",
    lambda s, d: D.ordinal_split(series(s, d), 0.2).select("code", "date", F.col("row_idx").cast("long").alias("row_idx"), "part"),
    f"WITH {SERIES} SELECT code, date, row_number() {OVER} - 1 AS row_idx, CASE WHEN row_number() {OVER} - 1 < floor(count(*) OVER (PARTITION BY code) * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM series",
)

ENV = f"{ENVIRONMENTS}, {environment_sql()}"


def environments(s, d):
    df = D.averages(D.returns(series(s, d)))
    df = J.with_environment(df, J.environment_features(S.ship_days(s, d)), "idx_")
    return J.with_environment(df, J.environment_features(S.segment_days(s, d)), "sec_")


add(
    "env_left_join",
    lambda s, d: environments(s, d).select("code", "date", "daily_return", "idx_daily_return", "idx_daily_range", "idx_ma5", "sec_daily_return", "sec_ma5", "sec_close_to_ma20"),
    f"""WITH {SERIES}, {RETURNS}, {ENV} SELECT r.code, r.date, r.daily_return, i.daily_return AS idx_daily_return, i.daily_range AS idx_daily_range, i.ma5 AS idx_ma5,
      s.daily_return AS sec_daily_return, s.ma5 AS sec_ma5, s.close_to_ma20 AS sec_close_to_ma20 FROM returns r LEFT JOIN idx i USING (date) LEFT JOIN sec s USING (date)""",
    "daily_return idx_daily_return idx_daily_range idx_ma5 sec_daily_return sec_ma5 sec_close_to_ma20",
)
_SPREADS = [f"stk_{e}_{k}_spread" for e in ("idx", "sec") for k in ("return", "gap", "close_to_ma20")] + ["flag_relative_weak_vs_idx", "flag_relative_weak_vs_sec", "flag_gap_up_without_index_confirmation", "flag_gap_up_without_sector_confirmation", "idx_sec_return_spread", "idx_sec_gap_spread"]
add(
    "relative_spreads",
    lambda s, d: J.relative_spreads(environments(s, d), 0.02).select("code", "date", *_SPREADS),
    f"""WITH {SERIES}, {RETURNS}, {ENV}, m AS (SELECT *, close / (avg(close) {over(20)}) - 1 AS close_to_ma20 FROM returns)
      SELECT r.code, r.date, """
    + ", ".join(f"r.daily_return - {e}.daily_return AS stk_{e}_return_spread, r.gap_pct - {e}.gap_pct AS stk_{e}_gap_spread, r.close_to_ma20 - {e}.close_to_ma20 AS stk_{e}_close_to_ma20_spread, "
                f"CASE WHEN r.daily_return - {e}.daily_return <= -0.02 THEN 1.0 ELSE 0.0 END AS flag_relative_weak_vs_{e}, "
                f"CASE WHEN r.gap_pct > 0 AND {e}.gap_pct <= 0 THEN 1.0 ELSE 0.0 END AS flag_gap_up_without_{n}_confirmation" for e, n in (("idx", "index"), ("sec", "sector")))
    + ", idx.daily_return - sec.daily_return AS idx_sec_return_spread, idx.gap_pct - sec.gap_pct AS idx_sec_gap_spread FROM m r LEFT JOIN idx USING (date) LEFT JOIN sec USING (date)",
    " ".join(_SPREADS),
)


def calendar(s, d):
    return S.table(s, d, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct().filter(F.dayofmonth("date") % 3 != 0)


CALENDAR = "calendar AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem WHERE date_part('day', l_shipdate) % 3 <> 0)"


def sessions(s, d, status):
    return S.table(s, d, "orders").filter(F.col("o_orderstatus") == status).groupBy(F.to_date("o_orderdate").alias("session")).agg(F.max_by("o_totalprice", "o_orderkey").alias("close"))


SESSIONS = ", ".join(f"s{k} AS (SELECT CAST(o_orderdate AS DATE) AS session, last(o_totalprice ORDER BY o_orderkey) AS close FROM orders WHERE o_orderstatus = '{k}' GROUP BY CAST(o_orderdate AS DATE))" for k in ("F", "O"))
MAPPED = ", ".join(
    f"""r{k} AS (SELECT session, close / nullif(lag(close) OVER (ORDER BY session), 0) - 1 AS r FROM s{k}),
m{k} AS (SELECT r{k}.session, r, c.date FROM r{k} ASOF JOIN calendar c ON r{k}.session < c.date WHERE r IS NOT NULL),
f{k} AS (SELECT date, last(r ORDER BY session) AS r FROM m{k} GROUP BY date)"""
    for k in ("F", "O")
)
add(
    "next_session_asof",
    lambda s, d: J.next_session(sessions(s, d, "F").select("session"), calendar(s, d)),
    f"WITH {CALENDAR}, {SESSIONS} SELECT session, c.date AS trade_date FROM sF ASOF JOIN calendar c ON sF.session < c.date",
)
add(
    "overnight_asof",
    lambda s, d: J.overnight_factors(sessions(s, d, "F"), sessions(s, d, "O"), calendar(s, d)),
    f"""WITH {CALENDAR}, {SESSIONS}, {MAPPED} SELECT date, a.r AS overnight_first_return, b.r AS overnight_second_return,
      CASE WHEN greatest(abs(a.r), abs(b.r)) < 0.01 THEN 0 WHEN greatest(abs(a.r), abs(b.r)) < 0.02 THEN 1 WHEN greatest(abs(a.r), abs(b.r)) < 0.035 THEN 2 ELSE 3 END AS overnight_gap_risk_bucket,
      (a.r + b.r) / 2 AS overnight_mean_return, a.r - b.r AS overnight_relative_strength_spread, CASE WHEN sign(a.r) = sign(b.r) THEN 1 ELSE 0 END AS overnight_direction_agreement_flag
      FROM fF a JOIN fO b USING (date)""",
    "overnight_first_return overnight_second_return overnight_mean_return overnight_relative_strength_spread",
)


def order_dates(s, d):
    return S.table(s, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()


DATES = "dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)"
SPARSE = "sparse AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem WHERE date_part('day', l_shipdate) = 7 AND date_part('month', l_shipdate) <> 5)"


def sparse(s, d):
    return S.table(s, d, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct().filter("day(date) = 7 AND month(date) <> 5")


add(
    "next_trading_day",
    lambda s, d: J.next_trading_day(order_dates(s, d), sparse(s, d)),
    f"""WITH {DATES}, {SPARSE} SELECT d.date, coalesce((SELECT min(c.date) FROM sparse c WHERE c.date > d.date AND c.date <= d.date + 30),
      d.date + CASE isodow(d.date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END) AS next_date FROM dates d""",
)
add("previous_trading_day", lambda s, d: J.previous_trading_day(order_dates(s, d), sparse(s, d)), f"WITH {DATES}, {SPARSE} SELECT d.date, (SELECT max(c.date) FROM sparse c WHERE c.date < d.date AND c.date >= d.date - 30) AS previous_date FROM dates d")
add(
    "expected_feature_date",
    lambda s, d: text(J.expected_date(S.table(s, d, "events").select(F.col("ts").alias("now")), S.table(s, d, "events").select(F.to_date("ts").alias("date")).distinct().filter("day(date) % 4 != 0")), "now"),
    """WITH c AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE date_part('day', ts) % 4 <> 0)
      SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS now, CASE WHEN date_part('hour', ts) >= 15 AND CAST(ts AS DATE) IN (SELECT date FROM c) THEN CAST(ts AS DATE)
        ELSE (SELECT max(date) FROM c WHERE date < CAST(ts AS DATE) AND date >= CAST(ts AS DATE) - 30) END AS expected FROM events""",
)
add("weekday_roll", lambda s, d: order_dates(s, d).select("date", X.weekday_after("date").alias("after"), X.weekday_before("date").alias("before")), f"WITH {DATES} SELECT date, date + CASE isodow(date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS after, date - CASE isodow(date) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS before FROM dates")
add(
    "incremental_upsert",
    lambda s, d: B.upsert(series(s, d).withColumn("seq", F.lit(0)).filter("volume != 1"), series(s, d).withColumn("seq", F.lit(0)).withColumn("close", F.col("close") * 2).filter("month(date) = 3"), ("code", "date")).select("code", "date", "close"),
    f"""WITH {SERIES} SELECT code, date, CASE WHEN date_part('month', date) = 3 THEN close * 2 ELSE close END AS close FROM series WHERE volume <> 1 OR date_part('month', date) = 3""",
    "close",
)
add("semi_join_count", lambda s, d: series(s, d).join(calendar(s, d), "date", "left_semi").groupBy("code").agg(F.count("*").alias("n")), f"WITH {SERIES}, {CALENDAR} SELECT code, count(*) AS n FROM series WHERE date IN (SELECT date FROM calendar) GROUP BY code")
add(
    "intersection_filter",
    lambda s, d: environments(s, d).filter("daily_return IS NOT NULL AND idx_daily_return IS NOT NULL AND sec_daily_return IS NOT NULL").select("code", "date"),
    f"WITH {SERIES}, {RETURNS}, {ENV} SELECT r.code, r.date FROM returns r JOIN idx USING (date) JOIN sec USING (date) WHERE r.daily_return IS NOT NULL AND idx.daily_return IS NOT NULL AND sec.daily_return IS NOT NULL",
)
add(
    "freshest_source",
    lambda s, d: J.freshest(S.order_days(s, d).withColumn("priority", F.substring("code", 1, 1).cast("int")).filter("priority != 1 OR year(date) < 1996"), F.expr("date'1998-01-01'")),
    f"""WITH {SERIES}, p AS (SELECT CAST(code[1] AS INTEGER) AS priority, max(date) AS last_date FROM series WHERE code[1] <> '1' OR date_part('year', date) < 1996 GROUP BY 1)
      SELECT priority, last_date, last_date >= DATE '1998-01-01' AS is_fresh FROM p
      ORDER BY is_fresh DESC, CASE WHEN is_fresh THEN NULL ELSE last_date END DESC, priority LIMIT 1""",
)
_WORDS = ("NATION_1", "_2", "ON", "7")
add(
    "board_name_match",
    lambda s, d: J.best_name_match(S.table(s, d, "nation"), "n_name", _WORDS),
    """WITH k AS (SELECT unnest(['NATION_1', '_2', 'ON', '7']) AS keyword),
      h AS (SELECT keyword, n_name, CASE WHEN n_name = keyword THEN 4 WHEN starts_with(n_name, keyword) OR suffix(n_name, keyword) THEN 3 ELSE 2 END AS r FROM nation, k WHERE contains(n_name, keyword))
      SELECT keyword, first(n_name ORDER BY r DESC, length(n_name), n_name DESC) AS name, count(*) AS n_candidates FROM h GROUP BY keyword""",
)
add("zero_open_patch", lambda s, d: text(B.patch_zero_open(dirty(s, d)).select("code", "seq", "open")), f"WITH {DIRTY} SELECT code, seq, CASE WHEN open = 0 THEN close ELSE open END AS open FROM dirty", "open")
add(
    "sum_min_count",
    lambda s, d: S.order_days(s, d).withColumn("x", F.when(F.col("volume") > 1, F.col("amount"))).groupBy("code", "date").agg(B.sum_or_missing("x").alias("amount_sum"), F.coalesce(B.sum_or_missing("x"), F.lit(0.0)).alias("amount_sum_or_zero")),
    f"WITH {SERIES} SELECT code, date, sum(CASE WHEN volume > 1 THEN amount END) AS amount_sum, coalesce(sum(CASE WHEN volume > 1 THEN amount END), 0) AS amount_sum_or_zero FROM series GROUP BY code, date",
    "amount_sum amount_sum_or_zero",
)
