"""Queries on sources and sinks, and on the pieces of the training frame. Files go to the shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import daily as D
from ..operators import heads as H
from ..operators import joins as J
from ..operators import segments as G
from ..operators.evaluate import HEADS
from ..sources import daily as Y
from ..sources import sinks as K
from ..sources import tables as S
from .common import SERIES, TICKS, text
from .evaluation import DECIDED, scored
from .foundation import CALENDAR, DIRTY, ENV, MAPPED, RETURNS, SESSIONS, calendar, dirty, environments, sessions
from .registry import add

series = S.order_days
_OHLC = "open high low close volume amount"
_HEADERS = {"date": "日期", "open": "开盘", "high": "最高", "low": "最低", "close": "收盘", "volume": "成交量", "amount": "成交额"}


def stored_csv(s, d):
    """The daily series as a CSV file with foreign headers."""
    path = K.work_path(s, "series.csv")
    K.write_csv(series(s, d).withColumnsRenamed(_HEADERS), path)
    return path


def csv_scan(s, d):
    df = S.read_csv(s, stored_csv(s, d), ("code", "date", *_OHLC.split()))
    price = S.first_present(df, ("adjusted_close", "close", "open"))
    return df.select("code", F.to_date("date").alias("date"), *(F.col(c).try_cast("double").alias(c) for c in _OHLC.split()), F.col(price).try_cast("double").alias("price"))


add("csv_scan", csv_scan, f"WITH {SERIES} SELECT code, date, open, high, low, close, volume, amount, close AS price FROM series", _OHLC + " price")


def csv_tolerant(s, d):
    """A file, a missing file, an empty one, one without the columns: which is usable, and how many rows it gives."""
    good, empty, other = stored_csv(s, d), K.work_path(s, "empty.csv"), K.work_path(s, "other.csv")
    K.write_csv(s.range(3).select(F.col("id").alias("x")), other)
    s.createDataFrame([], "value string").write.text(empty)
    out = None
    for name, path in (("good", good), ("missing", K.work_path(s, "none.csv")), ("empty", empty), ("other", other)):
        n = S.read_csv_or_empty(s, path, ("code", "date")).agg(F.count("*").alias("n_rows"))
        one = n.select(F.lit(name).alias("file"), F.lit(S.usable(s, path)).alias("usable"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


add(
    "csv_tolerant",
    csv_tolerant,
    f"WITH {SERIES} SELECT 'good' AS file, true AS usable, count(*) AS n_rows FROM series UNION ALL SELECT unnest(['missing', 'empty', 'other']), false, 0",
)
add(
    "table_sink",
    lambda s, d: _written(s, series(s, d)),
    f"WITH {SERIES} SELECT code, date, open, high, low, close, volume, amount FROM series",
    _OHLC,
)


def _written(s, df):
    path = K.work_path(s, "table")
    K.write_table(df, path, ("code",))
    return s.read.parquet(path)


def _lines(s, d, stamp: str):
    t = S.ticks(s, d)
    parts = ["price", "price", "price", "price", "volume", "amount"]
    line = F.concat_ws(",", F.date_format("datetime", stamp), *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in parts), F.when(F.col("seq") % 7 == 0, "n/a").otherwise(F.col("price").cast("string")))
    short = t.filter("seq % 100 = 0").select(F.lit("2024-01-01 10:00,1,2").alias("line"))
    return t.select(line.alias("line")).unionByName(short)


for _name, _stamp, _unit in (("minute_text_parse", "yyyy-MM-dd HH:mm:ss", "second"), ("minute_text_without_seconds", "yyyy-MM-dd HH:mm", "minute")):
    add(
        _name,
        lambda s, d, stamp=_stamp: text(S.parse_minutes(_lines(s, d, stamp)), "datetime"),
        f"""WITH {TICKS} SELECT strftime(date_trunc('{_unit}', datetime), '%Y-%m-%d %H:%M:%S') AS datetime, price AS open, price AS close, price AS high, price AS low, volume, amount,
          CASE WHEN seq % 7 = 0 THEN NULL ELSE price END AS price FROM ticks""",
        "open close high low volume amount price",
    )


def minute_rename(s, d):
    """Minute rows with a foreign stamp column and without amount and price: renamed, and filled as missing."""
    raw = S.ticks(s, d).select(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("day"), "code", *(F.col("price").cast("string").alias(c) for c in ("open", "high", "low", "close")), F.col("volume").cast("string").alias("volume"), F.lit(None).cast("string").alias("amount"))
    return text(S.typed_bars(S.rename_aliases(raw)), "datetime")


add(
    "minute_rename",
    minute_rename,
    f"WITH {TICKS} SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, code, price AS open, price AS high, price AS low, price AS close, volume, CAST(NULL AS DOUBLE) AS amount, CAST(NULL AS DOUBLE) AS price FROM ticks",
    "open high low close volume",
)


def snapshot(s, d):
    """One code's series with its last day made anew from a quote, and a day that was not there."""
    days = series(s, d).filter("code = '1-URGENT'").drop("code")
    last = days.agg(F.max("date").alias("date"))
    quote = last.select(F.explode(F.array("date", F.date_add("date", 1))).alias("date")).select("date", *(F.lit(float(k)).alias(c) for k, c in enumerate(("open", "high", "low", "close"))))
    return S.snapshot_row(days, quote)


add(
    "snapshot_row",
    snapshot,
    f"""WITH {SERIES}, u AS (SELECT * EXCLUDE (code) FROM series WHERE code = '1-URGENT'), m AS (SELECT max(date) AS date FROM u), q AS (SELECT date FROM m UNION ALL SELECT date + 1 FROM m)
      SELECT date, open, high, low, close, volume, amount FROM u WHERE date NOT IN (SELECT date FROM q) UNION ALL SELECT date, 0.0, 1.0, 2.0, 3.0, NULL, NULL FROM q""",
    _OHLC,
)
add("core_null_drop", lambda s, d: B.complete(dirty(s, d), "datetime", "open", "high", "low", "close").groupBy("code").agg(F.count("*").alias("n"), F.sum("seq").alias("seq_sum")), f"WITH {DIRTY} SELECT code, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seq_sum FROM dirty WHERE datetime IS NOT NULL AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL GROUP BY code")
_RANGE = ("1994-02-28", "1996-07-15")
add("date_range", lambda s, d: B.between(series(s, d), *(F.lit(x).cast("date") for x in _RANGE)).select("code", "date", "close"), f"WITH {SERIES} SELECT code, date, close FROM series WHERE date BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}'", "close")


def chunks(s, d):
    """The series in yearly chunks that overlap by a month, where the later chunk's rows differ."""
    df = series(s, d).withColumn("seq", F.lit(0))
    parts = [B.between(df, F.lit(f"{y}-01-01").cast("date"), F.lit(f"{y + 1}-01-31").cast("date")).withColumn("close", F.col("close") + y) for y in range(1992, 1999)]
    return B.in_chunks(parts, ("code", "date")).select("code", "date", "close")


add("chunked_union", chunks, f"WITH {SERIES} SELECT code, date, close + date_part('year', date) AS close FROM series WHERE date BETWEEN DATE '1992-01-01' AND DATE '1998-12-31' UNION ALL SELECT code, date, close + 1998 FROM series WHERE date BETWEEN DATE '1999-01-01' AND DATE '1999-01-31'", "close")


_PUSHED = "spark.sql.python.filterPushdown.enabled"


def daily_source(s, d):
    """One code's series out of a store by month, through the pluggable source: the filter's months are fetched, no others."""
    path = K.work_path(s, "months")
    K.write_table(series(s, d).withColumn("month", F.date_format("date", "yyyy-MM")), path, ("month",))
    s.dataSource.register(Y.DailyPushed)
    before = s.conf.get(_PUSHED, "false")
    s.conf.set(_PUSHED, "true")
    try:
        read = s.read.format("daily_pushed").options(fetch="tidemill.sources.daily:stored_month", source=path, symbol="1-URGENT", start="1992-01-01", end="1999-12-31").load()
        return K.stored(read.filter("date >= DATE '1994-02-10' AND date < DATE '1995-07-20'"), "fetched")
    finally:
        s.conf.set(_PUSHED, before)


add(
    "daily_source",
    daily_source,
    f"WITH {SERIES} SELECT code AS symbol, date, open, high, low, close, volume, amount FROM series WHERE code = '1-URGENT' AND date >= DATE '1994-02-10' AND date < DATE '1995-07-20'",
    _OHLC,
)
_NIGHT = "overnight_first_return overnight_second_return overnight_mean_return overnight_relative_strength_spread"
add(
    "overnight_left_join",
    lambda s, d: J.with_environment(series(s, d).select("code", "date", "close"), J.overnight_factors(sessions(s, d, "F"), sessions(s, d, "O"), calendar(s, d))),
    f"""WITH {SERIES}, {CALENDAR}, {SESSIONS}, {MAPPED} SELECT r.code, r.date, r.close, a.r AS overnight_first_return, b.r AS overnight_second_return,
      CASE WHEN greatest(abs(a.r), abs(b.r)) < 0.01 THEN 0 WHEN greatest(abs(a.r), abs(b.r)) < 0.02 THEN 1 WHEN greatest(abs(a.r), abs(b.r)) < 0.035 THEN 2 WHEN a.r IS NOT NULL THEN 3 END AS overnight_gap_risk_bucket,
      (a.r + b.r) / 2 AS overnight_mean_return, a.r - b.r AS overnight_relative_strength_spread, CASE WHEN a.r IS NULL THEN NULL WHEN sign(a.r) = sign(b.r) THEN 1 ELSE 0 END AS overnight_direction_agreement_flag
      FROM series r LEFT JOIN (SELECT date, fF.r FROM fF JOIN fO USING (date)) a USING (date) LEFT JOIN fO b ON b.date = a.date""",
    "close " + _NIGHT,
)
_FILLED = ("idx_close", "idx_ma5", "sec_close", "sec_ma5")
add(
    "env_join_filled",
    lambda s, d: D.forward_fill(environments(s, d).select("code", "date", *_FILLED), _FILLED),
    f"""WITH {SERIES}, {RETURNS}, {ENV}, j AS (SELECT r.code, r.date, idx.close AS idx_close, idx.ma5 AS idx_ma5, sec.close AS sec_close, sec.ma5 AS sec_ma5 FROM returns r LEFT JOIN idx USING (date) LEFT JOIN sec USING (date))
      SELECT code, date, """ + ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in _FILLED) + " FROM j",
    " ".join(_FILLED),
)


def training(s, d):
    """Features and labels of the orders' series in one frame, its features chosen and audited."""
    features = D.returns(series(s, d)).select("code", "date", "close", "daily_return", "gap_pct")
    labels = D.next_high_return(series(s, d)).withColumn("next_date", F.date_add("date", 1)).select("code", "date", "next_date", F.col("next_high_return").alias("target_upside"), "close", F.lit(0.5).alias("atr"))
    df = H.training_frame(features, labels, "code", "date")
    report = H.leakage_audit(df, H.feature_columns(df))
    return df.withColumn("features", F.lit(",".join(report["features"])))


add(
    "training_join",
    training,
    f"""WITH {SERIES}, {RETURNS} SELECT code, date, close, daily_return, gap_pct, date + 1 AS next_date, lead(high) OVER (PARTITION BY code ORDER BY date) / close - 1 AS target_upside, 'close,daily_return,gap_pct' AS features
      FROM returns QUALIFY lead(date) OVER (PARTITION BY code ORDER BY date) IS NOT NULL""",
    "close daily_return gap_pct target_upside",
)
_ALL_HEADS = ("upside", "downside", "grid_pnl", *HEADS)
_BUCKET = "CAST(greatest(1, ceil((row_number() OVER (PARTITION BY code ORDER BY pred_{h}, date) - 1) * 5 / (count(*) OVER (PARTITION BY code) - 1))) AS INTEGER) AS bucket_{h}"
add(
    "scored_test_set",
    lambda s, d: G.scored_table(scored(s, d), _ALL_HEADS, ("date",), "code").select("code", "date", "mode", "rationale", "position_scale", *(f"on_{h}" for h in HEADS), *(f"bucket_{h}" for h in _ALL_HEADS), "downside_error", "downside_abs_error"),
    f"""WITH {DECIDED} SELECT code, date, mode, rationale, position_scale, {', '.join(f'pred_{h} >= threshold_{h} AS on_{h}' for h in HEADS)}, {', '.join(_BUCKET.format(h=h) for h in _ALL_HEADS)},
      pred_downside - target_downside AS downside_error, abs(pred_downside - target_downside) AS downside_abs_error FROM decided""",
    "position_scale downside_error downside_abs_error",
)
