"""SQL of the inputs that several oracles share, and the same inputs as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bars as B
from ..sources import tables as S

TICKS = """ticks AS (
  SELECT event_type AS code, CAST(ts AS DATE) AS date, ts AS datetime, event_id AS seq, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         value * CAST(json_extract_string(props, '$.k') AS DOUBLE) AS amount
  FROM events)"""
BARS = TICKS + """, bars AS (
  SELECT code, date, date_trunc('hour', datetime) AS datetime, first(price ORDER BY datetime, seq) AS open, max(price) AS high,
         min(price) AS low, last(price ORDER BY datetime, seq) AS close, sum(volume) AS volume, sum(amount) AS amount,
         count(*) AS n_ticks, last(price ORDER BY datetime, seq) AS price
  FROM ticks WHERE price > 0 GROUP BY code, date, date_trunc('hour', datetime))"""
DAYS = BARS + """, days AS (
  SELECT code, date, min(datetime) AS first_datetime, max(datetime) AS last_datetime, count(*) AS bar_count,
         first(open ORDER BY datetime) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY datetime) AS close,
         sum(volume) AS volume, sum(amount) AS amount, last(price ORDER BY datetime) AS price,
         count_if(volume = 0) AS zero_volume_bar_count, count_if(amount = 0) AS zero_amount_bar_count
  FROM bars GROUP BY code, date)"""
SERIES = """series AS (
  SELECT o_orderpriority AS code, CAST(o_orderdate AS DATE) AS date, first(o_totalprice ORDER BY o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, last(o_totalprice ORDER BY o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS volume, sum(o_totalprice) AS amount
  FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE))"""
_SHIP = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
ENVIRONMENTS = f"""ship AS (
  SELECT CAST(l_shipdate AS DATE) AS date, first(l_extendedprice ORDER BY {_SHIP}) AS open, max(l_extendedprice) AS high,
         min(l_extendedprice) AS low, last(l_extendedprice ORDER BY {_SHIP}) AS close FROM lineitem GROUP BY CAST(l_shipdate AS DATE)),
segment AS (
  SELECT CAST(o_orderdate AS DATE) AS date, first(o_totalprice ORDER BY o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, last(o_totalprice ORDER BY o_orderkey) AS close
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY CAST(o_orderdate AS DATE))"""


def environment_sql() -> str:
    """idx and sec, the features of the daily series ship and segment."""
    e = "ORDER BY date"
    return ", ".join(
        f"""{n}0 AS (SELECT *, lag(close) OVER ({e}) AS pre_close, avg(close) OVER ({e} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma5, avg(close) OVER ({e} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma20 FROM {t}),
{n} AS (SELECT date, close, close / nullif(pre_close, 0) - 1 AS daily_return, (high - low) / nullif(pre_close, 0) AS daily_range, open / nullif(pre_close, 0) - 1 AS gap_pct, ma5, ma20, close / nullif(ma20, 0) - 1 AS close_to_ma20 FROM {n}0)"""
        for n, t in (("idx", "ship"), ("sec", "segment"))
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.from_ticks(S.ticks(spark, sf_dir))


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.daily_summary(hourly(spark, sf_dir), 24)


def text(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, whatever time zone a reader has."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})
