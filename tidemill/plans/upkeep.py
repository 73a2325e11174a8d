"""Queries on keeping a store: what it lacks, merges into its partitions, rows that do not parse, one long series in ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import backfill as B
from ..operators import daily as D
from ..operators import split_series as P
from ..sources import sinks as K
from ..sources import tables as S
from .common import SERIES, TICKS
from .registry import add

#: Orders of a day that make it complete, and the source that must have all days.
_LEAST, _HARD = 2, "1-URGENT"


def _lacks(s, d):
    stored = S.order_days(s, d).select(F.col("code").alias("source"), "date", F.col("volume").alias("n_bars"))
    calendar = S.table(s, d, "orders").select(F.to_date("o_orderdate").alias("date")).filter("dayofweek(date) BETWEEN 2 AND 6")
    names = stored.select("source").distinct().unionByName(s.createDataFrame([("9-NONE",)], "source string"))
    sources = names.select("source", F.lit("1995-01-01").cast("date").alias("since"), F.lit("1996-12-31").cast("date").alias("until"), (F.col("source") == _HARD).alias("is_hard"))
    return B.ranges_to_fetch(stored, sources, calendar, _LEAST), sources


LACKS = SERIES + f""", cal AS (SELECT date, row_number() OVER (ORDER BY date) AS o FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE isodow(CAST(o_orderdate AS DATE)) < 6)),
srcs AS (SELECT DISTINCT code AS source FROM series UNION ALL SELECT '9-NONE'),
need AS (SELECT source, date, o FROM srcs, cal WHERE date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'),
held AS (SELECT n.source, n.date, n.o, s.volume IS NOT NULL AS there, coalesce(s.volume, 0) >= {_LEAST} AS complete FROM need n LEFT JOIN series s ON s.code = n.source AND s.date = n.date),
bad AS (SELECT *, o - row_number() OVER (PARTITION BY source ORDER BY o) AS island FROM held WHERE NOT complete),
gaps AS (SELECT source, source = '{_HARD}' AS is_hard, min(date) AS from_date, max(date) AS to_date, count(*) FILTER (WHERE NOT there) AS n_missing, count(*) FILTER (WHERE there) AS n_incomplete FROM bad GROUP BY source, island)"""
add("backfill_ranges", lambda s, d: _lacks(s, d)[0], f"WITH {LACKS} SELECT * FROM gaps")
add(
    "backfill_state",
    lambda s, d: B.state(*_lacks(s, d)).drop("first_date"),
    f"""WITH {LACKS}, t AS (SELECT source, CAST(sum(n_missing + n_incomplete) AS BIGINT) AS n_days, count(*) AS n_ranges FROM gaps GROUP BY source)
      SELECT source, coalesce(n_days, 0) AS n_days, coalesce(n_ranges, 0) AS n_ranges, CASE WHEN n_ranges IS NULL THEN 'ok' WHEN source = '{_HARD}' THEN 'hard' ELSE 'soft' END AS verdict FROM srcs LEFT JOIN t USING (source)""",
)


def merged(s, d):
    """The daily series by year, into which later rows of some months are merged."""
    path = K.work_path(s, "store")
    df = S.order_days(s, d).select("code", "date", "close", F.lit(0).alias("seq"), F.year("date").alias("year"))
    K.write_table(df, path, ("year",))
    fresh = df.filter("month(date) = 3 AND year IN (1993, 1996)")
    fresh = fresh.withColumn("close", F.col("close") + 1).unionByName(fresh.withColumn("close", F.col("close") + 2).withColumn("seq", F.lit(1)).filter("dayofmonth(date) = 5"))
    fresh = fresh.unionByName(fresh.filter("seq = 1").withColumn("code", F.lit("0-NEW")).dropDuplicates(["date"]).withColumn("close", F.lit(7.0)))
    K.merge_table(fresh, path, ("code", "date", "year"), "year")
    return s.read.parquet(path).select("code", "date", "close", F.col("year").cast("int").alias("year"))


_MONTH = "month(date) = 3 AND year(date) IN (1993, 1996)"
add(
    "merge_partitions",
    merged,
    f"""WITH {SERIES} SELECT code, date, close + CASE WHEN {_MONTH} THEN CASE WHEN day(date) = 5 THEN 2 ELSE 1 END ELSE 0 END AS close, CAST(year(date) AS INTEGER) AS year FROM series
      UNION ALL SELECT DISTINCT '0-NEW', date, 7.0::DOUBLE, CAST(year(date) AS INTEGER) FROM series WHERE {_MONTH} AND day(date) = 5""",
    "close",
)
_BAR = "stamp timestamp_ntz, code string, price double, volume long"


def checked(s, d):
    """Ticks as text, some of it broken, read with rejects aside: rows and seconds by reason, '' for the good ones."""
    t = S.ticks(s, d).select("seq", F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"), "code", F.coalesce(F.col("price").cast("string"), F.lit("")).alias("price"), F.coalesce(F.col("volume").cast("long").cast("string"), F.lit("")).alias("volume"))
    price = F.when(F.col("seq") % 17 == 3, "n/a").when(F.col("seq") % 19 == 5, "").otherwise(F.col("price"))
    line = F.when(F.col("seq") % 13 == 7, F.concat_ws(",", "stamp", "code")).otherwise(F.concat_ws(",", "stamp", "code", price, "volume"))
    path = K.work_path(s, "ticks.csv")
    t.select(line.alias("value")).write.text(path)
    good, bad = S.read_checked(s, path, _BAR, ("price", "stamp"))
    good = good.select(F.lit("").alias("reason"), "code")
    return good.unionByName(bad.select("reason", F.split("line", ",")[1].alias("code"))).groupBy("reason", "code").agg(F.count("*").alias("n"))


add(
    "checked_rows",
    checked,
    f"WITH {TICKS} SELECT CASE WHEN seq % 13 = 7 THEN 'fields' WHEN seq % 17 = 3 THEN 'value' WHEN seq % 19 = 5 OR price IS NULL THEN 'missing' ELSE '' END AS reason, code, count(*) AS n FROM ticks GROUP BY 1, 2",
)
_WIDTHS = (3, 20)


def long_series(s, d):
    """All orders as one series by their key, cut into ranges: rolling means and deviations, a fill, an expanding mean."""
    df = S.table(s, d, "orders").select(F.lit("orders").alias("code"), F.col("o_orderkey").alias("date"), (F.col("o_totalprice") / 777).alias("price"), F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("last_filled"))
    series = P.forward_fill(P.cut(df), ("last_filled",))
    series = P.expanding_mean(series, {"mean_so_far": "price"})
    out = P.by_ranges(series, lambda x: D.rolling(x, ("price",), _WIDTHS), halo=max(_WIDTHS) - 1)
    return P.whole(out).select(F.col("date").alias("o_orderkey"), "last_filled", "mean_so_far", *(f"price_{k}_{n}d" for k in ("mean", "std") for n in _WIDTHS))


_W = "OVER (ORDER BY o_orderkey ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
add(
    "rolling_split_series",
    long_series,
    "SELECT o_orderkey, last_value(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END IGNORE NULLS) " + _W.format("UNBOUNDED") + " AS last_filled, avg(o_totalprice / 777) " + _W.format("UNBOUNDED") + " AS mean_so_far, "
    + ", ".join(f"avg(o_totalprice / 777) {_W.format(n - 1)} AS price_mean_{n}d, CASE WHEN count(o_totalprice) {_W.format(n - 1)} >= 2 THEN stddev_pop(o_totalprice / 777) {_W.format(n - 1)} END AS price_std_{n}d" for n in _WIDTHS) + " FROM orders",
    "last_filled mean_so_far " + " ".join(f"price_{k}_{n}d" for k in ("mean", "std") for n in _WIDTHS),
)
