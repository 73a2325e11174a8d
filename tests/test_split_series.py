import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import daily as D
from tidemill.operators import features as T
from tidemill.operators import split_series as S

ROLLED = ("daily_return", "daily_range", "volume")


def frame(spark, n=400):
    rng = random.Random(8)
    rows = []
    for code, days in (("long", n), ("short", 3), ("middle", 40)):
        for k in range(days):
            price = 100 + rng.random()
            rows.append((code, date(2020, 1, 1) + timedelta(days=k), price, price + 1, price - 1, price + 0.3, None if rng.random() < 0.4 else float(k)))
    return spark.createDataFrame(rows, "code string, date date, open double, high double, low double, close double, volume double")


def values(df, columns):
    return {(r.code, r.date): [None if r[c] is None else round(r[c], 9) for c in columns] for r in df.collect()}


@pytest.mark.parametrize("ranges", [8, 60])  # 60: ranges shorter than the halo
def test_rolling_windows_of_one_series_split(spark, ranges):
    df = frame(spark)
    block = lambda x: D.rolling(D.returns(x), ROLLED, T.ROLLING)
    want = block(df)
    columns = [c for c in want.columns if c not in ("code", "date")]
    series = S.cut(df, ranges=ranges)
    assert series.filter("code = 'long'").select(S.PART).distinct().count() >= ranges // 2
    got = S.whole(S.by_ranges(series, block, halo=20))
    assert got.count() == df.count() and values(got, columns) == values(want, columns)


def test_fills_and_expanding_means_are_carried(spark):
    df = frame(spark)
    series = S.cut(df, ranges=8)
    assert values(S.forward_fill(series, ("volume",)), ["volume"]) == values(D.forward_fill(df, ("volume",)), ["volume"])
    ever = D.days().rowsBetween(Window.unboundedPreceding, 0)
    want = values(df.withColumn("m", F.avg("volume").over(ever)).withColumn("c", F.avg("close").over(ever)), ["m", "c"])
    assert values(S.expanding_mean(series, {"m": "volume", "c": "close"}), ["m", "c"]) == want


def test_nothing_and_null_keys(spark):
    df = frame(spark).withColumn("code", F.when(F.col("code") != "long", F.col("code")))
    got = S.by_ranges(S.cut(df, ranges=5), lambda x: x.withColumn("before", F.lag("close").over(D.days())), halo=1)
    assert got.filter("before IS NULL").count() == 3
    assert S.by_ranges(S.cut(df.filter("close < 0")), lambda x: x, halo=3).collect() == []
