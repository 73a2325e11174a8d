import random

import pandas as pd
from pyspark.sql import functions as F

from tidemill.operators import ranks as R


def frame(spark, n=3000):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "a", None, "b"]), None if rng.random() < 0.05 else rng.choice([1.5, 2.5, rng.random()]), i, "x") for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, v double, id long, n string")


def test_numbered_is_row_number_over_the_key(spark):
    rows, df = frame(spark)
    got = R.numbered(df, ("k",), (F.col("v").asc_nulls_first(), F.col("id")), "r", ranges=7).collect()
    want = pd.DataFrame(rows, columns=["k", "v", "id", "n"]).fillna({"k": "-", "v": -1}).sort_values(["v", "id"])
    want["r"] = want.groupby("k").cumcount() + 1
    assert {r.id: r.r for r in got} == dict(zip(want.id, want.r)) and len(got) == len(rows)


def test_average_ranks_and_quantiles(spark):
    rows, df = frame(spark)
    want = pd.DataFrame(rows, columns=["k", "v", "id", "n"]).fillna({"k": "-"})
    want["r"] = want.groupby("k").v.rank()
    got = {r.id: r.r for r in R.with_average_rank(df, "v", "r", "k", ranges=7).collect()}
    assert all(pd.isna(b) if got[a] is None else abs(got[a] - b) < 1e-9 for a, b in zip(want.id, want.r))
    q = {r.k or "-": (r.lo, r.hi) for r in R.quantile(df, "v", {"lo": 0.2, "hi": 0.83}, "k", ranges=5).collect()}
    for k, g in want.groupby("k"):
        assert abs(q[k][0] - g.v.quantile(0.2)) < 1e-12 and abs(q[k][1] - g.v.quantile(0.83)) < 1e-12


def test_one_value_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 1)] * 50, "k string, v double, id long")
    assert {r.average_rank for r in R.value_ranks(df, "v", "k").collect()} == {25.5}
    assert R.value_ranks(df.filter("id > 1"), "v", "k").collect() == []
    assert R.numbered(df.filter("id > 1"), ("k",), (F.col("v"),)).collect() == []
