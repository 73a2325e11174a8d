import random

import numpy as np
from pyspark.sql import functions as F

from tidemill.operators import sketches as Q


def frame(spark, n=20_000):
    rng = random.Random(4)
    rows = [("ab"[i % 7 == 0], i % 40, rng.choice([1.0, rng.gauss(0, 1), rng.expovariate(1)]) if rng.random() > 0.03 else None) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, day int, x double")


def test_merged_sketches_hold_the_stated_error(spark):
    rows, df = frame(spark)
    size = 128
    days = df.groupBy("k", "day").agg(Q.sketch("x", size).alias("s"))
    got = {r.k: r for r in Q.quantiles(Q.merged(days, "s", "k", size=size), "s", {"q1": 0.1, "q5": 0.5, "q9": 0.9}).collect()}
    for k in "ab":
        x = np.sort([v for kk, _, v in rows if kk == k and v is not None])
        for name, q in (("q1", 0.1), ("q5", 0.5), ("q9", 0.9)):
            v = got[k][name]
            lo, hi = np.searchsorted(x, v, "left") / len(x), np.searchsorted(x, v, "right") / len(x)
            assert lo - Q.rank_error(size) <= q <= hi + Q.rank_error(size)


def test_exact_from_brackets_and_from_a_bracket_that_misses(spark):
    rows, df = frame(spark, 5000)
    at = {"lo": 0.0, "q1": 0.1, "mid": 0.5, "hi": 1.0}
    good = df.groupBy("k").agg(Q.sketch("x", 64).alias("sketch"))
    shifted = df.groupBy("k").agg(Q.sketch(F.col("x") + 100, 64).alias("sketch"))  # brackets hold no row: all values are taken
    for sketches in (good, shifted):
        got = {r.k: r for r in Q.exact_quantiles(df, "x", at, ("k",), sketches, size=64).collect()}
        for k in "ab":
            x = [v for kk, _, v in rows if kk == k and v is not None]
            for name, q in at.items():
                assert abs(got[k][name] - np.quantile(x, q)) < 1e-12


def test_missing_only_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, x double")
    got = Q.exact_quantiles(df, "x", {"m": 0.5}, ("k",), df.groupBy("k").agg(Q.sketch("x").alias("sketch"))).collect()
    assert [(r.k, r.m) for r in got] == [("b", 2.0)]
