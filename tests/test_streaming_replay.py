import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators import replay as O
from tidemill.streaming import replay as P

SCHEMA = "code string, datetime timestamp, high double, low double, close double, volume double"
MARKET = O.Market(share_of_bar=1.0)


def made(seed=2):
    rng = random.Random(seed)
    rows = []
    for code in ("a", "b"):
        for day in range(3):
            price = 100.0
            for k in range(12):
                price *= 1 + rng.gauss(0, 0.01)
                rows.append((code, datetime(2024, 1, 2 + day, 10) + timedelta(minutes=10 * k), price * (1 + rng.random() / 100), price * (1 - rng.random() / 100), price, rng.choice([0.0, 50.0, 500.0])))
    return rows


def test_restarts_late_bars_and_repeats_give_the_batch_result(spark, tmp_path):
    rows = made()
    anchors = spark.createDataFrame([(c, datetime(2024, 1, 2 + d).date(), 100.0, 0.01) for c in "ab" for d in range(3)] + [("end", datetime(2024, 2, 1).date(), 1.0, 0.01)], "code string, date date, anchor double, step double")
    late = next(r for r in rows if r[1] == datetime(2024, 1, 3, 10, 50) and r[0] == "a")  # comes an hour after its time: within the delay
    lost = next(r for r in rows if r[1] == datetime(2024, 1, 2, 10, 30) and r[0] == "b")
    goes = [
        [r for r in rows if r[1] < datetime(2024, 1, 3, 11, 30) and r != late],
        [late, *(r for r in rows if r[1] >= datetime(2024, 1, 3, 11, 30)), rows[-1]],
        [lost],  # its day is over: the watermark's own rule drops it
        [("end", datetime(2024, 2, 1), 1.0, 1.0, 1.0, 1.0)],
    ]
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for go in goes:
        spark.createDataFrame(go, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        P.run_available(spark, P.replay_stream(stream, anchors, MARKET), out, state)
    got = {(r.code, r.date): r for r in spark.read.schema(P.RESULT).parquet(out).filter("code != 'end'").collect()}
    bars = spark.createDataFrame(rows, SCHEMA).groupBy("code", F.to_date("datetime").alias("date")).agg(
        F.collect_list(F.struct("datetime", "high", "low", "close", "volume")).alias("bars"), (F.sum(F.col("close") * F.col("volume")) / F.sum("volume")).alias("vwap")
    )
    batch = O.replay(bars.join(anchors, ["code", "date"]), "bars", "anchor", "step", MARKET).collect()
    assert len(got) == len(batch) == 6
    for r in batch:
        s = got[r.code, r.date]
        assert s.grid_pnl == pytest.approx(r.replay.grid_pnl) and s.last_vwap == pytest.approx(r.vwap)
        assert all(s[c] == r.replay[c] for c in (*O.COUNTERS, "forced_close"))


def test_a_bar_behind_what_is_folded_is_counted(spark):
    class Value:
        def __init__(self):
            self.v = None

        exists = lambda self: self.v is not None
        get = lambda self: self.v

        def update(self, v):
            self.v = v

        def clear(self):
            self.v = None

    class Map(dict):
        iterator = lambda self: iter(list(self.items()))
        updateValue = dict.__setitem__
        removeKey = lambda self, k: self.pop(k)

    class Handle:
        getValueState = lambda self, *a: Value()
        getMapState = lambda self, *a: Map()
        registerTimer = lambda self, t: None

    class Times:
        getCurrentWatermarkInMs = lambda self: 500

    from pyspark.sql import Row

    p = P.Replay(MARKET)
    p.init(Handle())
    bar = lambda at: Row(at=at, day_end=1000, anchor=100.0, step=0.01, high=101.5, low=99.5, close=100.0, volume=500.0)
    list(p.handleInputRows(("a", None), iter([bar(300), bar(100), bar(900)]), Times()))
    list(p.handleInputRows(("a", None), iter([bar(200), bar(300), bar(600)]), Times()))
    (row,) = p.handleExpiredTimer(("a", None), Times(), None)
    assert row.late_bars == 2 and p._load() is None
