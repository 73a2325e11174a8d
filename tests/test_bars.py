"""Scenarios of cleaning and summing bars."""

from datetime import datetime, timedelta

import pytest

from tidemill.operators import bars as B
from tidemill.sources import tables as S

T0 = datetime(2024, 1, 2, 9, 31)
FIELDS = "datetime string, code string, open string, high string, low string, close string, volume string, amount string, price string, seq long"


def raw(spark, rows):
    df = spark.createDataFrame(rows, FIELDS)
    return S.typed_bars(df.drop("seq")).withColumn("seq", S.F.monotonically_increasing_id())


def row(minute, open_="10", high="11", low="9", close="10.5", volume="100", seq=0):
    stamp = minute if isinstance(minute, str) else str(T0 + timedelta(minutes=minute))
    return (stamp, " 300123 ", open_, high, low, close, volume, "1000", "0", seq)


def test_dirty_frame(spark):
    rows = [row(0), row(1, open_="0"), row(2, high="-1"), row(3), row(3, close="10.7"), row("2024-01-02 09:00:00"), row("not a time"), row(4, volume="x"), row(5)]
    got = B.canonical(raw(spark, rows), "300123").orderBy("datetime").collect()
    assert [r.datetime.minute for r in got] == [31, 32, 34, 36]
    assert all(r.open > 0 and r.price == r.close for r in got)
    assert got[1].open == 10.5 and got[2].close == 10.7  # the bar before donates its close; the last repeat stays


def test_off_session_bar_may_donate(spark):
    rows = [row("2024-01-02 09:30:00", close="8.5"), row(0, open_="0")]
    assert [r.open for r in B.canonical(raw(spark, rows), "300123").collect()] == [8.5]


def test_frequency_and_summary(spark):
    df = B.canonical(raw(spark, [row(k) for k in range(3)]))
    assert [(r.seconds) for r in B.frequency(df).collect()] == [60]
    (day,) = B.daily_summary(df, 240).collect()
    assert day.bar_count == 3 and not day.is_complete_day and day.volume == 300


def test_upsert_prefers_fresh(spark):
    old = spark.createDataFrame([("a", 1, 1.0, 0), ("a", 2, 2.0, 1)], "code string, day int, x double, seq int")
    new = spark.createDataFrame([("a", 2, 5.0, 0), ("a", 2, 6.0, 1), ("a", 3, 7.0, 2)], "code string, day int, x double, seq int")
    assert sorted((r.day, r.x) for r in B.upsert(old, new, ("code", "day")).collect()) == [(1, 1.0), (2, 6.0), (3, 7.0)]


def test_sources(spark, tmp_path):
    with pytest.raises(ValueError):
        S.require(spark.range(1), "missing")
    assert S.read_csv_or_empty(spark, str(tmp_path / "none.csv"), ("date", "close")).count() == 0
    (tmp_path / "a.csv").write_text("日期,收盘\n2024-01-02,3.5\n", encoding="utf-8")
    assert [tuple(r) for r in S.read_csv(spark, str(tmp_path / "a.csv"), ("date", "close")).collect()] == [("2024-01-02", "3.5")]
    assert not S.usable(spark, str(tmp_path / "a.csv")) or (tmp_path / "a.csv").stat().st_size > 32
    lines = spark.createDataFrame([("2024-01-02,1,2,3,0.5,10,20",), ("short,1",), ("2024-01-03,x,2,3,1,1,1",)], "line string")
    got = S.parse_klines(lines).orderBy("date").collect()
    assert len(got) == 2 and got[0].close == 2.0 and got[1].open is None
