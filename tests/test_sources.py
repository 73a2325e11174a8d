from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemill.functions import scalar as X
from tidemill.operators import bars as B
from tidemill.operators import decision as C
from tidemill.operators import heads as H
from tidemill.operators import joins as J
from tidemill.operators.evaluate import HEADS
from tidemill.sources import daily as Y
from tidemill.sources import export as E
from tidemill.sources import sinks as K
from tidemill.sources import tables as S


def test_daily_source_narrows_its_months_by_filters():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

    options = {"fetch": "x:y", "symbol": "s", "start": "2023-01-01", "end": "2024-12-31"}
    reader = Y.PushedReader(options)
    rest = list(reader.pushFilters([GreaterThan(("date",), date(2024, 1, 31)), LessThanOrEqual(("date",), date(2024, 3, 5)), EqualTo(("symbol",), "s"), In(("date",), (1,))]))
    assert len(rest) == 1 and [(p.first, p.last) for p in reader.partitions()] == [(date(2024, 2, 1), date(2024, 2, 29)), (date(2024, 3, 1), date(2024, 3, 5))]
    other = Y.PushedReader(options)
    assert not list(other.pushFilters([EqualTo(("symbol",), "t")])) and other.partitions() == []


def test_daily_source_fetches_by_month(spark):
    spark.dataSource.register(Y.Daily)
    read = spark.read.format("daily").options(fetch="tidemill.sources.daily:made_up", symbol="s", start="2024-01-30", end="2024-03-01")
    df = read.load()
    assert df.rdd.getNumPartitions() == 3
    assert sorted(r.date for r in df.select("date").collect())[0] == date(2024, 1, 30) and df.count() == 24
    with pytest.raises(Exception, match="options are missing"):
        spark.read.format("daily").option("symbol", "s").load().collect()


def test_errors_where_nothing_is_clear(spark):
    cal = spark.createDataFrame([(date(2026, 1, 5),)], "date date")
    days = spark.createDataFrame([(date(2026, 1, 6),), (date(2026, 4, 6),)], "date date")
    assert J.previous_trading_day(days, cal).orderBy("date").collect()[1].previous_date is None
    with pytest.raises(Exception, match="no trading day within 30 days"):
        J.previous_trading_day(days, cal, strict=True).collect()
    codes = spark.createDataFrame([("300123 600000",)], "s string")
    with pytest.raises(Exception, match="no clear symbol"):
        codes.select(X.symbol("s", strict=True)).collect()


def test_stale_hard_sources_stop_the_signal(spark):
    rows = spark.createDataFrame([("bars", date(2026, 1, 5)), ("index", date(2026, 1, 2))], "source string, date date")
    status = C.freshness(rows, F.lit("2026-01-05").cast("date"), ("bars",))
    C.assert_fresh(status)
    with pytest.raises(ValueError, match="stale: bars"):
        C.assert_fresh(C.freshness(rows, F.lit("2026-01-06").cast("date"), ("bars",)))


def test_validation_of_stored_bars(spark):
    bars = spark.createDataFrame([("c", date(2026, 1, d)) for d in (2, 5)], "code string, date date")
    late = B.between(bars, F.lit("2026-01-03").cast("date"), F.lit("2026-01-31").cast("date"))
    assert [r.date for r in late.collect()] == [date(2026, 1, 5)]


def test_retries_and_mirror(tmp_path):
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")
        return "there"

    assert E.with_retries(flaky, 3, 0) == "there" and len(calls) == 3
    with pytest.raises(OSError):
        E.with_retries(lambda: (_ for _ in ()).throw(OSError()), 2, 0)
    K.write_text(tmp_path / "a" / "x.txt", "1")
    assert E.mirror(str(tmp_path / "a"), str(tmp_path / "b")) == 1 and E.mirror(str(tmp_path / "a"), str(tmp_path / "b")) == 0


def test_table_and_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, `代码` string")
    K.write_table(df.withColumnRenamed("代码", "code"), str(tmp_path / "t"), ("code",))
    assert sorted(spark.read.parquet(str(tmp_path / "t")).select("a", "code").collect()) == [(1, "x"), (2, "y")]
    K.write_csv(df, str(tmp_path / "c"), single=True)
    assert sorted(S.read_csv(spark, str(tmp_path / "c"), ("code", "a")).collect()) == [("x", "1"), ("y", "2")]


def test_chunks_that_overlap(spark):
    one = spark.createDataFrame([("c", 1, 1, 0), ("c", 2, 1, 0)], "code string, t int, v int, seq int")
    two = spark.createDataFrame([("c", 2, 2, 0), ("c", 3, 2, 0), ("c", 3, 5, 1)], "code string, t int, v int, seq int")
    assert sorted((r.t, r.v) for r in B.in_chunks([one, two], ("code", "t")).collect()) == [(1, 1), (2, 2), (3, 5)]


def test_tick_numbers_beyond_their_bits(spark):
    ticks = spark.createDataFrame([("c", date(2026, 1, 5), 1 << 40, 1.0)], "code string, date date, seq long, price double").withColumn("datetime", F.lit("2026-01-05 10:00:00").cast("timestamp_ntz")).withColumns({"volume": F.lit(1.0), "amount": F.lit(1.0)})
    with pytest.raises(Exception, match="needs more bits"):
        B.from_ticks(ticks).collect()
    assert B.from_ticks(ticks, seq_bits=None).first().open == 1.0


def test_calibrate_then_fit_on_all(spark, monkeypatch):
    fits = []
    fit = H.fit_classifier
    monkeypatch.setattr(H, "fit_classifier", lambda df, *a: fits.append(df.count()) or fit(df, a[0], a[1], H.TreeConfig(trees=2)))
    rows = [(date(2026, 1, 1 + k % 28), k, float(k % 10), int(k % 10 >= 6)) for k in range(60)]
    df = spark.createDataFrame(rows, "date date, k int, x double, target_tradable int")
    head, threshold = H.calibrate_and_refit(df.filter("k < 50"), ("x",), "target_tradable", HEADS["tradable"], df.filter("k >= 50"))
    assert fits == [50, 60] and head.columns == ("x",) and 0.1 <= threshold <= 0.6
    scored = H.predict(head, df, "p")
    assert scored.filter("x >= 6").agg(F.min("p")).first()[0] > scored.filter("x < 6").agg(F.max("p")).first()[0]


def test_a_merge_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "store")
    kind = "code string, day int, x double, seq long, part string"
    spark.createDataFrame([("a", 1, 1.0, 0, "p"), ("b", 1, 2.0, 0, "p"), ("a", 2, 3.0, 0, "q"), ("a", 3, 4.0, 0, None)], kind).write.partitionBy("part").parquet(path)
    before = {f.name: f.parent.name for f in (tmp_path / "store").rglob("*.parquet")}
    fresh = spark.createDataFrame([("a", 2, 9.0, 1, "q"), ("a", 2, 8.0, 2, "q"), ("c", 5, 7.0, 0, "r")], kind)
    K.merge_table(fresh, path, ("code", "day", "part"), "part")
    after = {f.name: f.parent.name for f in (tmp_path / "store").rglob("*.parquet")}
    assert {n for n, p in before.items() if p != "part=q"} <= set(after) and not {n for n, p in before.items() if p == "part=q"} & set(after)
    got = sorted((r.code, r.day, r.x) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, 1.0), ("a", 2, 8.0), ("a", 3, 4.0), ("b", 1, 2.0), ("c", 5, 7.0)]
    with pytest.raises(ValueError, match="column of the key"):
        K.merge_table(fresh, path, ("code", "day"), "part")


def test_rejects_by_reason(spark, tmp_path):
    lines = ["2024-01-02,1.5,7", "2024-01-02,1.5", "2024-01-02,1.5,7,8", "x,1.5,7", "2024-01-03,,7", "2024-01-03,2.5,"]
    path = tmp_path / "rows.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    good, bad = S.read_checked(spark, str(path), "day date, price double, n long", ("price",))
    assert sorted((r.price, r.n) for r in good.collect()) == [(1.5, 7), (2.5, None)]
    got = {r.line: r.reason for r in bad.collect()}
    assert got == {lines[1]: "fields", lines[2]: "fields", lines[3]: "value", lines[4]: "missing"}


def test_a_hard_source_without_its_days_stops_the_run(spark):
    from tidemill.operators import backfill as B

    day = lambda n: date(2026, 1, n)
    calendar = spark.createDataFrame([(day(n),) for n in (5, 6, 7, 8, 9, 12)], "date date")
    stored = spark.createDataFrame([("soft", day(5), 9), ("soft", day(7), 1), ("soft", day(8), 9), ("soft", day(10), 9), ("whole", day(6), 9), ("whole", day(7), 9)], "source string, date date, n_bars long")
    sources = spark.createDataFrame([("soft", day(1), day(31), False), ("whole", day(6), day(7), True), ("none", day(7), day(9), True)], "source string, since date, until date, is_hard boolean")
    ranges = B.ranges_to_fetch(stored, sources, calendar, 5)
    got = sorted(tuple(r)[:1] + tuple(r)[2:] for r in ranges.collect())
    assert got == [("none", day(7), day(9), 3, 0), ("soft", day(6), day(7), 1, 1), ("soft", day(9), day(12), 2, 0)]
    states = B.state(ranges, sources)
    with pytest.raises(ValueError, match="none from 2026-01-07"):
        B.require_complete(states)
    assert B.require_complete(states.filter("source != 'none'")) == ["soft"]
