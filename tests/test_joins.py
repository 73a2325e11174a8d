from datetime import date, datetime

import pytest

from tidemill.functions import scalar as X
from tidemill.operators import joins as J
from tidemill.sources import export


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_session_goes_to_the_next_trade_day(spark):
    cal = frame(spark, [(date(2026, 4, 14),), (date(2026, 4, 15),), (date(2026, 6, 1),)], "date date")
    ses = frame(spark, [(date(2026, 4, 14),), (date(2026, 4, 13),), (date(2026, 4, 15),), (date(2026, 6, 1),)], "session date")
    got = {r.session: r.trade_date for r in J.next_session(ses, cal).collect()}
    assert got == {date(2026, 4, 14): date(2026, 4, 15), date(2026, 4, 13): date(2026, 4, 14), date(2026, 4, 15): date(2026, 6, 1)}


def test_overnight_factors(spark):
    cal = frame(spark, [(date(2026, 4, 15),)], "date date")
    a = frame(spark, [(date(2026, 4, 13), 100.0), (date(2026, 4, 14), 102.0)], "session date, close double")
    b = frame(spark, [(date(2026, 4, 13), 100.0), (date(2026, 4, 14), 101.0)], "session date, close double")
    (r,) = J.overnight_factors(a, b, cal).collect()
    assert r.date == date(2026, 4, 15) and r.overnight_gap_risk_bucket == 2 and r.overnight_direction_agreement_flag == 1
    assert r.overnight_mean_return == pytest.approx(0.015) and r.overnight_relative_strength_spread == pytest.approx(0.01)


def test_environment_must_be_unique(spark):
    days = frame(spark, [(date(2026, 1, 1), 1.0)], "date date, close double")
    with pytest.raises(Exception, match="date is not unique"):
        J.with_environment(days, days.union(days), "idx_").collect()


def test_expected_date_before_and_after_close(spark):
    cal = frame(spark, [(date(2026, 4, 13),), (date(2026, 4, 14),)], "date date")
    now = frame(spark, [(datetime(2026, 4, 14, 14, 59),), (datetime(2026, 4, 14, 15, 0),), (datetime(2026, 4, 18, 16, 0),)], "now timestamp_ntz")
    got = {r.now: r.expected for r in J.expected_date(now, cal).collect()}
    assert list(got[k] for k in sorted(got)) == [date(2026, 4, 13), date(2026, 4, 14), date(2026, 4, 14)]


def test_freshest_source(spark):
    rows = [(0, date(2026, 4, 10)), (1, date(2026, 4, 14)), (2, date(2026, 4, 15))]
    src = frame(spark, rows, "priority int, date date")
    assert J.freshest(src, date(2026, 4, 14)).first().priority == 1
    assert J.freshest(src.filter("priority < 1 OR priority = 2"), date(2026, 4, 20)).first().priority == 2


def test_weekdays_and_symbols(spark):
    df = frame(spark, [("SZ 300123",), ("123",), ("300123 600000",), ("x",), ("600000.ss",)], "s string")
    got = [tuple(r) for r in df.select(X.symbol("s"), X.exchange_symbol("s")).collect()]
    assert got[0] == ("300123", "300123.SZ") and got[1][0] == "000123" and got[2][0] is None and got[3][0] is None and got[4] == ("600000", "600000.SS")
    d = frame(spark, [(date(2026, 4, 17),), (date(2026, 4, 20),)], "d date").select(X.weekday_after("d"), X.weekday_before("d")).collect()
    assert tuple(d[0]) == (date(2026, 4, 20), date(2026, 4, 16)) and tuple(d[1]) == (date(2026, 4, 21), date(2026, 4, 17))


def test_clip_keeps_missing(spark):
    got = frame(spark, [(None,), (0.001,), (0.5,)], "x double").select(X.clip("x", 0.008, 0.035)).collect()
    assert [r[0] for r in got] == [None, 0.008, 0.035]


def test_export(tmp_path):
    source = "import os\nSIGNAL = {\n    'a': 1,\n}\nrest = 2\n"
    files = export.export_signal({"mode": "SAFE"}, str(tmp_path), "2026-04-14", source)
    assert {f.name for f in files} == {"signal_2026-04-14.json", "signal_latest.json", "signal_2026-04-14.py", "signal_latest.py"}
    space = {}
    exec((tmp_path / "signal_latest.py").read_text(), space)
    assert space["SIGNAL"] == {"mode": "SAFE"} and space["rest"] == 2
    with pytest.raises(ValueError):
        export.splice_assignment("x = 1\n", "SIGNAL", {})
    assert export.mirror(str(tmp_path), str(tmp_path.parent / "copy")) == 4 and export.mirror(str(tmp_path), str(tmp_path.parent / "copy")) == 0
