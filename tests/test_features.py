"""Features of days of 240 bars, and the whole table."""

from datetime import date, datetime, timedelta

import pytest

from tidemill.operators import features as T
from tidemill.operators import intraday as I

SCHEMA = "code string, date date, datetime timestamp_ntz, open double, high double, low double, close double, volume double, amount double, price double"


def day(k, closes, volumes):
    at, rows, before = datetime(2026, 3, 2, 9, 31) + timedelta(days=k), [], closes[0]
    for i, (c, v) in enumerate(zip(closes, volumes)):
        rows.append(("c", at.date(), at + timedelta(minutes=i), before, max(before, c), min(before, c), c, float(v), c * v, c))
        before = c
    return rows


def rising():
    return [100 + 0.01 * i for i in range(240)], [1000] * 240


def hostile():
    """Falls for 60 bars, recovers a little; most volume comes early."""
    closes = [100 - 0.07 * i for i in range(60)] + [95.8 + 0.004 * i for i in range(180)]
    return closes, [3000] * 30 + [800] * 210


@pytest.fixture(scope="module")
def bars(spark):
    return spark.createDataFrame(day(0, *rising()) + day(1, *rising()) + day(2, *hostile()), SCHEMA)


def test_a_day_of_even_volume(bars):
    r = I.features(bars).filter("date = date'2026-03-02'").first()
    assert r.n_bars == 240 and r.opening_volume_ratio == pytest.approx(15 / 240) and r.opening_volume_shock == pytest.approx(1.0)
    assert r.open5_return == pytest.approx(100.04 / 100 - 1) and r.open60_return == pytest.approx(100.59 / 100 - 1) and r.am_return == pytest.approx(101.19 / 100 - 1)
    assert r.pm_return == pytest.approx(102.39 / 101.19 - 1) and r.last_return == pytest.approx(102.39 / 102.09 - 1)
    assert r.midday_volume_ratio == pytest.approx(180 / 240) and r.trend_efficiency_ratio == pytest.approx(1.0) and r.low_in_first_hour_flag == 1.0


def test_a_hostile_day(bars):
    r = T.feature_table(bars).filter("date = date'2026-03-04'").first()
    assert r.open60_low_return < -0.03 and r.open60_negative_vwap_ratio >= 0.6 and r.close_recovery_ratio <= 0.55
    assert r.hostile_soft_score >= 6 and r.flag_hostile_regime == 1.0
    assert r.flag_hostile_regime_rate_3d == pytest.approx(1 / 3) and r.hostile_soft_score_mean_3d > 0


def test_columns_follow_what_is_given(spark, bars):
    env = spark.createDataFrame([(date(2026, 3, 2) + timedelta(days=k), 10.0, 11.0, 9.0, 10.0 + k) for k in range(3)], "date date, open double, high double, low double, close double")
    night = spark.createDataFrame([(date(2026, 3, 3), 0.01, 0.02, 1, 0.015, -0.01, 1)], "date date, overnight_first_return double, overnight_second_return double, overnight_gap_risk_bucket int, overnight_mean_return double, overnight_relative_strength_spread double, overnight_direction_agreement_flag int")
    bare, full = T.feature_table(bars), T.feature_table(bars, env, env, night)
    assert not [c for c in bare.columns if "idx_" in c or "sec_" in c or "overnight" in c]
    rolled = [c for c in T.rolled(I.DayParts()) if f"{c}_mean_3d" in full.columns]
    assert len(rolled) == 33 and len(T.RATED) == 13 and all(f"{c}_rate_20d" in full.columns for c in T.RATED)
    got = {r.date: r for r in full.collect()}
    assert len(got) == 3 and got[date(2026, 3, 3)].overnight_mean_return == 0.015 and got[date(2026, 3, 4)].overnight_mean_return is None
    assert got[date(2026, 3, 3)].stk_idx_return_spread == pytest.approx(got[date(2026, 3, 3)].daily_return - 0.1)
    with pytest.raises(Exception, match="date is not unique"):
        T.feature_table(bars, env.union(env)).collect()
