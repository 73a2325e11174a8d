"""The fold against a plain loop, and its scenarios."""

import random
from datetime import datetime, timedelta

import pytest

from tidemill.operators.replay import Market, replay

T0 = datetime(2024, 1, 2, 9, 31)
SCHEMA = "i long, close double, step double, bars array<struct<datetime:timestamp_ntz,high:double,low:double,close:double,volume:double>>"


def run(spark, cases, c=Market()):
    rows = [(i, anchor, step, [(T0 + timedelta(minutes=k), *b) for k, b in enumerate(bars)]) for i, (anchor, step, bars) in enumerate(cases)]
    out = replay(spark.createDataFrame(rows, SCHEMA), "bars", "close", "step", c).orderBy("i").collect()
    return [r.replay for r in out]


def plain(anchor, step, bars, c):
    side = trips = longs = shorts = both = skipped = filled = 0
    pnl = entry = cost = qty = 0.0
    buy, sell = anchor * (1 - step), anchor * (1 + step)

    def end(price):
        if side > 0:
            p = price * (1 - c.slip)
            return (p - entry) * qty - cost - p * qty * (c.fee + c.sales_tax)
        p = price * (1 + c.slip)
        return (entry - p) * qty - cost - p * qty * c.fee

    for high, low, close, volume in bars:
        if side == 0:
            b, s = low <= buy, high >= sell
            if not (b or s):
                continue
            q = min(c.order, int(volume * c.share_of_bar) // c.lot * c.lot) if volume > 0 else 0
            if q <= 0:
                skipped += 1
                continue
            both += b and s
            long = (close - buy * (1 + c.slip) <= sell * (1 - c.slip) - close) if b and s else b
            side, qty = (1 if long else -1), q
            entry = buy * (1 + c.slip) if long else sell * (1 - c.slip)
            cost = entry * q * (c.fee if long else c.fee + c.sales_tax)
            longs += long
            shorts += not long
            filled += q
        elif (side > 0 and high >= anchor) or (side < 0 and low <= anchor):
            pnl += end(anchor)
            trips += 1
            side = 0
    forced = int(side != 0)
    if side:
        pnl += end(bars[-1][2])
    return pnl, trips, longs, shorts, both, skipped, filled, forced


def test_round_trip_and_ambiguous_bar(spark):
    a, b = run(spark, [(100.0, 0.02, [(99.0, 97.0, 98.0, 1e6), (101.0, 98.0, 100.5, 1e6)]), (100.0, 0.02, [(103.0, 97.0, 101.0, 1e6), (101.0, 99.0, 100.0, 1e6)])])
    assert (a.long_entries, a.round_trips, a.forced_close) == (1, 1, 0) and a.grid_pnl > 0
    assert (b.ambiguous_entries, b.short_entries, b.round_trips) == (1, 1, 1)


def test_against_a_plain_loop(spark):
    rng, cases = random.Random(9), []
    for _ in range(200):
        price, bars = 100.0, []
        for _ in range(rng.randrange(1, 40)):
            price *= 1 + rng.gauss(0, 0.015)
            spread = abs(rng.gauss(0, 0.02))
            bars.append((price * (1 + spread), price * (1 - spread), price, rng.choice([0.0, 500.0, 3000.0, 50000.0])))
        cases.append((100.0, rng.choice([0.008, 0.02, 0.035]), bars))
    c = Market()
    for got, case in zip(run(spark, cases, c), cases):
        want = plain(*case, c)
        assert got.grid_pnl_cash == pytest.approx(want[0], abs=1e-9)
        assert (got.round_trips, got.long_entries, got.short_entries, got.ambiguous_entries, got.skipped_touches, got.filled_shares, got.forced_close) == want[1:]


def test_nothing_to_replay(spark):
    got = run(spark, [(0.0, 0.02, [(1.0, 1.0, 1.0, 1.0)]), (100.0, 0.02, [])])
    assert all(tuple(r) == (0.0, 0.0, 0, 0, 0, 0, 0, 0, 0) for r in got)
