"""Pessimistic grid replay of a day's bars, as one typed fold over a sorted array.

From flat, a bar that touches the buy or the sell trigger opens a cycle; if it touches
both, the side that is worse at the bar's close is taken (long on a tie).  A cycle ends at
the anchor on a later bar; one action a bar.  What is open after the last bar is closed at
its close, which is no round trip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTERS = ("round_trips", "long_entries", "short_entries", "ambiguous_entries", "skipped_touches", "filled_shares")


@dataclass(frozen=True)
class Market:
    """Fixed values (L8, L10): an order in shares, how much of it a bar fills, and what a trade costs of its value."""

    order: int = 100
    lot: int = 100
    share_of_bar: float = 0.05
    slip: float = 0.001
    fee: float = 0.0002
    sales_tax: float = 0.0005

    def round_trip(self) -> float:
        """What buying and selling once costs."""
        return 2 * (self.slip + self.fee) + self.sales_tax


def fillable(volume: Column, c: Market) -> Column:
    """Whole lots within the participation in a bar's volume, at most the order."""
    lots = F.floor(F.floor(volume * c.share_of_bar) / c.lot) * c.lot
    return F.when(volume > 0, F.least(F.lit(c.order).cast("long"), lots)).otherwise(F.lit(0)).cast("long")


def _closed(side: Column, entry: Column, quantity: Column, cost: Column, price: Column, c: Market) -> Column:
    """Cash of a cycle that ends at a price, after slippage, commission and stamp tax."""
    sold, bought = price * (1 - c.slip), price * (1 + c.slip)
    long = (sold - entry) * quantity - cost - sold * quantity * (c.fee + c.sales_tax)
    short = (entry - bought) * quantity - cost - bought * quantity * c.fee
    return F.when(side > 0, long).otherwise(short)


def replay(df: DataFrame, bars: str, anchor: str, step: str, c: Market = Market()) -> DataFrame:
    """df with a replay struct. bars: an array of (datetime, high, low, close, volume)."""
    at, buy = F.col(anchor), F.col(anchor) * (1 - F.col(step))
    sell = F.col(anchor) * (1 + F.col(step))
    long_price, short_price = buy * (1 + c.slip), sell * (1 - c.slip)
    none, zero = F.lit(0.0), F.lit(0).cast("long")
    start = F.struct(zero.alias("side"), none.alias("entry"), zero.alias("quantity"), none.alias("cost"), none.alias("pnl"), *(zero.alias(k) for k in COUNTERS))

    def move(s: Column, b: Column) -> Column:
        low, high = F.coalesce(b["low"] <= buy, F.lit(False)), F.coalesce(b["high"] >= sell, F.lit(False))
        flat = s["side"] == 0
        quantity = fillable(b["volume"], c)
        touched = flat & (low | high)
        opened = touched & (quantity > 0)
        both = opened & low & high
        worse = (b["close"] - long_price) <= (short_price - b["close"])
        long = opened & F.when(low & high, worse).otherwise(low)
        short = opened & ~long
        done = ((s["side"] > 0) & (b["high"] >= at)) | ((s["side"] < 0) & (b["low"] <= at))
        count = lambda k, cond: (s[k] + cond.cast("long")).alias(k)
        price = F.when(long, long_price).otherwise(short_price)
        rate = F.when(long, c.fee).otherwise(c.fee + c.sales_tax)
        return F.struct(
            F.when(long, 1).when(short, -1).when(done, 0).otherwise(s["side"]).cast("long").alias("side"),
            F.when(opened, price).otherwise(s["entry"]).alias("entry"),
            F.when(opened, quantity).otherwise(s["quantity"]).alias("quantity"),
            F.when(opened, price * quantity * rate).otherwise(s["cost"]).alias("cost"),
            F.when(done, s["pnl"] + _closed(s["side"], s["entry"], s["quantity"], s["cost"], at, c)).otherwise(s["pnl"]).alias("pnl"),
            count("round_trips", done),
            count("long_entries", long),
            count("short_entries", short),
            count("ambiguous_entries", both),
            count("skipped_touches", touched & ~opened),
            (s["filled_shares"] + F.when(opened, quantity).otherwise(0)).alias("filled_shares"),
        )

    ordered = F.array_sort(F.col(bars))
    end = F.element_at(ordered, -1)["close"]

    def finish(s: Column) -> Column:
        open_ = s["side"] != 0
        pnl = F.when(open_, s["pnl"] + _closed(s["side"], s["entry"], s["quantity"], s["cost"], end, c)).otherwise(s["pnl"])
        return F.struct((pnl / (at * c.order)).alias("grid_pnl"), pnl.alias("grid_pnl_cash"), *(s[k].alias(k) for k in COUNTERS), open_.cast("long").alias("forced_close"))

    fold = F.aggregate(ordered, start, move, finish)
    nothing = F.struct(none.alias("grid_pnl"), none.alias("grid_pnl_cash"), *(zero.alias(k) for k in COUNTERS), zero.alias("forced_close"))
    return df.withColumn("replay", F.when((F.size(bars) > 0) & (at > 0) & (F.col(step) > 0), fold).otherwise(nothing))
