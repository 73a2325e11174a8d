"""The grid replay over a stream of bars, one state for each instrument and day.

Bars wait in the state until the watermark has passed them, so a bar that comes late, but
within the watermark's delay, is folded in its place, and a bar that is sent again replaces
itself.  Then they are folded in order into the replay's state and the sums of the running
VWAP.  A timer at the day's end folds what is left, gives the result and drops the state.
The fold's rules are those of ``operators.replay``.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..operators.replay import COUNTERS, Market

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BAR = "high double, low double, close double, volume double"
FOLD = "anchor double, step double, side int, entry double, quantity long, cost double, pnl double, last double, upto long, value double, volume double, late long, " + ", ".join(f"{c} long" for c in COUNTERS)
RESULT = "code string, date date, grid_pnl double, grid_pnl_cash double, " + ", ".join(f"{c} long" for c in COUNTERS) + ", forced_close long, last_vwap double, late_bars long"


def begin(anchor: float | None, step: float | None) -> dict:
    return {"anchor": anchor, "step": step, "side": 0, "entry": 0.0, "quantity": 0, "cost": 0.0, "pnl": 0.0, "last": None, "upto": -1, "value": 0.0, "volume": 0.0, "late": 0} | dict.fromkeys(COUNTERS, 0)


def closed(s: dict, price: float, c: Market) -> float:
    """Cash of the open cycle, ended at a price."""
    if s["side"] > 0:
        sold = price * (1 - c.slip)
        return (sold - s["entry"]) * s["quantity"] - s["cost"] - sold * s["quantity"] * (c.fee + c.sales_tax)
    bought = price * (1 + c.slip)
    return (s["entry"] - bought) * s["quantity"] - s["cost"] - bought * s["quantity"] * c.fee


def fold(s: dict, high: float, low: float, close: float, volume: float | None, c: Market) -> None:
    """One bar into the state, in place."""
    volume = volume or 0.0
    s["last"] = close
    s["value"] += close * volume
    s["volume"] += volume
    at, step = s["anchor"], s["step"]
    if not (at and at > 0 and step and step > 0):
        return
    if s["side"]:
        if (s["side"] > 0 and high >= at) or (s["side"] < 0 and low <= at):
            s["pnl"] += closed(s, at, c)
            s["round_trips"] += 1
            s["side"] = 0
        return
    buy, sell = at * (1 - step), at * (1 + step)
    below, above = low <= buy, high >= sell
    if not (below or above):
        return
    lots = int(int(volume * c.share_of_bar) // c.lot * c.lot) if volume > 0 else 0
    quantity = min(c.order, lots)
    if quantity <= 0:
        s["skipped_touches"] += 1
        return
    bought, sold = buy * (1 + c.slip), sell * (1 - c.slip)
    long = (close - bought) <= (sold - close) if below and above else below
    s["ambiguous_entries"] += int(below and above)
    s["long_entries" if long else "short_entries"] += 1
    s["side"], s["quantity"], s["entry"] = (1 if long else -1), quantity, (bought if long else sold)
    s["cost"] = s["entry"] * quantity * (c.fee if long else c.fee + c.sales_tax)
    s["filled_shares"] += quantity


def _millis(t: datetime) -> int:
    return int(t.replace(tzinfo=timezone.utc).timestamp() * 1000) if t.tzinfo is None else int(t.timestamp() * 1000)


class Replay(StatefulProcessor):
    def __init__(self, market: Market):
        self.market = market

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("fold", FOLD)
        self.waiting = handle.getMapState("waiting", "at long", BAR)

    def _load(self) -> dict | None:
        got = self.state.get() if self.state.exists() else None
        return None if got is None else dict(zip([f.split()[0] for f in FOLD.split(", ")], got))

    def _fold_upto(self, s: dict, limit: float) -> None:
        ready = sorted((k[0], tuple(v)) for k, v in self.waiting.iterator() if k[0] < limit)
        for at, bar in ready:
            fold(s, *bar, self.market)
            s["upto"] = at
            self.waiting.removeKey((at,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        s = self._load()
        for r in rows:
            if s is None:
                s = begin(r.anchor, r.step)
                self.handle.registerTimer(r.day_end)
            if r.at <= s["upto"]:
                s["late"] += 1
                continue
            self.waiting.updateValue((r.at,), (r.high, r.low, r.close, r.volume))
        if s is not None:
            self._fold_upto(s, timerValues.getCurrentWatermarkInMs())
            self.state.update(tuple(s.values()))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = self._load()
        if s is None:
            return
        self._fold_upto(s, float("inf"))
        forced = int(s["side"] != 0)
        pnl = s["pnl"] + (closed(s, s["last"], self.market) if forced else 0.0)
        share = pnl / (s["anchor"] * self.market.order) if s["anchor"] else 0.0
        vwap = s["value"] / s["volume"] if s["volume"] > 0 else None
        self.state.clear()
        self.waiting.clear()
        counts = {c: s[c] for c in COUNTERS}
        yield Row(code=key[0], date=key[1], grid_pnl=share, grid_pnl_cash=pnl, **counts, forced_close=forced, last_vwap=vwap, late_bars=s["late"])

    def close(self) -> None:
        pass


def replay_stream(bars: DataFrame, anchors: DataFrame, market: Market = Market(), late: str = "2 hours") -> DataFrame:
    """A row for each day, when it is over. bars: a stream of code, datetime, high, low, close, volume; anchors: a table of code, date, anchor, step."""
    at = (F.unix_micros("datetime") / 1000).cast("long")
    rows = bars.withColumn("date", F.to_date("datetime")).join(anchors, ["code", "date"]).withWatermark("datetime", late)
    end = F.unix_millis(F.date_add("date", 1).cast("timestamp"))
    rows = rows.select("code", "date", "datetime", at.alias("at"), end.alias("day_end"), "anchor", "step", "high", "low", "close", F.col("volume").cast("double").alias("volume"))
    return rows.groupBy("code", "date").transformWithState(statefulProcessor=Replay(market), outputStructType=RESULT, outputMode="Append", timeMode="EventTime")


def run_available(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str) -> None:
    """Work off what there is into a table of Parquet files, by a state store that holds its states on disk."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        query = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
        query.awaitTermination()
    finally:
        spark.conf.set(STORE, before) if before else spark.conf.unset(STORE)
