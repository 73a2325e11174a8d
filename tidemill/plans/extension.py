"""Queries beyond batch SQL: streamed bars, tree heads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import daily as D
from ..operators import boosting as B
from ..operators import heads as H
from ..operators.evaluate import HEADS
from ..sources import sinks as K
from ..streaming import bars as T
from ..streaming import replay as P
from .common import BARS, days, hourly
from .evaluation import scored
from .labels import REPLAY, REPLAYED
from .registry import add

_NUMBERS = "open high low close volume amount"


def streamed(s, d):
    folder = T.work_folder(s)
    T.run_available(T.bars(T.tick_stream(s, d)), f"{folder}/bars", f"{folder}/state")
    return T.current(s, f"{folder}/bars").withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))


add("streaming_bars", streamed, f"WITH {BARS} SELECT code, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, open, high, low, close, volume, amount, n_ticks FROM bars", _NUMBERS)



def streamed_replay(s, d):
    """The hourly bars as a stream in two goes, the second one from the first's checkpoint; the last bar of all only moves the watermark on."""
    folder = T.work_folder(s)
    bars = hourly(s, d).select("code", F.col("datetime").cast("timestamp").alias("datetime"), "high", "low", "close", "volume")
    today = D.label_step(days(s, d)).withColumn("next_date", F.lead("date").over(D.days())).filter("next_date IS NOT NULL")
    anchors = K.stored(today.select("code", F.col("next_date").alias("date"), F.col("close").alias("anchor"), F.col("grid_step_pct").alias("step")), "anchors")
    bars = K.stored(bars, "bars")
    middle, last = bars.agg(F.timestamp_seconds(F.floor(F.avg(F.unix_seconds("datetime")))), F.max("datetime")).first()
    end = bars.limit(1).select(F.lit("end").alias("code"), (F.lit(last) + F.expr("INTERVAL 9 DAYS")).alias("datetime"), *("high", "low", "close", "volume"))
    anchors = anchors.unionByName(end.select("code", F.to_date("datetime").alias("date"), F.lit(1.0).alias("anchor"), F.lit(0.01).alias("step")))
    for part in (bars.filter(F.col("datetime") <= F.lit(middle)), bars.filter(F.col("datetime") > F.lit(middle)), end):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = s.readStream.schema(bars.schema).parquet(f"{folder}/in")
        P.run_available(s, P.replay_stream(stream, anchors, REPLAY), f"{folder}/out", f"{folder}/state")
    return s.read.schema(P.RESULT).parquet(f"{folder}/out").filter("code != 'end'")


_COUNTS = "round_trips long_entries short_entries ambiguous_entries skipped_touches filled_shares forced_close"
add(
    "streaming_replay",
    streamed_replay,
    f"""WITH {REPLAYED}, v AS (SELECT code, date AS next_date, sum(close * volume) / nullif(sum(volume), 0) AS last_vwap FROM bars GROUP BY code, date)
      SELECT code, next_date AS date, grid_pnl, grid_pnl_cash, {', '.join(_COUNTS.split())}, last_vwap, CAST(0 AS BIGINT) AS late_bars FROM labels JOIN v USING (code, next_date)""",
    "grid_pnl grid_pnl_cash last_vwap",
)

#: A tree takes four jobs, so the queries have a part of the published 300 trees; their other settings are as published.
SETTINGS = B.Boost(trees=12)
FEATURES = ("pred_upside", "pred_downside", "pred_grid_pnl", "pred_tradable", "grid_step_pct")
TARGETS = {h: ("regression", f"target_{h}") for h in ("upside", "downside", "grid_pnl")} | {h: ("classification", f"target_{h}") for h in HEADS}


def _parts(s, d):
    df = D.ordinal_split(scored(s, d).drop("row_idx"), 0.2)
    return df.filter("part = 'train'"), df.filter("part = 'test'")


def _model(train):
    return B.fit(train, FEATURES, B.heads_for(train, TARGETS), ("code", "date"), SETTINGS)


def boosted_scores(s, d):
    """Scores of the last fifth of the days by all heads' second-order trees."""
    train, test = _parts(s, d)
    return B.predict(test, _model(K.stored(train, "training")), "tree_").select("code", "date", *(f"tree_{h}" for h in TARGETS))


def boosted_importance(s, d):
    train, _ = _parts(s, d)
    return B.importance(s, _model(K.stored(train, "training"))).select("head", "feature", "splits", "gain", "total_gain", "share")


def gbt_scores(s, d):
    train, out = _parts(s, d)
    for name, head in H.fit_heads(train, FEATURES, TARGETS, ("code", "date")).items():
        out = H.predict(head, out, f"tree_{name}")
    return out.select("code", "date", *(f"tree_{h}" for h in TARGETS))


def head_importance(s, d):
    train, _ = _parts(s, d)
    return H.importance(s, H.fit_heads(train, FEATURES, TARGETS, ("code", "date")), 30)


add("boosted_scores", boosted_scores)
add("boosted_importance", boosted_importance)
add("gbt_scores", gbt_scores)
add("head_importance", head_importance)
