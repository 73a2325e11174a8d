"""Queries on the mode decision, freshness and the signal."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decision as C
from ..sources import tables as S
from .common import SERIES
from .evaluation import DECIDED, decided, scored
from .registry import add

_OUT = ("mode", "trend_weak", "position_scale", "grid_width_scale", "dip_buy", "high_sell", "rationale", "grid_width")
_NUMBERS = "position_scale grid_width_scale grid_width"
add("runtime_controls", lambda s, d: decided(s, d).select("code", "date", *_OUT), f"WITH {DECIDED} SELECT code, date, {', '.join(_OUT)} FROM decided", _NUMBERS)
add(
    "soft_downgrade",
    lambda s, d: C.soft_downgrade(decided(s, d), F.dayofmonth("date") % 4 == 0).select("code", "date", *_OUT),
    f"""WITH {DECIDED} SELECT code, date, CASE WHEN stale AND mode <> 'OFF' THEN 'SAFE' ELSE mode END AS mode, stale OR trend_weak AS trend_weak, CASE WHEN stale THEN least(position_scale, 0.55) ELSE position_scale END AS position_scale,
      CASE WHEN stale THEN greatest(grid_width_scale, 1.10) ELSE grid_width_scale END AS grid_width_scale, NOT stale AND dip_buy AS dip_buy, high_sell,
      CASE WHEN stale THEN 'soft_dependency_degraded_to_safe' ELSE rationale END AS rationale, CASE WHEN stale THEN greatest(grid_width, 0.005) ELSE grid_width END AS grid_width
      FROM (SELECT *, date_part('day', date) % 4 = 0 AS stale FROM decided)""",
    _NUMBERS,
)


def sources(s, d):
    return S.order_days(s, d).select(F.concat(F.lit("s"), F.substring("code", 1, 1)).alias("source"), "date").filter("source != 's3' OR year(date) < 1997")


add(
    "freshness_status",
    lambda s, d: C.freshness(sources(s, d), F.expr("date'1998-01-01'"), ("s1", "s3")),
    f"WITH {SERIES}, l AS (SELECT 's' || code[1] AS source, max(date) AS last_date FROM series WHERE code[1] <> '3' OR date_part('year', date) < 1997 GROUP BY 1) SELECT source, last_date, source IN ('s1', 's3') AS is_hard, DATE '1998-01-01' AS expected, last_date < DATE '1998-01-01' AS is_stale FROM l",
)
add("latest_row", lambda s, d: C.latest(scored(s, d).select("code", "date", "pred_upside", "pred_tradable"), "code"), f"WITH {DECIDED} SELECT code, date, pred_upside, pred_tradable FROM decided QUALIFY row_number() OVER (PARTITION BY code ORDER BY date DESC) = 1", "pred_upside pred_tradable")
add(
    "daily_signal",
    lambda s, d: C.payload(C.latest(decided(s, d), "code")).select("code", "date", F.get_json_object("payload", "$.version").alias("version"), F.get_json_object("payload", "$.mode").alias("mode"), F.get_json_object("payload", "$.thresholds.tradable").cast("double").alias("tradable_threshold"), F.get_json_object("payload", "$.grid_width").cast("double").alias("grid_width")),
    f"WITH {DECIDED} SELECT code, date, 'signal_' || strftime(date, '%Y%m%d') AS version, mode, threshold_tradable AS tradable_threshold, grid_width FROM decided QUALIFY row_number() OVER (PARTITION BY code ORDER BY date DESC) = 1",
    "tradable_threshold grid_width",
)
