"""What a store lacks: ranges of the calendar to fetch again, by source, and whether the run may go on.

A stored day is complete with enough bars.  Between two complete days that follow each other
all days of the calendar are to be fetched, so ranges come from one window over a source's
stored days; neither calendar nor sources are multiplied out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordinals(calendar: DataFrame) -> DataFrame:
    """Distinct dates of a calendar (one row a day, by nature small) with their numbers from 1."""
    return calendar.select("date").filter("date IS NOT NULL").distinct().withColumn("ordinal", F.row_number().over(Window.orderBy("date")).cast("long"))


def ranges_to_fetch(stored: DataFrame, sources: DataFrame, calendar: DataFrame, least_bars: int = 1) -> DataFrame:
    """Rows (source, is_hard, from_date, to_date, n_missing, n_incomplete), one for each gap.

    stored: (source, date, n_bars), a row for each stored day. sources: (source, since, until, is_hard): what must be there, also of
    sources that have no day at all. Stored days that the calendar does not have, and days outside of since to until, are not looked at.
    """
    days = ordinals(calendar)
    first = days.select(F.col("date").alias("from_date"), "ordinal")
    # the calendar's places of since and until: the first day not before, the last day not after
    bounds = days.agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    spans = sources.join(bounds).select("source", "is_hard", F.greatest("since", "_first").alias("_since"), F.least("until", "_last").alias("_until"))
    inside = spans.join(days, (F.col("date") >= F.col("_since")) & (F.col("date") <= F.col("_until")))
    spans = inside.groupBy("source", "is_hard").agg(F.min("ordinal").alias("_from"), F.max("ordinal").alias("_to"))
    here = stored.filter("source IS NOT NULL").join(days, "date").join(spans.select("source", "_from", "_to"), "source").filter("ordinal BETWEEN _from AND _to")
    here = here.select("source", "ordinal", (F.coalesce("n_bars", F.lit(0)) >= least_bars).alias("complete"))
    # one complete day before the first and one behind the last close the outer gaps
    ends = spans.select("source", F.explode(F.array(F.col("_from") - 1, F.col("_to") + 1)).alias("ordinal"), F.lit(True).alias("complete"))
    w = Window.partitionBy("source").orderBy("ordinal")
    ordered = here.unionByName(ends).withColumn("_poor", F.sum(F.when(F.col("complete"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    full = ordered.filter("complete").withColumn("_next", F.lead("ordinal").over(w)).withColumn("_poor_then", F.lead("_poor").over(w))
    gaps = full.filter(F.col("_next") > F.col("ordinal") + 1).select("source", (F.col("ordinal") + 1).alias("a"), (F.col("_next") - 1).alias("z"), (F.col("_poor_then") - F.col("_poor")).cast("long").alias("n_incomplete"))
    gaps = gaps.withColumn("n_missing", F.col("z") - F.col("a") + 1 - F.col("n_incomplete"))
    out = gaps.join(first.withColumnRenamed("ordinal", "a"), "a").join(days.select(F.col("date").alias("to_date"), F.col("ordinal").alias("z")), "z")
    return out.join(spans.select("source", "is_hard"), "source").select("source", "is_hard", "from_date", "to_date", "n_missing", "n_incomplete")


def state(ranges: DataFrame, sources: DataFrame) -> DataFrame:
    """A row for each source: days to fetch, ranges, the first of them, and 'ok', 'soft' (go on without it) or 'hard' (do not go on)."""
    days = ranges.groupBy("source").agg(F.sum(F.col("n_missing") + F.col("n_incomplete")).alias("n_days"), F.count("*").alias("n_ranges"), F.min("from_date").alias("first_date"))
    out = sources.select("source", "is_hard").join(days, "source", "left")
    verdict = F.when(F.col("n_ranges").isNull(), "ok").when(F.col("is_hard"), "hard").otherwise("soft")
    return out.select("source", F.coalesce("n_days", F.lit(0)).alias("n_days"), F.coalesce("n_ranges", F.lit(0)).alias("n_ranges"), "first_date", verdict.alias("verdict"))


def require_complete(states: DataFrame) -> list[str]:
    """Raises where a hard source lacks days; gives the names of soft ones that do (20 at most of either)."""
    rows = states.filter("verdict != 'ok'").orderBy(F.col("verdict") != "hard", "source").limit(20).collect()
    hard = [f"{r.source} from {r.first_date} ({r.n_days} days)" for r in rows if r.verdict == "hard"]
    if hard:
        raise ValueError(f"hard sources lack days: {'; '.join(hard)}")
    return [r.source for r in rows]
