"""Joins of daily frames: checked one-to-one, as-of, calendars, freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import flag, gap_risk_bucket, ratio, weekday_after


def unique(df: DataFrame, *key: str) -> DataFrame:
    """df; an action on it fails where a key repeats. Rows are counted by key as they are read, without a job of its own."""
    message = F.lit(f"{', '.join(key)} is not unique")
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(*key))).filter(F.assert_true(F.col("_n") == 1, message).isNull()).drop("_n")


def with_environment(df: DataFrame, environment: DataFrame, prefix: str = "", on: str = "date", check: bool = True) -> DataFrame:
    """Left join of a daily environment under a prefix. A day occurs once in the environment, or an action fails."""
    if check:
        environment = unique(environment, on)
    named = environment.select(on, *(F.col(c).alias(f"{prefix}{c}") for c in environment.columns if c != on))
    return df.join(named, on, "left")


def environment_features(days: DataFrame) -> DataFrame:
    """Returns, gap, averages of an environment series (one series: its days are its only order)."""
    w = Window.partitionBy(F.lit(0)).orderBy("date")
    mean = lambda n: F.avg("close").over(w.rowsBetween(1 - n, 0))
    df = days.withColumn("pre_close", F.lag("close").over(w)).withColumn("ma5", mean(5)).withColumn("ma20", mean(20))
    return df.select(
        "date",
        "close",
        (ratio("close", "pre_close") - 1).alias("daily_return"),
        ratio(F.col("high") - F.col("low"), "pre_close").alias("daily_range"),
        (ratio("open", "pre_close") - 1).alias("gap_pct"),
        "ma5",
        "ma20",
        (ratio("close", "ma20") - 1).alias("close_to_ma20"),
    )


def relative_spreads(df: DataFrame, weakness: float) -> DataFrame:
    """Spreads of returns, gaps and distances to the average against idx_ and sec_ columns, with flags; for what is there."""
    out = {}
    here = [(e, name) for e, name in (("idx", "index"), ("sec", "sector")) if f"{e}_daily_return" in df.columns]
    for e, name in here:
        out[f"stk_{e}_return_spread"] = F.col("daily_return") - F.col(f"{e}_daily_return")
        out[f"stk_{e}_gap_spread"] = F.col("gap_pct") - F.col(f"{e}_gap_pct")
        out[f"stk_{e}_close_to_ma20_spread"] = F.col("close_to_ma20") - F.col(f"{e}_close_to_ma20")
        out[f"flag_relative_weak_vs_{e}"] = flag(F.col("daily_return") - F.col(f"{e}_daily_return") <= -weakness)
        out[f"flag_gap_up_without_{name}_confirmation"] = flag((F.col("gap_pct") > 0) & (F.col(f"{e}_gap_pct") <= 0))
    if len(here) == 2:
        out["idx_sec_return_spread"] = F.col("idx_daily_return") - F.col("sec_daily_return")
        out["idx_sec_gap_spread"] = F.col("idx_gap_pct") - F.col("sec_gap_pct")
    return df.withColumns(out) if out else df


def next_session(sessions: DataFrame, calendar: DataFrame, column: str = "session") -> DataFrame:
    """Forward as-of join: each session's first calendar date after it, as trade_date; sessions beyond the calendar leave.

    Sessions and calendar are merged and walked from the last day on, the calendar dates so far at hand: a sort, not a
    range join.  Both have a row a day, so one task holds some hundred rows for a year whatever the data.
    """
    both = sessions.select("*", F.col(column).alias("_at"), F.lit(0).alias("_calendar")).unionByName(
        calendar.select(F.col("date").alias("_at"), F.lit(1).alias("_calendar")), allowMissingColumns=True
    )
    numbered = both.withColumn("_day", F.datediff("_at", F.lit("1970-01-01").cast("date")))
    later = Window.partitionBy(F.lit(0)).orderBy(F.col("_day").desc()).rangeBetween(Window.unboundedPreceding, -1)
    found = numbered.withColumn("trade_date", F.min(F.when(F.col("_calendar") == 1, F.col("_at"))).over(later))
    return found.filter("_calendar = 0 AND trade_date IS NOT NULL").select(*sessions.columns, "trade_date")


def overnight_factors(first: DataFrame, second: DataFrame, calendar: DataFrame) -> DataFrame:
    """Returns of two foreign series on the domestic days after their sessions; of several sessions of a day, the latest.

    Both series go through one window of changes, one as-of join and one aggregate.
    """
    both = first.select("session", "close", F.lit("a").alias("series")).unionByName(second.select("session", "close", F.lit("b").alias("series")))
    before = F.lag("close").over(Window.partitionBy("series").orderBy("session"))
    moved = both.withColumn("r", ratio("close", before) - 1).filter("r IS NOT NULL").select("series", "session", "r")
    last = lambda k: F.max_by(F.when(F.col("series") == k, F.col("r")), F.when(F.col("series") == k, F.col("session")))
    days = next_session(moved, calendar.distinct()).groupBy(F.col("trade_date").alias("date")).agg(last("a").alias("a"), last("b").alias("b"))
    return days.filter("a IS NOT NULL AND b IS NOT NULL").select(
        "date",
        F.col("a").alias("overnight_first_return"),
        F.col("b").alias("overnight_second_return"),
        gap_risk_bucket("a", "b").alias("overnight_gap_risk_bucket"),
        ((F.col("a") + F.col("b")) / 2).alias("overnight_mean_return"),
        (F.col("a") - F.col("b")).alias("overnight_relative_strength_spread"),
        F.coalesce(F.signum("a") == F.signum("b"), F.lit(False)).cast("int").alias("overnight_direction_agreement_flag"),
    )


def next_trading_day(days: DataFrame, calendar: DataFrame, limit: int = 30) -> DataFrame:
    """next_date: the first calendar date within limit days after date, else the next weekday."""
    ahead = days.withColumn("_try", F.explode(F.sequence(F.date_add("date", 1), F.date_add("date", limit))))
    hit = ahead.join(calendar.select(F.col("date").alias("_try")).distinct(), "_try", "left_semi").groupBy("date").agg(F.min("_try").alias("_next"))
    return days.join(hit, "date", "left").select(*days.columns, F.coalesce("_next", weekday_after("date")).alias("next_date"))


def previous_trading_day(days: DataFrame, calendar: DataFrame, limit: int = 30, strict: bool = False) -> DataFrame:
    """previous_date: the last calendar date within limit days before date; missing if there is none, or an error if strict."""
    back = days.withColumn("_try", F.explode(F.sequence(F.date_sub("date", limit), F.date_sub("date", 1))))
    hit = back.join(calendar.select(F.col("date").alias("_try")).distinct(), "_try", "left_semi").groupBy("date").agg(F.max("_try").alias("previous_date"))
    found = days.join(hit, "date", "left")
    if strict:
        message = F.concat(F.lit(f"no trading day within {limit} days before "), F.col("date").cast("string"))
        found = found.withColumn("previous_date", F.coalesce("previous_date", F.raise_error(message).cast("date")))
    return found


def expected_date(now: DataFrame, calendar: DataFrame, close_hour: int = 15) -> DataFrame:
    """For each now: its date if that is a trading day and the market has closed, else the trading day before."""
    at = now.withColumn("date", F.to_date("now"))
    at = previous_trading_day(at, calendar).join(calendar.select("date", F.lit(True).alias("_open")).distinct(), "date", "left")
    today = F.col("_open").isNotNull() & (F.hour("now") >= close_hour)
    return at.select("now", F.when(today, F.col("date")).otherwise(F.col("previous_date")).alias("expected"))


def freshest(sources: DataFrame, expected) -> DataFrame:
    """Of sources (priority, date rows), in order the first that reaches expected, else the one with the latest date; one row."""
    last = sources.groupBy("priority").agg(F.max("date").alias("last_date"))
    fresh = F.coalesce(F.col("last_date") >= F.lit(expected), F.lit(False))
    ranked = last.withColumn("is_fresh", fresh)
    key = F.when(F.col("is_fresh"), F.struct(F.lit(1).alias("f"), F.lit(None).cast("date").alias("d"), (-F.col("priority")).alias("p"))).otherwise(
        F.struct(F.lit(0).alias("f"), F.col("last_date").alias("d"), (-F.col("priority")).alias("p"))
    )
    return ranked.agg(F.max_by(F.struct("priority", "last_date", "is_fresh"), key).alias("s")).select("s.*")


def best_name_match(names: DataFrame, column: str, keywords: tuple[str, ...]) -> DataFrame:
    """For each keyword the name that holds it best: equal, then at an end, then within; then the shorter, then the later name."""
    n, k = F.col(column), F.col("keyword")
    rank = F.when(n == k, 4).when(n.startswith(k) | n.endswith(k), 3).otherwise(2)
    held = names.select(column, F.explode(F.array(*(F.lit(w) for w in keywords))).alias("keyword")).filter(n.contains(k))
    return held.groupBy("keyword").agg(F.max_by(column, F.struct(rank.alias("r"), (-F.length(n)).alias("l"), n.alias("n"))).alias("name"), F.count("*").alias("n_candidates"))
