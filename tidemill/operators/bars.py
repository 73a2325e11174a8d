"""Cleaning, repairing and aggregating bars. Every window is partitioned by code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FULL_DAY_SECONDS = 14_400


def dedupe(df: DataFrame, key: tuple[str, ...], seq: str = "seq", keep: str = "last") -> DataFrame:
    """One row for each key: the last or first by the ingestion order."""
    order = F.col(seq).desc() if keep == "last" else F.col(seq).asc()
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(order))).filter("_n = 1").drop("_n")


def upsert(stored: DataFrame, fresh: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """stored with fresh rows on top: of a key, the fresh row stays. Rows need a seq within their own frame."""
    both = stored.withColumn("_round", F.lit(0)).unionByName(fresh.withColumn("_round", F.lit(1)))
    order = Window.partitionBy(*key).orderBy(F.col("_round").desc(), F.col("seq").desc())
    return both.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "_round")


def clean(df: DataFrame, code: str | None = None) -> DataFrame:
    """Drops rows without a time, of another instrument, repeated, or with missing or impossible values.

    A missing value is dropped whether or not another row holds a negative one.
    """
    if code is not None:
        df = df.filter(F.trim("code") == code)
    df = dedupe(df.filter("datetime IS NOT NULL"), ("code", "datetime"))
    return df.filter("volume >= 0 AND amount >= 0 AND high > 0 AND low > 0 AND close > 0")


def repair_open(df: DataFrame, within_day: bool = True) -> DataFrame:
    """An open that is missing or not positive becomes the close before (of the day, or of the whole series), else its own close."""
    keys = ("code", "date") if within_day else ("code",)
    before = F.lag("close").over(Window.partitionBy(*keys).orderBy("datetime"))
    broken = F.col("open").isNull() | (F.col("open") <= 0)
    return df.withColumn("open", F.when(broken, F.coalesce(before, F.col("close"))).otherwise(F.col("open"))).filter("open > 0")


def repair_price(df: DataFrame) -> DataFrame:
    return df.withColumn("price", F.when(F.col("price") > 0, F.col("price")).otherwise(F.col("close")))


def in_session(datetime: Column, seconds: int = 60) -> Column:
    """Whether a stamp is on the grid of 09:31 to 11:30 or 13:01 to 15:00."""
    minute = F.hour(datetime) * 60 + F.minute(datetime)
    step = seconds // 60
    morning = minute.between(571, 690) & ((minute - 571) % step == 0)
    afternoon = minute.between(781, 900) & ((minute - 781) % step == 0)
    return (morning | afternoon) & (F.second(datetime) == 0)


def canonical(df: DataFrame, code: str | None = None, seconds: int | None = 60) -> DataFrame:
    """Clean, repaired bars of the regular session. Repairs see bars outside of it, as they come first."""
    df = repair_open(clean(df, code).withColumn("date", F.to_date("datetime")))
    if seconds in (60, 300):
        df = df.filter(in_session(F.col("datetime"), seconds))
    return repair_price(df).select("datetime", "date", "code", "open", "high", "low", "close", "volume", "amount", "price")


def frequency(df: DataFrame) -> DataFrame:
    """The commonest positive step between bars of a code, in seconds; of several, the smallest."""
    step = F.unix_seconds(F.col("datetime").cast("timestamp")) - F.lag(F.unix_seconds(F.col("datetime").cast("timestamp"))).over(Window.partitionBy("code").orderBy("datetime"))
    counts = df.withColumn("seconds", step).filter("seconds > 0").groupBy("code", "seconds").agg(F.count("*").alias("n"))
    return counts.groupBy("code").agg(F.max_by("seconds", F.struct("n", -F.col("seconds"))).alias("seconds"))


def expected_bars(seconds: Column) -> Column:
    return F.when(FULL_DAY_SECONDS % seconds == 0, (FULL_DAY_SECONDS / seconds).cast("int"))


#: Bits of a tick's number within its microsecond and hour, packed below the microseconds of the hour.
SEQ_BITS = 31


def tick_order(bar: Column, seq_bits: int | None = SEQ_BITS) -> Column:
    """What orders the ticks of a bar of an hour at most: one integer, so that aggregates hash instead of sorting.

    A number of a tick beyond the bits is an error; with seq_bits=None a struct orders, at the price of a sort.
    """
    if seq_bits is None:
        return F.struct("datetime", "seq")
    packed = F.timestamp_diff("MICROSECOND", bar, F.col("datetime")) * (1 << seq_bits) + F.col("seq")
    return F.when(F.col("seq").between(0, (1 << seq_bits) - 1), packed).otherwise(F.raise_error(F.lit("a tick's number needs more bits: seq_bits=None")))


def from_ticks(ticks: DataFrame, unit: str = "hour", minutes: int | None = None, seq_bits: int | None = SEQ_BITS) -> DataFrame:
    """Bars of a unit of time (an hour at most, unless seq_bits is None), or of some minutes that divide an hour, from ticks with a positive price."""
    bar = F.date_trunc("hour" if minutes else unit, "datetime").cast("timestamp_ntz")
    if minutes:
        bar = bar + F.make_dt_interval(mins=(F.floor(F.minute("datetime") / minutes) * minutes).cast("int"))
    by = tick_order(bar, seq_bits if unit.lower() in ("hour", "minute", "second") else None)
    return (
        ticks.filter("price > 0")
        .groupBy("code", "date", bar.alias("bar"))
        .agg(
            F.min_by("price", by).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", by).alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("amount").alias("amount"),
            F.count("*").alias("n_ticks"),
        )
        .withColumnRenamed("bar", "datetime")
        .withColumn("price", F.col("close"))
    )


def daily_summary(bars: DataFrame, expected: int | None) -> DataFrame:
    """One row for each code and day: prices (first and last that are not missing), sums, counts, completeness."""
    at = lambda c: F.when(F.col(c).isNotNull(), F.col("datetime"))
    out = bars.groupBy("code", "date").agg(
        F.min("datetime").alias("first_datetime"),
        F.max("datetime").alias("last_datetime"),
        F.count("*").alias("bar_count"),
        F.min_by("open", at("open")).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", at("close")).alias("close"),
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("amount"),
        F.max_by("price", at("price")).alias("price"),
        F.count_if(F.col("volume") == 0).alias("zero_volume_bar_count"),
        F.count_if(F.col("amount") == 0).alias("zero_amount_bar_count"),
    )
    return out.select(
        "*",
        (F.col("zero_volume_bar_count") / F.col("bar_count")).alias("zero_volume_bar_ratio"),
        (F.col("zero_amount_bar_count") / F.col("bar_count")).alias("zero_amount_bar_ratio"),
        F.lit(expected).cast("int").alias("expected_bar_count"),
        F.coalesce(F.col("bar_count") == F.lit(expected), F.lit(False)).alias("is_complete_day"),
    )


def audit(raw: DataFrame, days: DataFrame) -> DataFrame:
    """Counts of what cleaning drops, and how many bars days have: one row."""
    keyed = raw.filter("datetime IS NOT NULL")
    one = raw.agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col("datetime").isNull()).alias("invalid_datetime"),
        F.count_if(F.col("volume") < 0).alias("negative_volume"),
        F.count_if((F.col("high") <= 0) | (F.col("low") <= 0) | (F.col("close") <= 0)).alias("invalid_prices"),
        F.count_if(F.col("open") <= 0).alias("broken_opens"),
        F.sort_array(F.collect_set("code")).alias("codes"),
    )
    repeated = keyed.groupBy("code", "datetime").agg((F.count("*") - 1).alias("more")).agg(F.coalesce(F.sum("more"), F.lit(0)).alias("repeated_times"))
    counts = days.agg(
        F.count("*").alias("n_days"),
        F.count_if(~F.col("is_complete_day")).alias("incomplete_days"),
        F.min("bar_count").alias("min_bars"),
        F.max("bar_count").alias("max_bars"),
        F.percentile("bar_count", 0.5).alias("median_bars"),
        F.avg("bar_count").alias("mean_bars"),
    )
    first = days.filter(~F.col("is_complete_day")).orderBy("date", "code").limit(20)
    first = first.agg(F.slice(F.sort_array(F.collect_list(F.concat_ws(" ", F.col("date").cast("string"), "code"))), 1, 20).alias("first_incomplete"))
    return one.join(repeated).join(counts).join(first)  # single rows


def missing_ratio(df: DataFrame, limit: int = 20) -> DataFrame:
    """The columns with the largest share of missing values."""
    shares = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_share")) for c in df.columns)))
    return shares.select(pairs.alias("p")).select("p.*").orderBy(F.col("missing_share").desc(), "column_name").limit(limit)


def bars_per_day(bars: DataFrame) -> DataFrame:
    return bars.groupBy("code", "date").agg(F.count("*").alias("n")).groupBy("code").agg(F.avg("n").alias("mean_bars"), F.min("n").alias("min_bars"), F.max("n").alias("max_bars"))


def complete(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without a missing value in the columns."""
    return df.dropna(subset=list(columns))


def between(df: DataFrame, first, last, column: str = "date") -> DataFrame:
    """Rows of a range of dates, both ends included; on stored tables the range reaches the scan."""
    return df.filter(F.col(column).between(F.lit(first), F.lit(last)))


def in_chunks(chunks: list[DataFrame], key: tuple[str, ...]) -> DataFrame:
    """The union of chunks that may overlap: of a key, the row of the last chunk stays."""
    both = [c.withColumn("_chunk", F.lit(k)) for k, c in enumerate(chunks)]
    out = both[0]
    for c in both[1:]:
        out = out.unionByName(c)
    order = Window.partitionBy(*key).orderBy(F.col("_chunk").desc(), F.col("seq").desc())
    return out.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "_chunk")


def patch_zero_open(df: DataFrame) -> DataFrame:
    """An open of exactly zero is the close."""
    return df.withColumn("open", F.when(F.col("open") == 0, F.col("close")).otherwise(F.col("open")))


def sum_or_missing(c: str) -> Column:
    """A sum that is missing where no value is there; the daily summary's own sums are 0 then."""
    return F.sum(c)
