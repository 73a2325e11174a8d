"""Windows over one long series as many tasks.

A series is cut into ranges of its order.  Every range is given a halo, the last rows before
it, so windows that look back a bounded number of rows run within ranges; what is unbounded
(fills, expanding means) is a sum or a last value of each range, carried over the ranges
before.  A range has at most one series that began in an earlier one, so what is carried,
and which range needs whose last rows, are tables of the size of the number of ranges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stored

PART, HALO, PLACE = "_range_of_series", "_is_halo", "_place_in_series"


def cut(df: DataFrame, key: str = "code", order: str = "date", ranges: int | None = None) -> DataFrame:
    """df by ranges of (key, order), stored, with each row's range and its number in the series. order tells a series' rows apart."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(df.repartitionByRange(n, F.col(key).asc_nulls_first(), order).withColumn(PART, F.spark_partition_id()), "cut")
    begins = _begins(placed, key)
    within = Window.partitionBy(key, PART).orderBy(order)
    return _beside(placed, begins, key).withColumn(PLACE, F.row_number().over(within) + F.coalesce("_begin", F.lit(0))).drop("_begin")


def _begins(placed: DataFrame, key: str) -> DataFrame:
    """Rows (key, range, _begin): how many rows of the series lie before a range in which it goes on."""
    counts = placed.groupBy(key, PART).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(key, PART, F.sum("_n").over(before).alias("_begin")).filter("_begin IS NOT NULL")


def _beside(df: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """df with the columns of a table of (key, range), which is as small as the number of ranges."""
    far = small.withColumnsRenamed({key: "_far_key", PART: "_far_part"})
    return df.join(F.broadcast(far), df[key].eqNullSafe(far["_far_key"]) & (df[PART] == far["_far_part"]), "left").drop("_far_key", "_far_part")


def by_ranges(series: DataFrame, fn: Callable[[DataFrame], DataFrame], halo: int, key: str = "code") -> DataFrame:
    """fn over each range of a series from cut, with the halo rows before it; fn's windows are by key and look back at most halo rows in all.

    fn sees a key that stands for the series and the range, and must keep the rows it is given.
    """
    series = stored(series, "series")
    begins = stored(_begins(series, key), "begins")
    tail = Window.partitionBy(key, PART)
    ends = series.withColumn("_last", F.max(PLACE).over(tail)).filter(F.col(PLACE) > F.col("_last") - halo).drop("_last")
    far = begins.withColumnsRenamed({key: "_far_key", PART: "_to"})
    needed = ends[key].eqNullSafe(far["_far_key"]) & (ends[PART] < far["_to"]) & (ends[PLACE] <= far["_begin"]) & (ends[PLACE] > far["_begin"] - halo)
    extra = ends.join(F.broadcast(far), needed).withColumn(PART, F.col("_to")).drop("_far_key", "_to", "_begin")
    both = series.withColumn(HALO, F.lit(False)).unionByName(extra.withColumn(HALO, F.lit(True)))
    out = fn(both.withColumn(key, F.struct(F.col(key).alias("k"), F.col(PART).alias("r"))))
    return out.filter(~F.col(HALO)).withColumn(key, F.col(f"{key}.k")).drop(HALO)


def forward_fill(series: DataFrame, columns: tuple[str, ...], key: str = "code") -> DataFrame:
    """Columns with the last value before where they are missing, as far back as the series goes."""
    series = stored(series, "series")
    lasts = series.groupBy(key, PART).agg(*(F.max_by(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"))), F.when(F.col(c).isNotNull(), F.col(PLACE))).alias(f"_l_{c}") for c in columns))
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(key, PART, *(F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in columns))
    carried = carried.filter(" OR ".join(f"`_c_{c}` IS NOT NULL" for c in columns))
    here = Window.partitionBy(key, PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    out = _beside(series, carried, key)
    return out.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(here), F.col(f"_c_{c}.v")) for c in columns}).drop(*(f"_c_{c}" for c in columns))


def expanding_mean(series: DataFrame, columns: dict[str, str], key: str = "code") -> DataFrame:
    """Means of all rows up to each, as new columns. columns: by the new name, what is averaged."""
    series = stored(series, "series")
    sums = series.groupBy(key, PART).agg(*(f(c).alias(f"_{p}_{name}") for name, c in columns.items() for p, f in (("s", F.sum), ("n", F.count))))
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    both = [f"_{p}_{name}" for name in columns for p in "sn"]
    carried = sums.select(key, PART, F.count("*").over(before).alias("_earlier"), *(F.sum(c).over(before).alias(c) for c in both)).filter("_earlier > 0").drop("_earlier")
    here = Window.partitionBy(key, PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    out = _beside(series, carried, key)
    zero = lambda c: F.coalesce(c, F.lit(0))
    mean = lambda name, c: F.try_divide(zero(F.sum(c).over(here)) + zero(F.col(f"_s_{name}")), F.count(c).over(here) + zero(F.col(f"_n_{name}")))
    return out.withColumns({name: mean(name, c) for name, c in columns.items()}).drop(*both)


def whole(series: DataFrame) -> DataFrame:
    """Without what cut added."""
    return series.drop(PART, PLACE)
