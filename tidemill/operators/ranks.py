"""Numbers and ranks of rows without a window that holds a whole group.

Rows are dealt out by ranges of (key, order), so a group of any size lies in as many tasks
as its share of the rows asks for.  Rows are numbered within a range, and what a key has
before the range is carried over its bound: a range has at most one key that began in an
earlier one, so what is carried is at most a row a range, and is broadcast.

A run of equal values is one row of the counting table (values are counted before anything
is sorted), so ties do not gather either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stored

PART = "_range_of_rows"


def _ranges(df: DataFrame, key: tuple[str, ...], order: tuple[Column, ...], ranges: int | None) -> DataFrame:
    """df dealt out by ranges and written with each range's number, so that no later read deals it anew."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(n, *(F.col(k).asc_nulls_first() for k in key), *order).withColumn(PART, F.spark_partition_id()), "ranges")


def _carried(ranged: DataFrame, key: tuple[str, ...], sums: dict[str, Column]) -> DataFrame:
    """For each range whose first key began before it: the sums over that key's rows in earlier ranges."""
    each = ranged.groupBy(*key, PART).agg(*(v.alias(k) for k, v in sums.items()))
    before = Window.partitionBy(*key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    each = each.select(*key, PART, F.count("*").over(before).alias("_n"), *(F.sum(k).over(before).alias(f"_before_{k}") for k in sums))
    return each.filter("_n > 0").drop("_n")


def _joined(ranged: DataFrame, carried: DataFrame, key: tuple[str, ...], names: list[str]) -> DataFrame:
    far = carried.select(*(F.col(k).alias(f"_far_{k}") for k in key), F.col(PART).alias("_far_part"), *(f"_before_{k}" for k in names))
    same = F.col(PART) == F.col("_far_part")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_far_{k}"))
    out = ranged.join(F.broadcast(far), same, "left").drop("_far_part", *(f"_far_{k}" for k in key))
    return out.withColumns({f"_before_{k}": F.coalesce(f"_before_{k}", F.lit(0)) for k in names})


def numbered(df: DataFrame, key: tuple[str, ...], order: tuple[Column, ...], name: str = "row_number", ranges: int | None = None) -> DataFrame:
    """df with each row's number within its key, from 1. order must tell rows apart, or ties are numbered in any way. Null is a key."""
    ranged = _ranges(df, key, order, ranges)
    whole = _joined(ranged, _carried(ranged, key, {"rows": F.count("*")}), key, ["rows"])
    within = Window.partitionBy(*key, PART).orderBy(*order)
    return whole.withColumn(name, (F.row_number().over(within) + F.col("_before_rows")).cast("long")).drop(PART, "_before_rows")


def value_ranks(df: DataFrame, value: str, *key: str, sums: dict[str, Column] | None = None, ranges: int | None = None) -> DataFrame:
    """One row for each key and distinct value: n (rows that have it), below (rows with lesser values), average_rank
    (from 1, ties at their mean). Missing values are left out. sums: more whole numbers that are added up, by name;
    each gives its sum over the value's rows, and below_<name> over lesser values."""
    sums = sums or {}
    counts = df.filter(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("n"), *(F.sum(v).cast("long").alias(k) for k, v in sums.items()))
    names = ["n", *sums]
    ranged = _ranges(counts, key, (F.col(value).asc(),), ranges)
    whole = _joined(ranged, _carried(ranged, key, {k: F.sum(k) for k in names}), key, names)
    within = Window.partitionBy(*key, PART).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = {k: (F.coalesce(F.sum(k).over(within), F.lit(0)) + F.col(f"_before_{k}")).cast("long") for k in names}
    whole = whole.withColumns({"below" if k == "n" else f"below_{k}": v for k, v in below.items()})
    return whole.withColumn("average_rank", F.col("below") + (F.col("n") + 1) / 2).drop(PART, *(f"_before_{k}" for k in names))


def with_average_rank(df: DataFrame, value: str, name: str, *key: str, ranges: int | None = None) -> DataFrame:
    """df with the average rank of value within key; missing values have none."""
    ranks = value_ranks(df, value, *key, ranges=ranges).select(*(F.col(k).alias(f"_rank_{k}") for k in key), F.col(value).alias("_rank_value"), F.col("average_rank").alias(name))
    same = F.col(value) == F.col("_rank_value")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_rank_{k}"))
    return df.join(ranks, same, "left").drop("_rank_value", *(f"_rank_{k}" for k in key))


def quantile(df: DataFrame, value: str, at: dict[str, float], *key: str, ranges: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: a row a key, a column for each name in at."""
    return quantile_of_ranks(stored(value_ranks(df, value, *key, ranges=ranges), "value_ranks"), value, at, *key)


def quantile_of_ranks(ranks: DataFrame, value: str, at: dict[str, float], *key: str) -> DataFrame:
    """The same from a table of value_ranks."""
    total = ranks.groupBy(*key).agg(F.sum("n").alias("_total"))
    picked = []
    for name, q in at.items():
        # the value at a place is the one with below <= place < below + n; a place has two neighbours at most
        place = (F.col("_total") - 1) * F.lit(float(q))
        holds = lambda p: (F.col("below") <= p) & (p < F.col("below") + F.col("n"))
        low, high = F.max(F.when(holds(F.floor(place)), F.col(value))), F.max(F.when(holds(F.ceil(place)), F.col(value)))
        picked.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_all_{k}"))
    totals = total.select(*(F.col(k).alias(f"_all_{k}") for k in key), "_total")
    return ranks.join(totals, same).groupBy(*key).agg(*picked)
