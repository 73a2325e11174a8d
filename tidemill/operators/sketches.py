"""Quantiles from mergeable sketches, and exact ones from the brackets that sketches give.

A sketch (KLL) of each small group, a day or a window, is a column of a stored table; sketches
of any larger group are merged from those, without the rows.  The rank of a sketch's answer is
wrong by a share of the rows that depends on its size alone (``rank_error``).

Exact quantiles take a second pass: the sketch gives a bracket of values around each place,
rows below the bracket are counted, rows within it are ranked by ranges.  If a place turns
out to lie outside its bracket, all of the key's values are its bracket.  So results are
exact, while only about twice the rank error of the rows is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stored
from .ranks import value_ranks

SIZE = 1024


def rank_error(size: int = SIZE) -> float:
    """Share of the rows by which a sketch's rank may be wrong, at 99 % confidence. Fixed values of the published bound."""
    return 2.446 / size**0.9433


def sketch(value: str | Column, size: int = SIZE) -> Column:
    """An aggregate: the sketch of a column's values that are not missing."""
    return F.kll_sketch_agg_double(value, F.lit(size))


def merged(sketches: DataFrame, column: str, *key: str, size: int = SIZE) -> DataFrame:
    return sketches.groupBy(*key).agg(F.kll_merge_agg_double(column, F.lit(size)).alias(column))


def quantiles(sketches: DataFrame, column: str, at: dict[str, float]) -> DataFrame:
    """Approximate: a column for each name, in place of the sketch."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double(column, F.lit(q)) for name, q in at.items()}).drop(column)


def exact_quantiles(df: DataFrame, value: str, at: dict[str, float], key: tuple[str, ...], sketches: DataFrame, column: str = "sketch", size: int = SIZE) -> DataFrame:
    """Exact quantiles with linear interpolation, a row a key. sketches: a merged one for each key of df, its values those of df.

    df is read twice. Null is no key here.
    """
    df = df.select(*key, F.col(value).cast("double").alias("_x")).filter("_x IS NOT NULL")
    margin = rank_error(size)
    low = lambda q: F.kll_sketch_get_quantile_double(column, F.lit(max(0.0, q - margin)))
    high = lambda q: F.kll_sketch_get_quantile_double(column, F.lit(min(1.0, q + margin)))
    n = F.kll_sketch_get_n_double(column)
    wanted = F.explode(F.array(*(F.struct(F.lit(name).alias("_name"), F.lit(float(q)).alias("_q"), low(q).alias("_lo"), high(q).alias("_hi")) for name, q in at.items())))
    brackets = sketches.select(*key, n.alias("_n"), wanted.alias("_w")).select(*key, "_n", "_w.*").filter("_n > 0")
    # ends are exact minima and maxima, so brackets at the ends are open
    brackets = stored(brackets.withColumns({"_lo": F.when(F.col("_q") > margin, F.col("_lo")), "_hi": F.when(F.col("_q") < 1 - margin, F.col("_hi"))}), "brackets")
    found = _within(df, brackets, key)
    missed = brackets.join(found.select(*key, "_name"), [*key, "_name"], "left_anti").withColumns({"_lo": F.lit(None).cast("double"), "_hi": F.lit(None).cast("double")})
    if not missed.isEmpty():
        found = found.unionByName(_within(df, stored(missed, "missed"), key))
    return found.groupBy(*key).agg(*(F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in at))


def _within(df: DataFrame, brackets: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows (key, _name, _value) for the brackets that hold both of their places."""
    each = df.join(brackets, list(key))
    below = F.coalesce(F.col("_x") < F.col("_lo"), F.lit(False))
    inside = ~below & F.coalesce(F.col("_x") <= F.col("_hi"), F.lit(True))
    under = each.groupBy(*key, "_name").agg(F.count_if(below).alias("_under"))
    ranks = value_ranks(each.filter(inside).select(*key, "_name", "_x"), "_x", *key, "_name")
    place = F.col("_q") * (F.col("_n") - 1)
    at = F.col("_under") + F.col("below")
    holds = lambda p: (at <= p) & (p < at + F.col("n"))
    got = ranks.join(under, [*key, "_name"]).join(brackets.select(*key, "_name", "_q", "_n"), [*key, "_name"])
    got = got.groupBy(*key, "_name").agg(
        F.max(F.when(holds(F.floor(place)), F.col("_x"))).alias("_a"), F.max(F.when(holds(F.ceil(place)), F.col("_x"))).alias("_b"), F.max(place - F.floor(place)).alias("_part")
    )
    return stored(got.filter("_a IS NOT NULL AND _b IS NOT NULL").select(*key, "_name", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("_value")), "within")
