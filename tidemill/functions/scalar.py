"""Scalar column functions. Missing is NULL, never NaN; a division by zero is missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def ratio(a, b) -> Column:
    """a / b; missing where b is missing or zero."""
    return F.try_divide(col(a), col(b))


def change(anchor, price) -> Column:
    """price / anchor - 1 for a positive anchor."""
    return F.when(col(anchor) > 0, col(price) / col(anchor) - 1)


def move(anchor, price) -> Column:
    """(price - anchor) / anchor; missing for a zero anchor."""
    return ratio(col(price) - col(anchor), anchor)


def spread_ratio(high, low) -> Column:
    """high / low - 1 for a positive low."""
    return change(low, high)


def clip(x, low, high) -> Column:
    """x held in [low, high]; least and greatest skip NULL, so a missing x must be kept apart."""
    return F.when(col(x).isNotNull(), F.least(F.greatest(col(x), col(low)), col(high)))


def quantile(x, share: float, accuracy: int | None = None) -> Column:
    """An aggregate: the interpolated quantile, which holds a group's distinct values; with an accuracy the approximate one, of bounded memory."""
    return F.percentile(col(x), F.lit(share)) if accuracy is None else F.percentile_approx(col(x), share, accuracy)


def flag(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it does not or is missing."""
    return F.coalesce(condition, F.lit(False)).cast("double")


def int_flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def time_bucket(index, total, buckets: int) -> Column:
    """The 1-based bucket of a 0-based index among total places."""
    return F.least(F.floor(ratio(col(index) * F.lit(1.0), total) * buckets) + 1, F.lit(buckets)).cast("double")


def gap_risk_bucket(a, b) -> Column:
    """0 to 3 by the larger of two absolute returns: below 1 %, 2 %, 3.5 %, above."""
    size = F.greatest(F.abs(col(a)), F.abs(col(b)))
    return F.when(size < 0.01, 0).when(size < 0.02, 1).when(size < 0.035, 2).when(size.isNotNull(), 3)


def number(x) -> Column:
    """A double from text; missing where it is none, and for NaN."""
    value = F.try_cast(col(x), "double") if hasattr(F, "try_cast") else col(x).try_cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def weekday_after(d) -> Column:
    """The next day that is no Saturday or Sunday."""
    w = F.weekday(col(d))
    return F.date_add(col(d), F.when(w == 4, 3).when(w == 5, 2).otherwise(1))


def weekday_before(d) -> Column:
    w = F.weekday(col(d))
    return F.date_sub(col(d), F.when(w == 0, 3).when(w == 6, 2).otherwise(1))


def symbol(x, strict: bool = False) -> Column:
    """The one six-digit code in a text, else its digits filled up to six; missing where neither is clear, or an error if strict."""
    text = F.trim(col(x))
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?<![0-9])([0-9]{6})(?![0-9])"), F.lit(1)))
    digits = F.regexp_replace(text, "[^0-9]", "")
    clear = F.when(F.size(found) == 1, found[0]).when((F.size(found) == 0) & F.length(digits).between(1, 6), F.lpad(digits, 6, "0"))
    return F.coalesce(clear, F.raise_error(F.concat(F.lit("no clear symbol: "), text)).cast("string")) if strict else clear


def exchange_symbol(x) -> Column:
    """A symbol with its exchange: a known suffix stays, else the leading digit tells."""
    text = F.upper(F.trim(col(x)))
    suffix = F.regexp_extract(text, r"\.(SZ|SS|BJ)$", 1)
    code = symbol(text)
    lead = F.substring(code, 1, 1)
    own = F.when(lead.isin("0", "2", "3"), "SZ").when(lead.isin("5", "6", "9"), "SS").when(lead.isin("4", "8"), "BJ")
    return F.concat_ws(".", code, F.when(suffix != "", suffix).otherwise(own))


def month_ranges(start, end) -> Column:
    """Array of (first, last) days of the months from start to end, cut to them."""
    months = F.sequence(F.trunc(col(start), "month"), F.trunc(col(end), "month"), F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.struct(F.greatest(m.cast("date"), col(start)).alias("first"), F.least(F.last_day(m), col(end)).alias("last")))
