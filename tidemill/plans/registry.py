"""All registered queries and their DuckDB counterparts.

A query is a function of (spark, sf_dir). Doubles are rounded to DIGITS places on both
sides, as the order of floating sums is nobody's contract.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def tidy(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(F.col(f"`{c}`"), DIGITS).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


def add(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str | None = None, floats: str = "") -> None:
    """floats: the double columns of the SQL, which are rounded like those of the query (and never -0.0)."""
    QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
    if sql is not None:
        sql = re.sub(r"count_if\(([^()]*)\)", r"count(*) FILTER (WHERE \1)", sql)  # a BIGINT, as in Spark
        names = floats.split()
        rounded = f" REPLACE ({', '.join(f'round(CAST({c} AS DOUBLE), {DIGITS}) + 0 AS {c}' for c in names)})" if names else ""
        ORACLES[name] = f"SELECT *{rounded} FROM ({sql}) AS q"


from . import boosting, decision, evaluation, extension, foundation, intraday, labels, sources, training, upkeep  # noqa: E402, F401
