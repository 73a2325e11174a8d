"""Reading tables and texts, and the sources of bars that the driver's tables stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.scalar import number
from .sinks import work_path

#: Fixed values (P1, P2): headers that input files have for the same column.
ALIASES = {
    "日期": "date", "时间": "datetime", "代码": "code", "开盘": "open", "收盘": "close", "最高": "high",
    "最低": "low", "成交量": "volume", "成交额": "amount", "Date": "date", "Close": "close", "money": "amount", "day": "datetime",
}
BAR_FIELDS = ("open", "high", "low", "close", "volume", "amount", "price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rename_aliases(df: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Known headers under their own name, unless that is taken; others pass."""
    return df.select(*(F.col(f"`{c}`").alias(aliases[c] if c in aliases and aliases[c] not in df.columns else c) for c in df.columns))


def first_present(df: DataFrame, candidates: tuple[str, ...]) -> str:
    """The first of the candidates that is a column."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"none of {', '.join(candidates)} is a column")


def require(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_csv(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Text columns by header, aliases resolved; only the given columns where they are given."""
    df = rename_aliases(spark.read.option("header", True).option("encoding", "UTF-8").csv(path))
    return df.select(*columns) if columns else df


def usable(spark: SparkSession, path: str, least: int = 32) -> bool:
    """Whether a file or folder is there and larger than some bytes, in whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) and fs.getContentSummary(p).getLength() > least


def read_csv_or_empty(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The columns of a CSV file; an empty frame where the file is missing, empty or has other columns."""
    empty = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    try:
        if not usable(spark, path, 0):
            return empty
        return read_csv(spark, path, columns)
    except AnalysisException:
        return empty


def read_checked(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = (), separator: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of delimited text without a header, from one scan of it.

    Rejects are (line, reason): 'fields' where their number is wrong, 'value' where one does not parse, 'missing' where a required one
    is empty. Both are written to the shared folder in that scan, so that reading either reads only its rows.
    """
    names = [f.name for f in T.StructType.fromDDL(schema)]
    read = spark.read.schema(f"{schema}, _line string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line").option("sep", separator)
    rows = read.csv(path)
    fields = F.size(F.split(F.col("_line"), f"[{separator}]", -1))
    empty = F.lit(False)
    for c in required:
        empty = empty | F.col(c).isNull()
    reason = F.when(F.col("_line").isNotNull() & (fields != len(names)), "fields").when(F.col("_line").isNotNull(), "value").when(empty, "missing").otherwise("")
    line = F.coalesce("_line", F.concat_ws(separator, *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names)))
    both = rows.withColumn("_reason", reason).withColumn("_line", F.when(F.col("_reason") != "", line)).withColumn("_ok", F.col("_reason") == "")
    out = work_path(spark, "checked")
    both.write.partitionBy("_ok").parquet(out)
    table = spark.read.schema(f"{schema}, _line string, _reason string, _ok boolean").parquet(out)
    return table.filter("_ok").select(*names), table.filter("NOT _ok").select(F.col("_line").alias("line"), F.col("_reason").alias("reason"))


def typed_bars(df: DataFrame) -> DataFrame:
    """Text columns to the types of bars: timestamps and doubles, missing where they do not parse; optional columns added."""
    require(df, "datetime", "open", "high", "low", "close", "volume", "amount")
    for c in ("code", "price"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.select(F.expr("try_cast(datetime AS timestamp_ntz)").alias("datetime"), F.trim(F.col("code").cast("string")).alias("code"), *(number(c).alias(c) for c in BAR_FIELDS))


def parse_klines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Daily rows from comma-joined text: date, open, close, high, low, volume, amount; shorter rows are left out."""
    part = F.split(F.col(column), ",")
    names = ("open", "close", "high", "low", "volume", "amount")
    kept = lines.select(part.alias("part")).filter(F.size("part") >= 7)
    return kept.select(F.expr("try_cast(get(part, 0) AS date)").alias("date"), *(number(F.get("part", F.lit(i + 1))).alias(n) for i, n in enumerate(names)))


def parse_minutes(lines: DataFrame, column: str = "line") -> DataFrame:
    """Minute rows from comma-joined text of eight parts; a stamp without seconds gets them."""
    part = F.split(F.col(column), ",")
    names = ("open", "close", "high", "low", "volume", "amount", "price")
    kept = lines.select(part.alias("part")).filter(F.size("part") >= 8)
    first = F.get("part", F.lit(0))
    stamp = F.when(F.length(first) == 16, F.concat(first, F.lit(":00"))).otherwise(first)
    return kept.select(stamp.alias("stamp"), "part").select(F.expr("try_cast(stamp AS timestamp_ntz)").alias("datetime"), *(number(F.get("part", F.lit(i + 1))).alias(n) for i, n in enumerate(names)))


def snapshot_row(day: DataFrame, quote: DataFrame) -> DataFrame:
    """Daily rows with today's row made from a spot quote of the same columns; the quote wins."""
    return day.join(quote.select("date"), "date", "left_anti").unionByName(quote, allowMissingColumns=True)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as ticks: code, date, datetime, seq, price, volume, amount."""
    volume = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("code"),
        F.to_date("ts").alias("date"),
        F.col("ts").alias("datetime"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        volume.alias("volume"),
        (F.col("value") * volume).alias("amount"),
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a long daily series: one instrument for each priority."""
    by = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("code"), F.to_date("o_orderdate").alias("date"))
        .agg(
            F.min_by("o_totalprice", by).alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", by).alias("close"),
            F.count("*").cast("double").alias("volume"),
            F.sum("o_totalprice").alias("amount"),
        )
    )


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as an index: aggregates by ship date that no order of rows can change."""
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"))
        .agg(F.min_by(price, F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")).alias("close"), F.sum("l_quantity").alias("volume"))
    )


def segment_days(spark: SparkSession, sf_dir: str, segment: str = "BUILDING") -> DataFrame:
    """orders of one market segment as a sector's daily series."""
    customers = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == segment).select("c_custkey")
    by = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(F.min_by("o_totalprice", by).alias("open"), F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low"), F.max_by("o_totalprice", by).alias("close"), F.count("*").cast("double").alias("volume"))
    )
