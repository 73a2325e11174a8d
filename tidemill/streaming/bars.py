"""Bars from a stream of ticks, and their upsert. An extension: batch and stream give the same bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.bars import tick_order
from ..sources.sinks import work_path


def tick_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet", files_per_batch: int = 100) -> DataFrame:
    """Tick files of a folder as a stream, in the columns of sources.tables.ticks."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    volume = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.col("event_type").alias("code"), F.col("ts").cast("timestamp").alias("datetime"), F.col("event_id").alias("seq"), F.col("value").alias("price"), volume.alias("volume"), (F.col("value") * volume).alias("amount")
    )


def bars(ticks: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Open, high, low, close and sums by window; state of windows older than the watermark is dropped."""
    by = tick_order(F.date_trunc(width.split()[1], "datetime")) if width.split()[0] == "1" and width.split()[1].rstrip("s") in ("hour", "minute") else F.struct("datetime", "seq")
    out = (
        ticks.filter("price > 0")
        .withWatermark("datetime", late)
        .groupBy(F.window("datetime", width), "code")
        .agg(F.min_by("price", by).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", by).alias("close"), F.sum("volume").alias("volume"), F.sum("amount").alias("amount"), F.count("*").alias("n_ticks"))
    )
    return out.select("code", F.col("window.start").alias("datetime"), "open", "high", "low", "close", "volume", "amount", "n_ticks")


def run_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Work off what there is. Each batch's changed bars go to a folder of its own, so a batch that is repeated replaces itself."""

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = stream.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def current(spark: SparkSession, target: str) -> DataFrame:
    """The latest version of each bar."""
    stored = spark.read.option("basePath", target).parquet(f"{target}/batch=*")
    w = Window.partitionBy("code", "datetime").orderBy(F.col("batch").desc())
    return stored.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "batch")


def work_folder(spark: SparkSession) -> str:
    return work_path(spark, "stream")
