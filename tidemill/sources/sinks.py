"""Writing results: tables by Spark's commit protocol, small texts by rename."""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_path(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share; where that is unset, of this machine, if nothing else runs tasks."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tidemill-")
    return f"{shared.rstrip('/')}/tidemill/{uuid.uuid4().hex}/{label}"


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def merge_table(fresh: DataFrame, path: str, key: tuple[str, ...], partition: str, seq: str = "seq") -> None:
    """Fresh rows into a table that is stored by partition: of a key the fresh row stays, of several the one with the largest seq.

    Only partitions that fresh rows hold are read, merged and replaced; files of others keep their names. The partition is a
    column of the key, so no row moves from one to another. Merged rows are written aside first, and then take their places.
    """
    if partition not in key:
        raise ValueError(f"{partition} must be a column of the key")
    spark = fresh.sparkSession
    fresh = stored(fresh, "fresh")
    touched = fresh.select(partition).distinct()
    old = spark.read.schema(fresh.schema).parquet(path)
    old = old.join(touched, partition, "left_semi")  # prunes the scan to these partitions where they are few enough to be broadcast
    both = old.withColumn("_round", F.lit(0)).unionByName(fresh.withColumn("_round", F.lit(1)))
    best = F.max_by(F.struct(*(c for c in fresh.columns if c not in key)), F.struct("_round", seq))
    merged = stored(both.groupBy(*key).agg(best.alias("_r")).select(*key, "_r.*"), "merged")
    merged.select(*fresh.columns).repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written to a new path of the shared folder and read back: for frames that several branches of a plan read. It stays until its owner clears the folder."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that work_path gave, with the folder made for it."""
    whole = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    whole.getFileSystem(spark._jsc.hadoopConfiguration()).delete(whole, True)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV parts with a header; one part only for results known to be small."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_text(path: str | os.PathLike, text: str) -> None:
    """Whole or not at all: a temporary file beside it takes its name; where that is not allowed, written in place."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=target.parent)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.replace(name, target)
        except PermissionError:
            target.write_text(text, encoding="utf-8")
    finally:
        if os.path.exists(name):
            os.unlink(name)


def write_json(path: str | os.PathLike, payload: object) -> None:
    write_text(path, json.dumps(payload, ensure_ascii=False, indent=2, default=str))
