"""Shared plumbing: reading tables, materialising in the shared folder, Arrow maps."""

from __future__ import annotations

import hashlib
import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pattern of a word in the contracts: a run of characters other than ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"

#: DuckDB SQL: crc32 of a text of ASCII characters, bit by bit. {} is the text.
CRC32_SQL = "xor(list_reduce([4294967295] || list_transform(string_split({}, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x // 2, 3988292384 * (x % 2)))), 4294967295)"

_OWN_DIR: list[str] = []
_LOCAL = threading.local()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  Where that is unset, a temporary one of this machine, but only if nothing else runs tasks."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN_DIR:
        _OWN_DIR.append("file://" + tempfile.mkdtemp(prefix="tidemill-"))
    return _OWN_DIR[0]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tidemill/{uuid.uuid4().hex}/{label}"


@contextmanager
def scratch(spark: SparkSession):
    """What `materialize` writes within this block, unless it is to be kept, is deleted at its end."""
    outer, _LOCAL.folder = getattr(_LOCAL, "folder", None), fresh_path(spark, "scratch")
    try:
        yield
    finally:
        folder, _LOCAL.folder = _LOCAL.folder, outer
        path = spark._jvm.org.apache.hadoop.fs.Path(folder).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    Tables that a result reads must be kept in a `scratch` block; they stay until their owner clears the folder.
    """
    spark = df.sparkSession
    folder = getattr(_LOCAL, "folder", None)
    path = f"{folder}/{uuid.uuid4().hex}/{label}" if folder and not keep else fresh_path(spark, label)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as set it apart from the columns of docs."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, null texts as empty: other columns and their names cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow over column lists: fn gets an iterator of {name: list} and yields {name: list}.

    Batches are bounded for the session from then on, as jobs read that setting when they run.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    typed = StructType.fromDDL(schema)
    arrow = to_arrow_schema(typed)

    def run(batches):
        def columns():
            for b in batches:
                yield {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}

        for out in fn(columns()):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    bound_batches(spark)
    return df.mapInArrow(run, typed)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded bytes and rows, so that long texts do not pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    except Exception:  # the setting is newer than some supported releases
        pass


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
