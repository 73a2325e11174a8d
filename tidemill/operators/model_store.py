"""Versions of tree models in any file system that Spark reaches, one of them promoted by a pointer file.

A version is a folder of its own and is never changed.  The pointer is a small file that is
written aside and renamed over the old one in one step, so a reader finds the old version or
the new one, whole; where the file system cannot replace a file by a rename, promoting fails
and the old pointer stays.  The pointer names the version before it, to which a rollback goes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from .boosting import Model

POINTER = "CURRENT.json"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _write(spark: SparkSession, path, text: str) -> None:
    out = _fs(spark, path).create(path, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read(spark: SparkSession, path) -> str | None:
    fs = _fs(spark, path)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def save(spark: SparkSession, folder: str, model: Model, thresholds: dict[str, float] | None = None, about: dict | None = None) -> str:
    """A new version, not yet promoted: the model, and metadata of its heads. Gives the version's name."""
    version = uuid.uuid4().hex
    heads = {h.name: {"target": h.target, "kind": h.kind, "columns": list(model.columns), "trees": len(h.trees), "threshold": (thresholds or {}).get(h.name)} for h in model.heads}
    _write(spark, _path(spark, folder, version, "model.json"), model.to_json())
    _write(spark, _path(spark, folder, version, "metadata.json"), json.dumps({"version": version, "heads": heads} | (about or {}), indent=2))
    return version


def pointer(spark: SparkSession, folder: str) -> dict | None:
    """What is promoted: version, previous, promoted_at; None if nothing is."""
    text = _read(spark, _path(spark, folder, POINTER))
    return json.loads(text) if text else None


def promote(spark: SparkSession, folder: str, version: str, stamp: str) -> None:
    """Make a whole version the current one. Promoting the current one again changes nothing."""
    for name in ("model.json", "metadata.json"):
        if _read(spark, _path(spark, folder, version, name)) is None:
            raise FileNotFoundError(f"{folder}/{version}/{name}")
    now = pointer(spark, folder)
    if now and now["version"] == version:
        return
    fresh, target = _path(spark, folder, f".{POINTER}.{uuid.uuid4().hex}"), _path(spark, folder, POINTER)
    _write(spark, fresh, json.dumps({"version": version, "previous": now and now["version"], "promoted_at": stamp}))
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, target).getUri(), spark._jsc.hadoopConfiguration())
    context.rename(_fs(spark, fresh).makeQualified(fresh), _fs(spark, target).makeQualified(target), how)


def rollback(spark: SparkSession, folder: str, stamp: str) -> str:
    """Promote the version before the current one; gives its name."""
    now = pointer(spark, folder)
    if not now or not now["previous"]:
        raise ValueError(f"{folder} has no version before the current one")
    promote(spark, folder, now["previous"], stamp)
    return now["previous"]


def load(spark: SparkSession, folder: str, version: str | None = None) -> tuple[Model, dict]:
    """The model and the metadata of a version, or of the promoted one."""
    if version is None:
        now = pointer(spark, folder)
        if now is None:
            raise FileNotFoundError(f"{folder} has no promoted version: save one and promote it first")
        version = now["version"]
    model, meta = (_read(spark, _path(spark, folder, version, name)) for name in ("model.json", "metadata.json"))
    if model is None or meta is None:
        raise FileNotFoundError(f"{folder}/{version}")
    return Model.from_json(model), json.loads(meta)
