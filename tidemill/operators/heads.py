"""Boosted-tree heads: feature choice, leakage audit, training, importance, storage and promotion.

Trees are Spark ML's; missing features are imputed by their median and flagged.
"""

from __future__ import annotations

import json
import math
import os
import shutil
import uuid
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import work_path, write_json
from .evaluate import HeadRule, choose_threshold

#: Columns that look ahead begin with one of these.
AHEAD = ("next_", "target_", "replay_")
KEYS = ("code", "date", "next_date", "row_idx", "part")
#: Rows of a partition in training: a tree takes a job for each level, whose tasks should not be shorter than their start.
PARTITION_ROWS = 50_000


@dataclass(frozen=True)
class TreeConfig:
    depth: int = 4
    rate: float = 0.05
    trees: int = 300
    sample: float = 0.9
    columns: str = "0.9"
    seed: int = 42


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if c not in KEYS and not c.startswith(AHEAD) and t in ("double", "float", "int", "bigint")]


def training_frame(features: DataFrame, labels: DataFrame, *key: str) -> DataFrame:
    """Inner one-to-one join; of the labels only the key, next_date and what looks ahead."""
    keep = [c for c in labels.columns if c in key or c == "next_date" or c.startswith(AHEAD)]
    return features.join(labels.select(*keep), list(key))


def leakage_audit(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Raises where a chosen column looks ahead or is a key, or where a row's next date is not after its date."""
    wrong = [c for c in columns if c.startswith(AHEAD) or c in KEYS]
    if wrong:
        raise ValueError(f"columns look ahead: {', '.join(wrong)}")
    if {"date", "next_date"} <= set(df.columns) and not df.filter(F.col("next_date") <= F.col("date")).isEmpty():
        raise ValueError("a next_date is not after its date")
    return {"n_features": len(columns), "features": columns, "violations": []}


def _pipeline(learner, columns: tuple[str, ...]) -> Pipeline:
    filled = [f"{c}_filled" for c in columns]
    return Pipeline(stages=[Imputer(strategy="median", inputCols=list(columns), outputCols=filled), VectorAssembler(inputCols=[*filled, *(f"{c}_missing" for c in columns)], outputCol="features"), learner])


def _prepared(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("double") for c in columns} | {c: F.col(c).cast("double") for c in columns})


@dataclass
class Head:
    model: PipelineModel
    columns: tuple[str, ...]
    target: str
    kind: str


def _cut_lineage(spark: SparkSession) -> None:
    """Boosting cuts its lineage every ten trees only where there is a folder for checkpoints."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_path(spark, "checkpoints"))


def fit_regressor(df: DataFrame, columns: tuple[str, ...], target: str, c: TreeConfig = TreeConfig()) -> Head:
    _cut_lineage(df.sparkSession)
    tree = GBTRegressor(labelCol=target, maxDepth=c.depth, stepSize=c.rate, maxIter=c.trees, subsamplingRate=c.sample, featureSubsetStrategy=c.columns, seed=c.seed)
    return Head(_pipeline(tree, columns).fit(_prepared(df, columns)), tuple(columns), target, "regression")


def fit_classifier(df: DataFrame, columns: tuple[str, ...], target: str, c: TreeConfig = TreeConfig()) -> Head:
    """Positives weigh as many times as there are more negatives, at least once."""
    _cut_lineage(df.sparkSession)
    pos, neg = df.agg(F.count_if(F.col(target) == 1), F.count_if(F.col(target) == 0)).first()
    weight = max(1.0, neg / pos) if pos else 1.0
    tree = GBTClassifier(labelCol=target, weightCol="_w", maxDepth=c.depth, stepSize=c.rate, maxIter=c.trees, subsamplingRate=c.sample, featureSubsetStrategy=c.columns, seed=c.seed)
    return Head(_pipeline(tree, columns).fit(_prepared(df, columns).withColumn("_w", F.when(F.col(target) == 1, weight).otherwise(1.0))), tuple(columns), target, "classification")


def fit_heads(df: DataFrame, columns: tuple[str, ...], targets: dict[str, tuple[str, str]], order: tuple[str, ...], c: TreeConfig = TreeConfig()) -> dict[str, Head]:
    """All heads, side by side over the same stored rows. targets: by head its kind and target; order: a key of the rows, so that samples repeat.

    The rows are checkpointed, as each of some thousand jobs describes the whole lineage of its input to the driver.
    """
    _cut_lineage(df.sparkSession)
    rows = df.select(*dict.fromkeys([*order, *columns, *(t for _, t in targets.values())])).checkpoint()
    rows = rows.coalesce(math.ceil(rows.count() / PARTITION_ROWS) or 1).sortWithinPartitions(*order).checkpoint()
    fits = {"regression": fit_regressor, "classification": fit_classifier}
    one = inheritable_thread_target(df.sparkSession)(lambda target: fits[target[0]](rows, columns, target[1], c))
    with ThreadPool(len(targets)) as pool:
        return dict(zip(targets, pool.map(one, targets.values(), 1)))


def predict(head: Head, df: DataFrame, name: str) -> DataFrame:
    out = head.model.transform(_prepared(df, head.columns))
    value = vector_to_array("probability")[1] if head.kind == "classification" else F.col("prediction")
    return out.select(*df.columns, value.alias(name))


def calibrate_and_refit(df: DataFrame, columns: tuple[str, ...], target: str, rule: HeadRule, validation: DataFrame, c: TreeConfig = TreeConfig()) -> tuple[Head, float]:
    """Fit without the validation rows, choose the threshold on them, then fit on all."""
    first = predict(fit_classifier(df, columns, target, c), validation, "_score").withColumn("_key", F.lit(1))
    threshold = choose_threshold(first, target, "_score", rule, "_key").first()["threshold"]
    return fit_classifier(df.unionByName(validation), columns, target, c), threshold


def importance(spark: SparkSession, heads: dict[str, Head], limit: int) -> DataFrame:
    """The features of each head by importance (a feature's missing flag counts to it), with shares of what is kept."""
    rows = []
    for name, head in heads.items():
        values = head.model.stages[-1].featureImportances.toArray()
        n = len(head.columns)
        both = sorted(((float(values[i] + values[n + i]), c) for i, c in enumerate(head.columns)), key=lambda x: (-x[0], x[1]))[:limit]
        total = sum(v for v, _ in both)
        rows += [(name, k, c, v, v / total if total > 0 else 0.0) for k, (v, c) in enumerate(both, 1)]
    return spark.createDataFrame(rows, "head string, rank int, feature string, importance double, share double")


def save(heads: dict[str, Head], folder: str, thresholds: dict[str, float] | None = None) -> None:
    """Models by name, and metadata.json beside them (folder is local or mounted)."""
    for name, head in heads.items():
        head.model.write().overwrite().save(f"{folder}/{name}")
    meta = {n: {"target": h.target, "kind": h.kind, "columns": list(h.columns), "path": f"{folder}/{n}", "threshold": (thresholds or {}).get(n)} for n, h in heads.items()}
    write_json(f"{folder}/metadata.json", {"heads": meta})


def load(folder: str) -> dict[str, Head]:
    path = Path(folder) / "metadata.json"
    if not path.exists():
        raise FileNotFoundError(f"{path} is missing: train the heads, or promote a candidate, first")
    meta = json.loads(path.read_text(encoding="utf-8"))["heads"]
    return {n: Head(PipelineModel.load(m["path"]), tuple(m["columns"]), m["target"], m["kind"]) for n, m in meta.items()}


def promote(candidate: str, production: str, stamp: str) -> None:
    """A candidate's models and metadata become production's (local or mounted folders). They are copied beside production
    and take its name then, so a copy that fails leaves production as it was."""
    if Path(candidate).resolve() == Path(production).resolve():
        raise ValueError("candidate and production are the same folder")
    meta = json.loads((Path(candidate) / "metadata.json").read_text(encoding="utf-8"))
    missing = [m["path"] for m in meta["heads"].values() if not Path(m["path"]).exists()]
    if missing:
        raise FileNotFoundError(f"missing models: {', '.join(missing)}")
    target = Path(production)
    fresh, old = (target.with_name(f".{target.name}-{x}-{uuid.uuid4().hex}") for x in ("new", "old"))
    try:
        for name, m in meta["heads"].items():
            shutil.copytree(m["path"], fresh / name)
            m["path"] = f"{production}/{name}"
        write_json(fresh / "metadata.json", meta | {"promoted_from": str(candidate), "promoted_at": stamp})
    except BaseException:
        shutil.rmtree(fresh, ignore_errors=True)
        raise
    if target.exists():
        os.rename(target, old)
    os.rename(fresh, target)
    shutil.rmtree(old, ignore_errors=True)
