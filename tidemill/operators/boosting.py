"""Second-order boosted trees, a job for each level of a tree and all heads at once.

Features are cut into bins at quantiles, once, and the binned rows are written.  A level is
one job: every task adds up gradients and hessians of its rows by (head, node, feature, bin);
histograms are merged by (head, node, feature) as a stream, and each gives its best split, which is all that comes
to the driver.  Children's sums are known from the split, so leaves need no job.

A split's gain is that of Newton steps with an L2 penalty, under a least hessian for each
child and, where set, a largest step.  Missing values have a bin of their own and go to the
side that gains more.  Positive rows may weigh more.  Rows and columns are sampled for each
tree by hashes of the row's key and the column's name, so a lost task samples the same rows
again.

Gradients are rounded to multiples of 2^-24 of a head's spread before they are added up, so
sums are whole numbers and no order of tasks changes a split; equal gains take the first
feature, then the lowest bin, then missing to the left.

Margins are written anew every ``keep_every`` trees; between, a task applies the trees since.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import remove, work_path
from .ranks import value_ranks

MISSING = 255
#: Rows of a task at least: a level's tasks should not be shorter than their start.
TASK_ROWS = 100_000
#: Whole units in a head's spread.  A task's sums stay exact up to 2^53 units.
UNITS = float(1 << 24)
HIST = "head int, node int, feature int, hist binary"
BEST = "head int, node int, feature int, bin int, missing_left boolean, gain double, left_g double, left_h double, right_g double, right_h double, n long"


@dataclass(frozen=True)
class Boost:
    """Settings of a head. Fixed values (M20, M21): depth, rate, trees, sample, columns, seed; largest_step is 1 for classes, none (0) for numbers."""

    depth: int = 4
    rate: float = 0.05
    trees: int = 300
    sample: float = 0.9
    columns: float = 0.9
    seed: int = 42
    penalty: float = 1.0
    least_gain: float = 1e-6
    least_hessian: float = 1.0
    largest_step: float = 1.0
    bins: int = 255
    keep_every: int = 25


@dataclass
class Head:
    name: str
    target: str
    kind: str  # regression or classification
    positive_weight: float = 1.0
    base: float = 0.0  # margin before the first tree
    spread: float = 1.0
    trees: list[list[dict]] = field(default_factory=list)


@dataclass
class Model:
    columns: tuple[str, ...]
    edges: list[list[float]]
    heads: list[Head]
    settings: Boost

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Model:
        x = json.loads(text)
        return Model(tuple(x["columns"]), x["edges"], [Head(**h) for h in x["heads"]], Boost(**x["settings"]))


def edges(df: DataFrame, columns: tuple[str, ...], bins: int, accuracy: int | None = None) -> list[list[float]]:
    """Upper edges of all bins but the last: values at the ranks k / bins. accuracy: from a sketch of that size, for many rows; else exact."""
    if accuracy:
        at = [k / bins for k in range(1, bins)]
        found = df.agg(*(F.percentile_approx(c, at, accuracy).alias(f"e{k}") for k, c in enumerate(columns))).first()
        return [sorted(set(map(float, e or []))) for e in found]
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("feature"), F.col(c).cast("double").alias("x")) for k, c in enumerate(columns))))
    ranks = value_ranks(df.select(cells.alias("c")).select("c.*"), "x", "feature")
    total = ranks.groupBy("feature").agg(F.sum("n").alias("total"))
    before = F.floor(F.col("below") * bins / F.col("total"))
    upto = F.floor((F.col("below") + F.col("n")) * bins / F.col("total"))
    chosen = ranks.join(total, "feature").filter(F.least(upto, F.lit(bins - 1)) > before).select("feature", "x").collect()  # bins for each column at most
    out: list[list[float]] = [[] for _ in columns]
    for r in chosen:
        out[r.feature].append(r.x)
    return [sorted(e) for e in out]


def heads_for(df: DataFrame, kinds: dict[str, tuple[str, str]], weigh: bool = True) -> list[Head]:
    """Heads of (kind, target) with base and spread, from one pass. weigh: positives by the ratio of the classes, 1 at least."""
    aggs = []
    for h, (_, t) in kinds.items():
        y = F.col(t).cast("double")
        aggs += [F.round(F.avg(y), 9).alias(f"{h}_mean"), F.min(y).alias(f"{h}_min"), F.max(y).alias(f"{h}_max"), F.sum(y).alias(f"{h}_sum"), F.count(y).alias(f"{h}_n")]
    s = df.agg(*aggs).first()
    out = []
    for h, (kind, t) in kinds.items():
        if not s[f"{h}_n"]:
            raise ValueError(f"{t} is missing in all rows")
        if kind == "regression":
            base = s[f"{h}_mean"]
            out.append(Head(h, t, kind, 1.0, base, max(s[f"{h}_max"] - base, base - s[f"{h}_min"], 1e-12)))
            continue
        pos, n = s[f"{h}_sum"], s[f"{h}_n"]
        if s[f"{h}_min"] == s[f"{h}_max"]:
            raise ValueError(f"{t} has one class only")
        weight = max(1.0, (n - pos) / pos) if weigh else 1.0
        rate = pos * weight / (pos * weight + n - pos)
        out.append(Head(h, t, kind, weight, float(np.log(rate / (1 - rate))), weight))
    return out


def _binned(df: DataFrame, columns: tuple[str, ...], cuts: list[list[float]], heads: list[Head], key: tuple[str, ...]) -> DataFrame:
    """Rows (row, bins, y, margins): a hash of the key, a byte a feature, targets and margins by head."""
    cells = F.array(*(F.col(c).cast("double") for c in columns))
    ys = F.array(*(F.col(h.target).cast("double") for h in heads))
    df = df.select(F.xxhash64(*key).alias("row"), cells.alias("x"), ys.alias("y"))
    start = [h.base for h in heads]
    kind = "row long, bins binary, y array<double>, margins array<double>"

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            x = _matrix(b.column("x"), len(columns))
            bins = np.full(x.shape, MISSING, dtype=np.uint8)
            for j, e in enumerate(cuts):
                here = ~np.isnan(x[:, j])
                bins[here, j] = np.searchsorted(e, x[here, j], side="left")
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([r.tobytes() for r in bins]), b.column("y"), pa.array([start] * len(bins), pa.list_(pa.float64()))], ["row", "bins", "y", "margins"])

    return df.mapInArrow(run, kind)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix; null is NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _bins(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


def _route(tree: list[dict], bins: np.ndarray) -> np.ndarray:
    """The number of the node in which each row stops. Nodes are in order of depth; those with a feature are split."""
    at = np.zeros(len(bins), dtype=np.int32)
    for k, node in enumerate(tree):
        if "feature" in node:
            here = at == k
            b = bins[:, node["feature"]]
            left = np.where(b == MISSING, node["missing_left"], b <= node["bin"])
            at = np.where(here, np.where(left, node["left"], node["right"]), at)
    return at


def _add(tree: list[dict], bins: np.ndarray) -> np.ndarray:
    return np.array([n["value"] for n in tree])[_route(tree, bins)]


def _sampled(rows: np.ndarray, tree: int, c: Boost) -> np.ndarray:
    """Rows of a tree's sample, by a mix of the row's hash with the tree's number."""
    x = rows.astype(np.uint64) ^ np.uint64((c.seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(np.float64) < c.sample * 2.0**64


def _chosen_columns(columns: tuple[str, ...], tree: int, c: Boost) -> list[int]:
    count = max(1, int(len(columns) * c.columns))
    order = sorted(range(len(columns)), key=lambda j: (pd.util.hash_array(np.array([f"{c.seed}:{tree}:{columns[j]}"], dtype=object))[0], j))
    return sorted(order[:count])


def _gradients(head: Head, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In whole units of the spread."""
    if head.kind == "regression":
        g, h = margin - y, np.ones(len(y))
        return np.rint(g / head.spread * UNITS), np.rint(h * UNITS)
    p = 1 / (1 + np.exp(-margin))
    w = np.where(y == 1, head.positive_weight, 1.0)
    return np.rint((p - y) * w / head.spread * UNITS), np.rint(np.maximum(p * (1 - p), 1e-16) * w / head.spread * UNITS)


def _histograms(table: DataFrame, heads: list[Head], recent: list[list[list[dict]]], growing: list[list[dict]], open_: list[list[int]], features: list[int], width: int, tree: int, c: Boost) -> DataFrame:
    """Rows (head, node, feature, hist): a task's sums of gradients, hessians and rows by bin, of nodes still open."""

    def run(batches: Iterator[pa.RecordBatch]):
        sums = {(k, n): np.zeros((3, len(features), 256)) for k in range(len(heads)) for n in open_[k]}
        step = np.arange(len(features)) * 256
        for b in batches:
            rows = b.column("row").to_numpy()
            inside = _sampled(rows, tree, c)
            bins, y, margins = _bins(b.column("bins"), width), _matrix(b.column("y"), len(heads)), _matrix(b.column("margins"), len(heads))
            for k, head in enumerate(heads):
                if not open_[k]:
                    continue
                use = inside & ~np.isnan(y[:, k])
                part = bins[use]
                margin = margins[use, k] + sum((_add(t, part) for t in recent[k]), np.zeros(len(part)))
                g, h = _gradients(head, y[use, k], margin)
                at = _route(growing[k], part)
                for n in open_[k]:
                    here = at == n
                    cells = (part[here][:, features].astype(np.int64) + step).ravel()
                    for row, w in enumerate((g[here], h[here], np.ones(int(here.sum())))):
                        sums[k, n][row] += np.bincount(cells, np.repeat(w, len(features)), minlength=256 * len(features)).reshape(-1, 256)
        out = [(k, n, f, hist[:, j].astype(np.int64).tobytes()) for (k, n), hist in sums.items() for j, f in enumerate(features) if hist[2, j].any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["head", "node", "feature", "hist"])

    return table.mapInArrow(run, HIST)


def _score(g, h, c: Boost, largest: float):
    """What a node's best step is worth, and the step."""
    w = -g / (h + c.penalty)
    if largest:
        w = np.clip(w, -largest, largest)
    return -(2 * g * w + (h + c.penalty) * w * w), w


def best_split(hist: np.ndarray, c: Boost, head: Head) -> tuple | None:
    """(bin, missing_left, gain, sums of both sides, rows) of one feature's merged histogram; None without a split that counts."""
    classes = head.kind == "classification"
    largest = c.largest_step if classes else 0.0
    g, h = hist[0] / UNITS * head.spread, hist[1] / UNITS * (head.spread if classes else 1.0)
    total_g, total_h = g.sum(), h.sum()
    parent = _score(total_g, total_h, c, largest)[0]
    best = None
    for missing_left in (True, False):
        left_g, left_h = np.cumsum(g[:MISSING]), np.cumsum(h[:MISSING])
        if missing_left:
            left_g, left_h = left_g + g[MISSING], left_h + h[MISSING]
        elif not hist[2][MISSING]:
            break  # nothing is missing: both sides are the same
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = _score(left_g, left_h, c, largest)[0] + _score(right_g, right_h, c, largest)[0] - parent
        gain = np.where((left_h >= c.least_hessian) & (right_h >= c.least_hessian), gain, -np.inf)
        k = int(np.argmax(np.round(gain, 9)))
        if gain[k] > c.least_gain and (best is None or round(gain[k], 9) > round(best[2], 9)):
            best = (k, missing_left, float(gain[k]), float(left_g[k]), float(left_h[k]), float(right_g[k]), float(right_h[k]), int(hist[2].sum()))
    return best


def _best(hists: DataFrame, heads: list[Head], c: Boost, tasks: int) -> DataFrame:
    """The best split of each head, node and feature. Histograms of a feature are added up as they come in; those of one task are whole."""

    def run(batches: Iterator[pa.RecordBatch]):
        key, total = None, None

        def close():
            found = best_split(total, c, heads[key[0]])
            return [] if found is None else [(*key, *found)]

        for b in batches:
            out = []
            for k, n, f, raw in zip(*(x.to_pylist() for x in b.columns)):
                hist = np.frombuffer(raw, dtype=np.int64).reshape(3, 256)
                if (k, n, f) == key:
                    total = total + hist
                    continue
                if key is not None:
                    out += close()
                key, total = (k, n, f), hist
            yield _record(out)
        if key is not None:
            yield _record(close())

    types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), *[pa.float64()] * 5, pa.int64())
    names = [x.split()[0] for x in BEST.split(", ")]

    def _record(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    if tasks > 1:
        hists = hists.repartition("head", "node", "feature").sortWithinPartitions("head", "node", "feature")
    return hists.mapInArrow(run, BEST)


def fit(df: DataFrame, columns: tuple[str, ...], heads: list[Head], key: tuple[str, ...], c: Boost = Boost(), accuracy: int | None = None) -> Model:
    """All heads' trees. Rows are told apart by key, which only the sampling uses; a row without a head's target is not used for it."""
    if not 2 <= c.bins <= MISSING:
        raise ValueError(f"bins must be from 2 to {MISSING}")
    spark = df.sparkSession
    cuts = edges(df, columns, c.bins, accuracy)
    path = work_path(spark, "binned")
    binned = _binned(df, columns, cuts, heads, key)
    binned.coalesce(-(-df.count() // TASK_ROWS) or 1).write.parquet(path)
    # a level's shuffles carry histograms only, as many as heads, nodes and features: planned once, in few partitions
    quick = spark.newSession()
    quick.conf.set("spark.sql.adaptive.enabled", "false")
    quick.conf.set("spark.sql.shuffle.partitions", str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, len(heads) * len(columns) // 8))))
    table = quick.read.parquet(path)
    tasks = table.rdd.getNumPartitions()
    bare = [replace(h, trees=[]) for h in heads]  # what tasks need; of the trees they get the recent ones
    recent: list[list[list[dict]]] = [[] for _ in heads]
    for tree in range(c.trees):
        features = _chosen_columns(columns, tree, c)
        growing = [[{"value": 0.0}] for _ in heads]
        open_ = [[0] for _ in heads]
        for level in range(c.depth):
            if not any(open_):
                break
            found = _best(_histograms(table, bare, recent, growing, open_, features, len(columns), tree, c), bare, c, tasks).collect()  # a row for each head, open node and feature
            open_ = [[] for _ in heads]
            best: dict[tuple[int, int], object] = {}
            for r in sorted(found, key=lambda r: (-round(r["gain"], 9), r["feature"])):
                best.setdefault((r["head"], r["node"]), r)
            for _, r in sorted(best.items()):
                k, nodes, head = r["head"], growing[r["head"]], heads[r["head"]]
                largest = c.largest_step if head.kind == "classification" else 0.0
                left, right = len(nodes), len(nodes) + 1
                for g, h in ((r["left_g"], r["left_h"]), (r["right_g"], r["right_h"])):
                    nodes.append({"value": float(c.rate * _score(g, h, c, largest)[1]), "hessian": h})
                cut = cuts[r["feature"]][r["bin"]] if r["bin"] < len(cuts[r["feature"]]) else None  # None: only missing values go right
                nodes[r["node"]] |= {"feature": r["feature"], "bin": r["bin"], "cut": cut, "missing_left": r["missing_left"], "gain": r["gain"], "n": r["n"], "left": left, "right": right}
                open_[k] += [left, right]
        for k, head in enumerate(heads):
            head.trees.append(growing[k])
            recent[k].append(growing[k])
        if len(recent[0]) == c.keep_every and tree + 1 < c.trees:
            new = work_path(spark, "binned")
            _moved(table, recent, len(columns)).write.parquet(new)
            remove(spark, path)
            path, table, recent = new, quick.read.parquet(new), [[] for _ in heads]
            tasks = table.rdd.getNumPartitions()
    remove(spark, path)
    return Model(columns, cuts, heads, c)


def _moved(table: DataFrame, recent: list[list[list[dict]]], width: int) -> DataFrame:
    """The table with the recent trees added to its margins."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            bins, margins = _bins(b.column("bins"), width), _matrix(b.column("margins"), len(recent))
            for k, trees in enumerate(recent):
                for t in trees:
                    margins[:, k] += _add(t, bins)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("bins"), b.column("y"), pa.array(list(margins), pa.list_(pa.float64()))], ["row", "bins", "y", "margins"])

    return table.mapInArrow(run, table.schema)


def predictions(model: Model) -> Column:
    """An array of the heads' predictions: numbers, or probabilities of class 1."""
    columns, cuts = model.columns, model.edges

    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        values = np.array([np.asarray(r, dtype=np.float64) for r in x]).reshape(len(x), len(columns))
        bins = np.full(values.shape, MISSING, dtype=np.uint8)
        for j, e in enumerate(cuts):
            here = ~np.isnan(values[:, j])
            bins[here, j] = np.searchsorted(e, values[here, j], side="left")
        out = np.empty((len(x), len(model.heads)))
        for k, head in enumerate(model.heads):
            margin = head.base + sum((_add(t, bins) for t in head.trees), np.zeros(len(x)))
            out[:, k] = margin if head.kind == "regression" else 1 / (1 + np.exp(-margin))
        return pd.Series(list(out))

    return run(F.array(*(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns)))


def predict(df: DataFrame, model: Model, prefix: str = "pred_") -> DataFrame:
    df = df.withColumn("_scores", predictions(model))
    return df.withColumns({f"{prefix}{h.name}": F.col("_scores")[k] for k, h in enumerate(model.heads)}).drop("_scores")


def splits(spark: SparkSession, model: Model) -> DataFrame:
    """Every split of every tree: head, tree, node, feature, cut, missing_left, gain, n."""
    rows = [(h.name, t, k, model.columns[n["feature"]], n["cut"], n["missing_left"], n["gain"], n["n"]) for h in model.heads for t, tree in enumerate(h.trees) for k, n in enumerate(tree) if "feature" in n]
    return spark.createDataFrame(rows, "head string, tree int, node int, feature string, cut double, missing_left boolean, gain double, n long")


def importance(spark: SparkSession, model: Model) -> DataFrame:
    """Mean and total gain of each head's features that split anything, with the share of the mean."""
    each = splits(spark, model).groupBy("head", "feature").agg(F.count("*").alias("splits"), F.avg("gain").alias("gain"), F.sum("gain").alias("total_gain"))
    total = each.groupBy("head").agg(F.sum("gain").alias("_all"))
    return each.join(total, "head").withColumn("share", F.try_divide("gain", "_all")).drop("_all")
