"""Toxicity classifier with counterfactual regularisation.

A logistic regression over the presence of words and word beginnings.  In training,
documents get counterfactual versions: where sentences name groups, all the names are
swapped for others of their kind; a document that names none gets a neutral mention of
one, and of another in the second version.  All versions keep their document's label, and the
squared difference of the two versions' scores, and of the mention's to the original's,
is part of the loss.  So naming a group moves no score by itself, which is what makes
neutral mentions false positives.

Fitted on at most ``FIT_ROWS`` labelled rows (those with the smallest hash of the id), a
documented bound.  Features are counted distributedly with partial sums; the
``N_FEATURES`` with the clearest excess in toxic documents and all group names are kept.
Every document is scored over its whole text.

Defined results: null text counts as empty and scores like a text without features;
labels other than 0 and 1, null labels and unlabelled ids are not learned from; with one
class only, every score is that class's share (0 with no labels at all); repeated rows
score alike; a row with a null id is scored, and not held out; an empty table gives an
empty result; only the id and the text are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, read_table, texts
from .quality_qda import held_out

FIT_ROWS = 20_000
N_FEATURES = 3000
LEAST_DOCS = 3
PENALTY = 40.0
RIDGE = 0.3
STEPS = 150

#: Names of groups, in kinds whose members can stand for each other.
GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "transgender", "bisexual"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)
KIND_OF = {name: kind for kind in GROUPS for name in kind}

_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """Words, and beginnings of 5 and 6 characters written with a caret."""
    return words | {"^" + w[:5] for w in words if len(w) > 5} | {"^" + w[:6] for w in words if len(w) > 6}


def counterfactual(text: str, pick: int) -> tuple[set[str], set[str]]:
    """The words of two versions of a text: where sentences name groups, in the second version all of them name others of their kinds."""
    words = words_of(text)
    if words & KIND_OF.keys():
        swap = lambda w: KIND_OF[w][(KIND_OF[w].index(w) + 1 + pick % (len(KIND_OF[w]) - 1)) % len(KIND_OF[w])] if w in KIND_OF else w
        return words, {swap(w) for w in words}
    kind = GROUPS[pick % len(GROUPS)]
    a, b = kind[pick % len(kind)], kind[(pick + 1) % len(kind)]
    return words | {a}, words | {b}


@dataclass(frozen=True)
class Model:
    words: dict[str, float]
    beginnings: tuple[dict[str, float], dict[str, float]]  # of 5 and 6 characters
    bias: float

    def score(self, text: str) -> float:
        words = words_of(text)
        z = self.bias + math.fsum(self.words[w] for w in words & self.words.keys())
        for n, weights in zip((5, 6), self.beginnings):
            z += math.fsum(weights[w] for w in {w[:n] for w in words if len(w) > n} & weights.keys())
        return 1.0 / (1.0 + math.exp(-min(max(z, -40.0), 40.0)))


def clearest(counts: list[tuple[str, int, int]], n_pos: int, n_neg: int, limit: int = N_FEATURES) -> list[str]:
    """The features with the largest z values of their log odds in toxic against other documents."""
    out = []
    for name, pos, neg in counts:
        odds = math.log((pos + 0.5) / (n_pos - pos + 0.5)) - math.log((neg + 0.5) / (n_neg - neg + 0.5))
        z = odds / math.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
        if z > 1.0:
            out.append((-z, name))
    return [name for _, name in sorted(out)[:limit]]


def _clarity(n_pos: int, n_neg: int) -> Column:
    """The z value of `clearest`, over columns pos and neg."""
    pos, neg = F.col("pos"), F.col("neg")
    odds = F.log((pos + 0.5) / (n_pos - pos + 0.5)) - F.log((neg + 0.5) / (n_neg - neg + 0.5))
    return odds / F.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))


def fit(rows: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]], n: int, penalty: float = PENALTY, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias. rows: feature numbers of each document; pairs: those of its two counterfactual versions."""
    x, a, b = (_Sparse(r, n) for r in (rows, [p for p, _ in pairs], [q for _, q in pairs]))
    w, bias = np.zeros(n), math.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    size = len(y)
    for t in range(1, steps + 1):
        p, pa, pb = (1 / (1 + np.exp(-np.clip(s.dot(w) + bias, -40, 40))) for s in (x, a, b))
        ga, gb = (pa - y) * 0.5, (pb - y) * 0.5
        gx = (p - y).copy()
        for one, other, g_one, g_other in ((pa, pb, ga, gb), (pa, p, ga, gx)):
            d = 2 * penalty * (one - other)
            g_one += d * one * (1 - one)
            g_other -= d * other * (1 - other)
        grad = np.append(x.spread(gx) + a.spread(ga) + b.spread(gb) + ridge * w, gx.sum() + ga.sum() + gb.sum()) / size
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w -= step[:-1]
        bias -= step[-1]
    return w, float(bias)


class _Sparse:
    def __init__(self, rows: list[list[int]], n: int):
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.col = np.array([c for r in rows for c in r], dtype=int)
        self.shape = (len(rows), n)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.shape[0])

    def spread(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=g[self.row], minlength=self.shape[1])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", fit_rows: int = FIT_ROWS, penalty: float = PENALTY) -> Model:
    """labels: the rows to learn from, with doc_id and label_col."""
    usable = labels.filter(F.col(label_col).isin(0, 1)).select("doc_id", F.col(label_col).cast("int").alias("label")).dropna()
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id")
    n_pos, n_neg = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    if not n_pos or not n_neg:
        return Model({}, ({}, {}), 40.0 if n_pos else -40.0)

    def count(batches):
        pos, neg = Counter(), Counter()

        def out():
            names = list(pos.keys() | neg.keys())
            return {"name": names, "pos": [pos[k] for k in names], "neg": [neg[k] for k in names]}

        for b in batches:
            for text, label in zip(b["text"], b["label"]):
                (pos if label else neg).update(features_of(words_of(text)))
            if len(pos) + len(neg) > 400_000:
                yield out()
                pos.clear()
                neg.clear()
        if pos or neg:
            yield out()

    counted = arrow_map(rows, count, "name string, pos long, neg long").groupBy("name").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    top = counted.filter(F.col("pos") >= LEAST_DOCS).orderBy(_clarity(n_pos, n_neg).desc(), "name").limit(N_FEATURES)
    names = clearest(sorted((r.name, r.pos, r.neg) for r in top.collect()), n_pos, n_neg, N_FEATURES)
    number = {name: k for k, name in enumerate(dict.fromkeys([*names, *KIND_OF]))}

    def vectors(batches):
        find = lambda words: sorted(number[f] for f in features_of(words) & number.keys())
        for b in batches:
            versions = [counterfactual(t, zlib.crc32(str(i).encode()) >> 8) for i, t in zip(b["doc_id"], b["text"])]
            yield {"doc_id": b["doc_id"], "label": b["label"], "x": [find(words_of(t)) for t in b["text"]], "a": [find(p) for p, _ in versions], "b": [find(q) for _, q in versions]}

    got = arrow_map(rows, vectors, "doc_id long, label int, x array<int>, a array<int>, b array<int>").collect()
    got.sort(key=lambda r: (r.doc_id, r.label, r.x, r.a, r.b))
    w, bias = fit([r.x for r in got], np.array([r.label for r in got], dtype=float), [(r.a, r.b) for r in got], len(number), penalty)
    weight = {name: float(w[k]) for name, k in number.items() if w[k] != 0}
    starts = tuple({f[1:]: v for f, v in weight.items() if f[0] == "^" and len(f) == n + 1} for n in (5, 6))
    return Model({f: v for f, v in weight.items() if f[0] != "^"}, starts, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, score), one for each input row."""

    def run(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "score": [model.score(t) for t in b["text"]]}

    return arrow_map(texts(docs), run, "doc_id long, score double")


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    scored = score(docs, train(docs, labels.filter(~held_out(2, 4))))
    return scored.select("doc_id", held_out(2, 4).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_toxicity_cf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
