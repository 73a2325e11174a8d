"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a Gaussian over transformed statistics of a document (lengths, word and
word-pair repetition, case, symbols, digits, line breaks).  A class covariance is shrunk
towards a multiple of the identity; its Cholesky factor is inverted once and cached, and
a score is the logistic of the difference of the two Mahalanobis log densities plus the
class priors.

Fitted on at most ``FIT_ROWS`` labelled rows (those with the smallest hash of the id),
a documented bound; every document is scored.

Defined results: null text counts as empty and is scored like any other; labels other
than 0 and 1, null labels and unlabelled ids are not learned from; with no labelled rows
of one of the classes every score is the share of label 1 (0.5 with no labels at all);
repeated rows are scored alike; a row with a null id is scored, and not held out; only the
id and the text are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, bound_batches, read_table, texts

FIT_ROWS = 20_000
SHRINKAGE = 0.15
DAMP = 10
CLIP = 8.0

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()!?/@+="]] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(c) for c in "!?"]] = True
_DIGITS = np.zeros(256, dtype=bool)
_DIGITS[48:58] = True
_SENTENCE = re.compile(r"[.!?]")

N_FEATURES = 13


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    hist = np.bincount(raw, minlength=256)
    size = len(raw)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 1
    repeats = sum(map(str.__eq__, words, words[1:]))
    shouted = sum(map(str.isupper, words))
    changed = int(hist[65:91].sum()) if text.isascii() else sum(map(str.__ne__, text, text.lower()))
    lone = sum(1 for w in words if len(w) == 1 and not w.isalnum())
    # counts are damped by a few units, so that texts of a few words are not extreme
    return [
        math.log(n + DAMP),
        math.log((size + 60) / (n + DAMP)),
        math.log(distinct + DAMP) / math.log(n + DAMP),
        math.log(pairs + DAMP) / math.log(n + DAMP),
        math.sqrt(repeats / (n + DAMP)),
        math.sqrt(shouted / (n + DAMP)),
        math.sqrt(changed / (size + 60)),
        math.sqrt(hist[_SYMBOLS].sum() / (size + 60)),
        math.sqrt(hist[_MARKS].sum() / (size + 60)),
        math.sqrt(hist[_DIGITS].sum() / (size + 60)),
        math.sqrt(hist[10] / (n + DAMP)),
        math.sqrt(lone / (n + DAMP)),
        math.sqrt(len(_SENTENCE.findall(text)) / (n + DAMP)),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Standardisation, and for each class its mean, inverse Cholesky factor and log prior with determinant."""

    center: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    offsets: tuple[float, float]
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        z = np.clip((x - self.center) / self.scale, -CLIP, CLIP)
        log = [self.offsets[k] - 0.5 * np.square((z - self.means[k]) @ self.factors[k].T).sum(axis=1) for k in (0, 1)]
        return 1.0 / (1.0 + np.exp(-np.clip(log[1] - log[0], -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, shrinkage: float = SHRINKAGE) -> Discriminant:
    share = float(y.mean()) if len(y) else 0.5
    if len(y) == 0 or not 0 < share < 1:
        return Discriminant(np.zeros(N_FEATURES), np.ones(N_FEATURES), None, None, (0.0, 0.0), share)
    center, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - center) / scale, -CLIP, CLIP)
    means, factors, offsets = [], [], []
    for k in (0, 1):
        own = z[y == k]
        mean = own.mean(axis=0)
        cov = (own - mean).T @ (own - mean) / len(own)
        d = cov.shape[0]
        cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        means.append(mean)
        factors.append(np.linalg.inv(factor))
        offsets.append(math.log(len(own) / len(z)) - float(np.log(np.diag(factor)).sum()))
    return Discriminant(center, scale, tuple(means), tuple(factors), tuple(offsets), share)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", fit_rows: int = FIT_ROWS, shrinkage: float = SHRINKAGE) -> Discriminant:
    """labels: the rows to learn from, with doc_id and label_col. At most fit_rows of them reach the driver, as statistics."""
    usable = labels.filter(F.col(label_col).isin(0, 1)).select("doc_id", F.col(label_col).cast("int").alias("label")).dropna()
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for b in batches:
            yield {"label": b["label"], "x": [statistics(t) for t in b["text"]]}

    got = arrow_map(rows, run, "label int, x array<double>").collect()
    got.sort(key=lambda r: (r.label, r.x))  # the same sums whatever the order of tasks
    x = np.array([r.x for r in got], dtype=float).reshape(-1, N_FEATURES)
    return fit(x, np.array([r.label for r in got]), shrinkage)


def score(docs: DataFrame, model: Discriminant) -> DataFrame:
    """Rows (doc_id, score), one for each input row."""

    def run(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "score": model.scores(np.array([statistics(t) for t in b["text"]]).reshape(-1, N_FEATURES))}

    return arrow_map(texts(docs), run, "doc_id long, score double")


def held_out(remainder: int, of: int):
    """Whether crc32 of the id as text leaves this remainder. A null id leaves none."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == remainder, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    return labels.filter(~held_out(1, 3))


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    scored = score(docs, train(docs, learnable(labels)))
    return scored.select("doc_id", held_out(1, 3).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns."""
    model = train(docs, learnable(labels))
    names = docs.columns

    def run(batches):
        for b in batches:
            text = b.column(names.index("text")).to_pylist()
            x = np.array([statistics(t or "") for t in text]).reshape(-1, N_FEATURES)
            yield b.filter(pa.array(model.scores(x) >= threshold))

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def op7_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
