"""Quality by hashed word n-grams in a logistic regression fitted with follow-the-regularised-leader updates.

The n-grams of a text are single words and pairs of its tokens (words, numbers, runs of symbols), and single, double
and triple shapes of them: kind, case, length class, and whether a token repeats the word before it. Each is hashed to
one of 2**BITS weights; a feature's value is its share of the text's n-grams of that order, so a score is a sparse dot
product that does not depend on the text's length.

Updates are per-coordinate (FTRL-Proximal, McMahan et al. 2013): gradients are summed in z, their squares in n, and a
weight is read as zero until |z| exceeds the L1 strength.

All labelled rows are learnt from (see `training`). Defined cases: null and empty texts have no n-grams and
get the score of the bias; without labels the score is 1 (nothing speaks against a text), with one class only it is
that class; repeated rows are scored alike; an empty table gives no rows; texts are read whole. Columns of the input
stay unless an added one has their name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_chars, fold, map_texts, mix64
from .hashed import LETTER, SYMBOL, tokens
from .training import fits, labelled, rounds, rows_of

BITS = 20
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 0.002, 0.001, 3
SCALE = 5.0
FOLDS, HELD = 3, 1


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weight's number, text, value) of every n-gram occurrence."""
    t = tokens(texts)
    same = np.zeros(len(t.doc), bool)
    if len(t.doc) > 1:
        same[1:] = (t.hash[1:] == t.hash[:-1]) & (t.doc[1:] == t.doc[:-1]) & (t.kind[1:] == LETTER)
    length = np.minimum(np.where(t.kind == SYMBOL, t.size, np.ceil(np.log2(t.size + 1))), 15).astype(np.uint64)
    case = t.upper.astype(np.uint64) * np.uint64(2) + t.first.astype(np.uint64)
    shape = mix64((((t.kind.astype(np.uint64) << np.uint64(4) | length) << np.uint64(3) | case) << np.uint64(1))
                  | same.astype(np.uint64) | np.uint64(1 << 40))
    found = []
    for order, base, kind in ((1, t.hash, 1), (2, t.hash, 2), (1, shape, 3), (2, shape, 4), (3, shape, 5)):
        n = len(base) - order + 1
        if n <= 0:
            continue
        h = base[:n].copy()
        for k in range(1, order):
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + base[k: k + n])
        inside = t.doc[:n] == t.doc[order - 1:]
        h, doc = mix64(h + np.uint64(kind))[inside], t.doc[:n][inside]
        share = SCALE / np.maximum(1, np.bincount(doc, minlength=len(texts)))
        found.append(((h >> np.uint64(64 - BITS)).astype(np.int32), doc, share[doc]))
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


class Model:
    def __init__(self):
        self.w = np.zeros(1 << BITS, np.float32)
        self.bias = 0.0
        self.prior: float | None = None

    @classmethod
    def of(cls, state: dict) -> "Model":
        own = cls.__new__(cls)
        vars(own).update(state)
        return own

    def score(self, texts: list[str]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        out = []
        for part in by_chars(texts, 400_000):
            at, doc, value = ngrams(part)
            total = np.bincount(doc, self.w[at] * value, len(part)) + self.bias
            out.append(1 / (1 + np.exp(-np.clip(total, -500, 500))))
        return np.concatenate(out) if out else np.zeros(0)

    @staticmethod
    def state() -> list[np.ndarray]:
        """Sums of gradients and of their squares, of the weights and of the bias: what `fit` goes on from."""
        return [np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros((1, 2))]

    def fit(self, texts: list[str], labels: np.ndarray, seed=5, epochs: int = EPOCHS, state: list | None = None) -> None:
        """Passes over the texts; with `state`, from where it stands, which is changed."""
        z, n, of_bias = state = self.state() if state is None else state
        z0, n0 = of_bias[0].tolist()
        held = []
        for t in texts:
            at, _, value = ngrams([t])
            unique, inverse = np.unique(at, return_inverse=True)
            held.append((unique, np.bincount(inverse, value, len(unique))))
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in rng.permutation(len(texts)):
                at, x = held[i]
                w, bias = weights(z[at], n[at]), -z0 / ((BETA + np.sqrt(n0)) / ALPHA)
                p = 1 / (1 + np.exp(-np.clip(w @ x + bias, -50, 50)))
                g = (p - labels[i]) * x
                step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - step * w
                n[at] += g * g
                g0 = p - labels[i]
                z0 += g0 - (np.sqrt(n0 + g0 * g0) - np.sqrt(n0)) / ALPHA * bias
                n0 += g0 * g0
        of_bias[0] = z0, n0
        self.take(state)

    def take(self, state: list[np.ndarray]) -> None:
        z, n, ((z0, n0),) = state
        self.w = weights(z, n).astype(np.float32)
        self.bias = float(-z0 / ((BETA + np.sqrt(n0)) / ALPHA))


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(state: list[np.ndarray], texts: list[str], labels: np.ndarray, seed) -> None:
    Model().fit(texts, labels, seed, 1, state)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    if not fits(docs, labels, "quality", FOLDS, HELD):
        model, rows = Model(), rows_of(docs, labels, "quality", FOLDS, HELD)
        n, ones = rows.agg(F.count("*"), F.sum("label")).first()
        if ones in (0, n):
            model.prior = ones / n
        else:
            model.take(rounds(rows, model.state(), learn, EPOCHS))
        return model
    sample = labelled(docs, labels, "quality", FOLDS, HELD)
    model, y = Model(), np.array([r[1] for r in sample], np.float64)
    if len(y) == 0 or y.min() == y.max():
        model.prior = float(y.mean()) if len(y) else 1.0
        return model
    model.fit([r[0] for r in sample], y)
    return model


ADDED = T.StructType([T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, model: Model, *, keep: list[str] | None = None) -> DataFrame:
    """Appends score (1: good) and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # fixed size: 2**BITS weights
    out = map_texts(docs, ADDED, lambda texts: [pa.array(Model.of(shared.value).score(texts), pa.float64())], keep=keep)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", "predicted")
