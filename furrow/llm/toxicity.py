"""Toxicity by a convolutional text classifier in numpy.

A word is the sum of hashed embeddings: two of the whole word (a chance collision meets one of them only) and those of
its first three, four and five letters. Filters over one, two and three words in a row run along the whole text, each
filter's largest response (rectified) is kept, and a logistic layer makes the score of them. Training is by
mini-batches with adaptive steps; through max pooling a text's gradient reaches one place per filter.

All labelled rows are learnt from (see `training`). A part of them is not trained on but calibrates, for each language,
the threshold with the fewest errors; languages with few calibration rows, and null or unknown ones, use
all of them. The score itself sees only the text.

Defined cases: null and empty texts have no words and get the score of no evidence (the bias); without any label, or
with one class only, every score is the share of positive labels (0 without labels); repeated rows are scored alike;
an empty table gives no rows; texts of any length are read whole. Columns of the input stay unless an added one has
their name.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.session import settle

from .common import by_chars, fold, map_texts
from .hashed import LETTER, prefix_hashes, tokens
from .training import fits, labelled, rounds, rows_of

BITS, DIM, FILTERS, WIDTHS = 18, 8, 8, (1, 2, 3)
#: At least EPOCHS passes, and more over few rows (up to MORE), so that about STEPS texts are seen.
EPOCHS, MORE, STEPS, BATCH, STEP = 6, 40, 72_000, 32, 0.08
FOLDS, HELD = 5, 0
CALIBRATION = 5  # every fifth labelled row
FEW = 40
BINS = 10_000  # scores of a large table are counted by so many steps


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, 5) rows of the embedding table, the text of each word, and where a filter may start.

    As many empty words as the widest filter stand after each text; a filter starts at words and at the first empty
    one, so that none reaches into the next text and a text without words has a response too.
    """
    t = tokens(texts)
    word = t.kind == LETTER
    mask = np.uint64((1 << BITS) - 1)
    parts = [t.hash[word], t.hash[word] >> np.uint64(32), *prefix_hashes(t, (3, 4, 5), word)]
    salted = [((p + np.uint64(i << 12)) & mask).astype(np.int32) + 1 for i, p in enumerate(parts)]
    doc = t.doc[word]
    # row 0 of the table is the empty word: always zero
    gap = max(WIDTHS)
    at = np.arange(len(doc)) + gap * doc
    out = np.zeros((len(doc) + gap * len(texts), len(parts)), np.int32)
    out[at] = np.stack(salted, 1)
    counts = np.bincount(doc, minlength=len(texts)) + gap
    opens = np.ones(len(out), bool)
    for k in range(1, gap):
        opens[np.cumsum(counts) - k] = False
    return out, np.repeat(np.arange(len(texts)), counts), opens


def features_of_each(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The table's rows and the starts of filters of each text, worked out for many texts at once."""
    out = []
    for part in by_chars(texts, 400_000):
        rows, doc, opens = features(part)
        ends = np.searchsorted(doc, np.arange(len(part)), "right").tolist()
        out += [(rows[a:z], opens[a:z]) for a, z in zip([0, *ends], ends)]
    return out


class Model:
    """Parameters; `prior` is the answer where nothing could be learnt."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.02, ((1 << BITS) + 1, DIM)).astype(np.float32)
        self.table[0] = 0
        self.filters = [rng.normal(0, 0.5, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shift = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.top = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(-1)
        self.prior: float | None = None
        self.thresholds: dict[str | None, float] = {None: 0.5}

    def responses(self, rows: np.ndarray, opens: np.ndarray):
        x = self.table[rows].sum(axis=1)
        wide = np.concatenate([x, np.zeros((max(WIDTHS), DIM), np.float32)])
        outs = []
        for w, f, b in zip(WIDTHS, self.filters, self.shift):
            y = np.repeat(b[None], len(x), 0)
            for k in range(w):
                y += wide[k: k + len(x)] @ f[k * DIM: (k + 1) * DIM]
            y[~opens] = -np.inf
            outs.append(y)
        return x, np.concatenate(outs, 1)

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
            rows, doc, opens = features(part)
            _, y = self.responses(rows, opens)
            begins = np.searchsorted(doc, np.arange(len(part)))
            pooled = np.maximum(np.maximum.reduceat(y, begins, axis=0), 0)
            out.append(1 / (1 + np.exp(-(pooled @ self.top + self.bias).astype(np.float64))))
        return np.concatenate(out) if out else np.zeros(0)

    def state(self) -> list[np.ndarray]:
        """Parameters, and the steps' history of each: what `fit` goes on from."""
        own = [self.table, *self.filters, *self.shift, self.top, np.array([self.bias], np.float32)]
        return own + [np.full(p.shape, 1e-4, np.float32 if len(p) > 1 else np.float64) for p in own]

    def take(self, state: list[np.ndarray]) -> None:
        n = len(WIDTHS)
        self.table, self.filters, self.shift = state[0], state[1: n + 1], state[n + 1: 2 * n + 1]
        self.top, self.bias = state[2 * n + 1], state[2 * n + 2][0]

    def fit(self, texts: list[str], labels: np.ndarray, seed=7, epochs: int | None = None, state: list | None = None) -> None:
        """Passes over the texts; with `state`, from where it stands, which is changed."""
        rng = np.random.default_rng(seed)
        held = features_of_each(texts)
        state = self.state() if state is None else state
        self.take(state)
        half = len(state) // 2
        speed = {id(p): s for p, s in zip(state[: half - 1], state[half: -1])}
        bias_speed = float(state[-1][0])

        def move(param, grad, at=slice(None)):
            s = speed[id(param)]
            s[at] += grad * grad
            param[at] -= STEP * grad / np.sqrt(s[at])

        n = FILTERS * len(WIDTHS)
        for _ in range(epochs or min(MORE, max(EPOCHS, STEPS // max(1, len(texts))))):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                own = order[at: at + BATCH]
                rows, opens = (np.concatenate([held[i][k] for i in own]) for k in (0, 1))
                sizes = np.array([len(held[i][0]) for i in own])
                begins = np.cumsum(sizes) - sizes
                x, y = self.responses(rows, opens)
                top_value = np.maximum.reduceat(y, begins, axis=0)
                place = np.stack([b + y[b: b + s].argmax(axis=0) for b, s in zip(begins, sizes)])  # (docs, n)
                pooled = np.maximum(top_value, 0)
                p = 1 / (1 + np.exp(-(pooled @ self.top + self.bias)))
                error = (p - labels[own]).astype(np.float32) / len(own)
                back = error[:, None] * self.top[None] * (top_value > 0)  # (docs, n)
                move(self.top, pooled.T @ error)
                bias_speed += float(error.sum()) ** 2
                self.bias -= np.float32(STEP * error.sum() / np.sqrt(bias_speed))
                wide = np.concatenate([x, np.zeros((max(WIDTHS), DIM), np.float32)])
                to_words, gradients = [], []
                for w_at, w in enumerate(WIDTHS):
                    cols = slice(w_at * FILTERS, (w_at + 1) * FILTERS)
                    g, spot = back[:, cols], place[:, cols]
                    f = self.filters[w_at].copy()
                    grad = np.zeros_like(f)
                    for k in range(w):
                        grad[k * DIM: (k + 1) * DIM] = np.einsum("bfd,bf->df", wide[spot + k], g)
                        to_words.append((spot + k).ravel())
                        gradients.append((g[:, :, None] * f[k * DIM: (k + 1) * DIM].T[None]).reshape(-1, DIM))
                    move(self.filters[w_at], grad)
                    move(self.shift[w_at], g.sum(axis=0))
                spots, grads = np.concatenate(to_words), np.concatenate(gradients)
                used = (spots < len(rows)) & (np.abs(grads).sum(axis=1) > 0)
                where = rows[spots[used]].ravel()
                grads = np.repeat(grads[used], rows.shape[1], axis=0)
                unique, inverse = np.unique(where, return_inverse=True)
                total = np.zeros((len(unique), DIM), np.float32)
                np.add.at(total, inverse, grads)
                real = unique > 0
                move(self.table, total[real], unique[real])
        assert n == len(self.top)
        state[half - 1][0], state[-1][0] = self.bias, bias_speed

    def calibrate(self, texts: list[str], labels: np.ndarray, langs: list) -> None:
        """For each language the threshold with the fewest errors, halfway to the neighbouring scores."""
        by_lang = defaultdict(list)
        for s, y, lang in zip(self.score(texts), labels, langs):
            by_lang[None].append((s, y))
            by_lang[lang].append((s, y))
        for lang, pairs in by_lang.items():
            pairs.sort()
            s, y = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
            self.set_threshold(lang, s, s, y, 1 - y)

    def set_threshold(self, lang, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> None:
        """From runs of scores, ascending, with the labels in each. Few rows of a language, or one label, set nothing."""
        if lang is not None and ones.sum() + zeros.sum() < FEW or not ones.sum() or not zeros.sum():
            return
        # errors if everything from position k on is called positive
        errors = np.concatenate([[0], np.cumsum(ones)]) + np.concatenate([np.cumsum(zeros[::-1])[::-1], [0]])
        best = np.nonzero(errors == errors.min())[0]
        k = int(best[len(best) // 2])
        edge = (high[max(0, k - 1)] + low[min(k, len(low) - 1)]) / 2
        self.thresholds[lang] = float(min(0.8, max(0.2, edge)))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    if not fits(docs, labels, "toxic", FOLDS, HELD):
        return train_in_rounds(rows_of(docs, labels, "toxic", FOLDS, HELD, also=["lang"]))
    sample = labelled(docs, labels, "toxic", FOLDS, HELD, also=["lang"])
    model, y = Model(), np.array([r[1] for r in sample], np.float32)
    if len(y) == 0 or y.min() == y.max():
        model.prior = float(y.mean()) if len(y) else 0.0
        return model
    check = np.arange(len(sample)) % CALIBRATION == 0
    if len({*y[~check]}) < 2 or len({*y[check]}) < 2:
        check[:] = False
    model.fit([r[0] for r, c in zip(sample, check) if not c], y[~check])
    own = [r for r, c in zip(sample, check) if c] or sample
    model.calibrate([r[0] for r in own], np.array([r[1] for r in own]), [r[2] for r in own])
    return model


def learn(state: list[np.ndarray], texts: list[str], labels: np.ndarray, seed) -> None:
    own = Model.of({"prior": None})
    own.fit(texts, labels.astype(np.float32), seed, 1, state)


def train_in_rounds(rows: DataFrame) -> Model:
    """As `train`, over a table of labelled rows: passes are rounds, and thresholds come from counts of scores."""
    model = Model()
    check = F.pmod(F.xxhash64(F.lit("check"), "doc_id"), F.lit(CALIBRATION)) == 0
    counts = {r.c: r for r in rows.groupBy(check.alias("c")).agg(
        F.count("*").alias("n"), F.sum("label").alias("ones")).collect()}
    n, ones = (sum(r[k] for r in counts.values()) for k in ("n", "ones"))
    if ones in (0, n):
        model.prior = ones / n if n else 0.0
        return model
    apart = len(counts) == 2 and all(0 < r.ones < r.n for r in counts.values())
    model.take(rounds(rows.where(~check) if apart else rows, model.state(), learn, EPOCHS))
    scored = score(rows.where(check) if apart else rows, model, keep=["label", "lang"])
    step = F.floor(F.col("score") * BINS)
    runs = scored.groupBy("lang", step.alias("step")).agg(
        F.min("score").alias("low"), F.max("score").alias("high"), F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"))
    whole = runs.groupBy("step").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("ones").alias("ones"),
                                     F.sum("zeros").alias("zeros"))
    runs = settle(runs, "score-runs")
    large = runs.where("lang is not null").groupBy("lang").agg(F.sum(F.col("ones") + F.col("zeros")).alias("n")).where(F.col("n") >= FEW)
    for lang, found in [(None, whole.toPandas()), *runs.join(large.select("lang"), "lang", "left_semi").toPandas().groupby("lang")]:
        found = found.sort_values("step")
        model.set_threshold(lang, *(found[c].to_numpy() for c in ("low", "high", "ones", "zeros")))
    return model


ADDED = T.StructType([T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, model: Model, *, keep: list[str] | None = None) -> DataFrame:
    """Appends score, predicted, threshold (of the row's language) and rejected (score at or over the threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # fixed size: the table has 2**BITS rows
    out = map_texts(docs, ADDED, lambda texts: [pa.array(Model.of(shared.value).score(texts), pa.float64())], keep=keep)
    if "lang" in out.columns:
        known = {k: v for k, v in model.thresholds.items() if k is not None}
        pairs = [F.lit(x) for kv in known.items() for x in kv]
        limit = F.coalesce(F.create_map(*pairs)[F.col("lang")], F.lit(model.thresholds[None])) if pairs else F.lit(model.thresholds[None])
    else:
        limit = F.lit(model.thresholds[None])
    return (out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("threshold", limit)
            .withColumn("rejected", F.col("score") >= F.col("threshold")))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    from .common import table

    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, keep=["doc_id", "lang"]).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "score", "predicted", "threshold", "rejected")
