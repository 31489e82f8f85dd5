"""The two classifiers against plain restatements: their scores, one step of learning, and all of it."""

import math
from collections import defaultdict

import numpy as np
import pytest

from furrow.llm import hashed, quality, toxicity

TEXTS = ["You are a fine person, thank you.", "you vile VILE thing", "A short one", "", "1 2 3 ...", "Well written lines\nof text stand here.",
         "buy NOW now now!!! $$$", "el perro y la casa son buenos", "x", "vile words again, vile person"]
LABELS = np.array([0, 1, 0, 0, 0, 0, 1, 0, 0, 1], np.float64)


# -- quality: follow the regularised leader, feature by feature -----------------------------------------------------

def occurrences(text):
    found = defaultdict(float)
    at, _, value = quality.ngrams([text])
    for i, v in zip(at.tolist(), value.tolist()):
        found[i] += v
    return found


def leader(z, n):
    if abs(z) <= quality.L1:
        return 0.0
    return -(z - math.copysign(quality.L1, z)) / ((quality.BETA + math.sqrt(n)) / quality.ALPHA + quality.L2)


def test_quality_is_learnt_by_the_formula():
    model = quality.Model()
    model.fit(TEXTS, LABELS, seed=5)
    z, n, z0, n0 = defaultdict(float), defaultdict(float), 0.0, 0.0
    intercept = lambda: -z0 / ((quality.BETA + math.sqrt(n0)) / quality.ALPHA)
    rng = np.random.default_rng(5)
    for _ in range(quality.EPOCHS):
        for i in rng.permutation(len(TEXTS)):
            x = occurrences(TEXTS[i])
            w, b = {f: leader(z[f], n[f]) for f in x}, intercept()
            p = 1 / (1 + math.exp(-(sum(w[f] * x[f] for f in x) + b)))
            for f, v in x.items():
                g = (p - LABELS[i]) * v
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / quality.ALPHA * w[f]
                n[f] += g * g
            g = p - LABELS[i]
            z0, n0 = z0 + g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / quality.ALPHA * b, n0 + g * g
    want = {f: leader(z[f], n[f]) for f in z}
    assert np.allclose(model.w[list(want)], list(want.values()), atol=1e-6) and math.isclose(model.bias, intercept(), abs_tol=1e-9)
    assert np.count_nonzero(model.w) == sum(abs(v) > 0 for v in want.values())
    scores = [1 / (1 + math.exp(-(sum(want.get(f, 0.0) * v for f, v in occurrences(t).items()) + intercept()))) for t in TEXTS]
    assert np.allclose(model.score(TEXTS), scores, atol=1e-6)


# -- toxicity: convolutions word by word, gradients by differences ---------------------------------------------------

def forward(p, text):
    """The score of one text in double precision, filter by filter and place by place."""
    rows, _, opens = toxicity.features([text])
    words = [p["table"][r].sum(axis=0) for r in rows] + [np.zeros(toxicity.DIM)] * max(toxicity.WIDTHS)
    pooled = []
    for width, filters, shift in zip(toxicity.WIDTHS, p["filters"], p["shift"]):
        for f in range(toxicity.FILTERS):
            places = [sum(words[a + k] @ filters[k * toxicity.DIM: (k + 1) * toxicity.DIM, f] for k in range(width)) + shift[f]
                      for a in range(len(rows)) if opens[a]]
            pooled.append(max(0.0, max(places)))
    return 1 / (1 + math.exp(-(np.array(pooled) @ p["top"] + p["bias"])))


def parameters(model):
    return {"table": model.table.astype(float), "filters": [f.astype(float) for f in model.filters],
            "shift": [s.astype(float) for s in model.shift], "top": model.top.astype(float), "bias": float(model.bias)}


def test_toxicity_scores_word_by_word():
    model = toxicity.Model(3)
    model.table[1:] *= 20
    p = parameters(model)
    assert np.allclose(model.score(TEXTS), [forward(p, t) for t in TEXTS], atol=1e-5)


def test_toxicity_steps_down_the_gradient(monkeypatch):
    """One step over all texts: what each parameter moved by tells its gradient, which differences of the loss confirm."""
    monkeypatch.setattr(toxicity, "MORE", 1)
    monkeypatch.setattr(toxicity, "BATCH", len(TEXTS))
    model = toxicity.Model(3)
    model.table[1:] *= 20
    for k, shift in enumerate(model.shift):  # texts without words would sit on the bend at zero
        shift += 0.05 + 0.01 * k
    before = parameters(model)
    model.fit(TEXTS, LABELS.astype(np.float32))
    after = parameters(model)

    def loss():
        return -sum(math.log(s if y else 1 - s) for s, y in ((forward(before, t), y) for t, y in zip(TEXTS, LABELS))) / len(TEXTS)

    rng, checked = np.random.default_rng(0), 0
    used = np.unique(toxicity.features(TEXTS)[0])
    for name, arrays in (("top", [(before["top"], after["top"])]), ("filters", list(zip(before["filters"], after["filters"]))),
                         ("shift", list(zip(before["shift"], after["shift"]))), ("table", [(before["table"], after["table"])])):
        for old, new in arrays:
            for _ in range(6):
                at = tuple(int(rng.integers(k)) for k in old.shape)
                if name == "table":
                    at = (int(rng.choice(used[used > 0])), at[1])
                kept, sides = old[at], []
                for side in (1e-5, -1e-5):
                    old[at] = kept + side
                    sides.append(loss())
                old[at] = kept
                slope, share = (sides[0] - sides[1]) / 2e-5, (new[at] - kept) / -toxicity.STEP
                told = math.copysign(math.sqrt(1e-4 * share ** 2 / max(1e-12, 1 - share ** 2)), share)  # the first step's rule, solved
                assert told == pytest.approx(slope, abs=2e-4, rel=0.02), (name, at)
                checked += abs(slope) > 1e-6
    assert checked > 15
    assert (after["table"][0] == 0).all()


def test_features_of_many_texts_are_those_of_each():
    texts = [*TEXTS, " ", "x" * 500_000, "", "\U0001f600 a bc def ghij klmno pqrstu", *TEXTS]
    for text, (rows, opens) in zip(texts, toxicity.features_of_each(texts), strict=True):
        want, _, begins = toxicity.features([text])
        assert (rows == want).all() and (opens == begins).all() and len(rows) == len(want)
    assert toxicity.features_of_each([]) == []


def test_prefix_hashes_go_on_from_each_other():
    t = hashed.tokens(TEXTS)
    word = t.kind == hashed.LETTER
    for k, got in zip((1, 3, 4, 5), hashed.prefix_hashes(t, (1, 3, 4, 5), word)):
        assert (got == hashed.prefix_hash(t, k)[word]).all()
