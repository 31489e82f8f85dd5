"""Classifiers by held-out accuracy, the language model by brute force, the pipeline stage by stage."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from furrow.llm import class_lm, common, copies, hashed, packing, quality, simhash, toxicity, training

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"
BAD = ["nastyword", "vilething", "awfulname"]


def made_texts(n=500, seed=3):
    """(id, text, lang, toxic, quality): a bad word makes toxic, runs of symbols make poor."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(600)]
    out = []
    for i in range(n):
        body = [rnd.choice(words) for _ in range(rnd.randint(5, 120))]
        toxic, good = rnd.random() < 0.25, rnd.random() < 0.7
        if toxic:
            for _ in range(2):
                body.insert(rnd.randrange(len(body)), rnd.choice(BAD).upper() + rnd.choice([",", "", "!"]))
        if not good:
            body = [w + rnd.choice(["$$$", "%%%"]) for w in body]
        out.append((i, " ".join(body), ["en", "de", None][i % 3], int(toxic), int(good)))
    return out


@pytest.fixture(scope="module")
def frames(spark):
    made = made_texts()
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang, _, _ in made], DOC).repartition(4)
    labels = spark.createDataFrame([(i, q, x) for i, _, _, x, q in made] + [(None, 1, 1), (3, None, None), (99999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    return made, docs, labels


def test_token_kinds():
    t = hashed.tokens(["Ab cd!! 12\nx", "", "ÉA b"])
    assert t.doc.tolist() == [0, 0, 0, 0, 0, 0, 2, 2]
    assert t.kind.tolist() == [1, 1, 3, 2, 3, 1, 1, 1]
    assert t.hash[0] == hashed.tokens(["AB"]).hash[0] and t.upper.tolist()[-2:] == [True, False]
    assert hashed.prefix_hash(hashed.tokens(["abcd abce ab"]), 3).tolist()[0] == hashed.prefix_hash(hashed.tokens(["abcx"]), 3)[0]


def test_sample_is_bounded_and_never_held_out(spark, frames):
    made, docs, labels = frames
    by_text = {t: (i, x) for i, t, _, x, _ in made}
    for rows, most in ((10_000, 10 ** 9), (40, 10 ** 9), (10_000, 3000)):
        got = training.labelled(docs, labels, "toxic", 5, 0, rows, most, also=["lang"])
        assert 0 < len(got) <= rows and sum(len(g[0]) for g in got) <= most
        for text, label, _ in got:
            i, toxic = by_text[text]
            assert label == toxic and zlib.crc32(str(i).encode()) % 5 != 0
    assert training.labelled(docs, labels.limit(0), "toxic", 5, 0) == []
    many = docs.unionByName(docs).unionByName(docs.withColumn("text", F.concat("text", F.lit(" more"))))
    assert training.labelled(many, labels, "toxic", 5, 0) == training.labelled(docs, labels, "toxic", 5, 0)


def test_toxicity_on_held_out_rows(spark, frames):
    made, docs, labels = frames
    model = toxicity.train(docs, labels)
    truth = {i: x for i, _, _, x, _ in made}
    got = toxicity.score(docs.withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == len(made) and isinstance(got[0].score, float)
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    assert all(r.predicted == int(r.score >= 0.5) and r.rejected == (r.score >= r.threshold) for r in got)


def test_quality_on_held_out_rows(spark, frames):
    made, docs, labels = frames
    truth = {i: q for i, _, _, _, q in made}
    got = quality.score(docs, quality.train(docs, labels), keep=["doc_id"]).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifier_edges(spark, frames, module):
    _, docs, labels = frames
    model = module.train(docs, labels)
    odd = spark.createDataFrame([(1, None, "xx"), (1, "", None), (None, "\n\t ", "en"), (2, "z" * 300_000, "en"),
                                 (2, "word " * 40_000, "de"), (3, "same", "en"), (3, "same", "en")], "doc_id long, text string, lang string")
    got = module.score(odd, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert module.score(odd.limit(0), model).count() == 0
    alone = {r.text: r.score for r in module.score(odd.coalesce(1), model).collect()}
    assert all(alone[r.text] == pytest.approx(r.score, abs=1e-6) for r in got)
    none = module.train(docs, labels.limit(0))
    assert {r.predicted for r in module.score(odd, none).collect()} == {1 if module is quality else 0}
    one = module.train(docs, labels.filter("quality = 1 and toxic = 1"))
    assert {r.predicted for r in module.score(odd, one).collect()} == {1}


def test_thresholds_by_language():
    model = toxicity.Model()
    model.score = lambda texts: np.array([float(t) for t in texts])
    low = [(0.1, 0), (0.3, 1)] * 30  # a language whose toxic texts score low
    high = [(0.5, 0), (0.7, 1)] * 30
    rows = [(str(s), y, "lo") for s, y in low] + [(str(s), y, "hi") for s, y in high] + [("0.9", 1, "few")]
    model.calibrate([r[0] for r in rows], np.array([r[1] for r in rows]), [r[2] for r in rows])
    assert model.thresholds["lo"] == pytest.approx(0.2) and model.thresholds["hi"] == pytest.approx(0.6)
    assert "few" not in model.thresholds


def lm_rows(n=160):
    rnd = random.Random(5)
    langs = [["".join(rnd.choice(a) for _ in range(rnd.randint(1, 5))) for _ in range(60)] for a in ("abcd", "wxyz")]
    rows = [(i, " ".join(rnd.choice(langs[i % 2]) for _ in range(rnd.randint(0, 80))).title()) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "never-seen \t words here É"), (None, "A b"), (5, "abc"), (n + 3, "É " * 3000)]


def test_base_scores_are_exact_and_the_model_is_better(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "HEAD", 40)  # most words take the join
    monkeypatch.setattr(class_lm, "MOST_FREQUENT", 30)
    monkeypatch.setattr(class_lm, "CLASSES", 8)
    rows = lm_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string").repartition(4)
    got = class_lm.score_texts(df).collect()
    assert len(got) == len(rows)
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), held(i), len(tokens(t)), sum(w in counts for w in tokens(t)), n,
                   round(sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    ours, base = (sum(getattr(r, c) for r in got if r.held_out and r.doc_id < 160) for c in ("score", "base_score"))
    assert ours > base


def test_class_probabilities_sum_to_one(spark):
    rows = [r for r in lm_rows(60) if r[1]]
    model, counts, _ = class_lm.train(spark.createDataFrame([(t,) for _, t in rows], "text string"))
    assert np.allclose((10 ** model["moves"]).sum(axis=1), 1)
    # all words of a class and one unknown word share its probability
    total = np.zeros(class_lm.CLASSES)
    for r in counts.filter(F.col("word") != class_lm.END).collect():
        w = r.word.encode()
        k = model["head"][w][1] if w in model["head"] else model["own"][class_lm.group_of(w)]
        total[k] += r.c + 0.5
    used = total > 0
    assert np.allclose(10 ** model["emits"][used], total[used] + 0.5)


def test_group_in_sql_equals_group_in_python(spark):
    words = ["a", "ab", "abc", "abcd", "é", "日本語", "x y"]
    got = spark.createDataFrame([(w,) for w in words], "word string").select(class_lm.group_column(F.col("word")).alias("g")).collect()
    assert [r.g for r in got] == [class_lm.group_of(w.encode()) for w in words]


def test_exchange_finds_two_languages():
    rng, n = np.random.default_rng(0), 20
    b = np.zeros((n + 1, n + 1))
    for i in range(1, n + 1):
        for j in range(1, n + 1):
            b[i, j] = rng.integers(5, 9) * (i % 2 == j % 2)
    own = class_lm.exchange(b, classes=3)
    assert len({own[i] for i in range(1, n + 1, 2)}) == 1 and len({own[i] for i in range(2, n + 1, 2)}) == 1 and own[1] != own[2]


def test_language_model_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert class_lm.score_texts(empty).count() == 0
    only_held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = class_lm.score_texts(spark.createDataFrame([(only_held, "a b")], "doc_id long, text string")).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score)


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Every stage's rows follow from its operator's decisions on the rows it got; nothing else changes."""
    docs = common.table(spark, SF, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:3]):
        path = str(tmp_path / str(k))
        stage(spark, docs, SF).write.parquet(path)
        kept, before = spark.read.parquet(path), {r.doc_id: r for r in docs.collect()}
        assert kept.columns == docs.columns
        after = {r.doc_id: r for r in kept.collect()}
        assert all(before[i] == r for i, r in after.items())
        gone = set(before) - set(after)
        if name == "near copies":
            sets = {i: frozenset(copies.shingle_hashes(r.text).tolist()) for i, r in before.items()}
            like = lambda a, b: len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b])) if sets[a] != sets[b] else 1.0
            ids = sorted(before)
            near = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if like(a, b) >= copies.LIKENESS]
            # every row that goes is linked to what stays, by links of that likeness; few links are not found
            label = {i: i for i in ids}
            for _ in ids:
                for a, b in near:
                    label[a] = label[b] = min(label[a], label[b])
            assert all(label[i] != i for i in gone)
            assert sum(a in after and b in after for a, b in near) <= 0.1 * len(near)
        else:
            column, bad = ("toxic", 1) if name == "toxicity" else ("quality", 0)
            labels = {r.doc_id: r[column] for r in common.table(spark, SF, "labels").collect() if r.doc_id in before}
            wrong = sum((i in gone) != (y == bad) for i, y in labels.items())
            assert wrong <= 0.06 * len(labels)
        docs = kept
    pieces = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert pieces.columns[:8] == [f.split()[0] for f in packing.SCHEMA.split(", ")]
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == set(after)


def test_pipeline_keeps_odd_rows(spark, frames, tmp_path):
    """Null ids and texts, repeated rows and extra columns of clashing names go through every stage."""
    made, docs, labels = frames
    labels.coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(i, t, lang, "s", 0, "x", 1.5, 7) for i, t, lang, x, q in made if q and not x]
    rows += [(None, "quite alone with these words", None, None, None, None, None, None), (7000, None, "en", "s", 0, "x", 0.0, 1),
             (7001, "twice the same row", "en", "s", 0, "x", 0.0, 1), (7001, "twice the same row", "en", "s", 0, "x", 0.0, 1)]
    wide = spark.createDataFrame(rows, DOC + ", score string, threshold double, fp int")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"s{k}")
        stage(spark, wide, str(tmp_path)).write.parquet(path)
        before, wide = wide.columns, spark.read.parquet(path)
        assert k == 3 or wide.columns == before
        ids = [r.doc_id for r in wide.select("doc_id").collect()]
        assert None in ids and 7000 in ids and ids.count(7001) == (2 if k < 2 else 1)
        assert len(ids) > 0.9 * len([m for m in made if m[4] and not m[3]])
    empty = spark.createDataFrame([], DOC)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_every_training_word_chooses_its_class(spark, monkeypatch):
    """Words beyond the most frequent have classes by their neighbours, not by their last bytes."""
    for name, value in (("HEAD", 8), ("MOST_FREQUENT", 4), ("CLASSES", 8)):
        monkeypatch.setattr(class_lm, name, value)
    rnd = random.Random(3)
    # one in five words of either kind ends like the other kind; "p" and "r" stand around the left ones, "q" and "s" the right
    left, right = ([f"{s}{i}{x if i % 5 else y}" for i in range(40)] for s, x, y in (("a", "xyz", "uvw"), ("b", "uvw", "xyz")))
    texts = [" ".join(x for _ in range(30) for x in rnd.choice([("p", rnd.choice(left), "r"), ("q", rnd.choice(right), "s")])) for _ in range(60)]
    model, words, bound = class_lm.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    of = {r.word: r["class"] for r in words.collect()}
    assert len(of) == 84 and words.filter(F.col("c") < bound).count() > 70
    assert len({of[w] for w in left}) == 1 and len({of[w] for w in right}) == 1 and of[left[0]] != of[right[0]]
    counts = Counter(w for t in texts for w in t.split())
    assert {r.word: r.c for r in words.collect()} == counts
    assert np.allclose((10 ** model["moves"]).sum(axis=1), 1)


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_all_labelled_rows_are_learnt_from(spark, frames, monkeypatch, module, label):
    """Beyond what is one list, rounds over all rows: every labelled row outside the held fold is seen, each once a round."""
    docs, labels = frames[1].repartition(5), frames[2]
    monkeypatch.setattr(training, "ROWS", 50)
    monkeypatch.setattr(training, "CHUNK", 20_000)
    seen = spark.sparkContext.accumulator(0)
    own = module.learn

    def learn(state, texts, y, seed):
        seen.add(len(texts))
        own(state, texts, y, seed)

    monkeypatch.setattr(module, "learn", learn)
    model = module.train(docs, labels)
    known = [i for i, *_ in frames[0] if zlib.crc32(str(i).encode()) % module.FOLDS != module.HELD]
    share = seen.value / len(known) / module.EPOCHS
    assert share == 1 if module is quality else 0.65 < share < 0.95  # a fifth of the rows sets thresholds
    got = module.score(docs.join(labels, "doc_id"), model).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % module.FOLDS == module.HELD]
    assert sum(r.predicted == r[label] for r in held) >= 0.9 * len(held)


def test_changes_travel_small():
    """What a task tells of its changes comes back row by row, in at most 4 bytes a number and a bit, or 4 bytes, a row."""
    rng = np.random.default_rng(4)
    old = rng.normal(size=2 * training.BLOCK + 100)
    for share in (0.0, 0.001, 0.7, 1.0):
        new = np.where(rng.random(len(old)) < share, old + rng.normal(size=len(old)), old)
        got, size = np.zeros(len(old)), 0
        for at, where, moved in training.changed(new, old):
            got[at + training.rows_in(where)] = np.frombuffer(moved, np.float32)
            size += len(where) + len(moved)
        n = np.count_nonzero(new != old)
        assert np.allclose(got, new - old, rtol=1e-6, atol=0) and np.count_nonzero(got) == n
        assert size <= 4 * n + min(4 * n, len(old) / 8 + 8) + 3
