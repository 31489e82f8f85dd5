"""Hard negatives and the filter audit against plain loops and SQL."""

import itertools
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from furrow.llm import audit, negatives
from furrow.session import settle

ROW = "vec_id long, embedding array<float>, label int, score double"


def brute_negatives(rows, high=90, low=30):
    vs = [(i, l, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for i, e, l in rows]
    out = []
    for i, l, v in vs:
        if i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in vs if j != i and len(w) == len(v)]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for p, pid, _ in [r for r in scored if r[2] == l][:5]:
            window = [r for r in scored if r[2] != l and low * p <= 100 * r[0] <= high * p][:10]
            out += [(i, pid, k, r[1], p, r[0]) for k, r in enumerate(window, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,anchors", [(4096, 4096), (7, 2)])
def test_negatives(spark, monkeypatch, block, anchors):
    """Ties, equal vectors in a third of all rows, negative scores, several lengths, rows that take no part."""
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    monkeypatch.setattr(negatives, "SLAB", 2)
    rng = np.random.default_rng(block)
    rows = []
    for i in range(400):
        e = rng.normal(size=6).round(2).tolist() if i % 3 else [0.5, 0.25, -0.25, 0.125, 0.5, 1.0]
        rows.append((i * 25, e[: 4 + 2 * (i % 5 > 0)], int(rng.integers(0, 3))))
    rows += [(200, [-x for x in rows[8][1]], 1), (7, [0.0] * 6, 0)]
    bad = [(None, [1.0] * 6, 1), (300, None, 1), (400, [1.0, None], 1), (500, [float("nan")] * 6, 2), (600, [float("inf")] * 6, 0),
           (700, [], 1), (800, [1.0] * 6, None)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows + bad], ROW).repartition(3)
    vectors = negatives.labelled_vectors(df)
    got = negatives.hard_negatives(vectors.filter("vec_id % 100 = 0"), vectors)
    found = sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
                   for r in got.collect())
    assert found == brute_negatives(rows) and len(found) > 500
    assert negatives.hard_negatives(vectors.limit(0), vectors.limit(0)).collect() == []


def brute_audit(docs, labels):
    text = lambda d: d[1] or ""
    rows = []
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text(d))
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text(d))) > 10 * len(text(d)), "D": bool(re.search("[#$%&*|]", text(d))),
                 "E": d[0] is not None and any(text(o) == text(d) and o[0] is not None and o[0] < d[0] for o in docs)}
        own = [x for x in labels if x[0] is not None and x[0] == d[0]]
        rows.append((d[2] or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                own = [r for r in rows if r[0] == part]
                gone = lambda r: any(r[1][x] for x in order[:k])  # noqa: B023, E731
                now = [r for r in own if r[1][f] and not gone(r)]
                out[part, "".join(order), k + 1] = (
                    sum(not r[1][f] and not gone(r) for r in own), len(now), sum(r[1][f] and gone(r) for r in own),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in own), sum(r[2] for r in now), sum(r[3] for r in now))
                shapley[part, f] = shapley.get((part, f), 0) + len(now)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("chunk,part", [(6_000_000, 4_000_000), (300, 40)])
def test_audit(spark, monkeypatch, chunk, part):
    """Null ids, texts and languages, equal ids, repeated rows, copies, other white space, clashing columns."""
    monkeypatch.setattr(audit, "CHUNK", chunk)
    monkeypatch.setattr(audit, "SLICE", part)
    monkeypatch.setattr(audit, "NUMBERS", part)
    rng = random.Random(3)
    prose = lambda n, k: " ".join(rng.choice("Ab cde é# Zz k l m".split(" ")) + str(rng.randrange(k)) for _ in range(n))
    docs = [(i, prose(rng.choice([3, 99, 100, 180]), rng.choice([5, 90, 9000])), rng.choice(["en", "de", None, ""])) for i in range(60)]
    docs += [(i + 100, docs[i % 7][1], "en") for i in range(25)] + [docs[3], docs[3], (3, "other", "de"), (None, docs[4][1], "fr")]
    docs += [(None, None, None), (500, "", "x"), (501, None, "x"), (502, " \t\n\x0b\x0c\r", "x"), (503, "a\x0bb\x1cc d", "x"), (2, docs[5][1], "y")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(50)] + [(4, 1, 0), (None, 1, 1)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, lang string, chunk int").repartition(4)
    ls = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    got = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in audit.interactions(audit.judged(df), ls).collect()}
    want = brute_audit(docs, labels)
    assert got == want
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"}))
    con.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    cur = con.execute(audit.OP13_SQL)
    at = [d[0] for d in cur.description]
    assert {tuple(r[at.index(n)] for n in ("part", "filter_order", "step")): tuple(r[at.index(n)] for n in names) for r in cur.fetchall()} == want
    assert audit.interactions(audit.judged(df.limit(0)), ls).collect() == []


def test_matrix_is_encoded_globally(spark):
    """A word has one number in all shards, and no other word has it."""
    texts = ["a b a", "b c", "c c c d", "a"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    shards = settle(audit.local_shards(df, "doc_id", "text", "lang"), "shards")
    table = settle(audit.global_numbers(shards), "numbers")
    rows = audit.vocabulary(shards, table).collect()
    numbers = {r.word.encode(): r.number for r in rows}
    assert len(rows) == len(numbers) == len(set(numbers.values())) == 4
    assert audit.numbers_of([{"base": 5 << 40, "places": np.int32([1]).tobytes(), "numbers": np.int32([7]).tobytes()}], 2)[1] == (5 << 40) + 7
    import zstandard
    raw = lambda b, k: np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(b)), k).tolist()
    found = {}
    for r in audit.term_matrix(shards, table).collect():
        ends, columns, counts = raw(r.ends, np.int64), raw(r.columns, np.int64), raw(r["counts"], np.int32)
        for i, (a, b) in zip(r.ids, zip([0, *ends], ends)):
            found[i] = dict(zip(columns[a:b], counts[a:b]))
    assert found == {i: {numbers[w.encode()]: t.split().count(w) for w in t.split()} for i, t in enumerate(texts)}
