"""Induced sorting and the removal of repeated strings against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from furrow.llm import repeats
from furrow.llm.suffix import Scratch, joined, suffix_array


def brute_array(text):
    t = text.tolist()
    order, shared = sorted(range(len(t)), key=lambda i: t[i:]), [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        shared.append(k)
    return order, shared


@pytest.mark.parametrize("seed", range(6))
def test_induced_sorting(seed):
    """Full recursion and early ends, tuples and arrays in memory and on disk."""
    rng = random.Random(seed)
    for _ in range(40):
        letters = rng.choice([1, 2, 3, 26])
        texts = [bytes(rng.randrange(letters) + 97 for _ in range(rng.choice([0, 1, 5, 30, 80]))) for _ in range(rng.randint(1, 6))]
        texts += [texts[0] * 2] * (rng.random() < .3) + [b"a" * 50] * (rng.random() < .3)
        text, symbols, _ = joined(texts)
        scratch = Scratch(rng.choice([10, 10 ** 6]), rng.choice([10, 10 ** 6]), rng.choice([1, 1, 40, 10 ** 6]))
        order, shared = suffix_array(text, symbols, scratch)
        assert (order.tolist(), shared.tolist()) == brute_array(text)


def brute(texts, length):
    seen = Counter(t[i: i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i: i + length]] > 1:
                gone[i: i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join("".join(rng.choices("aeioubdklmnprst", k=rng.randint(1, 9))) for _ in range(n))
    passage, other = prose(60), prose(45)
    docs = [prose(rng.randint(5, 120)) for _ in range(25)]
    docs += [prose(rng.randint(1, 30)) + passage + prose(rng.randint(1, 30)) for _ in range(40)]  # a hot passage
    docs += [docs[0], docs[0], docs[3], other[:200], other[:199], "x" * 199, "x" * 200, "y" * 201, "z" * 900, "ab" * 300]
    docs += [other[40:], other + prose(5) + other, "é" * 150 + passage[:210], "é" * 150, "", None, " ", passage[1:200] + "é"]
    half = docs[5].split()
    half[len(half) // 2] = "edited"
    return docs + [" ".join(half)]


@pytest.mark.parametrize("group,shard,chunk", [(20_000, 5_000_000, 2_000_000), (3, 2_000, 3_000), (5, 40_000, 1)])
def test_against_brute_force(spark, monkeypatch, group, shard, chunk):
    """With small bounds hot groups are cut level by level, and shards and chunks are many."""
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    docs = corpus(chunk)
    rows = [(i, d, i) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk long").repartition(3)
    got = {r.doc_id: r for r in repeats.remove_repeats(df, group=group, shard=shard).collect()}
    want = brute([(d or "").encode() for d in docs], 200)
    for i, w in enumerate(want):
        r = got[i]
        assert (r.n_bytes, sum(s.length for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) == w, i


def test_other_lengths_ids_and_empty_tables(spark):
    docs = ["one two three four five six seven eight nine ten eleven twelve " * 2, "q" * 64, "q" * 63, None]
    df = spark.createDataFrame([(None, d) for d in docs], "doc_id string, text string")
    got = sorted((r.n_bytes, sum(s.length for s in r.spans)) for r in repeats.remove_repeats(df, 64).collect())
    assert got == sorted((a, b) for a, b, _, _ in brute([(d or "").encode() for d in docs], 64))
    assert repeats.remove_repeats(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        repeats.remove_repeats(df, 10)


def test_what_counts_tell_is_not_sorted():
    one, two, three = (b"a", 3, 1, b"x" * 210), (b"b", 0, 2, b"y" * 205), (b"c", 1, 3, b"z" * 200)
    assert repeats.told_apart([], 200) == ([], [])
    assert repeats.told_apart([one], 200) == ([], [])
    assert repeats.told_apart([two], 200) == ([(b"b", 0, 5)], [])
    assert repeats.told_apart([two, three], 200) == ([(b"b", 0, 5), (b"c", 0, 0)], [])
    assert repeats.told_apart([one, two], 200) == ([(b"b", 0, 5)], [(b"a", 1, one[3]), (b"b", 2, two[3])])
