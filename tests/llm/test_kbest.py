"""Searches that compare every query with every vector: what is held, and what moves."""

import numpy as np
import pytest

from furrow.llm import kbest, negatives, vafile
from furrow.session import settle


@pytest.mark.parametrize("k", [1, 3])
def test_best_against_sorting(k):
    """Many ties, groups with few rows, rows that come in any order."""
    rng = np.random.default_rng(k)
    best, rows = kbest.Best(9, k, 1), []
    for _ in range(40):
        n = int(rng.integers(0, 30))
        group, score, ids, other = rng.integers(0, 8, n), rng.integers(-4, 5, n), rng.integers(0, 50, n), rng.integers(0, 9, n)
        best.add(group, score, ids, other)
        rows += zip(group.tolist(), score.tolist(), ids.tolist())
    group, score, ids, _ = best.found()
    want = [r for g in range(9) for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:k]]
    assert list(zip(group.tolist(), score.tolist(), ids.tolist())) == want
    assert best.floor([8]) == [kbest.NONE]


def test_bounds_of_the_kth():
    rng = np.random.default_rng(5)
    for n in (2, 5, 70, 1000):
        scores = rng.integers(-50, 50, (20, n)).astype(np.float32)
        got = kbest.kth(scores, 5)
        assert (got <= np.sort(scores, axis=1)[:, -min(n, 5)]).all() and (n < 5) == np.isinf(got).all()
        place, spot = kbest.reaching(scores, np.full(20, 49, np.float32))
        assert set(zip(place.tolist(), spot.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(scores >= 49))))


@pytest.mark.parametrize("top", [100, 300, 2 ** 20, 2 ** 40])
def test_blocks_keep_their_integers(top):
    x = np.random.default_rng(1).integers(-top, top, (50, 7))
    assert (kbest.matrix(kbest.narrow(x).tobytes(), 50, 7) == x).all()
    cells, low, width = vafile.cells_of(x)
    assert (vafile.vectors_of(cells, low, width, kbest.narrow(x - (low + cells * width))) == x).all()


def test_equal_vectors_leave_k_candidates(spark):
    """A vector that many rows have leaves no more candidates than others; ties go to the smaller ids."""
    rng = np.random.default_rng(6)
    bases = rng.integers(-900, 900, (10, 8))
    df = spark.createDataFrame([(i, bases[i % 10].tolist()) for i in range(2000)], "vec_id long, v array<long>").repartition(4)
    data, asked = settle(vafile.blocks(df, 150, "data"), "d"), settle(vafile.blocks(df.filter("vec_id % 50 = 0"), 7, "asked"), "a")
    assert vafile.scan(asked, data, 5).count() == 5 * 40
    got = vafile.top_k(df.filter("vec_id = 50"), df, 5).orderBy("rank").collect()
    assert [r.vec_id for r in got][: 5] == sorted(np.argsort(-(bases @ bases[0])[np.arange(2000) % 10], kind="stable")[:6].tolist())[:5]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_are_not_repeated_for_each_pair(spark):
    """No block is broadcast or shuffled once for each block that it meets."""
    rng = np.random.default_rng(7)
    rows = [(i, int(i % 3), rng.integers(-50, 50, 6).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>").repartition(3)
    vectors = df.select("vec_id", "v")
    data, asked = settle(vafile.blocks(vectors, 20, "data"), "d"), settle(vafile.blocks(vectors.limit(9), 4, "asked"), "a")
    plan = plan_of(vafile.scan(asked, data, 5))
    assert "Join" not in plan and "Broadcast" not in plan and plan.count("CartesianProduct") == 1


def test_anchor_blocks_are_not_repeated_for_each_pair(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(i % 3), rng.integers(-50, 50, 6).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>").repartition(3)
    data, asked = settle(negatives.packed(df, 20), "d"), settle(negatives.packed(df.limit(9), 4), "a")
    near = negatives.positives(asked, data, 5)
    assert "Join" not in plan_of(near) and plan_of(near).count("CartesianProduct") == 1
    assert near.count() == 45
    low, high = negatives.limits(near.positive_score, 30, 90)
    near = near.withColumns({"low": low, "high": high}).filter("low <= high")
    told = settle(negatives.with_windows(asked, near), "w")
    kept = negatives.slots(told, data, 10)
    assert "Join" not in plan_of(kept) and plan_of(kept).count("CartesianProduct") == 1
