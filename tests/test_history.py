"""Versions of claims, and what is kept from their changes, against the whole sets."""

import random

import pytest
from pyspark.sql import functions as F

from furrow.operators import publishing as pb
from furrow.sources import history as hs

DAYS = [f"2026-01-0{i} 00:00:00" for i in range(1, 7)]


def test_a_sequence_of_publishes(spark, tmp_path):
    """Added, changed, withdrawn and claimed again; unchanged rows write nothing; every day can be read."""
    rng, path, states, state = random.Random(4), str(tmp_path / "h"), [], {}
    for at in DAYS:
        state = {k: v for k, v in state.items() if rng.random() > .2}
        state.update({f"r{rng.randrange(40)}": rng.randrange(4) for _ in range(12)})
        states.append(dict(state))
        rows = [(k, "c1" if int(k[1:]) % 2 else "c2", v) for k, v in state.items()]
        hs.record(spark, path, spark.createDataFrame(rows, "id string, cat string, v int"), at, "id", scope="cat", bucket_bytes=2500)
    history = hs.read(spark, path).cache()
    for at, want in zip(DAYS, states):
        assert {r["id"]: r["v"] for r in hs.as_of(history, at).collect()} == want
    assert history.groupBy("id", "valid_from").count().where("count > 1").count() == 0
    want = [(at, c, k) for at, old, new in zip(DAYS, [{}, *states], states) for k in {*old, *new}
            for c in ["added" if k not in old else "removed" if k not in new else "changed" if old[k] != new[k] else None] if c]
    got = hs.feed(history, "id").select(F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), "change", "id").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    sums = None
    for change in hs.batches(history, DAYS):
        sums = hs.moved_sums(sums, change, "cat")
    whole = hs.as_of(history, DAYS[-1])
    full = pb.claims_hash(whole, F.to_json(F.struct("id", "cat", "v")), "cat")
    assert sorted(map(tuple, pb.hash_of(sums).collect())) == sorted(map(tuple, full.collect()))


def test_without_a_scope_nothing_is_withdrawn(spark, tmp_path):
    path = str(tmp_path / "h")
    df = lambda *rows: spark.createDataFrame(list(rows), "id string, v int")
    hs.record(spark, path, df(("a", 1), ("b", 1)), DAYS[0], "id")
    before = hs.record(spark, path, df(("a", 2)), DAYS[1], "id").version
    assert {r["id"]: r["v"] for r in hs.as_of(hs.read(spark, path), DAYS[1]).collect()} == {"a": 2, "b": 1}
    assert hs.record(spark, path, df(("a", 2), ("b", 1)), DAYS[2], "id").version == before  # nothing changed
    with pytest.raises(ValueError, match="after"):
        hs.record(spark, path, df(("a", 3)), DAYS[0], "id")
