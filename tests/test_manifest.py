"""Commits of whole tables: what readers see while a write goes on, fails or is overtaken."""

import pytest
from pyspark.sql import functions as F

from furrow.sources import manifest as mf


def rows(spark, values):
    return spark.createDataFrame(values, "k string, doc string, v int, tag string")


def content(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    mf.upsert_table(rows(spark, [("a", "d1", 1, "x"), ("b", "d2", 1, "y")]), path, ["k"], ["doc"])
    return path


@pytest.mark.parametrize("step", ["_described", "commit", "_rename"])
def test_a_write_that_dies_leaves_the_table_as_it_was(spark, table, monkeypatch, step):
    before = mf.open_table(spark, table)

    def dies(*args):
        raise KeyboardInterrupt(step)

    monkeypatch.setattr(mf, step, dies)
    with pytest.raises(KeyboardInterrupt):
        mf.upsert_table(rows(spark, [("a", "d1", 2, "x"), ("c", "d3", 1, "z")]), table, ["k"], ["doc"])
    monkeypatch.undo()
    assert mf.open_table(spark, table).version == before.version
    assert content(mf.read_table(spark, table)) == [("a", 1), ("b", 1)]
    # the same write again, and an older reader keeps what it opened
    mf.upsert_table(rows(spark, [("a", "d1", 2, "x"), ("c", "d3", 1, "z")]), table, ["k"], ["doc"])
    assert content(mf.read_table(spark, table)) == [("a", 2), ("b", 1), ("c", 1)] and content(before.read()) == [("a", 1), ("b", 1)]


def test_a_second_writer_is_told(spark, table, monkeypatch):
    sound = mf._described

    def slow(*args):  # another commit comes between writing and committing
        monkeypatch.setattr(mf, "_described", sound)
        mf.upsert_table(rows(spark, [("z", "d9", 9, "q")]), table, ["k"], ["doc"])
        return sound(*args)

    monkeypatch.setattr(mf, "_described", slow)
    with pytest.raises(mf.Overtaken):
        mf.upsert_table(rows(spark, [("a", "d1", 5, "x")]), table, ["k"], ["doc"])
    assert content(mf.read_table(spark, table)) == [("a", 1), ("b", 1), ("z", 9)]


def test_buckets_split_by_size_and_only_touched_ones_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    values = [(f"k{i}", f"d{i % 40}", i, f"t{i % 7}") for i in range(4000)]
    now = mf.upsert_table(rows(spark, values), path, ["k"], ["doc"], sort_by=("tag",), bucket_bytes=4000)
    buckets = {f.bucket for f in now.files}
    assert len(buckets) > 4 and sum(f.rows for f in now.files) == 4000
    # every file holds one bucket, and a document has one bucket
    for f in now.files:
        assert spark.read.parquet(f.path).where(now.bucket_of(F.xxhash64("doc")) != f.bucket).count() == 0
    one = now.buckets_with(rows(spark, [("k5", "d5", 0, "")]), ["doc"])
    assert len(one) == 1
    after = mf.upsert_table(rows(spark, [("k5", "d5", -1, "t0")]), path, ["k"], ["doc"], sort_by=("tag",), bucket_bytes=4000)
    assert {f.path for f in now.files if f.bucket not in one} == {f.path for f in after.files} & {f.path for f in now.files}
    assert content(after.read()) == sorted((k, -1 if k == "k5" else v) for k, _, v, _ in values)
    # a document that the table has never seen goes where its hash belongs
    more = mf.upsert_table(rows(spark, [("n", "new", 1, "t1")]), path, ["k"], ["doc"], sort_by=("tag",), bucket_bytes=4000)
    assert more.read().count() == 4001


def test_files_are_skipped_by_what_the_manifest_tells(spark, tmp_path):
    path = str(tmp_path / "t")
    values = [(f"k{i}", f"d{i}", i, f"t{i // 100:02d}") for i in range(1000)]
    now = mf.upsert_table(rows(spark, values), path, ["k"], ["tag"], sort_by=("tag",), bucket_bytes=3000)
    few = now.select(where={"tag": ["t03"]})
    assert 0 < len(few) < len(now.files)
    assert now.read(where={"tag": ["t03"]}).where("tag = 't03'").count() == 100
    assert now.read(where={"tag": ["none"]}).where("tag = 'none'").count() == 0


def test_empty_fresh_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    assert mf.read_table(spark, path) is None
    mf.upsert_table(rows(spark, []), path, ["k"], ["doc"])
    assert content(mf.read_table(spark, path)) == []
    mf.upsert_table(rows(spark, [("a", "d", 1, ""), ("b", "d", 1, ""), ("c", "e", 1, "")]), path, ["k"], ["doc"])
    mf.upsert_table(rows(spark, [("a", "d", 2, "")]), path, ["k"], ["doc"], pruned_by="doc")
    assert content(mf.read_table(spark, path)) == [("a", 2), ("c", 1)]
    mf.upsert_table(rows(spark, [("x", "d", 7, "")]), path, ["k"], ["doc"], fresh=True)
    assert content(mf.read_table(spark, path)) == [("x", 7)]
    assert mf.expire(spark, path, keep=1) and content(mf.read_table(spark, path)) == [("x", 7)]
