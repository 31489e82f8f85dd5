"""What was claimed when: versions of published rows, and what is derived from their changes alone.

A version is a row with the time from which it was claimed and, once another publish changed or withdrew it, the time
until which. A publish writes only the versions that it opens and closes, in one commit (`manifest`). From them follow
reads as of any time, a feed of changes, and aggregates that are kept by adding what came and subtracting what went:
sums behind claims hashes, and facet counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.discover import facet_counts
from ..operators.publishing import LANES, lane_sums
from ..session import settle
from .manifest import BUCKET_BYTES, Snapshot, open_table, upsert_table

OWN = ("digest", "valid_from", "valid_to")
TIMES = OWN[1:]


def _digest(columns) -> Column:
    """Of a row's own columns. It is worked out where it is asked for and not stored: it takes more room than most rows."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def _time(at: datetime | str) -> Column:
    return F.lit(at).cast("timestamp")


def record(spark: SparkSession, path: str, rows: DataFrame, at: datetime | str, key: str, *, scope: str | None = None,
           bucket_bytes: int = BUCKET_BYTES) -> Snapshot | None:
    """One publish of rows, one for each `key`, at a time after all before. With `scope`, a column, a publish stands for
    all rows of the values it names: those it does not send are withdrawn.

    Unchanged rows write nothing. Without a scope only the buckets of the sent keys are read.
    """
    sent = settle(rows, "sent")
    now = open_table(spark, path)
    if now is None:
        return upsert_table(opened(sent, at), path, [key, "valid_from"], [key], bucket_bytes=bucket_bytes)
    held = now.read(None if scope else now.buckets_with(sent, [key]))
    late = held.agg(F.max(F.greatest("valid_from", F.coalesce("valid_to", "valid_from"))) > _time(at)).first()[0]
    if late:
        raise ValueError(f"{path} already holds claims of a time after {at}")
    current = held.where("valid_to is null")
    same = current.join(sent.select(F.col(key), F.unhex(_digest(rows.columns)).alias("_sent")), key)
    equal = F.unhex(_digest(rows.columns)) == F.col("_sent")
    changed = same.where(~equal).drop("_sent")
    gone = changed
    if scope:
        withdrawn = current.join(sent.select(scope).distinct(), scope, "left_semi").join(sent.select(key), key, "left_anti")
        gone = changed.unionByName(withdrawn)
    fresh = sent.join(same.where(equal).select(key), key, "left_anti")
    delta = gone.withColumn("valid_to", _time(at)).unionByName(opened(fresh, at))
    delta = settle(delta.select(*rows.columns, *TIMES), "delta")
    if delta.isEmpty():
        return now
    return upsert_table(delta, path, [key, "valid_from"], [key], written=True, bucket_bytes=bucket_bytes)


def opened(rows: DataFrame, at: datetime | str) -> DataFrame:
    return rows.withColumns({"valid_from": _time(at), "valid_to": F.lit(None).cast("timestamp")})


def read(spark: SparkSession, path: str) -> DataFrame:
    """All versions, each with the digest of its row."""
    held = open_table(spark, path).read()
    own = [c for c in held.columns if c not in OWN]
    return held.select(*own, _digest(own).alias("digest"), *TIMES)


def as_of(history: DataFrame, at: datetime | str) -> DataFrame:
    """The rows claimed at a time. A publish counts from its own instant on."""
    t = _time(at)
    return history.where((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))).drop(*OWN)


def feed(history: DataFrame, key: str | None = None) -> DataFrame:
    """(at, change, …row): rows added and removed, and changed ones in their new form. Each version opens once and closes
    at most once, so a key meets only its own versions."""
    key = key or history.columns[0]
    opens = history.select("*", F.col("valid_from").alias("at"), F.lit(1).alias("_sign"))
    closes = history.where("valid_to is not null").select("*", F.col("valid_to").alias("at"), F.lit(-1).alias("_sign"))
    body = F.struct(*[c for c in history.columns if c not in (key, *OWN)])
    both = opens.unionByName(closes).groupBy(key, "at").agg(
        F.count("*").alias("_n"), F.max_by(body, "_sign").alias("_row"), F.max("_sign").alias("_top"))
    change = F.when(F.col("_n") == 2, "changed").when(F.col("_top") == 1, "added").otherwise("removed")
    return both.select("at", change.alias("change"), key, "_row.*")


def batches(history: DataFrame, times) -> Iterator[DataFrame]:
    """For each time the versions that a publish at it opened (`sign` 1) and closed (`sign` -1)."""
    for at in times:
        t = _time(at)
        yield history.where(F.col("valid_from") == t).withColumn("sign", F.lit(1)).unionByName(
            history.where(F.col("valid_to") == t).withColumn("sign", F.lit(-1)))


def moved_sums(sums: DataFrame | None, change: DataFrame, *keys: str) -> DataFrame:
    """`publishing.lane_sums` after a batch of versions: what came is added, what went is subtracted; no row that stayed
    is read. A key without rows left is gone."""
    names = ["n", *(f"l{i}" for i in range(LANES))]
    parts = lane_sums(change, F.col("digest"), *keys, "sign")
    parts = parts.select(*keys, *[(F.col(c) * F.col("sign")).cast("decimal(38,0)").alias(c) for c in names])
    whole = parts if sums is None else parts.unionByName(sums)
    summed = whole.groupBy(*keys).agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in names])
    return summed.where("n > 0").withColumn("n", F.col("n").cast("decimal(38,0)"))


def moved_counts(counts: DataFrame | None, change: DataFrame) -> DataFrame:
    """`discover.facet_counts` after a batch of versions, kept in the same way. Values that no resource has any more are
    gone."""
    signed = [facet_counts(change.where(F.col("sign") == s)).withColumn("resources", F.col("resources") * s) for s in (1, -1)]
    parts = signed[0].unionByName(signed[1])
    whole = parts if counts is None else parts.unionByName(counts)
    return whole.groupBy("facet", "value").agg(F.sum("resources").alias("resources")).where("resources <> 0")
