"""Tables that change by whole commits: files beside each other, and a manifest that tells which of them count.

    <table>/data/<commit>/bucket=<depth>-<prefix>/part-….parquet
    <table>/manifests/v<number>/                          one row for each live file

A commit writes the changed buckets as new files, then a manifest, which is renamed into place. Until then nothing that
a reader sees has changed; a reader keeps the files of the manifest it opened. A writer that finds its number taken has
been overtaken: it raises `Overtaken` and leaves the table to the other.

A bucket is a prefix of the hash of the columns `by`. It starts with no bits and is split by more of them as its rows
outgrow `bucket_bytes`, so a batch rewrites buckets of a bounded size whatever the size of the table (rows of one value of
`by` stay together). Manifest rows number the table's bytes over that size; they are read by the driver.

Files carry the least and greatest value of the columns `stats`, and searches skip files by them before Spark plans any.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import literal
from ..operators.ordered import first_per
from ..operators.vector_index import prune, upsert
from ..session import settle
from .sinks import _versions, remove

BUCKET_BYTES = 512_000_000


class Overtaken(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class File:
    path: str
    bucket: str
    rows: int
    bytes: int
    low: dict = field(default_factory=dict)
    high: dict = field(default_factory=dict)

    def may_hold(self, where: dict[str, list]) -> bool:
        """Whether a row can have one of the listed values in each column."""
        return all(c not in self.low or any(self.low[c] <= str(v) <= self.high[c] for v in values) for c, values in where.items())


_SCHEMA = "path string, bucket string, rows long, bytes long, low map<string,string>, high map<string,string>"


@dataclass(frozen=True)
class Snapshot:
    """The table as one manifest tells it."""

    spark: SparkSession
    path: str
    version: int
    files: tuple[File, ...]

    def select(self, buckets: set[str] | None = None, where: dict[str, list] | None = None) -> list[File]:
        return [f for f in self.files if (buckets is None or f.bucket in buckets) and f.may_hold(where or {})]

    def read(self, buckets: set[str] | None = None, where: dict[str, list] | None = None) -> DataFrame:
        """Rows of the files that can hold what is asked for; the caller still filters."""
        chosen = self.select(buckets, where)
        if chosen:
            return self.spark.read.parquet(*[f.path for f in chosen])
        return self.spark.read.parquet(self.files[0].path).limit(0)

    def bucket_of(self, hashed: Column) -> Column:
        """The bucket of a row by its hash. Where the table holds none, as small a one as it has anywhere: no other
        overlaps it."""
        by_depth: dict[int, set[int]] = {}
        for name in {f.bucket for f in self.files}:
            depth, prefix = map(int, name.split("-"))
            by_depth.setdefault(depth, set()).add(prefix)
        deepest = max(by_depth, default=0)
        found = F.concat_ws("-", F.lit(deepest), _prefix(hashed, deepest))
        for depth, prefixes in by_depth.items():
            own = _prefix(hashed, depth)
            found = F.when(own.isin(*prefixes), F.concat_ws("-", F.lit(depth), own)).otherwise(found)
        return found

    def buckets_with(self, rows: DataFrame, by: list[str]) -> set[str]:
        """Buckets in which the rows lie, or would."""
        names = rows.select(self.bucket_of(F.xxhash64(*by)).alias("b")).distinct().collect()  # at most all buckets
        return {r["b"] for r in names}


def _prefix(hashed: Column, depth: int | Column) -> Column:
    """The first `depth` bits of a hash as a number."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", hashed, F.lit(64) - depth))


def open_table(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest state of a table, or that of a version; None before the first commit."""
    versions = _versions(spark, f"{path}/manifests")
    if not versions or version is not None and version not in versions:
        return None
    number = versions[-1] if version is None else version
    rows = spark.read.schema(_SCHEMA).parquet(f"{path}/manifests/v{number}").collect()
    return Snapshot(spark, path, number, tuple(sorted((File(**r.asDict()) for r in rows), key=lambda f: f.path)))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the newest state, or None before the first commit."""
    now = open_table(spark, path)
    return now.read() if now else None


def _described(spark: SparkSession, folder: str, stats: list[str]) -> list[File]:
    """The files of a folder just written, from one aggregate over narrow columns."""
    rows = spark.read.parquet(folder)
    file = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
    edge = lambda fn: F.map_from_arrays(F.array(*[F.lit(c) for c in stats]), F.array(*[
        fn(F.col(c).cast("string")) for c in stats])) if stats else F.create_map().cast("map<string,string>")
    found = file.groupBy("_path", "bucket").agg(F.count("*").alias("rows"), F.first("_size").alias("bytes"),
                                                edge(F.min).alias("low"), edge(F.max).alias("high"))
    return [File(r["_path"], r["bucket"], r["rows"], r["bytes"], _known(r["low"]), _known(r["high"])) for r in found.collect()]


def _known(values: dict) -> dict:
    return {k: v for k, v in values.items() if v is not None}


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    return not fs.exists(path(target)) and fs.rename(path(source), path(target))


def commit(spark: SparkSession, path: str, files: list[File], after: int) -> Snapshot:
    """Make `files` the table's state that follows version `after`."""
    aside = f"{path}/manifests/new-{uuid.uuid4().hex}"
    rows = [(f.path, f.bucket, f.rows, f.bytes, f.low, f.high) for f in files]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.parquet(aside)
    if not _rename(spark, aside, f"{path}/manifests/v{after + 1}"):
        remove(spark, aside)
        raise Overtaken(f"{path}: version {after + 1} was committed by another writer")
    return Snapshot(spark, path, after + 1, tuple(files))


def upsert_table(incoming: DataFrame, path: str, keys: list[str], by: list[str], *, fresh: bool = False,
                 pruned_by: str | None = None, sort_by: tuple[str, ...] = (), written: bool = False,
                 newest_first: list[Column] | None = None, bucket_bytes: int = BUCKET_BYTES) -> Snapshot:
    """Keyed upsert as one commit. Only buckets that receive rows are read and written again.

    `written` says that `incoming` is a cheap view of a written table; `newest_first` decides between rows of one key,
    held or incoming; `pruned_by` drops held rows of a re-sent value of that column that were not sent again.
    """
    spark = incoming.sparkSession
    rows = incoming if written else settle(incoming, "incoming")
    now = open_table(spark, path)
    held = None if fresh else now
    touched = held.buckets_with(rows, by) if held else set()
    if touched:
        part = held.read(touched)
        if pruned_by:
            part = prune(part, rows, pruned_by, keys)
        merged = upsert(part.select(*rows.columns), rows, keys, newest_first)
    else:
        merged = first_per(rows, keys, newest_first or [F.lit(1)])
    merged = settle(merged, "merged")
    hashed = F.xxhash64(*by)
    bucket = held.bucket_of(hashed) if held else F.lit("0-0")
    counted = merged.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    counts = {r["bucket"]: r["n"] for r in counted.collect()}  # at most the touched buckets
    size = int(str(merged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # a bucket above the bound gets as many bits as halves are needed
    bits = {b: max(0, math.ceil(math.log2(n * size / sum(counts.values()) / bucket_bytes))) for b, n in counts.items()}
    depth = F.split(bucket, "-")[0].cast("int") + F.coalesce(F.element_at(literal(bits or {"": 0}, "map<string,int>"), bucket), F.lit(0))
    named = merged.withColumn("_depth", depth)
    named = named.withColumn("bucket", F.concat_ws("-", "_depth", _prefix(hashed, F.col("_depth")))).drop("_depth")
    # REBALANCE keeps rows of a bucket together, splits buckets over the advisory size and joins small ones
    ordered = named.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *sort_by)
    folder = f"{path}/data/{uuid.uuid4().hex}"
    writer = ordered.write.partitionBy("bucket")
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.parquet(folder)
    stats = [c for c in dict.fromkeys([*sort_by, *by]) if dict(incoming.dtypes)[c] == "string"]
    files = _described(spark, folder, stats) if counts else []
    kept = [f for f in held.files if f.bucket not in touched] if held else []
    if not kept and not files:  # a table without rows keeps one file, which tells its columns
        empty = f"{path}/data/{uuid.uuid4().hex}"
        merged.limit(0).coalesce(1).write.parquet(empty)
        found = spark.read.parquet(empty).inputFiles()
        files = [File(found[0], "0-0", 0, 0)] if found else []
    return commit(spark, path, kept + files, now.version if now else 0)


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest `keep` manifests, and the files that only they name. Not while a reader of an older
    state is at work."""
    versions = _versions(spark, f"{path}/manifests")
    live = {f.path for v in versions[-keep:] for f in open_table(spark, path, v).files}
    gone = {f.path for v in versions[:-keep] for f in open_table(spark, path, v).files} - live
    for v in versions[:-keep]:
        remove(spark, f"{path}/manifests/v{v}")
    for f in sorted(gone):
        remove(spark, f)
    return sorted(gone)
