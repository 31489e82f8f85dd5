"""How quality filters interact, decided on a sparse document-term matrix.

Texts are packed into chunks of about CHUNK bytes. A chunk becomes a CSR shard over the words that it holds (their
number in each document) beside the flags that need no words. Each chunk's distinct words are dealt out by word, once a
chunk whatever their frequency; the task that has a word gives it its global number, and the chunk's numbers go back to
it, so that all shards are columns of one matrix (`term_matrix`). Row sums are the words of a document, stored entries
its distinct words.

A document fails any of five filters: A under 100 words, B distinct words under 80 percent, C capitals A-Z over
10 percent of the code points, D one of the characters #$%&*|, E a text that a smaller id has. The five bits and the
labels are counted by part first; orders of filters are then worked out on these few counts, not on documents.

Defined cases: null is the empty text (no words: it fails A only, besides E); null languages are the part ''; a null id
never repeats another and is not repeated; rows with equal ids do not repeat each other; a document is good (or toxic)
if a label row of its id says so; each row of repeated rows counts; a very long text is a chunk by itself and is read
in slices; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  used as pa.compute
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.session import settle

CHUNK, SLICE = 4_000_000, 4_000_000
#: Numbers that a task holds before it sends them.
NUMBERS = 500_000
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
LETTERS = "ABCDE"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SIGNS = re.compile(rb"[#$%&*|]")


def slices(text: bytes) -> Iterator[bytes]:
    """A text in parts that end between words."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + SLICE) if len(text) - at > SLICE else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end + (cut is not None)


def shard(texts: list[bytes]) -> dict:
    """A CSR shard over its own words: words in the order of first sight, row ends, word numbers and counts."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    parts, sizes = [], []
    for t in texts:
        n = 0
        for part in slices(t):
            words = part.split()
            parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            n += len(words)
        sizes.append(n)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    width = max(1, len(number))
    flat += np.repeat(np.arange(len(texts), dtype=np.int64) * width, sizes)
    cell, count = np.unique(flat, return_counts=True)
    ends = np.searchsorted(cell, np.arange(1, len(texts) + 1, dtype=np.int64) * width)
    return {"words": list(number), "ends": ends, "columns": (cell % width).astype(np.int32), "counts": count.astype(np.int32)}


def plain_flags(texts: list[bytes]) -> tuple[list[bool], list[bool]]:
    """Filters C and D."""
    capitals, signs = [], []
    for t in texts:
        b = np.frombuffer(t, np.uint8)
        upper = np.count_nonzero((b - np.uint8(65)) < 26)
        points = np.count_nonzero((b & 0xC0) != 0x80)
        capitals.append(bool(100 * upper > MOST_CAPITALS * points))
        signs.append(_SIGNS.search(t) is not None)
    return capitals, signs


def local_shards(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """One row for each chunk: ids, parts, digests, flags C and D, and its CSR shard over its own words (`words` stand
    in one string, with blanks between)."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
        T.StructField("parts", T.ArrayType(T.StringType())), T.StructField("digests", T.ArrayType(T.BinaryType())),
        T.StructField("capitals", T.ArrayType(T.BooleanType())), T.StructField("signs", T.ArrayType(T.BooleanType())),
        T.StructField("words", T.StringType()), T.StructField("ends", T.BinaryType()),
        T.StructField("columns", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, press = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1)
        ids, langs, texts, held = [], [], [], 0

        def row():
            s, (capitals, signs) = shard(texts), plain_flags(texts)
            stored = (pa.array([press.compress(s[c].tobytes())], pa.binary()) for c in ("ends", "columns", "counts"))
            return pa.RecordBatch.from_arrays([
                pa.array([made], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([langs], pa.list_(pa.string())),
                pa.array([[hashlib.sha256(t).digest() for t in texts]], pa.list_(pa.binary())),
                pa.array([capitals], pa.list_(pa.bool_())), pa.array([signs], pa.list_(pa.bool_())),
                pa.array([b" ".join(s["words"]).decode("utf-8", "replace")], pa.string()), *stored], names=schema.fieldNames())

        for batch in batches:
            id_type = batch.column(0).type
            for i, p, t in zip(*(c.to_pylist() for c in batch.columns)):
                if texts and held + len(t) > CHUNK:
                    yield row()
                    made, ids, langs, texts, held = made + 1, [], [], [], 0
                ids.append(i)
                langs.append(p)
                texts.append(t)
                held += len(t)
        if texts:
            yield row()

    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("t")).mapInArrow(pack, schema)


def global_numbers(shards: DataFrame) -> DataFrame:
    """(chunk, base, places, numbers): packed, the global number (base + numbers) of the word at each place of a chunk.

    All rows of a word are in one task, next to each other. A task sends each chunk its numbers in few rows.
    """
    words = shards.filter("words <> ''").select("chunk", F.posexplode(F.split("words", " ")).alias("place", "word"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, last, given = TaskContext.get().partitionId() << 40, None, -1
        held, size = [], 0

        def rows():
            chunk, place, own = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(chunk, kind="stable")
            chunk, place, own = chunk[order], place[order], own[order]
            edge = np.append(np.nonzero(np.diff(chunk, prepend=chunk[0] - 1))[0], len(chunk))
            low = [int(own[i:j].min()) for i, j in zip(edge, edge[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(chunk[edge[:-1]]), pa.array([base + x for x in low], pa.int64()),
                 pa.array([place[i:j].tobytes() for i, j in zip(edge, edge[1:])], pa.binary()),
                 pa.array([(own[i:j] - x).astype(np.int32).tobytes() for i, j, x in zip(edge, edge[1:], low)], pa.binary())],
                names=["chunk", "base", "places", "numbers"])

        for batch in batches:
            word = batch.column(0)
            if not len(word):
                continue
            fresh = np.ones(len(word), bool)
            fresh[0] = word[0].as_py() != last
            fresh[1:] = pa.compute.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
            own = given + np.cumsum(fresh)
            last, given = word[len(word) - 1].as_py(), int(own[-1])
            held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy(), own))
            size += len(own)
            if size > NUMBERS:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    # the hash alone is a fixed-width sort key; words of one hash are told apart after it
    return (words.select("word", "chunk", "place").repartition("word").sortWithinPartitions(F.xxhash64("word"), "word")
            .mapInArrow(number, "chunk long, base long, places binary, numbers binary"))


def numbers_of(rows, size: int) -> np.ndarray:
    """The global numbers of a chunk's words by place, from its rows of `global_numbers`."""
    known = np.empty(size, np.int64)
    for r in rows or ():
        known[np.frombuffer(r["places"], np.int32)] = r["base"] + np.frombuffer(r["numbers"], np.int32).astype(np.int64)
    return known


def vocabulary(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """(word, number) of the whole dictionary. Both frames are stored tables."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words = r["words"].split(" ")
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(numbers_of(r["rows"], len(words)))],
                                                 names=["word", "number"])

    own = numbers.groupBy("chunk").agg(F.collect_list(F.struct("base", "places", "numbers")).alias("rows"))
    return shards.select("chunk", "words").join(own, "chunk").drop("chunk").mapInArrow(read, "word string, number long").distinct()


def term_matrix(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """The shards with their columns numbered globally: `columns` holds long numbers. Both frames are stored tables."""
    own = numbers.groupBy("chunk").agg(F.collect_list(F.struct("base", "places", "numbers")).alias("rows"))
    kept = ["chunk", "ids", "parts", "digests", "capitals", "signs", "ends"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, open_ = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                columns = np.frombuffer(open_.decompress(batch.column("columns")[i].as_py()), np.int32)
                known = numbers_of(batch.column("rows")[i].as_py(), int(columns.max(initial=-1)) + 1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c)[i: i + 1] for c in kept), pa.array([press.compress(known[columns].tobytes())], pa.binary()),
                     batch.column("counts")[i: i + 1]], names=[*kept, "columns", "counts"])

    whole = shards.drop("words").join(own, "chunk", "left")
    return whole.mapInArrow(encode, T.StructType([shards.schema[c] for c in [*kept, "columns", "counts"]]))


def decided(matrix: DataFrame, kind: T.DataType) -> DataFrame:
    """(doc_id, part, digest, n_words, n_distinct, failed): row sums and entries of the matrix, filters A to D as bits."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                ends = np.frombuffer(open_.decompress(batch.column("ends")[i].as_py()), np.int64)
                counts = np.frombuffer(open_.decompress(batch.column("counts")[i].as_py()), np.int32)
                total = np.append(0, np.cumsum(counts, dtype=np.int64))
                words, distinct = np.diff(total[ends], prepend=0), np.diff(ends, prepend=0)
                capitals, signs = (np.array(batch.column(c)[i].as_py(), bool) for c in ("capitals", "signs"))
                failed = ((words < LEAST_WORDS) + 2 * (100 * distinct < LEAST_DISTINCT * words) + 4 * capitals + 8 * signs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("parts")[i].values, batch.column("digests")[i].values,
                     pa.array(words), pa.array(distinct), pa.array(failed.astype(np.int32))],
                    names=["doc_id", "part", "digest", "n_words", "n_distinct", "failed"])

    return matrix.mapInArrow(read, T.StructType([
        T.StructField("doc_id", kind), T.StructField("part", T.StringType()), T.StructField("digest", T.BinaryType()),
        T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType()), T.StructField("failed", T.IntegerType())]))


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, part, n_words, n_distinct, failed) of every row, `failed` with the bits of all five filters."""
    shards = settle(local_shards(docs, doc_id, text, lang), "term-shards")
    numbers = settle(global_numbers(shards), "term-numbers")
    rows = settle(decided(term_matrix(shards, numbers), docs.schema[doc_id].dataType), "judged")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * 16
    return rows.join(first, "digest", "left").select("doc_id", "part", "n_words", "n_distinct",
                                                      (F.col("failed") + again).alias("failed"))


def steps() -> list[tuple]:
    """(order, step, letter, bit of the filter, bits of those before it) of all orders."""
    bit = {x: 1 << i for i, x in enumerate(LETTERS)}
    return [("".join(o), k + 1, x, bit[x], sum(bit[y] for y in o[:k]))
            for o in itertools.permutations(LETTERS) for k, x in enumerate(o)]


def interactions(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of filters and step, from `judged` rows and labels (doc_id, quality, toxic)."""
    yes = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(yes("quality"), yes("toxic"))
    counted = (rows.join(known, "doc_id", "left").groupBy("part", "failed")
               .agg(F.count("*").alias("n"), F.sum(F.coalesce("quality", F.lit(0))).alias("good"),
                    F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))
    plan = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(x).alias("letter"),
                              F.lit(b).alias("own"), F.lit(before).alias("before")) for o, k, x, b, before in steps()])
    fails, gone = F.col("failed").bitwiseAND(F.col("s.own")) > 0, F.col("failed").bitwiseAND(F.col("s.before")) > 0
    total = lambda test, of, name: F.sum(F.when(test, F.col(of)).otherwise(0)).cast("long").alias(name)
    found = (counted.withColumn("s", F.explode(plan)).groupBy("part", "s.filter_order", "s.step", "s.letter").agg(
        total(~fails & ~gone, "n", "kept"), total(fails & ~gone, "n", "removed"), total(fails & gone, "n", "redundant"),
        total(F.col("failed") == F.col("s.own"), "n", "unique_fails"),
        total(fails & ~gone, "good", "good_lost"), total(fails & ~gone, "toxic", "toxic_lost")))
    return found.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")


def op13_audit(spark, sf_dir: str) -> DataFrame:
    from .common import table

    rows = judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return interactions(rows, table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), f AS (
  SELECT doc_id, part,
         [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
          regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM d
), l AS (
  SELECT doc_id, coalesce(max((quality = 1)::INTEGER), 0) AS good, coalesce(max((toxic = 1)::INTEGER), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), r AS (
  SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM f LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM r GROUP BY part, fails
), x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i), o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS seq FROM x a JOIN x b ON b.i <> a.i JOIN x c ON c.i NOT IN (a.i, b.i)
  JOIN x d ON d.i NOT IN (a.i, b.i, c.i) JOIN x e ON e.i NOT IN (a.i, b.i, c.i, d.i)
), s AS (
  SELECT list_reduce(list_transform(seq, lambda j: 'ABCDE'[j]), lambda p, q: p || q) AS filter_order, k.i::INTEGER AS step,
         seq[k.i] AS own, seq[1:k.i - 1] AS before
  FROM o, x k
), p AS (
  SELECT c.*, s.*, fails[own] AS now, len(list_filter(before, lambda j: fails[j])) > 0 AS gone,
         len(list_filter(fails, lambda v: v)) AS many FROM c, s
), g AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT now AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (now AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (now AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (now AND many = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (now AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (now AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM p GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM g
"""
