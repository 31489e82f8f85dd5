"""Labelled rows that the classifiers learn from: all of them.

Up to ROWS rows and BYTES of text are one list (`labelled`), and a model learns from it in order. More rows stay a table
(`rows_of`) dealt out by a hash of their ids, and are learnt from in rounds (`rounds`): every task goes on from the same
parameters over its own rows, CHUNK bytes at a time, and tells what it changed; changes are averaged, by Spark and by
blocks of parameters, over the tasks that changed a row of them. Changes travel in single precision, whatever the
parameters have. A model, a chunk and the driver's memory have a fixed size whatever the input. One text stands for each id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.session import settle

from .common import fold, small_batches

ROWS, BYTES = 10_000, 40_000_000
#: Bytes of text that a task learns from at once; rows of parameters that are averaged at once.
CHUNK, BLOCK = 8_000_000, 8192


def known_labels(labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    return (labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null")
            .filter(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), folds) != held))
            .groupBy("doc_id").agg(F.min("label").alias("label")))


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int = ROWS,
             most: int = BYTES, *, also: list[str] = ()) -> list[tuple]:
    """(text, label, *also) of the first rows in the order of a hash, at most `rows` of them and `most` bytes of text (a text
    that no longer fits is passed over), only from rows whose fold is not `held`. Null labels and ids take no part;
    of several labels or texts of an id the smallest are used."""
    order = F.xxhash64("doc_id")
    known = known_labels(labels, label, folds, held)
    taken = known.orderBy(order, "doc_id").limit(rows).collect()
    if not taken:
        return []
    spark = docs.sparkSession

    def texts_of(ids: list) -> DataFrame:
        """One row for each id, whatever the number of rows that have it; `ids` are at most `rows` narrow rows."""
        chosen = spark.createDataFrame(ids, known.schema)
        row = F.struct(F.coalesce("text", F.lit("")).alias("text"), *[F.col(c) for c in also])
        return docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min(row).alias("r"))

    sizes = texts_of(taken).select(order.alias("o"), "doc_id", "label", F.octet_length("r.text").alias("n")).collect()
    total, fit = 0, []
    for r in sorted(sizes, key=lambda r: (r.o, r.doc_id)):
        if total + r.n <= most:
            total += r.n
            fit.append((r.doc_id, r.label))
    if not fit:
        return []
    got = texts_of(fit).select(order.alias("o"), "doc_id", "label", "r.*").toArrow().to_pylist()
    got.sort(key=lambda r: (r["o"], r["doc_id"]))
    return [(r["text"], r["label"], *(r[c] for c in also)) for r in got]


def fits(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int) -> bool:
    """Whether all labelled rows are one list."""
    texts = docs.select("doc_id", F.octet_length("text").alias("n")).join(known_labels(labels, label, folds, held), "doc_id")
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return n <= ROWS and size <= BYTES


def rows_of(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, *, also: list[str] = ()) -> DataFrame:
    """(doc_id, label, text, *also): all labelled rows whose fold is not `held`, written, one for each id as in `labelled`."""
    row = F.struct(F.coalesce("text", F.lit("")).alias("text"), *[F.col(c) for c in also])
    joined = docs.join(known_labels(labels, label, folds, held), "doc_id")
    return settle(joined.groupBy("doc_id", "label").agg(F.min(row).alias("r")).select("doc_id", "label", "r.*"), "labelled", "zstd")


def changed(new: np.ndarray, old: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(first row, which rows changed, by what) of each block that changed. Rows are bits or numbers, which is shorter."""
    moved = (new - old).astype(np.float32).reshape(len(new), -1)
    for at in range(0, len(moved), BLOCK):
        block = moved[at: at + BLOCK]
        touched = (block != 0).any(axis=1)
        if touched.any():
            where, bits = np.nonzero(touched)[0].astype(np.int32), np.packbits(touched)
            short = where.nbytes < bits.nbytes
            yield at, b"n" + where.tobytes() if short else b"b" + bits.tobytes(), block[touched].tobytes()


def rows_in(told: bytes) -> np.ndarray:
    """The rows of a block that `changed` tells of."""
    numbers = np.frombuffer(told[1:], np.int32 if told[:1] == b"n" else np.uint8)
    return numbers if told[:1] == b"n" else np.nonzero(np.unpackbits(numbers))[0]


def rounds(rows: DataFrame, state: list[np.ndarray], learn: Callable, count: int) -> list[np.ndarray]:
    """`state` after `count` rounds over all rows. `learn(state, texts, labels, seed)` changes the arrays it is given."""
    small_batches(rows.sparkSession)
    for number in range(count):
        told = rows.sparkSession.sparkContext.broadcast(state)  # of fixed size

        def run(batches: Iterator[pa.RecordBatch], number: int = number, told=told) -> Iterator[pa.RecordBatch]:
            own = [x.copy() for x in told.value]
            texts, labels, size, seen, chunk = [], [], 0, 0, 0
            part = TaskContext.get().partitionId()

            def through() -> None:
                nonlocal texts, labels, size, seen, chunk
                learn(own, texts, np.array(labels), [number, part, chunk])
                seen, chunk = seen + len(texts), chunk + 1
                texts, labels, size = [], [], 0

            for batch in batches:
                for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    texts.append(text)
                    labels.append(label)
                    size += len(text)
                    if size >= CHUNK:
                        through()
            if texts:
                through()
            for k, (new, old) in enumerate(zip(own, told.value)):
                for at, where, moved in changed(new, old):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([k], pa.int32()), pa.array([at], pa.int64()), pa.array([seen], pa.int64()),
                        pa.array([where], pa.binary()), pa.array([moved], pa.binary())],
                        names=["array", "at", "seen", "rows", "moved"])

        kinds = [(x.dtype, int(np.prod(x.shape[1:])), len(x)) for x in state]

        def mean(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k, at = (x.as_py() for x in key)
            kind, width, length = kinds[k]
            total, weight = np.zeros((min(BLOCK, length - at), width)), np.zeros((min(BLOCK, length - at), 1))
            for part in parts:
                for seen, where, moved in zip(*(part.column(c).to_pylist() for c in ("seen", "rows", "moved"))):
                    where = rows_in(where)
                    total[where] += seen * np.frombuffer(moved, np.float32).reshape(-1, width)
                    weight[where] += seen
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([at], pa.int64()), pa.array(
                [(total / np.maximum(weight, 1)).astype(kind).tobytes()], pa.binary())], names=["array", "at", "moved"])

        moves = rows.select("text", "label").mapInArrow(run, "array int, at long, seen long, rows binary, moved binary")
        summed = moves.groupBy("array", "at").applyInArrow(mean, "array int, at long, moved binary")
        state = [x.copy() for x in state]
        for k, at, moved in zip(*(c.to_pylist() for c in summed.toArrow().columns)):
            block = state[k][at: at + BLOCK]
            block += np.frombuffer(moved, block.dtype).reshape(block.shape)
        told.destroy()
    return state
