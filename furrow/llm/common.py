"""What the operators of this package share: tables, folds, and Arrow passes over whole texts."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one Arrow batch, unless the session sets another figure. Bounds a worker's memory, changes no result.
BATCH_ROWS = 500
_DEFAULT_BATCH = "10000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts can be long, so Arrow batches of Spark's default row count are made smaller."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == _DEFAULT_BATCH:
        spark.conf.set(key, str(BATCH_ROWS))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def kept_columns(df: DataFrame, added: list[str]) -> list[str]:
    """Input columns that stay: those that no added column replaces, in any case of letters."""
    taken = {a.lower() for a in added}
    return [c for c in df.columns if c.lower() not in taken]


def map_texts(df: DataFrame, added: T.StructType, fn: Callable[[list[str]], list[pa.Array]], *,
              text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append columns computed from whole texts, one narrow Arrow pass, rows neither moved nor dropped.

    `fn` gets the texts of a batch (null as empty) and returns one array per added field. An added column
    replaces an input column of that name; `keep` narrows the input columns that are carried.
    """
    small_batches(df.sparkSession)
    names = kept_columns(df, added.fieldNames())
    names = [c for c in names if keep is None or c in keep]
    schema = T.StructType([df.schema[c] for c in names] + list(added.fields))
    body = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    inner = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields[: len(names)])]
                         + [T.StructField(f"a{i}", f.dataType) for i, f in enumerate(added.fields)])
    kinds = [arrow_type(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = fn(batch.column(batch.num_columns - 1).to_pylist())
            arrays = [a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(arrays, kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *arrays],
                names=[*(f"c{i}" for i in range(len(names))), *(f"a{i}" for i in range(len(arrays)))])

    out = body.mapInArrow(run, inner)
    return out.toDF(*schema.fieldNames())


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def concatenated(texts: list[bytes], gap: int = 0, fill: bytes = b"\xff") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte array, with `gap` fill bytes before each; where each starts, and ends."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    pad = fill * gap
    joined = np.frombuffer(pad + pad.join(texts), np.uint8)
    starts = np.cumsum(sizes + gap) - sizes
    return joined, starts, starts + sizes


def per_worker(key: str, make: Callable):
    """An object that a worker process makes once and keeps over its tasks.

    Functions travel to tasks with their own copy of module globals, so what should outlive a task is kept apart.
    """
    state = sys.modules.setdefault("_training_data_worker", types.ModuleType("_training_data_worker")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]


def by_chars(texts: list[str], most: int = 1_500_000) -> Iterator[list[str]]:
    """The texts in runs of about `most` characters; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix) over unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
