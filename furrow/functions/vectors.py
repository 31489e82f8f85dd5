"""Vector arithmetic. Dense maths runs on Arrow batches, hashing has a native twin."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col, let


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of one Arrow batch as a float64 matrix; vectors share a dimension."""
    if not len(vectors):
        return np.zeros((0, 0))
    return np.stack(vectors.to_numpy()).astype(np.float64, copy=False)


def unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norms, out=m.copy(), where=norms > 0)


def cosine_to(query: list[float]):
    """A function scoring a vector column against one fixed query vector."""
    target = unit_rows(np.asarray([query], dtype=np.float64))[0]

    @F.pandas_udf(T.DoubleType())
    def score(v: pd.Series) -> pd.Series:
        return pd.Series(unit_rows(matrix(v)) @ target) if len(v) else pd.Series([], dtype=float)

    return score


def norm(c: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(c), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def unit(c: Column | str) -> Column:
    """L2-normalised copy; a zero vector stays zero."""
    n = norm(c)
    return F.when(n > 0, F.transform(col(c), lambda x: x.cast("double") / n)).otherwise(
        F.transform(col(c), lambda x: x.cast("double"))
    )


def gram_text(c: Column | str) -> Column:
    """Lower case, with every white-space run as one blank."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "(?U)\\s+", " "))


def grams(c: Column | str, size: int = 3) -> Column:
    """All runs of `size` adjacent characters; null for shorter texts."""
    def joined(chars):
        places = F.sequence(F.lit(1), F.size(chars) - (size - 1))
        return F.transform(places, lambda i: F.concat(*[F.element_at(chars, i + k) for k in range(size)]))

    return let(F.split(gram_text(c), ""), lambda chars: F.when(F.size(chars) >= size, joined(chars)))


class GramCells:
    """Cells of character grams, many texts at once. A task keeps the cells of the grams it has hashed. `digest` gives
    the bytes whose first four choose a gram's cell."""

    MOST, CHARS = 1_000_000, 1_000_000

    def __init__(self, dim: int, digest: Callable[[bytes], bytes]):
        self.dim, self.digest, self.known = dim, digest, {}

    def cell(self, code: int) -> int:
        found = self.known.get(code)
        if found is None:
            if len(self.known) > self.MOST:
                self.known.clear()
            gram = chr(code >> 42) + chr(code >> 21 & 0x1FFFFF) + chr(code & 0x1FFFFF)
            found = self.known[code] = int.from_bytes(self.digest(gram.encode())[:4], "big") % self.dim
        return found

    def counts(self, texts: list[str]) -> np.ndarray:
        """How many of a text's grams fall into each cell, a row for each text."""
        out = np.zeros((len(texts), self.dim), np.int64)
        # a long text is counted in pieces, which overlap by two characters
        pieces = [(i, t[at: at + self.CHARS + 2]) for i, t in enumerate(texts) for at in range(0, len(t) - 2, self.CHARS)]
        while pieces:
            n, size = 1, len(pieces[0][1])
            while n < len(pieces) and size + len(pieces[n][1]) <= self.CHARS:
                size += len(pieces[n][1])
                n += 1
            rows, part = zip(*pieces[:n])
            cp = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            owner = np.repeat(np.arange(n), np.fromiter(map(len, part), np.int64, n))
            inside = owner[:-2] == owner[2:]
            codes, which = np.unique((cp[:-2] << 42 | cp[1:-1] << 21 | cp[2:])[inside], return_inverse=True)
            cells = np.fromiter(map(self.cell, codes.tolist()), np.int64, len(codes))
            found = np.bincount(owner[:-2][inside] * self.dim + cells[which], minlength=n * self.dim)
            np.add.at(out, np.array(rows), found.reshape(n, self.dim))
            pieces = pieces[n:]
        return out


def _md5(gram: bytes) -> bytes:
    return hashlib.md5(gram).digest()


def gram_cells(df: DataFrame, key: str, text: str = "text", dim: int = 64, digest: Callable[[bytes], bytes] = _md5) -> DataFrame:
    """(key, cell, n): how many 3-grams of the texts of a key fall into each cell. A text's grams are counted where it
    stands, so at most `dim` rows of it move."""
    cells = GramCells(dim, digest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counts = cells.counts(part.column(1).to_pylist())
                row, cell = np.nonzero(counts)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(cell.astype(np.int32)),
                                                  pa.array(counts[row, cell])], names=["k", "cell", "n"])

    source = df.select(col(key).alias("k"), gram_text(text).alias("t"))
    schema = T.StructType([source.schema["k"], T.StructField("cell", T.IntegerType()), T.StructField("n", T.LongType())])
    return source.mapInArrow(run, schema).groupBy(F.col("k").alias(key), "cell").agg(F.sum("n").alias("n"))


def _blake(gram: bytes) -> bytes:
    return hashlib.blake2b(gram, digest_size=4).digest()


def lexical_embedder(dim: int, digest: Callable[[bytes], bytes] = _blake):
    """Character 3-gram counts hashed into `dim` cells, unit length.

    Spark has no BLAKE2, so this is an Arrow batch function; see `GramCells`.
    """
    cells = GramCells(dim, digest)

    def rows(texts: list[str | None]) -> np.ndarray:
        counts = cells.counts([" ".join((t or "").lower().split()) for t in texts]).astype(np.float64)
        return unit_rows(counts).astype(np.float32)

    def vector(text: str | None) -> np.ndarray:
        return rows([text])[0]

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pd.Series) -> pd.Series:
        return pd.Series([r for at in range(0, len(texts), 1000) for r in rows(texts[at: at + 1000].tolist())])

    embed.vector = vector  # the query side runs on the driver for one text
    return embed
