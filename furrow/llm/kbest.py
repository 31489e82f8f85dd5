"""Searches that compare every query with every vector: who meets whom, and the k best of what streams by.

A task holds one block of queries and streams a part of the vector blocks past it, read from the stored table. So no
block is shuffled once for each block it meets, and a task leaves k rows for each query, not k for each pair of blocks:
what is written grows with the queries, only the arithmetic with the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Tasks for each core, as far as there are stored parts of the vectors. Changes no result.
TASKS = 4
#: Below every score.
NONE = -(1 << 61)


def meetings(asked: DataFrame, data: DataFrame) -> DataFrame:
    """Each query block beside each vector block of its length (`dim`), one row for a pair: a nested loop over stored
    blocks, in which a task has one query block. The vectors are in few parts if there are many query blocks."""
    many = max(1, asked.count())
    cores = data.sparkSession.sparkContext.defaultParallelism
    return data.coalesce(-(-TASKS * cores // many)).hint("shuffle_replicate_nl").join(asked.repartition(many), "dim")


def pairs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    """The rows of batches as dictionaries; binary values are buffers of the batch, not copies."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield {n: c[i].as_buffer() if pa.types.is_binary(c.type) else c[i].as_py() for n, c in zip(names, columns)}


def narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in the smallest signed type that holds them."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def matrix(body, rows: int, dim: int) -> np.ndarray:
    """What `narrow` made of a matrix, from its bytes."""
    width = len(body) // max(1, rows * dim)
    return np.frombuffer(body, f"<i{max(1, width)}").reshape(rows, dim)


def exact_type(reach: float):
    """A type in which sums of products of integers are exact if no partial sum exceeds `reach`."""
    return np.float32 if reach < 2 ** 23 else np.float64 if reach < 2 ** 52 else np.int64


def largest(x: np.ndarray) -> float:
    return float(max(1, abs(int(x.max())), abs(int(x.min())))) if x.size else 1.0


def lowest(kind):
    return NONE if kind == np.int64 else -np.inf


def blank(scores: np.ndarray, q_ids: np.ndarray, ids: np.ndarray) -> None:
    """Gives the rows with a query's own id the lowest score."""
    spots = np.nonzero(np.isin(ids, q_ids))[0]
    if len(spots):
        place, at = np.nonzero(q_ids[:, None] == ids[spots])
        scores[place, spots[at]] = lowest(scores.dtype)


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """At most the k-th greatest of each row: the k-th greatest among the maxima of groups of columns."""
    n = scores.shape[1]
    if n < k:
        return np.full(len(scores), lowest(scores.dtype), scores.dtype)
    groups = min(n, max(64, 4 * k))
    tops = scores[:, : n // groups * groups].reshape(len(scores), n // groups, groups).max(axis=1)
    return np.partition(tops, groups - k, axis=1)[:, groups - k]


def reaching(scores: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the scores that reach their row's cut."""
    rows = np.nonzero(scores.max(axis=1) >= cut)[0]
    own = scores if len(rows) == len(scores) else scores[rows]
    at, spot = np.nonzero(own >= cut[rows, None])
    return rows[at], spot


class Best:
    """The k best (score, id) of each group, ties to the smaller id, with what else belongs to them."""

    def __init__(self, groups: int, k: int, more: int = 0):
        self.k, self.score = k, np.full((groups, k), NONE, np.int64)
        self.rest = [np.zeros((groups, k), np.int64) for _ in range(1 + more)]  # the first has the ids

    def floor(self, groups) -> np.ndarray:
        """The k-th best score of the groups, NONE where there are fewer."""
        return self.score[groups, self.k - 1]

    def add(self, group: np.ndarray, score: np.ndarray, *rest: np.ndarray) -> None:
        use = score >= self.score[group, self.k - 1]
        if not use.any():
            return
        group, score, rest = group[use], score[use], [x[use] for x in rest]
        touched = np.unique(group)
        group = np.concatenate([np.repeat(touched, self.k), group])
        score = np.concatenate([self.score[touched].ravel(), score])
        rest = [np.concatenate([held[touched].ravel(), x]) for held, x in zip(self.rest, rest)]
        order = np.lexsort((rest[0], -score, group))
        group = group[order]
        opens = np.nonzero(np.diff(group, prepend=-1))[0]
        nth = np.arange(len(group)) - np.repeat(opens, np.diff(np.append(opens, len(group))))
        first = nth < self.k
        at, order = (group[first], nth[first]), order[first]
        self.score[at] = score[order]
        for held, x in zip(self.rest, rest):
            held[at] = x[order]

    def found(self) -> tuple:
        """(group, score, id, ...) of all that is held."""
        group, nth = np.nonzero(self.score > NONE)
        return group, self.score[group, nth], *(x[group, nth] for x in self.rest)
