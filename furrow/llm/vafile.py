"""Exact top-k inner products with a vector-approximation file.

Each vector is kept in two parts: as cells (every component quantised into at most 2**BITS intervals between the block's
smallest and largest value of that component) and as what is left of it within its cell. A query scans the cells, which
bound its score from both sides. Rows whose upper bound is below the query's k-th best score so far, or the k-th greatest
lower bound of the block, cannot enter its result. Only for the others is the second part read, which makes the score exact.

Vectors are packed into blocks of BLOCK rows and queries into blocks of QUERIES rows. A task streams stored vector blocks
past one query block of their length (see `kbest`), so what it leaves is k candidates for each query: equal and nearly
equal vectors, which bounds do not tell apart, leave no more. The vectors of the candidates are picked from their blocks
afterwards, once each, and meet the candidates by (block, place). `scan` gives the candidates, `top_k` the result.

Defined cases: a null vector, or one with a null or non-finite component, takes no part, neither as query nor as
candidate, nor does an empty one; vectors of a different length than the query have no score with it; ties go to the
smaller id; rows with equal ids are different candidates with equal rank order, but a query skips every row with its
own id, and query rows with equal ids share one result; null ids take no part; fewer than k candidates give all of them; an empty
table gives no rows; other columns are dropped. Components are integers (floor of SCALE times the value): scores are exact
64-bit integers while every |component| is below 2**20.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.session import settle

from .kbest import NONE, Best, blank, exact_type, kth, largest, matrix, meetings, narrow, pairs, reaching

BITS, BLOCK, QUERIES, SLAB, SCALE = 8, 8192, 4096, 512, 256
FOUND = "asked long, place int, query_id long, data long, spot int, vec_id long, score long"


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    doubles = F.col(f"`{embedding}`").cast("array<double>")
    return (df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), doubles.alias("e"))
            .filter(F.col("vec_id").isNotNull() & (F.size("e") > 0) & F.forall("e", finite))
            .select("vec_id", F.transform("e", lambda x: F.floor(x * float(SCALE)).cast("long")).alias("v")))


def blocks(vectors: DataFrame, rows: int, label: str) -> DataFrame:
    """Vectors packed into binary rows (`label`, dim, ids, cells, edges, rest); a partition makes its own blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}  # by length of the vector

        def out(dim: int, last: bool):
            """Full blocks of what is held, at last also the one that is not full."""
            nonlocal made
            ids, body = (np.concatenate(x) for x in zip(*held.pop(dim)))
            upto = len(ids) if last else len(ids) - len(ids) % rows
            for at in range(0, upto, rows):
                i, b = ids[at: at + rows], body[at: at + rows]
                cells, low, width = cells_of(b)
                rest = narrow(b - (low + cells * width))
                yield pa.RecordBatch.from_pydict({
                    label: pa.array([part * 1_000_000 + made], pa.int64()), "dim": pa.array([dim], pa.int32()),
                    **{f"{label}_{name}": pa.array([x.tobytes()], pa.binary()) for name, x in (
                        ("ids", i), ("cells", cells), ("edges", np.stack([low, width])), ("rest", rest))}})
                made += 1
            if upto < len(ids):
                held[dim] = [(ids[upto:], body[upto:])]

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                at = np.nonzero(sizes == dim)[0]
                body = values[starts[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0), np.int64)
                held.setdefault(dim, []).append((ids[at], body))
                if sum(len(p[0]) for p in held[dim]) >= rows:
                    yield from out(dim, False)
        for dim in list(held):
            yield from out(dim, True)

    return vectors.mapInArrow(pack, f"{label} long, dim int, {label}_ids binary, {label}_cells binary, "
                                    f"{label}_edges binary, {label}_rest binary")


def cells_of(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The approximation of a block: cell numbers, smallest value and cell width of each component."""
    low, high = v.min(axis=0), v.max(axis=0)
    width = np.maximum(1, -(-(high - low + 1) // (1 << BITS)))
    return ((v - low) // width).astype(np.uint8), low, width


def unpacked(r: dict, label: str) -> tuple:
    """(ids, cells, smallest values, cell widths, rest) of a block."""
    ids = np.frombuffer(r[f"{label}_ids"], np.int64)
    low, width = np.frombuffer(r[f"{label}_edges"], np.int64).reshape(2, -1)
    cells = np.frombuffer(r[f"{label}_cells"], np.uint8).reshape(len(ids), len(low))
    return ids, cells, low, width, matrix(r[f"{label}_rest"], len(ids), len(low))


def vectors_of(cells, low, width, rest) -> np.ndarray:
    """The vectors themselves."""
    return low + cells * width + rest


def block_candidates(q_ids, q, ids, cells, low, width, k: int, floor=None):
    """(query place, row, lower bound, upper bound) of the rows of a block that can be among the k best of a query, and
    reach its `floor`, the k-th best score so far (NONE: there are fewer)."""
    exact = exact_type((largest(low) + largest(width) * (1 << BITS)) * largest(q) * max(1, q.shape[1]))
    qf, spare = q.astype(exact), (width - 1).astype(exact)
    base = qf @ (cells * width.astype(exact) + low.astype(exact)).T
    # within a cell a component adds between nothing and q * (width - 1), or the reverse if q is negative
    most, least = np.maximum(qf, 0) @ spare, np.minimum(qf, 0) @ spare
    floor = np.full(len(q_ids), NONE, np.int64) if floor is None else floor
    cut, fresh = floor.astype(exact), np.nonzero(floor == NONE)[0]
    if len(fresh):
        known = base[fresh]
        blank(known, q_ids[fresh], ids)
        cut[fresh] = kth(known, k) + least[fresh]
    place, spot = reaching(base, cut - most)
    other = ids[spot] != q_ids[place]
    place, spot = place[other], spot[other]
    b = base[place, spot]
    return place, spot, (b + least[place]).astype(np.int64), (b + most[place]).astype(np.int64)


def exact_scores(q: np.ndarray, place: np.ndarray, spot: np.ndarray, cells, low, width, rest) -> np.ndarray:
    """The scores of pairs. The second part of a vector is read only if the vector is in a pair."""
    if len(spot) > q.shape[0] * len(cells) // 16:
        v = vectors_of(cells, low, width, rest)
        kind = exact_type(largest(v) * largest(q) * max(1, q.shape[1]))
        return (q.astype(kind) @ v.T.astype(kind))[place, spot].astype(np.int64)
    out = np.zeros(len(spot), np.int64)
    for at in range(0, len(spot), 20_000):
        i, j = place[at: at + 20_000], spot[at: at + 20_000]
        out[at: at + 20_000] = np.einsum("ij,ij->i", q[i], vectors_of(cells[j], low, width, rest[j]))
    return out


def scan(asked: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """The k candidates of each query (see FOUND). Both frames are stored blocks."""
    parts = ("ids", "cells", "edges", "rest")
    names = ["asked", "data", *(f"{label}_{p}" for label in ("asked", "data") for p in parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}  # by query block
        for r in pairs(batches, names):
            if r["asked"] not in held:
                q_ids, *kept = unpacked(r, "asked")
                held[r["asked"]] = q_ids.copy(), vectors_of(*kept), Best(len(q_ids), k, 2)
            q_ids, q, best = held[r["asked"]]
            ids, cells, low, width, rest = unpacked(r, "data")
            for lo in range(0, len(q_ids), SLAB):
                own = slice(lo, lo + SLAB)
                place, spot, _, _ = block_candidates(q_ids[own], q[own], ids, cells, low, width, k, best.floor(own))
                score = exact_scores(q[own], place, spot, cells, low, width, rest)
                best.add(lo + place, score, ids[spot], np.full(len(spot), r["data"], np.int64), spot)
        for number, (q_ids, _, best) in held.items():
            place, score, vec_id, block, spot = best.found()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), number)), pa.array(place.astype(np.int32)), pa.array(q_ids[place]),
                 pa.array(block), pa.array(spot.astype(np.int32)), pa.array(vec_id), pa.array(score)],
                names=[f.split()[0] for f in FOUND.split(", ")])

    found = meetings(asked, data).select(*names).mapInArrow(run, FOUND)
    order = Window.partitionBy("asked", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k).drop("nth", "vec_id", "score")


def picked(blocks_: DataFrame, wanted: DataFrame, name: str, spot: str) -> DataFrame:
    """(block, place, id, vector bytes) of the wanted rows of stored blocks, each once."""
    places = wanted.groupBy(name).agg(F.collect_set(spot).alias("places"))  # at most the rows of a block
    parts = [f"{name}_{p}" for p in ("ids", "cells", "edges", "rest")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in parts}
                ids, cells, low, width, rest = unpacked(r, name)
                at = batch.column("places")[i].values.to_numpy()
                body = vectors_of(cells[at], low, width, rest[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), batch.column(name)[i].as_py())), pa.array(at), pa.array(ids[at]),
                     pa.array([x.tobytes() for x in body], pa.binary())], names=[name, spot, "id", "v"])

    return blocks_.select(name, *parts).join(places, name).mapInArrow(
        run, f"{name} long, {spot} int, id long, v binary")


def top_k(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query. Both frames hold (vec_id, v).

    Blocks are written to the shared folder, since their numbers must stay the same for all uses.
    """
    data = settle(blocks(vectors, BLOCK, "data"), "va-file")
    asked = settle(blocks(queries.hint("rebalance"), QUERIES, "asked"), "va-asked")
    left = settle(scan(asked, data, k), "va-candidates")
    exact = picked(data, left, "data", "spot").withColumnsRenamed({"id": "vec_id", "v": "dv"})
    query = picked(asked, left, "asked", "place").withColumnsRenamed({"v": "qv"}).drop("id")
    rows = left.join(exact, ["data", "spot"]).join(query, ["asked", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [int(np.frombuffer(q, np.int64) @ np.frombuffer(d, np.int64))
                     for q, d in zip(batch.column("qv").to_pylist(), batch.column("dv").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("query_id", "vec_id")),
                                              pa.array(score, pa.int64())], names=["query_id", "vec_id", "score"])

    scored = rows.select("query_id", "vec_id", "qv", "dv").mapInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_vafile(spark, sf_dir: str) -> DataFrame:
    from .common import table

    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors, 5)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
