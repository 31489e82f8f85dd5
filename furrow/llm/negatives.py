"""Hard negatives from score windows, selected through disjoint slots.

An anchor's positives are its best rows of the same label. Each positive of score p opens a window of negative scores,
from LOW to HIGH hundredths of p. The windows of one anchor overlap, so negatives are not selected for each window: the
upper limits of the windows cut the scores into disjoint slots, slot j holding what j limits reach. Every task keeps the
best k of each slot for its rows, a window over (anchor, slot) combines them, and all windows are then answered from
one descending list of at most k rows for each slot: a window's rows are the suffix that begins with its own slot, cut
at its lower limit and at k. That is exact, since a window takes whole slots from its upper limit down.

Vectors are packed into blocks of BLOCK rows in the order of labels and ids, anchors into blocks of ANCHORS rows. A task
streams stored vector blocks past one anchor block of their length (see `kbest`), twice: positives, for which only rows of
one label are multiplied, then negatives. It holds what it has found so far, so it leaves at most k rows for each anchor and
slot, and a score that is below the k-th best of an anchor's last slot is not looked at.

Defined cases: rows with a null id or label, a null or empty vector, or one with a null or non-finite component take no
part; vectors of another length have no score with an anchor; rows with an anchor's own id are neither its positives
nor its negatives; of repeated rows each is a candidate, and each anchor row answers for itself; ties go to the smaller
id; an anchor without positives, or a window without rows (so each of a negative positive score), gives no rows; an
empty table gives none. Other columns are dropped. Scores are exact while components stay below 2**20.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.session import settle

from .kbest import NONE, Best, blank, exact_type, kth, largest, lowest, matrix, meetings, narrow, pairs, reaching

SCALE, BLOCK, ANCHORS, SLAB = 256, 4096, 4096, 128
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
_PACKED = "block long, dim int, ids binary, labels binary, body binary"


def labelled_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v array<long>) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"),
                     F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    return (rows.filter("vec_id is not null and label is not null").filter((F.size("e") > 0) & F.forall("e", finite))
            .select("vec_id", "label", F.transform("e", lambda x: F.floor(x * float(SCALE)).cast("long")).alias("v")))


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most `rows` vectors of one length, in the order of labels and ids within each; a partition makes its own."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def out(dim: int, last: bool):
            """Full blocks of what is held, at last also the one that is not full."""
            nonlocal number
            ids, labels, body = (np.concatenate(x) for x in zip(*held.pop(dim)))
            upto = len(ids) if last else len(ids) - len(ids) % rows
            for at in range(0, upto, rows):
                o = np.lexsort((ids[at: at + rows], labels[at: at + rows])) + at
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([dim], pa.int32()),
                     *(pa.array([x.tobytes()], pa.binary()) for x in (ids[o], labels[o], narrow(body[o])))],
                    names=["block", "dim", "ids", "labels", "body"])
                number += 1
            if upto < len(ids):
                held[dim] = [(ids[upto:], labels[upto:], body[upto:])]

        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                at = np.nonzero(sizes == dim)[0]
                held.setdefault(dim, []).append((ids[at], labels[at], values[starts[at][:, None] + np.arange(dim)]))
                if sum(len(h[0]) for h in held[dim]) >= rows:
                    yield from out(dim, False)
        for dim in list(held):
            yield from out(dim, True)

    return vectors.select("vec_id", "label", "v").mapInArrow(pack, _PACKED)


def met(asked: DataFrame, data: DataFrame, told: list[str]) -> tuple[DataFrame, list[str]]:
    """Anchor blocks beside vector blocks (d_...), and the names of the columns; `told` is carried beside the anchors."""
    own = ["block", "ids", "labels", "body"]
    left = data.select("dim", *(F.col(c).alias(f"d_{c}") for c in own[1:]))
    names = [*own, *told, *(f"d_{c}" for c in own[1:]), "dim"]
    return meetings(asked.select("dim", *own, *told), left).select(*names), names


def rows_of(r: dict, dim: int, of: str = "") -> tuple:
    """(ids, labels, vectors) of a block."""
    ids, labels = (np.frombuffer(r[f"{of}{c}"], np.int64) for c in ("ids", "labels"))
    return ids, labels, matrix(r[f"{of}body"], len(ids), dim)


def alike_types(a: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type in which their products are exact."""
    kind = exact_type(largest(a) * largest(d) * a.shape[1])
    return a.astype(kind), d.astype(kind)


def found_rows(names: tuple, block: int, columns: list) -> pa.RecordBatch:
    columns = [np.full(len(columns[0]), block), *columns]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=list(names))


def positives(asked: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """(asked, place, anchor_id, positive_id, positive_score): the k best rows of each anchor's label."""
    names = ("asked", "place", "anchor_id", "positive_id", "positive_score")
    meet, columns = met(asked, data, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}  # by anchor block
        for r in pairs(batches, columns):
            if r["block"] not in held:
                a_ids, a_labels, a = (x.copy() for x in rows_of(r, r["dim"]))
                held[r["block"]] = a_ids, a_labels, a, Best(len(a_ids), k)
            a_ids, a_labels, a, best = held[r["block"]]
            d_ids, d_labels, d = rows_of(r, r["dim"], "d_")
            a, d = alike_types(a, d)
            got = []
            for label in np.intersect1d(a_labels, d_labels).tolist():  # both blocks are in the order of labels
                (b, e), (lo, hi) = ([int(np.searchsorted(x, label, side)) for side in ("left", "right")] for x in (a_labels, d_labels))
                for at in range(b, e, SLAB):
                    own = np.arange(at, min(at + SLAB, e))
                    scores = a[own] @ d[lo:hi].T
                    floor = best.floor(own)
                    cut, fresh = floor.astype(scores.dtype), np.nonzero(floor == NONE)[0]
                    if len(fresh):
                        known = scores[fresh]
                        blank(known, a_ids[own[fresh]], d_ids[lo:hi])
                        cut[fresh] = kth(known, k)
                    place, spot = reaching(scores, cut)
                    got.append((own[place], scores[place, spot].astype(np.int64), d_ids[lo:hi][spot]))
            if got:
                place, score, ids = (np.concatenate(x) for x in zip(*got))
                other = ids != a_ids[place]
                best.add(place[other], score[other], ids[other])
        for block, (a_ids, _, _, best) in held.items():
            place, score, ids = best.found()
            yield found_rows(names, block, [place, a_ids[place], ids, score])

    found = meet.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy("asked", "place").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def limits(score: Column, low: int, high: int) -> tuple[Column, Column]:
    """The least and the largest integer score of a positive's window."""
    down = lambda x: ((x - F.pmod(x, F.lit(100))) / 100).cast("long")  # noqa: E731  whole numbers, also below zero
    return -down(score * -low), down(score * high)


def with_windows(asked: DataFrame, near: DataFrame) -> DataFrame:
    """The anchor blocks with `lows`, the least limit of each of their rows, and `highs`, its upper limits, ascending and with
    NONE before them where a row has fewer than another. Rows without windows have no upper limit."""
    windows = near.groupBy(F.col("asked").alias("block")).agg(F.collect_list(F.struct("place", "low", "high")).alias("w"))
    joined = asked.join(windows, "block").select("block", "dim", "ids", "labels", "body", "w.place", "w.low", "w.high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lows, highs = [], []
            for i in range(batch.num_rows):
                place, low, high = (batch.column(c)[i].values.to_numpy() for c in ("place", "low", "high"))
                order = np.lexsort((-high, place))
                place, low, high = place[order], low[order], high[order]
                nth = np.arange(len(place)) - np.searchsorted(place, place)
                n = len(batch.column("ids")[i].as_buffer()) // 8
                least, upper = np.full(n, -NONE, np.int64), np.full((n, int(nth.max()) + 1), NONE, np.int64)
                np.minimum.at(least, place, low)
                upper[place, upper.shape[1] - 1 - nth] = high
                lows.append(least.tobytes())
                highs.append(upper.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(lows, pa.binary()), pa.array(highs, pa.binary())],
                                             names=[*batch.schema.names[:5], "lows", "highs"])

    return joined.mapInArrow(run, f"{_PACKED}, lows binary, highs binary")


def slots(asked: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """(asked, place, slot, negative_id, score): the k best rows of another label in each slot of each anchor. `asked` is of
    `with_windows`."""
    names = ("asked", "place", "slot", "negative_id", "score")
    meet, columns = met(asked, data, ["lows", "highs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}  # by anchor block
        for r in pairs(batches, columns):
            if r["block"] not in held:
                a_ids, a_labels, a = rows_of(r, r["dim"])
                lows, highs = np.frombuffer(r["lows"], np.int64), np.frombuffer(r["highs"], np.int64).reshape(len(a_ids), -1)
                use = np.nonzero(highs[:, -1] > NONE)[0]
                highs = highs[use]
                count = (highs > NONE).sum(axis=1)
                held[r["block"]] = (use, a_ids[use], a_labels[use], a[use], lows[use], highs, count,
                                    Best(highs.size, k))
            use, a_ids, a_labels, a, lows, highs, count, best = held[r["block"]]
            d_ids, d_labels, d = rows_of(r, r["dim"], "d_")
            a, d = alike_types(a, d)
            many = highs.shape[1]
            for at in range(0, len(use), SLAB):
                own = np.arange(at, min(at + SLAB, len(use)))
                scores = a[own] @ d.T
                # the last slot holds all scores up to the least upper limit: once it is full, nothing below its k-th counts
                floor = best.floor(own * many + count[own] - 1)
                cut, fresh = np.maximum(floor, lows[own]).astype(scores.dtype), np.nonzero(floor == NONE)[0]
                if len(fresh):
                    i = own[fresh]
                    last = highs[i, many - count[i]].astype(scores.dtype)
                    none = np.array(lowest(scores.dtype), scores.dtype)
                    known = np.where((scores[fresh] <= last[:, None]) & (d_labels != a_labels[i, None]), scores[fresh], none)
                    blank(known, a_ids[i], d_ids)
                    cut[fresh] = np.maximum(cut[fresh], kth(known, k))
                place, spot = reaching(scores, cut)
                score, place = scores[place, spot].astype(np.int64), own[place]
                fits = (score <= highs[place, -1]) & (d_labels[spot] != a_labels[place]) & (d_ids[spot] != a_ids[place])
                score, place, spot = score[fits], place[fits], spot[fits]
                slot = (highs[place] >= score[:, None]).sum(axis=1)
                best.add(place * many + slot - 1, score, d_ids[spot])
        for block, (use, *_, highs, _, best) in held.items():
            group, score, ids = best.found()
            many = highs.shape[1]
            yield found_rows(names, block, [use[group // many], group % many + 1, ids, score])

    found = meet.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy("asked", "place", "slot").orderBy(F.desc("score"), "negative_id")
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def hard_negatives(anchors: DataFrame, vectors: DataFrame, *, positive: int = POSITIVES, negative: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Both frames hold (vec_id, label, v).

    Blocks are written to the shared folder: their numbers must stay the same for both passes.
    """
    data = settle(packed(vectors, BLOCK), "vector-blocks")
    asked = settle(packed(anchors.hint("rebalance"), ANCHORS), "anchor-blocks")
    near = settle(positives(asked, data, positive), "positives")
    least, most = limits(F.col("positive_score"), low, high)
    near = near.withColumns({"low": least, "high": most}).filter("low <= high")
    kept = slots(settle(with_windows(asked, near), "anchor-windows"), data, negative)
    # one descending list for each anchor: slots ascend as scores descend
    item = F.struct("slot", (-F.col("score")).alias("down"), "negative_id")
    lists = kept.groupBy("asked", "place").agg(F.sort_array(F.collect_list(item)).alias("found"))
    own = near.groupBy("asked", "place").agg(
        F.first("anchor_id").alias("anchor_id"),
        F.collect_list(F.struct("positive_id", "positive_score", "low", "high")).alias("windows"))
    opened = lists.join(own, ["asked", "place"]).withColumn("w", F.explode("windows"))
    opened = opened.withColumn("own_slot", F.expr("size(filter(windows, x -> x.high >= w.high))"))
    suffix = F.expr(f"slice(filter(found, x -> x.slot >= own_slot and -x.down >= w.low), 1, {int(negative)})")
    return opened.select("anchor_id", F.col("w.positive_id").alias("positive_id"), F.col("w.positive_score").alias("positive_score"),
                         F.posexplode(suffix).alias("rank", "x")).select(
        "anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.negative_id").alias("negative_id"),
        "positive_score", (-F.col("x.down")).alias("negative_score"))


def op12_negatives(spark, sf_dir: str) -> DataFrame:
    from .common import table

    rows = labelled_vectors(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return hard_negatives(rows.filter(F.col("vec_id") % 100 == 0), rows)


OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE))::DOUBLE[] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.row_no, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS nth FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.row_no, p.nth ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON p.row_no = s.row_no AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
  WHERE p.nth <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
