"""Removal of repeated byte strings across all texts, decided by suffix arrays of external induced sorting.

A byte goes if it lies in a string of `length` bytes that also starts elsewhere, in the same text or another. Such a
string must be seen twice in one suffix array, wherever its copies stand, and no array may hold all texts. So texts
are cut into pieces that bring equal strings together:

* Each string is assigned to the GRAM-byte window in it with the least hash (its anchor). Equal strings have equal
  anchors at equal places, and so have an equal core: the bytes that all strings of one anchor, on one side of it,
  have in common. Only cores that stand twice among all texts matter; they are counted first.
* Strings that follow each other with one core make a piece, the bytes they span. Equal pieces are one piece with a
  count. Pieces are dealt out by core; a task joins whole groups to shards and builds the suffix array and the
  common-prefix values of each shard (`suffix.py`), its tuples waiting on disk beyond a set number. A string is
  repeated if its suffix shares `length` bytes with a neighbour, or its piece stands twice.
* A core with more than GROUP different pieces (a passage in a third of all texts, with other words around it) is not
  gathered: its pieces are cut into quarters, whose cores are longer, and dealt out again, down to single strings, of
  which equal ones are one piece. Nothing is left out at any level.

Texts are packed once into compressed chunk rows of about CHUNK bytes in the shared folder. A core or piece counts once
in a chunk, so no key has more rows than there are chunks. Chunk numbers are stored, so all passes see the same.

Defined cases: null is the empty text; a text below `length` bytes keeps all; overlaps count (a run of one letter
repeats itself from the second start on); repeated rows and null or equal ids are texts of their own; a text longer than
CHUNK is a chunk by itself; an empty table gives no rows; other columns are dropped. Positions in a chunk are
below 2**31, in line with the longest string Spark holds.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.session import settle

from .suffix import Scratch, repeated

LENGTH, GRAM = 200, 32
CHUNK, SHARD, GROUP = 2_000_000, 1_500_000, 6_000
#: Pieces whose bytes a task remembers to have sent; it then starts again. Only what is sent twice depends on it.
SEEN = 400_000
_TOP = np.uint64(0xFFFFFFFF80000000)
_LAST = np.uint64(2 ** 64 - 1)


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(chunk, ids, sizes, body): texts packed in the order of the scan, the body compressed."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    kind = docs.schema[doc_id].dataType

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
        press = zstandard.ZstdCompressor(level=3)

        def row():
            sizes = np.fromiter(map(len, texts), np.int32, len(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([made], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([sizes.tobytes()], pa.binary()),
                 pa.array([press.compress(b"".join(texts))], pa.binary())], names=["chunk", "ids", "sizes", "body"])

        for batch in batches:
            id_type = batch.column(0).type
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if texts and held + len(t) > CHUNK:
                    yield row()
                    made, ids, texts, held = made + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t)
        if texts:
            yield row()

    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("t")
                       ).mapInArrow(pack, T.StructType([
                           T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
                           T.StructField("sizes", T.BinaryType()), T.StructField("body", T.BinaryType())]))


def opened(sizes: bytes, body: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes of a chunk, where its texts start and end."""
    n = np.frombuffer(sizes, np.int32).astype(np.int64)
    ends = np.cumsum(n)
    return zstandard.ZstdDecompressor().decompress(body, max_output_size=int(n.sum()) + 1) if n.sum() else b"", ends - n, ends


def anchored(data: bytes, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH):
    """Pieces of a chunk: (core hash, anchor, first start, last start), each piece inside one text."""
    n, span = len(data), length - GRAM + 1
    middle = span // 2
    empty = np.zeros(0, np.int64)
    if n < length or not (ends - starts >= length).any():
        return empty.astype(np.uint64), empty, empty, empty
    h = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    power, width = 0xD6E8FEB86659FD93, 1
    while width < GRAM:  # h[i] becomes the hash of 2 * width bytes from i on
        h[:-width] = h[:-width] * np.uint64(power) + h[width:]
        power, width = power * power % 2 ** 64, 2 * width
    v = h ^ h >> np.uint64(29)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v &= _TOP
    v |= np.arange(n, dtype=np.uint64)  # ties go to the leftmost
    rows = -(-n // span) + 1
    padded = np.full(rows * span, _LAST)
    padded[:n] = v
    block = padded.reshape(-1, span)
    left = np.minimum.accumulate(block, 1).ravel()
    right = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
    real = np.zeros(n + 1, np.int32)
    long = ends - starts >= length
    np.add.at(real, starts[long], 1)
    np.add.at(real, ends[long] - length + 1, -1)
    s = np.nonzero(np.cumsum(real[:n]))[0]
    anchor = (np.minimum(right[s], left[s + span - 1]) & ~_TOP).astype(np.int64)
    before = anchor - s >= middle  # strings that reach far to the left of their anchor
    new = np.ones(len(s), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (s[1:] != s[:-1] + 1) | (before[1:] != before[:-1])
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(s)) - 1
    a, b = anchor[first], before[first]
    # all strings of a piece hold anchor - middle .. anchor + GRAM, or anchor .. anchor + length - middle + 1
    begin, end = np.where(b, a - middle, a), np.where(b, a + GRAM, a + length - middle + 1)
    core = b.astype(np.uint64)
    for k in range(-(-(length - middle + 1) // GRAM)):
        at = np.minimum(begin + k * GRAM, end - GRAM)
        core = (core ^ h[at]) * np.uint64(0xD6E8FEB86659FD93)
        core ^= core >> np.uint64(32)
    return core, a, s[first], s[last]


def digest(core: int, shift: int, body: bytes) -> bytes:
    return xxhash.xxh3_128_digest(struct.pack("<qi", core, shift) + body)


def cores(store: DataFrame, length: int) -> DataFrame:
    """(chunk, cores): of each chunk the cores that stand at least twice among all texts."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                core, n = np.unique(anchored(*opened(r["sizes"], r["body"]), length)[0].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(np.full(len(core), r["chunk"])),
                                                  pa.array(n.astype(np.int32))], names=["core", "chunk", "n"])

    found = store.select("chunk", "sizes", "body").mapInArrow(emit, "core long, chunk long, n int")
    everywhere = F.sum("n").over(Window.partitionBy("core"))
    return (found.withColumn("n", everywhere).filter("n > 1").groupBy("chunk")
            .agg(F.collect_list("core").alias("cores")))


ROWS = "chunk long, spots binary, sid binary, key long, shift int, n int, body binary"


def pieces(store: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Different pieces of each chunk with the places where they stand; what they are only with the first row of a task."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for r in batch.to_pylist():
                data, starts, ends = opened(r["sizes"], r["body"])
                core, anchor, first, last = anchored(data, starts, ends, length)
                core = core.view(np.int64)
                take = np.nonzero(np.isin(core, np.array(r["cores"], np.int64)))[0]
                own: dict[bytes, tuple] = {}
                for c, a, s, e in zip(core[take].tolist(), anchor[take].tolist(), first[take].tolist(), last[take].tolist()):
                    body = data[s: e + length]
                    sid = digest(c, a - s, body)
                    if sid in own:
                        own[sid][0].append(s)
                    else:
                        own[sid] = ([s], c, a - s, body)
                out = []
                for sid, (spots, c, shift, body) in own.items():
                    told = (None, None) if sid in seen else (c, shift)
                    out.append((r["chunk"], np.array(spots, np.int32).tobytes(), sid, *told, len(spots),
                                None if sid in seen else body))
                seen.update(own)
                if len(seen) > SEEN:
                    seen.clear()
                for at in range(0, len(out), 5000):
                    yield batch_of(out[at: at + 5000], _ROW_TYPES)

    return store.join(wanted, "chunk").select("chunk", "sizes", "body", "cores").mapInArrow(emit, ROWS)


_ROW_TYPES = dict(chunk=pa.int64(), spots=pa.binary(), sid=pa.binary(), key=pa.int64(), shift=pa.int32(), n=pa.int32(),
                  body=pa.binary())
DECIDED = "sid binary, first int, last int, key long, sub binary, shift int, n int, body binary"
_DECIDED_TYPES = dict(sid=pa.binary(), first=pa.int32(), last=pa.int32(), key=pa.int64(), sub=pa.binary(), shift=pa.int32(),
                      n=pa.int32(), body=pa.binary())


def batch_of(rows: list[tuple], types: dict) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, types.values())], names=list(types))


def quarters(key: int, shift: int, body: bytes, length: int, width: int) -> Iterator[tuple]:
    """(offset, key, digest, shift, bytes) of a piece cut at multiples of `width` starts from its anchor."""
    starts = len(body) - length + 1
    at = 0
    while at < starts:
        j = (shift - at) // width  # the anchor is shift - at bytes after this start
        n = min(starts - at, shift - at - j * width + 1)
        begin = shift - j * width  # in all strings of this part
        core = body[begin: begin - width + 1 + length]
        new = xxhash.xxh3_64_intdigest(struct.pack("<qi", key, j) + core) - 2 ** 63
        part = body[at: at + n - 1 + length]
        yield at, new, digest(new, shift - at, part), shift - at, part
        at += n


def told_apart(members: list[tuple], length: int) -> tuple[list[tuple], list[tuple]]:
    """Runs (sid, first, last) that the counts of a group's pieces (sid, shift, n, bytes) tell, and the pieces to sort. Strings
    of a group stand in no other group, and in a piece once: a piece that stands twice is repeated as a whole, and pieces
    are sorted only for those that stand once and are not alone."""
    runs = [(sid, 0, len(body) - length) for sid, _, n, body in members if n > 1]
    return runs, [(sid, n, body) for sid, _, n, body in members] if 1 < len(members) != len(runs) else []


def decide(distinct: DataFrame, length: int, width: int, group: int, shard: int) -> DataFrame:
    """Runs of repeated starts (sid, first, last) of each piece; or its parts (with bytes), where a group is too large."""
    narrower = max(1, width // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, out = [], 0, []
        open_key, members, hot = None, [], False

        def sort():
            """One suffix array over all groups held."""
            nonlocal held, size
            found = [(held[o][0], f, l) for o, f, l in zip(*(x.tolist() for x in repeated([h[2] for h in held], length, Scratch())))
                     if held[o][1] == 1]
            held, size = [], 0
            return [(*r, None, None, None, None, None) for r in found]

        def close():
            nonlocal size
            runs, left = told_apart(members, length)
            out.extend((*r, None, None, None, None, None) for r in runs)
            held.extend(left)
            size += sum(len(m[2]) for m in left)

        def cut(key, rows):
            for sid, shift, n, body in rows:
                for at, new, sub, s, part in quarters(key, shift, body, length, narrower):
                    yield sid, at, None, new, sub, s, n, part

        for batch in batches:
            for key, sid, shift, n, body in zip(*(c.to_pylist() for c in batch.columns)):
                if key != open_key:
                    close()
                    if size >= shard:
                        out += sort()
                    open_key, members, hot = key, [], False
                if hot:
                    out += cut(key, [(sid, shift, n, body)])
                else:
                    members.append((sid, shift, n, body))
                    if len(members) > group and width > 1:
                        out += cut(key, members)
                        hot, members = True, []
                while len(out) >= 5000:
                    yield batch_of(out[:5000], _DECIDED_TYPES)
                    out = out[5000:]
        close()
        out += sort()
        for at in range(0, len(out), 5000):
            yield batch_of(out[at: at + 5000], _DECIDED_TYPES)

    return (distinct.select("key", "sid", "shift", "n", "body").repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, DECIDED))


def together(rows: DataFrame, sid: str) -> DataFrame:
    return rows.groupBy(F.col(sid).alias("sid")).agg(
        F.first("key", ignorenulls=True).alias("key"), F.first("shift", ignorenulls=True).alias("shift"), F.sum("n").cast("int").alias("n"),
        F.first("body", ignorenulls=True).alias("body"))


def repeated_runs(rows: DataFrame, length: int, group: int, shard: int) -> DataFrame:
    """(sid, first, last) for all pieces, level by level."""
    width, levels, found = length - GRAM + 1, [], []
    distinct = together(rows, "sid")
    while True:
        got = settle(decide(distinct, length, width, group, shard), "runs", "zstd")
        found.append(got.filter("body is null").select("sid", "first", "last"))
        parts = got.filter("body is not null")
        if parts.isEmpty():
            break
        levels.append(parts.select("sid", "first", "sub"))
        distinct, width = together(parts, "sub"), max(1, width // 4)
    runs = found.pop()
    while levels:  # from the narrowest parts back to the pieces
        parts = levels.pop()
        runs = found.pop().unionByName(parts.withColumnRenamed("first", "at").join(runs.withColumnRenamed("sid", "sub"), "sub")
                                       .select("sid", (F.col("at") + F.col("first")).alias("first"),
                                               (F.col("at") + F.col("last")).alias("last")))
    return runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, *, doc_id: str = "doc_id", text: str = "text",
                   group: int = GROUP, shard: int = SHARD) -> DataFrame:
    """doc_id, n_bytes, spans (start, length of each maximal removed run), kept (the remaining bytes) of every row."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    kind = docs.schema[doc_id].dataType
    store = settle(chunks(docs, doc_id, text), "chunks")
    rows = settle(pieces(store, cores(store, length), length), "pieces", "zstd")
    runs = repeated_runs(rows, length, group, shard)
    runs = runs.groupBy("sid").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    hits = (rows.select("chunk", "sid", "spots").join(runs, "sid").groupBy("chunk")
            .agg(F.collect_list(F.struct("spots", "runs")).alias("hits")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data, starts, ends = opened(r["sizes"], r["body"])
                pairs = [(hit["spots"], run["first"], run["last"]) for hit in r["hits"] or () for run in hit["runs"]]
                spots = np.frombuffer(b"".join([p[0] for p in pairs]), np.int32)
                times = [len(p[0]) // 4 for p in pairs]
                begin, end = (np.repeat(np.array([p[k] for p in pairs], np.int64), times) for k in (1, 2))
                edge = np.bincount(spots + begin, minlength=len(data) + 1) - np.bincount(spots + end + length, minlength=len(data) + 1)
                gone = np.cumsum(edge[:-1]) > 0
                flat, spans, kept = np.frombuffer(data, np.uint8), [], []
                for a, b in zip(starts.tolist(), ends.tolist()):
                    own = gone[a:b]
                    if own.any():
                        at = np.nonzero(np.diff(own.astype(np.int8), prepend=0, append=0))[0].tolist()
                        spans.append([{"start": s, "length": e - s} for s, e in zip(at[::2], at[1::2])])
                        kept.append(flat[a:b][~own].tobytes())
                    else:
                        spans.append([])
                        kept.append(data[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["ids"], batch.schema.field("ids").type.value_type), pa.array(ends - starts),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                     pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                         T.StructField("length", T.LongType())]))),
        T.StructField("kept", T.BinaryType())])
    return store.join(hits, "chunk", "left").select("ids", "sizes", "body", "hits").mapInArrow(cut, schema)


def op11_repeats(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes",
                      F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["length"]).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
