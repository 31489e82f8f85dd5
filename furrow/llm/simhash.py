"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 22, 21 and 21 bits, each read as a word of the perfect binary Golay
code (23, 12, 7): decoding gives the 12-bit index of the only codeword within three bits. Words that differ in one bit
need not decode alike, but each one's index is among the indices of the other's neighbourhood (the word itself and
its one-bit changes: one index, or six).

Three errors at most over three segments leave two cases:

* one segment has none and another at most one: the exact segment with the neighbourhood indices of the other is a
  key (six ordered pairs of segments);
* each has exactly one: the first segment's own index with the neighbourhoods of the two others, and the first
  segment's neighbourhood with the own indices of the two others, always have a key in common.

Rows are joined by key, each candidate pair is verified on all 64 bits, and groups leave a spanning forest of their
links, not all pairs: small groups pair up directly, larger ones are searched breadth first. A group beyond GROUP
members is not gathered: it is dealt out as pairs of salted parts in a second pass, so that nothing is left out.

Only distinct fingerprints meet; copies share one. Components come from alternating large-star and small-star steps
on tables.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; null ids keep their row and
are ignored when the smallest id of a component is taken (a component of null ids only has a null id); repeated rows
stay; an empty table gives no rows. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.session import settle

from .common import map_texts, per_worker, small_batches

SEED, SHINGLE, APART = 42, 3, 3
GROUP = 50_000
#: Shift and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fixed value: the generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprints_of(texts: list[str], width: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprints of whole texts."""
    out, digests, sizes, owners = np.zeros(len(texts), np.uint64), [], [], []
    held = 0
    digest = xxhash.xxh64_digest

    def close():
        nonlocal digests, sizes, owners, held
        if not owners:
            return
        h = np.frombuffer(b"".join(digests), ">u8").astype("<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        n = np.array(sizes)
        counts = np.add.reduceat(bits, np.cumsum(n) - n, axis=0, dtype=np.int32)
        packed = np.packbits(counts * 2 > n[:, None], axis=1, bitorder="little")
        out[owners] = np.ascontiguousarray(packed).view("<u8")[:, 0]
        digests, sizes, owners, held = [], [], [], 0

    for at, t in enumerate(texts):
        words = t.encode("utf-8", "surrogatepass").translate(LOWER).split()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= width:
            digests.append(digest(line, SEED))
            sizes.append(1)
        else:
            n = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(n + 1) - 1
            begins = ends - n
            digests += [digest(line[a:b], SEED) for a, b in
                        zip(begins[: 1 - width].tolist(), ends[width - 1:].tolist())]
            sizes.append(len(words) - width + 1)
        owners.append(at)
        held += sizes[-1]
        if held > 50_000:
            close()
    close()
    return out


def fingerprints(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Appends `fp`, the fingerprint's bits as a long."""
    added = T.StructType([T.StructField("fp", T.LongType())])
    return map_texts(docs, added, lambda texts: [pa.array(fingerprints_of(texts).view(np.int64))], text=text, keep=keep)


def codeword_index() -> np.ndarray:
    """For every 23-bit word the index of the codeword within three bits (16 MB, made once per worker)."""
    return per_worker("golay", _codeword_index)


def _codeword_index() -> np.ndarray:
    messages = np.arange(4096, dtype=np.int64)
    codes = np.zeros(4096, np.int64)
    for k in range(12):
        codes ^= np.where(messages >> k & 1, GENERATOR << k, 0)
    one = [1 << i for i in range(23)]
    errors = [0, *one, *(a | b for a in one for b in one if a < b),
              *(a | b | c for a in one for b in one if a < b for c in one if b < c)]
    table = np.zeros(1 << 23, np.uint16)
    table[(codes[:, None] ^ np.array(errors)[None, :]).ravel()] = np.repeat(messages, len(errors)).astype(np.uint16)
    return table


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in fp) of all keys; a fingerprint never has a key twice."""
    index = codeword_index()
    seg = [(fp >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
    own = [index[x].astype(np.int64) for x in seg]
    near, first = [], []
    for x, (_, w) in zip(seg, SEGMENTS):
        words = x[:, None] ^ np.array([0, *(1 << i for i in range(w))])[None, :]
        found = np.sort(index[words].astype(np.int64), axis=1)
        # at most six distinct indices, moved to the front
        fresh = np.ones(found.shape, bool)
        fresh[:, 1:] = found[:, 1:] != found[:, :-1]
        order = np.argsort(~fresh, axis=1, kind="stable")[:, :6]
        near.append(np.take_along_axis(found, order, 1))
        first.append(np.take_along_axis(fresh, order, 1))
    keys, rows = [], []
    at = np.arange(len(fp))

    def add(kind: int, value: np.ndarray, real: np.ndarray):
        keys.append((np.int64(kind) << 58 | value)[real])
        rows.append(np.broadcast_to(at.reshape(-1, *[1] * (value.ndim - 1)), value.shape)[real])

    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                add(kind, seg[i][:, None] << 12 | near[j], first[j])
                kind += 1
    a, b, c = near
    real = first[1][:, :, None] & first[2][:, None, :]
    add(kind, own[0][:, None, None] << 24 | b[:, :, None] << 12 | c[:, None, :], real)
    add(kind, a << 24 | (own[1] << 12 | own[2])[:, None], first[0] & (a != own[0][:, None]))
    return np.concatenate(keys), np.concatenate(rows)


def forest(members: np.ndarray, apart: int = APART) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members within `apart` bits, breadth first."""
    left, out = members.copy(), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            reached = np.zeros(len(left), bool)
            for x in front:
                hit = (np.bitwise_count(left ^ x) <= apart) & ~reached
                if hit.any():
                    out += [(int(x), int(y)) for y in left[hit]]
                    reached |= hit
            front, left = left[reached], left[~reached]
    return out


def group_links(key: np.ndarray, fp: np.ndarray, apart: int = APART) -> np.ndarray:
    """Verified links (n, 2) of runs of equal keys; each run keeps its connectivity."""
    edges = np.nonzero(np.diff(key))[0] + 1
    begins = np.concatenate([[0], edges])
    sizes = np.diff(np.concatenate([begins, [len(key)]]))
    found = []
    small = np.repeat(sizes <= 8, sizes)
    for s in range(1, min(8, int(sizes.max(initial=0)))):
        i = np.nonzero((key[:-s] == key[s:]) & small[:-s])[0]
        i = i[np.bitwise_count(fp[i] ^ fp[i + s]) <= apart]
        found.append(np.stack([fp[i], fp[i + s]], 1))
    for b, n in zip(begins[sizes > 8], sizes[sizes > 8]):
        got = forest(fp[b: b + n], apart)
        if got:
            found.append(np.array(got, np.uint64))
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


class Joined:
    """Union-find over what one task has linked; remembers only links that joined something new."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while (p := up.get(x, x)) != root:
            up[x] = root
            x = p
        return root

    def add(self, links: np.ndarray) -> list[tuple[int, int]]:
        new = []
        for a, b in np.unique(np.sort(links, axis=1), axis=0).tolist():
            x, y = self.top(a), self.top(b)
            if x != y:
                self.up[max(x, y)] = min(x, y)
                new.append((a, b))
        return new


LINK = "a long, b long, salt long"
_EMPTY = np.zeros(0, np.uint64)


def _pairs(rows: list) -> pa.RecordBatch:
    a, b, salt = (np.array(x, np.uint64).view(np.int64) for x in (zip(*rows) if rows else ([], [], [])))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(salt)], names=["a", "b", "salt"])


def wide_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys for pairs further apart: the neighbourhood indices of two segments together, for each two segments. Two
    words that differ in two bits have a neighbour in common, so fingerprints share a key whenever two segments have at
    most two errors each, as they must at seven errors in all, and mostly with some more."""
    index = codeword_index()
    near, real = [], []
    for s, w in SEGMENTS:
        x = (fp >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64)
        found = np.sort(index[x[:, None] ^ np.array([0, *(1 << i for i in range(w))])[None, :]].astype(np.int64), axis=1)
        fresh = np.ones(found.shape, bool)
        fresh[:, 1:] = found[:, 1:] != found[:, :-1]
        order = np.argsort(~fresh, axis=1, kind="stable")[:, :6]
        near.append(np.take_along_axis(found, order, 1))
        real.append(np.take_along_axis(fresh, order, 1))
    keys, rows = [], []
    for kind, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        value = np.int64(kind) << 24 | near[i][:, :, None] << 12 | near[j][:, None, :]
        use = real[i][:, :, None] & real[j][:, None, :]
        keys.append(value[use])
        rows.append(np.broadcast_to(np.arange(len(fp))[:, None, None], value.shape)[use])
    return np.concatenate(keys), np.concatenate(rows)


def links(distinct: DataFrame, apart: int = APART) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp); they connect whatever all links connect."""
    spark = distinct.sparkSession
    small_batches(spark)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fp = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(all_fp), 4000):
                fp = all_fp[at: at + 4000]
                key, row = keys_of(fp)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row].view(np.int64))], names=["key", "fp"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of whole keys. Links have salt 0; members of a group that is too large pass on as (key, fp, 1)."""
        joined, key, fp, large = Joined(), np.zeros(0, np.int64), _EMPTY, None
        rest: list[tuple] = []

        def close(key, fp):
            rest.extend((a, b, 0) for a, b in joined.add(group_links(key, fp, apart)))

        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if large is not None:  # the open group was found too large before
                own = key == large
                rest += [(int(np.int64(large).view(np.uint64)), int(x), 1) for x in fp[own]]
                key, fp = key[~own], fp[~own]
                large = large if not len(key) else None
            if len(key) >= 20_000:
                whole = int(np.searchsorted(key, key[-1]))
                close(key[:whole], fp[:whole])
                key, fp = key[whole:], fp[whole:]
                if len(key) > GROUP:
                    large = key[-1]
                    rest += [(int(large.view(np.uint64)), int(x), 1) for x in fp]
                    key, fp = key[:0], _EMPTY
            if len(rest) > 20_000:
                yield _pairs(rest)
                rest = []
        if len(key):
            close(key, fp)
        yield _pairs(rest)

    keyed = distinct.select("fp").mapInArrow(emit, "key long, fp long")
    found = settle(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(join, LINK), "links")
    return found.filter("salt = 0").select("a", "b").unionByName(large_links(found, apart))


def large_links(found: DataFrame, apart: int) -> DataFrame:
    """Links inside groups beyond GROUP: each pair of salted parts of a group is one bounded piece of work."""
    members = found.filter("salt = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    parts = members.groupBy("key").agg(F.ceil(F.count("*") / (GROUP / 4)).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("fp"), "parts").cast("int")
    dealt = (members.join(parts, "key").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("pair"), "fp"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined, key, fp = Joined(), np.zeros(0, np.int64), _EMPTY
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield _pairs([(a, b, 0) for a, b in joined.add(group_links(key[:whole], fp[:whole], apart))])
            key, fp = key[whole:], fp[whole:]
        yield _pairs([(a, b, 0) for a, b in joined.add(group_links(key, fp, apart))] if len(key) else [])

    return (dealt.repartition("pair").sortWithinPartitions("pair").mapInArrow(join, LINK)
            .select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(u, root): for every vertex of the edges (a, b) the smallest vertex reachable, for all but the roots.

    Large-star and small-star steps in turn, each a pre-aggregated minimum and a join; edges are written between
    rounds, and rounds end when a round changes nothing (their number grows with the logarithm of the longest chain).
    """
    e = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(small, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")),
                              F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("p"))
        e = settle(linked.select(F.col("p.x").alias("u"), F.col("p.y").alias("v")).filter("u <> v").distinct(), "edges")
        seen = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark or not seen[0]:
            return e.select("u", F.col("v").alias("root"))
        mark = seen


def near_groups(docs: DataFrame, apart: int = APART, *, doc_id: str = "doc_id", text: str = "text",
                row: str | None = None) -> DataFrame:
    """doc_id, row, fp, component_id, first_row for every row.

    `row` is the column of that name, stored before, or else numbers the rows of the scan; `first_row` is the row of its component with the smallest id (then number),
    nulls last.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                      (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
                      F.col(f"`{text}`").alias("text"))
    rows = settle(fingerprints(own, keep=["doc_id", "row"]), "fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    distinct = settle(rows.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    roots = components(links(distinct, apart))
    named = settle(distinct.join(roots, distinct.fp == roots.u, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    least = named.groupBy("root").agg(F.min("least").alias("first"))
    groups = named.join(least, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first_row"))
    return rows.join(groups, "fp").select("doc_id", "row", "fp", "component_id", "first_row")


def free_name(columns: list[str], name: str = "row_number") -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_of_each(docs: DataFrame, apart: int = APART) -> DataFrame:
    """One row of each component, with all its columns. Rows are numbered once and written with their numbers: a later
    scan may be split in another way, for instance after an executor was lost."""
    row = free_name(docs.columns)
    numbered = settle(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    kept = near_groups(numbered, apart, row=row).filter("row = first_row").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").drop(row)


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import table

    found = near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
