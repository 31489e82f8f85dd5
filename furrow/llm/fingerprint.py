"""Document fingerprints from content-defined chunks.

A gear hash over the last WINDOW bytes marks possible boundaries. Boundaries are normalised: up to NORMAL bytes into a
chunk the mark must be rare (STRICT high bits zero), from there on a common one will do (LOOSE bits), and no chunk is
shorter than LEAST or longer than MOST bytes. Hashes do not start anew at chunks, so a boundary depends on nearby
bytes alone and survives shifts. The fingerprint is the set of chunk digests with their lengths, as a string: for each
distinct chunk, sorted, 12 hexadecimal digits of its XXH64 and 3 of its length in bytes.

`containment(a, b)` is the share of a's chunk bytes that b has too: 0 to 1, 1 for equal fingerprints.

Defined cases: a null text is empty; an empty text has the empty fingerprint, which is contained only in another
empty one; equal texts have equal fingerprints. In the order of descending ids, null ids come last, and rows with
equal ids are ordered by their text; the row after the last is the first, so a single row follows itself. Texts of any
length are chunked whole. An empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import concatenated, mix64, small_batches

WINDOW, LEAST, NORMAL, MOST = 16, 8, 32, 128
STRICT, LOOSE = 5, 3
#: One value for each byte from a fixed mixer; the byte 255, which UTF-8 never has, separates texts and counts nothing.
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
GEAR[255] = 0


def chunk_sets(texts: list[bytes]) -> list[set[int]]:
    """The set of (digest << 12 | length) of each text's chunks."""
    if not texts:
        return []
    joined, starts, ends = concatenated(texts, WINDOW)
    h = GEAR[joined]
    for k in (1, 2, 4, 8):  # doubles the window
        h[k:] += h[:-k] << np.uint32(k)
    marks = np.nonzero(h < np.uint32(1 << 32 - LOOSE))[0]
    rare = (h[marks] < np.uint32(1 << 32 - STRICT)).tolist()
    begin = np.searchsorted(marks, starts).tolist()
    stop = np.searchsorted(marks, ends).tolist()
    digest, out = xxhash.xxh64_intdigest, []
    places = (marks + 1).tolist()  # where the next chunk would start
    for text, at, end, m, last in zip(texts, starts.tolist(), ends.tolist(), begin, stop):
        found, base = set(), at
        while at < end:
            least, normal, most = at + LEAST, at + NORMAL, at + MOST
            cut = min(most, end)
            while m < last:
                p = places[m]
                if p > most:
                    break
                m += 1
                if p >= least and (p > normal or rare[m - 1]):
                    cut = p
                    break
            size = cut - at
            found.add((digest(text[at - base: cut - base]) >> 16) << 12 | size)
            at = cut
        out.append(found)
    return out


def as_string(chunks: set[int]) -> str:
    return "".join([f"{c:015x}" for c in sorted(chunks)])


def from_string(fingerprint: str) -> set[int]:
    return {int(fingerprint[i: i + 15], 16) for i in range(0, len(fingerprint), 15)}


def containment(a: set[int], b: set[int]) -> float:
    if not a:
        return 0.0 if b else 1.0
    both = a & b
    return sum([c & 4095 for c in both]) / sum([c & 4095 for c in a]) if both else 0.0


def ranges(docs: DataFrame, parts: int) -> list[int]:
    """Ids that end `parts` ranges of about equal row counts, ascending, the largest id last. One narrow scan."""
    asked = [i / parts for i in range(1, parts)]
    got = docs.agg(F.percentile_approx("doc_id", asked or [0.5], 100 * parts).alias("p"), F.max("doc_id").alias("m")).first()
    return sorted({*(got["p"] or [] if asked else []), got["m"]} - {None})


def followed(docs: DataFrame) -> DataFrame:
    """Deal rows out by ranges of descending ids. A range's last row needs the first row of the next range: that row
    also goes to the range before as a guest (its id is the range's own bound, so nothing is gathered to find it)."""
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = np.array(ranges(docs, 8 * parts), np.int64)  # several ranges each, so that partitions are even

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy()
            own = np.where(known, np.searchsorted(bounds, ids), 0) if len(bounds) else np.zeros(len(ids), np.int64)
            guest = known & (bounds[np.minimum(own, len(bounds) - 1)] == ids) if len(bounds) else ~known
            at = np.concatenate([np.arange(len(ids)), np.nonzero(guest)[0]])
            to = np.concatenate([own, (own[guest] + 1) % max(1, len(bounds))])
            is_guest = np.arange(len(at)) >= len(ids)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(to.astype(np.int32)), pa.array(is_guest)],
                                             names=["doc_id", "text", "part", "guest"])

    routed = docs.mapInArrow(route, "doc_id long, text string, part int, guest boolean")
    return routed.repartition(parts, "part").sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "text")


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_pairs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, with their likeness, and that to the next row's."""
    small_batches(docs.sparkSession)
    rows = followed(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                                F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows whose next row is not seen yet, or whose result is not given yet

        def results(ready: list[tuple]) -> pa.RecordBatch:
            """`ready` rows but the last get their result, if the row after is of the same range."""
            raw = [r[1].encode("utf-8", "surrogatepass") for r in ready]
            sets = chunk_sets(raw)
            changed = [edited(a[1], b[1]).encode("utf-8", "surrogatepass") for a, b in zip(ready, ready[1:])]
            new_sets = chunk_sets(changed)
            out = []
            for i, (a, b) in enumerate(zip(ready, ready[1:])):
                if a[3] or a[2] != b[2]:
                    continue
                out.append((a[0], len(a[1]), hashlib.sha256(changed[i]).hexdigest(), as_string(sets[i]),
                            as_string(new_sets[i]), containment(sets[i], new_sets[i]), containment(sets[i], sets[i + 1])))
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=[f.split()[0] for f in SCHEMA.split(", ")])

        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[1])
                if size > 1_500_000:
                    yield results(held)
                    held, size = held[-1:], len(held[-1][1])
        if held:
            yield results(held)

    return rows.mapInArrow(run, SCHEMA)


def op2_fingerprint(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return fingerprint_pairs(table(spark, sf_dir, "documents"))
