"""Order-preserving packing of token streams by dynamic programming.

Documents are taken in the order of their partition's rows and never reordered. Their ids form one stream, cut into
windows of at most `size` tokens. The cost of a set of cuts is the padding plus a penalty for every cut that is not
at the end of a document: SENTENCE after a sentence's last token, INSIDE elsewhere. A window is padded to `size`
unless its length is a power of two, which needs no padding; but a short window is a sequence more, and costs SHORT
instead. The cheapest cuts come from

    best(j) = penalty(j) + min( min over j - size <= i < j of best(i) + size - (j - i),  best(j - 2**k) + SHORT )

where the first minimum is kept in a monotone queue of best(i) + i, so that each candidate costs amortised constant
time, and the second has one term per power of two. Candidates are document and sentence ends and, to bound the
padding where sentences are long, every GRID-th token of the stream.

The stream is handled in runs of RUN tokens: a run's cuts are final except for its last two windows, whose tokens open
the next run. Memory is bounded by RUN and the longest document. What is left at the end of a partition is padded, or
cut into powers of two where that costs less.

Defined cases: a null or empty text is the single end id; null and repeated document ids are packed like others, each
row by itself; an empty table gives no pieces; very long texts span windows. Extra columns are dropped. Sequence
numbers are unique, not consecutive: the partition number times 2**40 plus a count.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_chars, per_worker, small_batches
from .piecetable import START, PieceTable
from .pretoken import is_odd

SIZE, RUN, GRID = 2048, 400_000, 64
SENTENCE, INSIDE, SHORT = 1, 40, 512
END = 1
#: New pieces that go to the tokenizer as one text.
JOINED = 100
VOCABULARY = "byte_bpe_50k.json"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "padded long")


class Encoder:
    """Ids of whole texts by a tokenizer file. Pieces of texts are encoded once and remembered."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        # in byte-level vocabularies a blank is written as U+0120 and a line feed as U+010A
        self.opens = np.array([t.startswith(("\u0120", "\u010a")) for t in names])
        self.closes = np.array([t.endswith((".", "!", "?", "\u010a")) for t in names])
        self.closes[END] = True
        self.table = PieceTable(self._ids)

    def _ids(self, pieces_: list[bytes]) -> list:
        """Pieces that open with white space are encoded JOINED at a time: exactly their first tokens open with it."""
        texts = [(p[1:] if p[0] == START else p).decode("utf-8", "surrogatepass") for p in pieces_]
        out: list = [None] * len(texts)
        bare = [i for i, p in enumerate(pieces_) if p[0] == START or len(p) == 1]
        for i, e in zip(bare, self.tokenizer.encode_batch([texts[i] for i in bare], add_special_tokens=False)):
            out[i] = e.ids
        rest = [i for i, p in enumerate(pieces_) if p[0] != START and len(p) > 1]
        runs = [rest[at: at + JOINED] for at in range(0, len(rest), JOINED)]
        joined = self.tokenizer.encode_batch(["".join([texts[i] for i in r]) for r in runs], add_special_tokens=False)
        for r, e in zip(runs, joined):
            ids = e.ids
            opens = np.nonzero(self.opens[ids])[0].tolist()
            if len(opens) != len(r):
                parts = [e.ids for e in self.tokenizer.encode_batch([texts[i] for i in r], add_special_tokens=False)]
            else:
                parts = [ids[a:b] for a, b in zip(opens, [*opens[1:], len(ids)])]
            for i, part in zip(r, parts):
                out[i] = part
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, unsigned 32-bit."""
        odd = [i for i, t in enumerate(texts) if is_odd(t)]
        out: list = [None] * len(texts)
        for i, e in zip(odd, self.tokenizer.encode_batch([texts[i] for i in odd], add_special_tokens=False)):
            out[i] = np.array(e.ids, "<u4")
        even = [i for i, t in enumerate(texts) if out[i] is None]
        if even:
            mark = bytes([START])
            buffer = mark + mark.join([texts[i].encode("utf-8", "surrogatepass") for i in even])
            ids, counts, begins = self.table.look_up(np.frombuffer(buffer, np.uint8))
            cuts = (np.cumsum(counts) - counts)[begins][1:]
            for i, part in zip(even, np.split(ids.astype("<u4", copy=False), cuts)):
                out[i] = part
        return out


def encoder(path: str) -> Encoder:
    return per_worker(f"encoder {path}", lambda: Encoder(path))


def cuts_of(places: list[int], penalty: list[int], size: int, tail: bool) -> list[int]:
    """Cheapest cut places: `places` ascend from 0, the last is the stream's end. Monotone queue, see the module.

    With `tail` the last window is the end of the stream; otherwise it stays open and costs nothing.
    """
    powers = [1 << k for k in range(size.bit_length()) if 1 << k <= size]
    end, far = places[-1], float("inf")
    best, back = {0: 0}, {}
    queue, grow = deque([(0, 0)]), 0  # (best(i) + i, i), values ascend
    for j, extra in zip(places[1:], penalty[1:]):
        while queue and queue[0][1] < j - size:
            queue.popleft()
        if queue:
            value, source = queue[0]
            cost = value + size - j
        else:
            cost, source = far, -1
        open_end = not tail and j == end
        if open_end and queue:
            value, source = min((best[i], i) for _, i in queue)
            cost = value
        for p in powers:
            b = best.get(j - p)
            if b is not None and b + (SHORT if p < size else 0) < cost:
                cost, source = b + (SHORT if p < size else 0), j - p
        if source < 0:
            continue
        cost += 0 if j == end else extra
        best[j], back[j] = cost, source
        value = cost + j
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    out, at = [], end
    while at > 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def last_parts(n: int, size: int) -> list[int]:
    """The last n tokens: powers of two that add up to n, largest first, if that costs less than padding."""
    parts = [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]
    return parts if len(parts) * SHORT < size - n + SHORT else [n]


def plan(ids: np.ndarray, doc_ends: np.ndarray, closes: np.ndarray, size: int, tail: bool) -> list[int]:
    """Cut places of one run."""
    n = len(ids)
    if n == 0:
        return []
    kind = np.full(n + 1, -1, np.int64)
    kind[GRID::GRID] = INSIDE
    kind[1:][closes[ids]] = SENTENCE
    kind[doc_ends] = 0
    kind[0] = kind[n] = 0
    places = np.nonzero(kind >= 0)[0]
    return cuts_of(places.tolist(), kind[places].tolist(), size, tail)


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None, *, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded) of all documents.

    One narrow pass; `padded` is the padding of the piece's sequence.
    """
    small_batches(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    body = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, sequence = encoder(path), TaskContext.get().partitionId() << 40
        end = np.array([END], "<u4")
        held: list[list] = []  # [doc_id, ids, tokens of the document, tokens of it already placed]
        waiting = 0

        def placed(tail: bool) -> pa.RecordBatch:
            nonlocal sequence, held, waiting
            stream = np.concatenate([h[1] for h in held])
            sizes = np.array([len(h[1]) for h in held], np.int64)
            ends = np.cumsum(sizes)
            cuts = plan(stream, ends, enc.closes, size, tail)
            if not tail:
                cuts = cuts[:-2]
            elif cuts:
                last = cuts[-2] if len(cuts) > 1 else 0
                cuts = cuts[:-1] + (last + np.cumsum(last_parts(cuts[-1] - last, size))).tolist()
            rows, d, begin = [], 0, 0
            for cut in cuts:
                offset, length = 0, cut - begin
                pad = 0 if length & (length - 1) == 0 else size - length
                at = begin
                while at < cut:
                    while ends[d] <= at:
                        d += 1
                    name, data, total, before = held[d]
                    own = at - int(ends[d] - sizes[d])
                    take = min(cut, int(ends[d])) - at
                    rows.append((name, before + own, take, zlib.crc32(data[own: own + take]),
                                 total, sequence, offset, pad))
                    offset += take
                    at += take
                sequence += 1
                begin = cut
            rest = []
            for (name, data, total, before), stop, n in zip(held, ends.tolist(), sizes.tolist()):
                own = max(0, begin - (stop - n))
                if own < n:
                    rest.append([name, data[own:], total, before + own])
            held, waiting = rest, int(ends[-1]) - begin if len(ends) else 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 8)],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids_of = (ids for part in by_chars(texts) for ids in enc.encode(part))
            for name, ids in zip(names, ids_of):
                held.append([name, np.concatenate([ids, end]), len(ids) + 1, 0])
                waiting += len(ids) + 1
                if waiting >= RUN:
                    yield placed(False)
        if held:
            yield placed(True)

    return body.mapInArrow(run, SCHEMA)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return pack(table(spark, sf_dir, "documents"))
