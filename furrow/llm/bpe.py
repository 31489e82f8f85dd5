"""Byte-level BPE with DuckDB: encoding as a recursive query over token positions, decoding as an ordered aggregate.

A worker keeps one in-memory database with two tables made from a rank file:

* `vocabulary` (token, hex): each token's bytes;
* `merges` (pair, token): every pair of tokens whose bytes together are a token, as left * 2**20 + right.

Encoding holds a row for each token position of each word (w, i, token, the token after it). A round joins the rows
to the merges, finds each word's pair of least rank (leftmost if several) as one packed minimum, contracts it and moves
the later positions up; words without a pair left drop out, and the query ends when no word is left. A round reads
only rows of the round before. Decoding joins ids to the vocabulary and concatenates the bytes by position.

Both run on distinct pieces of text: a piece is cut so that the public pattern treats it independently, so a document's
ids are those of its pieces in order. Pieces are encoded once per worker as long as they are kept.

Words of more than LONG bytes contract every occurrence of their least pair in a round (left to right where they
overlap). That gives the same ids wherever a merged token ranks after its parts, as in any trained vocabulary, and
needs as many rounds as there are distinct merges rather than as there are positions.

Defined cases: a null or empty text has no ids and decodes to nothing; texts are taken as UTF-8 and decode to the same
bytes; special tokens are ordinary text; an empty table gives no rows; repeated rows stay. Extra columns are dropped.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import by_chars, map_texts, per_worker
from .pretoken import MATCHES, pieces, text_of

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces a worker keeps, rows of bytes one recursive query starts from, and what its database may use.
KEPT, ROWS, MEMORY = 1_000_000, 250_000, "250MB"
LONG = 256

_STEP = """
WITH RECURSIVE t AS (
  SELECT w, i, token, after, 0 AS round FROM start
  UNION ALL
  SELECT t.w, t.i - (t.i > b.at)::INTEGER AS i,
         CASE WHEN t.i = b.at + 1 THEN b.token ELSE t.token END AS token,
         CASE WHEN t.i = b.at - 1 THEN b.token ELSE t.after END AS after, t.round + 1
  FROM t JOIN (
    SELECT w, (least_pair & 1048575)::INTEGER AS at, (least_pair >> 20)::INTEGER AS token FROM (
      SELECT t.w, min((m.token::BIGINT << 20) | t.i) AS least_pair
      FROM t JOIN merges m ON m.pair = (t.token::BIGINT << 20) | t.after GROUP BY t.w)
  ) b ON t.w = b.w
  WHERE t.i <> b.at
)
SELECT t.w, t.i, t.token FROM t JOIN (SELECT w, max(round) AS last FROM t GROUP BY w) z
  ON t.w = z.w AND t.round = z.last
"""

# every occurrence of the least pair: an occurrence counts if an even number of them touch it from the left
_LONG_STEP = """
WITH RECURSIVE t AS (
  SELECT w, i, token, after, 0 AS round FROM start
  UNION ALL
  SELECT w, (row_number() OVER (PARTITION BY w ORDER BY i) - 1)::INTEGER AS i, token,
         coalesce(lead(token) OVER (PARTITION BY w ORDER BY i), -1) AS after, round
  FROM (
    SELECT w, i, CASE WHEN hit THEN best ELSE token END AS token, round + 1 AS round,
           coalesce(lag(hit) OVER (PARTITION BY w ORDER BY i), false) AS swallowed
    FROM (
      SELECT *, is_best AND (row_number() OVER (PARTITION BY w, grp ORDER BY i)) % 2 = 1 AS hit
      FROM (
        SELECT *, sum((NOT is_best)::INTEGER) OVER (PARTITION BY w ORDER BY i) * 2 + is_best::INTEGER AS grp
        FROM (
          SELECT t.w, t.i, t.token, t.round, b.best, coalesce(m.token = b.best, false) AS is_best
          FROM t JOIN (SELECT t.w, min(m.token) AS best FROM t JOIN merges m
                       ON m.pair = (t.token::BIGINT << 20) | t.after GROUP BY t.w) b ON t.w = b.w
          LEFT JOIN merges m ON m.pair = (t.token::BIGINT << 20) | t.after))))
  WHERE NOT swallowed
)
SELECT t.w, t.i, t.token FROM t JOIN (SELECT w, max(round) AS last FROM t GROUP BY w) z
  ON t.w = z.w AND t.round = z.last
"""

_DECODE = """
SELECT w, unhex(string_agg(v.hex, '' ORDER BY i)) AS body FROM ids JOIN vocabulary v ON v.token = ids.token GROUP BY w
"""


class Codec:
    """A DuckDB database with the tables of one rank file."""

    def __init__(self, path: str):
        import duckdb

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.db = duckdb.connect()
        self.db.execute(f"SET threads = 1; SET memory_limit = '{MEMORY}'; SET temp_directory = ''; "
                        "SET preserve_insertion_order = false")
        left, right, merged = [], [], []
        for body, rank in ranks.items():
            for k in range(1, len(body)):
                a, b = ranks.get(body[:k]), ranks.get(body[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        pairs = pa.table({"pair": np.array(left, np.int64) << 20 | np.array(right, np.int64),  # noqa: F841
                          "token": np.array(merged, np.int32)})
        words = pa.table({"token": np.array(list(ranks.values()), np.int32), "hex": [b.hex() for b in ranks]})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM pairs")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM words")
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict = {}  # pieces asked for lately: (ids, their number, bytes)
        self.older: dict = {}  # those asked for before; what is asked for again moves up, the rest is forgotten

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has. No word is empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts, parts = np.zeros(len(words), np.int64), []
        for step, chosen in ((_STEP, sizes <= LONG), (_LONG_STEP, sizes > LONG)):
            at = np.nonzero(chosen)[0]
            ends = np.cumsum(sizes[at])
            begin = 0
            while begin < len(at):
                before = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, before + ROWS, "right")))
                own = at[begin:stop]
                w, i, token = self._contract(step, own, [words[x] for x in own], sizes[own])
                counts += np.bincount(w, minlength=len(words))
                parts.append((w, i, token))
                begin = stop
        if not parts:
            return np.zeros(0, np.int32), counts
        w, i, token = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((i, w))
        return token[order], counts

    def _contract(self, step, own, words, sizes):
        tokens = self.first[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum(sizes)
        after = np.empty_like(tokens)
        after[:-1] = tokens[1:]
        after[ends - 1] = -1
        place = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)
        start = pa.table({"w": np.repeat(own, sizes).astype(np.int32), "i": place.astype(np.int32),  # noqa: F841
                          "token": tokens, "after": after})
        got = self.db.sql(step).fetchnumpy()
        return got["w"], got["i"], got["token"]

    def decode(self, tokens: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes of runs of ids: `counts[k]` ids belong to run k."""
        starts = np.cumsum(counts) - counts
        ids = pa.table({"w": np.repeat(np.arange(len(counts)), counts), "token": tokens,  # noqa: F841
                        "i": np.arange(len(tokens)) - np.repeat(starts, counts)})
        out = [b""] * len(counts)
        got = self.db.sql(_DECODE).to_arrow_table()
        for w, body in zip(got.column(0).to_pylist(), got.column(1).to_pylist()):
            out[w] = body
        return out

    def words(self, words: list[str]) -> dict[str, tuple[str, int, bytes]]:
        """Each word with its ids, their number, and the bytes they decode to."""
        tokens, counts = self.encode_words([w.encode("utf-8", "surrogatepass") for w in words])
        bodies = self.decode(tokens, counts)
        text, ends = list(map(str, tokens.tolist())), np.cumsum(counts).tolist()
        return {w: (" ".join(text[e - n: e]), n, body) for w, n, e, body in zip(words, counts.tolist(), ends, bodies)}

    def learn(self, new: set) -> None:
        """Ids and decoded bytes of pieces: those of the pattern's matches in them, each encoded separately."""
        cut = {p: MATCHES.findall(text_of(p)) for p in new}
        words = self.words(list({m for found in cut.values() for m in found}))
        for p, found in cut.items():
            if len(found) == 1:
                self.known[p] = words[found[0]]
            else:
                ids, counts, bodies = zip(*[words[m] for m in found])
                self.known[p] = (" ".join(ids), sum(counts), b"".join(bodies))

    def run(self, texts: list[str]) -> list[tuple[str, int, bytes]]:
        """Per text: its ids as decimal numbers with single spaces, their number, and the bytes they decode to."""
        cut = [pieces(t) for t in texts]
        if len(self.known) > KEPT // 2:
            self.older, self.known = self.known, {}
        missing = set().union(*cut) - self.known.keys()
        again = missing & self.older.keys()
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        if missing := missing - again:
            self.learn(missing)
        out, get = [], self.known.__getitem__
        for c in cut:
            ids, counts, bodies = zip(*map(get, c)) if c else ((), (), ())
            out.append((" ".join(ids), sum(counts), b"".join(bodies)))
        return out


def codec(path: str) -> Codec:
    return per_worker(f"codec {path}", lambda: Codec(path))


def encode(docs: DataFrame, path: str | None = None, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Appends `ids` (array of int) to every row."""
    path = path or public_tokenizers.path(RANKS)

    def run(texts: list[str]) -> list[pa.Array]:
        c = codec(path)
        return [pa.array([list(map(int, ids.split())) for part in by_chars(texts) for ids, _, _ in c.run(part)],
                         pa.list_(pa.int32()))]

    added = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return map_texts(docs, added, run, text=text, keep=keep)


def decode(rows: DataFrame, path: str | None = None, *, ids: str = "ids") -> DataFrame:
    """Replaces the array column `ids` by `decoded` (binary). A null array decodes to nothing; null or unknown ids are
    left out of it."""
    path = path or public_tokenizers.path(RANKS)
    rest = [c for c in rows.columns if c.lower() not in (ids.lower(), "decoded")]
    schema = T.StructType([rows.schema[c] for c in rest] + [T.StructField("decoded", T.BinaryType())])

    def run(batches):
        for batch in batches:
            lists = [[i for i in x or [] if i is not None] for x in batch.column(batch.num_columns - 1).to_pylist()]
            counts = np.array([len(x) for x in lists], np.int64)
            tokens = np.array([i for x in lists for i in x], np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(codec(path).decode(tokens, counts), pa.binary())],
                                             names=[*rest, "decoded"])

    return rows.select(*rest, ids).mapInArrow(run, schema)


ADDED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                      T.StructField("decoded_sha256", T.StringType())])


def round_trip(docs: DataFrame, path: str | None = None, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Appends the number of ids, the digest of the ids and the digest of what they decode to; ids stay in the task."""
    path = path or public_tokenizers.path(RANKS)

    def run(texts: list[str]) -> list:
        counts, ids_sha, text_sha, c = [], [], [], codec(path)
        for part in by_chars(texts):
            for ids, n, body in c.run(part):
                counts.append(n)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(body).hexdigest())
        return [counts, ids_sha, text_sha]

    return map_texts(docs, ADDED, run, text=text, keep=keep)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return round_trip(table(spark, sf_dir, "documents"), keep=["doc_id"])
