"""Aliases of a large lexicon, all found in one pass over a text.

A machine of all aliases (Aho-Corasick) is built once on the driver from the alias table and shipped to the workers,
which run it over Arrow batches: the time for a text depends on its length and on what it mentions, not on how many
aliases there are. The boundary test of Latin aliases looks at the characters beside a match.

The alias table is measured before it is read: up to MOST_BYTES it becomes a machine, beyond that `match` takes the
equi-join of `lexicon.match_by_join`, with the same result. An empty alias is no alias.
"""

from __future__ import annotations

import pickle
import sys
import types
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lexicon import is_latin, match_by_join

#: Bytes of all alias rows that may become a machine, which is shipped to every worker and takes about 20 times as much.
MOST_BYTES = 32_000_000
#: Texts and mentions that a worker holds as objects at once.
TEXTS, MENTIONS = 200, 20_000
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")
_COLUMNS = ("dimension", "scope", "alias", "canonical")


class Machine:
    """Two machines, of Latin aliases over lower-cased text and of the others over the text as it is."""

    def __init__(self, aliases):
        import ahocorasick

        self.aliases = sorted(set(aliases) - {""})
        self.latin, self.other = ahocorasick.Automaton(), ahocorasick.Automaton()
        for i, a in enumerate(self.aliases):
            (self.latin if is_latin(a) else self.other).add_word(a, i)
        self.ascii = any(a.isascii() and not is_latin(a) for a in self.aliases)
        self.lengths = [len(a) for a in self.aliases]
        for m in (self.latin, self.other):
            if len(m):
                m.make_automaton()

    def find(self, text: str) -> set[int]:
        """Numbers of the aliases that the text mentions."""
        found: set[int] = set()
        if len(self.latin):
            low, lengths, end_of = text.lower(), self.lengths, len
            last = end_of(low) - 1
            for end, i in self.latin.iter(low):
                if i not in found and (end == last or low[end + 1] not in _LETTERS):
                    begin = end - lengths[i]
                    if begin < 0 or low[begin] not in _LETTERS:
                        found.add(i)
        if len(self.other) and (self.ascii or not text.isascii()):
            found.update(i for _, i in self.other.iter(text))
        return found


class Shipped:
    """A machine as a broadcast value; a worker process opens it once."""

    def __init__(self, spark: SparkSession, entries: list[tuple]):
        machine = Machine(e[2] for e in entries)
        place = {a: i for i, a in enumerate(machine.aliases)}
        meaning: list[list] = [[] for _ in machine.aliases]
        for dimension, scope, alias, canonical in entries:
            if alias:
                meaning[place[alias]].append((dimension, scope, canonical))
        self.key = uuid.uuid4().hex
        self.value = spark.sparkContext.broadcast(pickle.dumps((machine, meaning)))

    def open(self) -> tuple[Machine, list[list]]:
        kept = sys.modules.setdefault("_furrow_machines", types.ModuleType("_furrow_machines")).__dict__
        if self.key not in kept:
            kept[self.key] = pickle.loads(self.value.value)
        return kept[self.key]


def alias_bytes(table: DataFrame) -> int:
    """Size of an alias table's rows, from an aggregate."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in _COLUMNS), F.lit(0))
    return table.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def ship(table: DataFrame, most: int = MOST_BYTES) -> Shipped:
    """The machine of an alias table (dimension, scope, alias, canonical) whose size is within the bound."""
    size = alias_bytes(table)
    if size > most:
        raise ValueError(f"{size} bytes of aliases are too many for a machine (at most {most}): match by join")
    return Shipped(table.sparkSession, [tuple(r) for r in table.select(*_COLUMNS).distinct().collect()])


def few_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most TEXTS."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), TEXTS):
            yield batch.slice(at, TEXTS)


def match_by_automaton(texts: DataFrame, shipped: Shipped, key: str, text: str = "text",
                       scope: str | None = None) -> DataFrame:
    """Distinct (key, dimension, scope, alias, canonical) mentions, in one narrow pass over the texts. With `scope`,
    a column of `texts`, only aliases of that scope count."""
    source = texts.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"),
                          (F.col(scope) if scope else F.lit(None)).cast("string").alias("s"))
    scoped = scope is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, meaning = shipped.open()

        def told(batch, rows, out):
            columns = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())),
                                               *(pa.array(list(c), pa.string()) for c in columns)], names=["k", *_COLUMNS])

        for batch in few_at_once(batches):
            rows, out = [], []
            for at, (t, s) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                for i in machine.find(t):
                    for dimension, where, canonical in meaning[i]:
                        if not scoped or where == s:
                            rows.append(at)
                            out.append((dimension, where, machine.aliases[i], canonical))
                if len(out) >= MENTIONS:
                    yield told(batch, rows, out)
                    rows, out = [], []
            yield told(batch, rows, out)

    schema = T.StructType([T.StructField("k", source.schema["k"].dataType), *(T.StructField(c, T.StringType()) for c in _COLUMNS)])
    return source.mapInArrow(run, schema).withColumnRenamed("k", key)


def match(texts: DataFrame, table: DataFrame, key: str, text: str = "text", scope: str | None = None) -> DataFrame:
    """Mentions of an alias table of any size, by machine or by join. `table` should be stored: it is read twice."""
    if alias_bytes(table) <= MOST_BYTES:
        return match_by_automaton(texts, ship(table), key, text, scope)
    return match_by_join(texts, table, key, text, scope)


#: Facet column and the dimension it is made of.
FACETS = {"subject_slugs": "subject", "topics": "topic", "weather_parameters": "weather", "district_codes": "district"}


def with_facets(df: DataFrame, shipped: Shipped, text: str = "text", state: str | None = None) -> DataFrame:
    """What `lexicon.with_mentions` adds, by machine: sorted distinct canonicals, districts only of the row's state."""
    names = [c for c in FACETS if state or c != "district_codes"]
    kept = [c for c in df.columns if c not in names]
    # columns travel under plain names, so that any name may stand in the input
    source = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text}`").alias("t"),
                       (F.col(f"`{state}`") if state else F.lit(None)).cast("string").alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, meaning = shipped.open()
        for batch in few_at_once(batches):
            lists: list[list] = [[] for _ in names]
            for t, s in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()):
                own: dict[str, set] = {}
                for i in machine.find(t or ""):
                    for dimension, where, canonical in meaning[i]:
                        if dimension != "district" or where == s:
                            own.setdefault(dimension, set()).add(canonical)
                for out, c in zip(lists, names):
                    out.append(sorted(own.get(FACETS[c], ())))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *(pa.array(x, pa.list_(pa.string())) for x in lists)],
                                             names=[*(f"c{i}" for i in range(len(kept))), *names])

    schema = T.StructType([T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(kept)]
                          + [T.StructField(c, T.ArrayType(T.StringType())) for c in names])
    return source.mapInArrow(run, schema).toDF(*kept, *names)


def known_words(texts: DataFrame, vocabulary: DataFrame, key: str, word: str, text: str = "text") -> DataFrame:
    """(key, words): how many different entries of a vocabulary (one column of Latin words) each text mentions."""
    table = vocabulary.select(F.lit("word").alias("dimension"), F.lit("").alias("scope"), F.col(word).alias("alias"),
                              F.col(word).alias("canonical"))
    return match(texts, table, key, text).groupBy(key).agg(F.count("*").alias("words"))
