"""Brown's class-based bigram model, learnt and scored on whole texts.

P(w | before) = P(class(w) | class(before)) * P(w | class(w)). Every word of the training part has a class of its own
choice; only words that it never has fall back on the class of their last three bytes. Classes are learnt in two steps:

* A start: the MOST_FREQUENT words and GROUPS groups of all other words (by their last three bytes) are items, the end
  of a text is an item and class of its own, and the exchange algorithm (Kneser & Ney 1993) moves items between CLASSES
  classes until a sweep changes little.
* Exchange over all words: one table holds for each word how often words of each class stand left and right of it.
  In each sweep every word goes to the class under which its neighbours are likeliest, all at once, and the classes'
  counts are summed anew, until their likelihood gains less than LEAST_GAIN (at most SWEEPS times). Neighbours have
  the classes of the start in this table. The model's own class bigrams are counted with the classes found.

Smoothing: transitions are backed off to the classes' shares with weight BACKOFF; a class emits a word with
(c + 0.5) / (C + 0.5 * (V + 1)), its V distinct words and one unknown word.

Counts and classes of words are exact and a table. The HEAD most frequent words go to all tasks; they hold most tokens
and all hot words. What is left of each text (its distinct words) is joined with the table, and the text's classes are
written once; bigrams and scores are made from them.

Defined cases: null and empty texts are one end token; a null id counts as the empty text for the fold; repeated rows
count and are scored each; without training rows every count is zero and scores stay finite; an empty table gives no
rows; extra columns are dropped.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.session import settle

from .common import by_chars, fold, small_batches

FOLDS, HELD = 5, 1
MOST_FREQUENT, GROUPS, CLASSES, SWEEPS = 1500, 500, 64, 8
HEAD, FLUSH = 150_000, 300_000
#: Distinct (word, neighbour class) of a task that are merged, and passed on, at the latest.
MERGE, PASS_ON = 3_000_000, 1_500_000
LEAST_GAIN = 1e-3
BACKOFF = 5.0
#: Stands for the end of a text in the table of counts; white space is never part of a word.
END = "\n"


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case, cut at ASCII white space: both are what bytes do by themselves."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) of all rows' words and ends; combined in the task before the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        ends = 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("utf-8", "replace") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "c"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(words_of(text))
                ends += 1
            if len(seen) > FLUSH:
                yield flush()
                seen.clear()
        yield flush()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends], pa.int64())], names=["word", "c"])

    return texts.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> tuple[list[tuple[bytes, int]], int]:
    """All words (not the end) that occur at least so often that they are `most` or fewer; and that bound.

    The bound is the end of a logarithmic bin of counts, so that finding it takes a small histogram and no sort.
    """
    words = counts.filter(F.col("word") != END)
    bins = (words.groupBy(F.floor(F.log2("c") * 16).alias("bin")).agg(F.count("*").alias("n"), F.min("c").alias("least"))
            .orderBy(F.desc("bin")).collect())
    total, bound = 0, 1 << 62
    for b in bins:
        total += b.n
        if total > most:
            break
        bound = b.least
    rows = words.filter(F.col("c") >= bound).toArrow().to_pylist()
    return sorted(((r["word"].encode(), r["c"]) for r in rows), key=lambda x: (-x[1], x[0])), bound


def group_of(word: bytes) -> int:
    return 1 + MOST_FREQUENT + zlib.crc32(word[-3:]) % GROUPS


def group_column(word: Column) -> Column:
    """`group_of` in SQL."""
    body = word.cast("binary")
    last = F.substring(body, F.greatest(F.length(body) - 2, F.lit(1)), F.lit(3))
    return (1 + MOST_FREQUENT + F.crc32(last) % GROUPS).cast("int")


def item_bigrams(texts: DataFrame, items: dict[bytes, int]) -> DataFrame:
    """(pair, n): how often an item follows another, ends included; pair = before * I + after."""
    size = 1 + MOST_FREQUENT + GROUPS
    shared = texts.sparkSession.sparkContext.broadcast(items)  # at most HEAD words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value, np.zeros(size * size, np.int64)
        get = known.get
        for batch in batches:
            sequence = [0]
            for text in batch.column(0).to_pylist():
                sequence += [i if (i := get(w)) is not None else group_of(w) for w in words_of(text)]
                sequence.append(0)
            ids = np.array(sequence, np.int64)
            pairs, n = np.unique(ids[:-1] * size + ids[1:], return_counts=True)
            table[pairs] += n
        pairs = np.nonzero(table)[0]
        for at in range(0, len(pairs), 100_000):
            part = pairs[at: at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(table[part])], names=["pair", "n"])

    return texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each item; item 0 stays alone in class 0. `bigrams` is a dense item by item matrix."""
    items = len(bigrams)
    n = bigrams.sum(axis=1) + bigrams.sum(axis=0)
    order = np.argsort(-n[1:], kind="stable") + 1
    own = np.zeros(items, np.int64)
    own[order] = 1 + np.arange(items - 1) % (classes - 1)
    member = np.eye(classes)[own]
    to, of = bigrams @ member, bigrams.T @ member  # counts from each item to classes, and from classes to each item
    both = member.T @ to
    left, right = bigrams.sum(axis=1), bigrams.sum(axis=0)
    row, col = both.sum(axis=1), both.sum(axis=0)

    def f(x):
        return x * np.log(np.maximum(x, 1e-12))

    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not n[w]:
                continue
            a, r, l, s = own[w], to[w].copy(), of[w].copy(), bigrams[w, w]
            both[a] -= r
            both[:, a] -= l
            both[a, a] += s
            row[a] -= left[w]
            col[a] -= right[w]
            r[a] -= s  # the item itself is in no class now
            l[a] -= s
            gain = (f(both + r[None]) - f(both)).sum(axis=1) + (f(both + l[:, None]) - f(both)).sum(axis=0)
            d = both.diagonal()
            gain += f(d + r + l + s) - f(d + r) - f(d + l) + f(d)
            gain -= f(row + left[w]) - f(row) + f(col + right[w]) - f(col)
            gain[0] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            r[b] += s
            l[b] += s
            both[b] += r
            both[:, b] += l
            both[b, b] -= s
            row[b] += left[w]
            col[b] += right[w]
            if b != a:
                moved += 1
                own[w] = b
                to[:, a] -= bigrams[:, w]
                to[:, b] += bigrams[:, w]
                of[:, a] -= bigrams[w]
                of[:, b] += bigrams[w]
        if moved < items / 200:
            break
    return own


def flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column in one array, and where each row's begin (and the last one's end)."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(body.tobytes(), kind), (at - at[0]) // np.dtype(kind).itemsize


def packed(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The reverse of `flat`."""
    at = (bounds * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(at), pa.py_buffer(values.tobytes())])


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their numbers."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.concatenate([[0], np.nonzero(np.diff(keys))[0] + 1])
    return keys[begins], np.add.reduceat(n[order], begins)


CONTEXTS = "word string, slots binary, ns binary"


def contexts(texts: DataFrame, head: list[bytes], own: np.ndarray, groups: np.ndarray) -> DataFrame:
    """(word, c, slots, ns): how often each word stands, and how often after (slot k) and before (slot CLASSES + k) class k.

    Head words have the classes `own`, others `groups` of their last bytes. A task passes on one row for each of its
    words; rows of a word meet once, as they are sorted.
    """
    width = 2 * CLASSES
    shared = texts.sparkSession.sparkContext.broadcast((head, own.astype(np.int8), groups.astype(np.int8)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own, groups = shared.value
        get = {w: 1 + i for i, w in enumerate(head)}.get
        first, others, found, held = 1 + len(head), {}, [], 0
        base = np.concatenate([np.zeros(1, np.int8), own])
        classes: list[int] = []

        def other(word: bytes) -> int:
            i = others.get(word)
            if i is None:
                i = others[word] = first + len(others)
                classes.append(groups[group_of(word)])
            return i

        def rows(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            names = list(others)
            word = keys // width
            bounds = np.concatenate([[0], np.nonzero(np.diff(word))[0] + 1, [len(word)]])
            slots, n = (keys % width).astype(np.uint8), n.astype(np.int64)
            for at in range(0, len(bounds) - 1, 20_000):
                part = bounds[at: at + 20_001]
                ids = word[part[:-1]].tolist()
                said = [(head[i - 1] if i < first else names[i - first]).decode("utf-8", "replace") for i in ids]
                a, b = part[0], part[-1]
                yield pa.RecordBatch.from_arrays([pa.array(said, pa.string()), packed(slots[a:b], part - a), packed(n[a:b], part - a)],
                                                 names=["word", "slots", "ns"])

        for batch in batches:
            for run in by_chars([t or "" for t in batch.column(0).to_pylist()]):
                sequence = [0]
                for text in run:
                    sequence += [get(w) or other(w) for w in words_of(text)]
                    sequence.append(0)
                ids = np.array(sequence, np.int64)
                of = np.concatenate([base, np.array(classes, np.int8)])[ids]
                at = np.nonzero(ids)[0]
                keys, n = np.unique(np.concatenate([ids[at] * width + of[at - 1], ids[at] * width + CLASSES + of[at + 1]]),
                                    return_counts=True)
                found.append((keys, n))
                held += len(keys)
                if held > MERGE or len(others) > FLUSH:
                    found = [summed(*map(np.concatenate, zip(*found)))]
                    held = len(found[0][0])
                    if held > PASS_ON or len(others) > FLUSH:
                        yield from rows(*found[0])
                        others.clear()
                        classes.clear()
                        found, held = [], 0
        if held:
            yield from rows(*summed(*map(np.concatenate, zip(*found))))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(rows: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
            slots, bounds = flat(rows.column(1), np.uint8)
            n, _ = flat(rows.column(2), np.int64)
            keys, n = summed(np.repeat(np.cumsum(new) - 1, np.diff(bounds)) * width + slots, n)
            word = keys // width
            ends = np.concatenate([[0], np.nonzero(np.diff(word))[0] + 1, [len(word)]])
            slots = (keys % width).astype(np.uint8)
            c = np.add.reduceat(np.where(slots < CLASSES, n, 0), ends[:-1])
            return pa.RecordBatch.from_arrays([rows.column(0).filter(pa.array(new)), pa.array(c), packed(slots, ends), packed(n, ends)],
                                              names=["word", "c", "slots", "ns"])

        parts, held = [], 0

        def whole(last: bool) -> Iterator[pa.RecordBatch]:
            """All words that no later row can have."""
            nonlocal parts, held
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            said = rows.column(0).to_pylist()
            new = np.array([True, *(a != b for a, b in zip(said, said[1:]))])
            cut = len(said) if last else int(np.nonzero(new)[0][-1])
            if cut:
                yield close(rows.slice(0, cut), new[:cut])
            parts, held = ([rows.slice(cut)], len(said) - cut) if cut < len(said) else ([], 0)

        for batch in batches:
            if batch.num_rows:
                parts.append(batch)
                held += batch.num_rows
            if held > 10_000:
                yield from whole(False)
        if held:
            yield from whole(True)

    return (texts.mapInArrow(count, CONTEXTS).repartition("word").sortWithinPartitions("word")
            .mapInArrow(meet, "word string, c long, slots binary, ns binary"))


def side_shares(m: np.ndarray) -> np.ndarray:
    """Logarithms of a slot's share among a class's neighbours on that side; no word may join the end's class."""
    sides = []
    for side in (m[:CLASSES], m[CLASSES:]):
        share = (side.sum(axis=1) + 1) / (side.sum() + CLASSES)
        sides.append(np.log((side + BACKOFF * share[:, None]) / (side.sum(axis=0) + BACKOFF)))
    out = np.concatenate(sides)
    out[:, 0] = -np.inf
    return out


def likelihood(m: np.ndarray) -> float:
    """Log likelihood of all neighbours' classes given the classes of the words."""
    f = lambda x: x * np.log(np.maximum(x, 1e-12))
    return float(f(m).sum() - f(m[:CLASSES].sum(axis=0)).sum() - f(m[CLASSES:].sum(axis=0)).sum())


def best_classes(batch: pa.RecordBatch, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The likeliest class of each row of contexts (the first of equals); slots, numbers and bounds as they were read."""
    slots, bounds = flat(batch.column(2), np.uint8)
    n, _ = flat(batch.column(3), np.int64)
    gain = np.add.reduceat(logs[slots] * n[:, None], bounds[:-1], axis=0)
    return 1 + gain[:, 1:].argmax(axis=1), slots, n, bounds


def sweep(table: DataFrame, logs: np.ndarray) -> np.ndarray:
    """Counts (slot, class) once every word has gone to its best class."""
    shared = table.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, logs = np.zeros(2 * CLASSES * CLASSES, np.int64), shared.value
        for batch in batches:
            if batch.num_rows:
                best, slots, n, bounds = best_classes(batch, logs)
                np.add.at(sums, slots.astype(np.int64) * CLASSES + np.repeat(best, np.diff(bounds)), n)
        at = np.nonzero(sums)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    got = table.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    m = np.zeros(2 * CLASSES * CLASSES)
    m[got["at"].to_numpy()] = got["n"].to_numpy()
    return m.reshape(2 * CLASSES, CLASSES)


def classes_of_words(table: DataFrame, both: np.ndarray) -> DataFrame:
    """(word, c, class) of all words in the table of contexts; `both` are the class bigrams of the start."""
    logs, m = None, np.concatenate([both, both.T])
    m[:, 0] = 0
    for _ in range(SWEEPS):
        tried = side_shares(m)
        got = sweep(table, tried)
        before, after = likelihood(m), likelihood(got)
        if logs is not None and after <= before:
            break
        logs, m = tried, got
        if after - before < LEAST_GAIN * abs(before):
            break
    shared = table.sparkSession.sparkContext.broadcast(logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = best_classes(batch, shared.value)[0] if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best.astype(np.int32))],
                                             names=["word", "c", "class"])

    return table.mapInArrow(run, "word string, c long, class int")


def learn(texts: DataFrame) -> tuple[dict, DataFrame, int]:
    """The classes: what all tasks get, the table (word, c, class), and the least count of words that all tasks get."""
    spark = texts.sparkSession
    small_batches(spark)
    counts = settle(count_words(texts), "word-counts")
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    ends = counts.filter(F.col("word") == END).select("c").first()
    head, bound = frequent(counts, HEAD)
    size = 1 + MOST_FREQUENT + GROUPS
    top = {w: 1 + i for i, (w, _) in enumerate(head[:MOST_FREQUENT])}
    items = {w: top.get(w) or group_of(w) for w, _ in head}
    got = item_bigrams(texts, items).toArrow()  # at most size * size rows
    bigrams = np.zeros(size * size)
    bigrams[got["pair"].to_numpy()] = got["n"].to_numpy()
    bigrams = bigrams.reshape(size, size)
    own = exchange(bigrams, CLASSES, SWEEPS)
    member = np.eye(CLASSES)[own]
    start = np.array([own[items[w]] for w, _ in head], np.int64)
    table = settle(contexts(texts, [w for w, _ in head], start, own), "contexts")
    words = settle(classes_of_words(table, member.T @ bigrams @ member), "word-classes")
    known = words.filter(F.col("c") >= bound).toArrow().to_pylist()
    of = {r["word"].encode(): (r["class"], r["c"]) for r in known}
    number = int(total or 0)
    model = {"head": {w: (i, *of[w]) for i, (w, _) in enumerate(head)}, "own": own, "tokens": number,
             "base": np.log10(number + 0.5 * (distinct + 1)), "ends": ends.c if ends else 0,
             "end": float(np.log10((ends.c if ends else 0) + 0.5)), "end_known": int(bool(ends))}
    return model, words, bound


LOCAL = ("uid long, doc_id long, held_out boolean, n_tokens long, known long, counted double, classes binary, "
         "holes binary, which binary, words array<string>, times array<int>")
FILLED = "doc_id long, held_out boolean, n_tokens long, known long, counted double, classes binary"


def local_classes(docs: DataFrame, model: dict) -> DataFrame:
    """One row per text: its classes, those of words beyond the head by their last bytes, and these words.

    `holes` has the places of such words among the classes, `which` their places in `words`.
    """
    shared = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("head", "own")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        head, own = shared.value["head"], shared.value["own"]
        heads = list(head.values())
        class_of = np.array([h[1] for h in heads] or [0], np.uint8)
        log_c = np.log10(np.array([h[2] for h in heads] or [0], np.float64) + 0.5)
        get = {w: i for i, w in enumerate(head)}.get
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                known = at >= 0
                classes = np.zeros(len(words) + 2, np.uint8)
                classes[1:-1] = class_of[at]
                holes = np.nonzero(~known)[0]
                place: dict[bytes, int] = {}
                which = np.array([place.setdefault(words[i], len(place)) for i in holes.tolist()], np.int32)
                if len(holes):
                    classes[1 + holes] = own[[group_of(w) for w in place]][which]
                out.append((uid, len(words) + 1, int(known.sum()), float(log_c[at[known]].sum() + len(holes) * np.log10(0.5)),
                            classes.tobytes(), (1 + holes).astype(np.int32).tobytes(), which.tobytes(),
                            [w.decode("utf-8", "replace") for w in place], np.bincount(which, minlength=len(place)).tolist()))
                uid += 1
            uids, n, known, counted, classes, holes, which, words, times = zip(*out) if out else [[]] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids, pa.int64()), batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(counted, pa.float64()), pa.array(classes, pa.binary()), pa.array(holes, pa.binary()),
                 pa.array(which, pa.binary()), pa.array(words, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))],
                names=[f.split()[0] for f in LOCAL.split(", ")])

    return docs.mapInArrow(run, LOCAL)


def text_classes(docs: DataFrame, model: dict, words: DataFrame, bound: int) -> DataFrame:
    """doc_id, held_out, n_tokens, known, counted, classes of every text (doc_id, held_out, text), by the table of words."""
    local = settle(local_classes(docs, model), "local")
    rare = (local.select("uid", F.posexplode(F.arrays_zip("words", "times")).alias("pos", "t"))
            .select("uid", "pos", F.col("t.words").alias("word"), F.col("t.times").alias("times")))
    found = rare.join(words.filter(F.col("c") < bound), "word").groupBy("uid").agg(
        F.collect_list(F.col("pos").cast("long") * CLASSES + F.col("class")).alias("put"),
        F.sum(F.col("times") * (F.log10(F.col("c") + 0.5) - F.log10(F.lit(0.5)))).alias("more"),
        F.sum("times").alias("also"))
    rows = local.drop("words", "times").join(found, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("known"),
        (F.col("counted") + F.coalesce("more", F.lit(0.0))).alias("counted"), "classes", "holes", "which", "put")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for classes, holes, which, put in zip(*(batch.column(k).to_pylist() for k in (5, 6, 7, 8))):
                if put:
                    put, which = np.array(put), np.frombuffer(which, np.int32)
                    fill = np.full(which.max() + 1, -1)
                    fill[put // CLASSES] = put % CLASSES
                    seen = fill[which] >= 0
                    body = np.frombuffer(classes, np.uint8).copy()
                    body[np.frombuffer(holes, np.int32)[seen]] = fill[which[seen]]
                    classes = body.tobytes()
                out.append(classes)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.binary())],
                                             names=[f.split()[0] for f in FILLED.split(", ")])

    return rows.mapInArrow(run, FILLED)


def finish(model: dict, words: DataFrame, texts: DataFrame) -> dict:
    """The model with moves and emits; `texts` has the classes of all training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            all_of, bounds = flat(batch.column(0), np.uint8)
            pairs = all_of[:-1].astype(np.int64) * CLASSES + all_of[1:]
            inside = np.ones(len(pairs), bool)
            inside[bounds[1:-1] - 1] = False  # the step from one text to the next
            sums += np.bincount(pairs[inside], minlength=len(sums))
        at = np.nonzero(sums)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    got = texts.select("classes").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros(CLASSES * CLASSES)
    both[got["at"].to_numpy()] = got["n"].to_numpy()
    both = both.reshape(CLASSES, CLASSES)
    v, n = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in words.groupBy("class").agg(F.count("*").alias("v"), F.sum("c").alias("n")).collect():
        v[r["class"]], n[r["class"]] = r.v, r.n
    v[0], n[0] = 1, model["ends"]
    share = (n + 1) / (n.sum() + CLASSES)
    moves = np.log10((both + BACKOFF * share[None]) / (both.sum(axis=1, keepdims=True) + BACKOFF))
    emits = np.log10(n + 0.5 * (v + 1))
    emits[0] = 0  # the end is certain in its class
    return {**model, "moves": moves, "emits": emits}


def train(texts: DataFrame) -> tuple[dict, DataFrame, int]:
    """The whole model, the table (word, c, class) of all words, and the least count of words that the model itself has."""
    model, words, bound = learn(texts)
    rows = texts.select(F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), F.col(texts.columns[0]).alias("text"))
    return finish(model, words, text_classes(rows, model, words, bound)), words, bound


SCORED = "doc_id long, held_out boolean, n_tokens long, known long, counted double, structure double"


def score_texts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    held = (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out")
    model, words, bound = learn(rows.filter(~held).select("text"))
    texts = settle(text_classes(rows.select("doc_id", held, "text"), model, words, bound), "text-classes")
    model = finish(model, words, texts.filter(~F.col("held_out")))
    moves, emits = model["moves"], model["emits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            structure = []
            for body in batch.column(5).to_pylist():
                classes = np.frombuffer(body, np.uint8)
                structure.append(float(moves[classes[:-1], classes[1:]].sum() - emits[classes[1:-1]].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(structure, pa.float64())],
                                             names=[f.split()[0] for f in SCORED.split(", ")])

    # the end has a count of its own in the baseline; in the model it is certain in its class
    return (texts.mapInArrow(run, SCORED).select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + model["end_known"]).alias("n_known"),
        F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        (F.col("counted") + model["end"] - F.col("n_tokens") * float(model["base"])).alias("base_score"),
        (F.col("counted") + F.col("structure")).alias("score"))
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))


def op5_class_lm(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return score_texts(table(spark, sf_dir, "documents"))
