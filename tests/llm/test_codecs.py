"""Encoding, packing and fingerprints against libraries and brute force."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from furrow.llm import bpe, fingerprint, packing
from furrow.llm.piecetable import PieceTable
from furrow.llm.pretoken import MATCHES, pieces, text_of

DOC = "doc_id long, text string"
LETTERS = list("abZ19 \n\t\r'.,!é 　\x1c\x85中½²_-😀\\") + ["'s", " '", "\n\n", "  ", " the", "ing", "<|endoftext|>"]


def random_texts(n, seed=1):
    rnd = random.Random(seed)
    made = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]
    plain = [" ".join(rnd.choice(["a", "b.", "c\nd", "'s", "thing,", "é"]) for _ in range(rnd.randint(1, 9))) for _ in range(n)]
    return made + plain


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.RANKS), "rb"))}


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(P.path(packing.VOCABULARY))
    t.encode_special_tokens = True
    return t


def test_pieces_are_independent(reference):
    for t in random_texts(1500, 3):
        matches = [m for p in pieces(t) for m in MATCHES.findall(text_of(p))]
        assert matches == MATCHES.findall(t)


def test_recursive_queries_give_the_library_s_ids(reference):
    texts = random_texts(800) + ["a" * 1000, "ab" * 500, "=" * 333, "漢" * 300, "x" * 20001]
    for t, (ids, n, body) in zip(texts, bpe.codec(P.path(bpe.RANKS)).run(texts)):
        want = reference.encode_ordinary(t)
        assert ids == " ".join(map(str, want)) and n == len(want) and body == t.encode()


def test_what_is_forgotten_is_encoded_again(monkeypatch, reference):
    monkeypatch.setattr(bpe, "KEPT", 4)
    codec, texts = bpe.Codec(P.path(bpe.RANKS)), random_texts(20, 9)
    for _ in range(3):
        for t in texts:
            assert codec.run([t])[0][1] == len(reference.encode_ordinary(t))


def test_encode_and_decode_tables(spark, reference, ranks):
    texts = [*random_texts(30, 5), "", None, "a b", "a b"]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], DOC + ", ids string")
    encoded = bpe.encode(rows)
    assert encoded.columns == ["doc_id", "text", "ids"]  # the input's own `ids` gives way
    for r in bpe.decode(encoded).collect():
        assert bytes(r.decoded) == (r.text or "").encode()
    for r in encoded.collect():
        assert r.ids == reference.encode_ordinary(r.text or "")
    for r in bpe.round_trip(rows, keep=["doc_id"]).collect():
        t = texts[r.doc_id] or ""
        ids = reference.encode_ordinary(t)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    odd = spark.createDataFrame([(1, [None, 257, 99999999]), (2, None), (3, [])], "k int, ids array<int>")
    two = next(b for b, rank in ranks.items() if rank == 257)
    assert sorted((r.k, bytes(r.decoded)) for r in bpe.decode(odd).collect()) == [(1, two), (2, b""), (3, b"")]
    assert bpe.round_trip(rows.limit(0)).count() == 0


def test_tokenizer_ids_by_pieces(tokenizer):
    encoder, texts = packing.encoder(P.path(packing.VOCABULARY)), random_texts(800, 7)
    for t, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_piece_table_survives_equal_hashes(monkeypatch):
    from furrow.llm import piecetable

    monkeypatch.setattr(piecetable, "mix64", lambda x: np.zeros(len(x), np.uint64))  # every hash is the same
    table = PieceTable(lambda ps: [list(p.strip(b"\xff")) for p in ps])
    buffer = b"\xffab cd\nef\xffab\xff"
    for _ in range(2):
        ids, counts, begins = table.look_up(np.frombuffer(buffer, np.uint8))
        assert bytes(ids.astype(np.uint8)) == b"ab cd\nefab"
        assert counts.tolist() == [2, 3, 3, 2, 0] and begins.tolist() == [True, False, False, True, True]


def packed(spark, texts, ids=None):
    rows = spark.createDataFrame([(i if ids is None else ids[i], t, 0) for i, t in enumerate(texts)], DOC + ", offset int")
    return packing.pack(rows.coalesce(1)).toPandas()


def check_pieces(found, texts, tokenizer):
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in found[found.doc_id == i].sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at: at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for _, s in found.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]]
        total = s.length.sum()
        assert total <= 2048 and s.padded.iloc[0] == (0 if total & (total - 1) == 0 else 2048 - total)


def test_pieces_hold_every_id_once(spark, tokenizer):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["word", "other.", "thing,", "Long\nline!"]) for _ in range(rnd.randint(0, 900))) for _ in range(60)]
    texts += ["", None, "z" * 9000, "no end " * 4000]
    found = packed(spark, texts)
    check_pieces(found, texts, tokenizer)
    assert found.groupby("sequence_id").padded.first().sum() <= 0.01 * found.length.sum() + 2048 * 8  # a rest for each partition
    assert found.sequence_id.nunique() <= 1.02 * found.length.sum() / 2048 + 8


def test_runs_join_without_loss(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 5000)
    texts = ["a few words. " * 300] * 12
    check_pieces(packed(spark, texts), texts, tokenizer)


def test_packing_edges(spark):
    empty = spark.createDataFrame([], DOC)
    assert packing.pack(empty).count() == 0
    found = packed(spark, ["same", "same", None], ids=[None, None, 5])
    assert len(found) == 3 and sorted(found.doc_tokens) == [1, 2, 2]


@pytest.mark.parametrize("short", [0, 3, 512])
def test_cheapest_cuts_equal_exhaustive_search(monkeypatch, short):
    monkeypatch.setattr(packing, "SHORT", short)
    rng = np.random.default_rng(2)
    window = lambda n: min(16 - n, short if n & (n - 1) == 0 and n < 16 else 16)
    for _ in range(60):
        places = [0, *np.unique(rng.integers(1, 60, 12)).tolist(), 61]
        penalty = [0, *rng.choice([0, 1, 8], len(places) - 2).tolist(), 0]
        cost = {0: 0.0}
        for at, j in enumerate(places[1:], 1):
            options = [cost[i] + window(j - i) for i in places[:at] if i in cost and j - i <= 16]
            if options:
                cost[j] = min(options) + (penalty[at] if j != 61 else 0)
        if 61 not in cost:
            continue
        cuts = packing.cuts_of(places, penalty, 16, True)
        extra, total, before = dict(zip(places, penalty)), 0, 0
        for c in cuts:
            n = c - before
            total += window(n) + (extra[c] if c != 61 else 0)
            before = c
        assert total == cost[61]


def brute_chunks(text: bytes):
    """Boundaries by rolling the hash byte by byte."""
    f, h, start, out = fingerprint, 0, 0, set()
    import xxhash

    for i, b in enumerate(text):
        h = ((h << 1) + int(f.GEAR[b])) & 0xFFFFFFFF
        if i >= f.WINDOW:
            h = (h - (int(f.GEAR[text[i - f.WINDOW]]) << f.WINDOW)) & 0xFFFFFFFF
        n = i + 1 - start
        cut = n >= f.LEAST and (h >> 32 - f.STRICT == 0 if n <= f.NORMAL else h >> 32 - f.LOOSE == 0) or n == f.MOST
        if cut or i + 1 == len(text):
            out.add((xxhash.xxh64_intdigest(text[start: i + 1]) >> 16) << 12 | n)
            start = i + 1
    return out


def test_chunks_equal_a_rolling_hash():
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abcdefgh é.\n") for _ in range(rnd.randint(0, 900))).encode() for _ in range(60)] + [b"", b"a" * 1000]
    assert fingerprint.chunk_sets(texts) == [brute_chunks(t) for t in texts]


def test_fingerprint_pairs(spark):
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    texts = {i: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 300))) for i in rnd.sample(range(1000), 70)}
    texts |= {1001: "", 1002: "x", 1003: texts[min(texts)]}
    rows = [(i, t or None, "n") for i, t in texts.items()]
    got = fingerprint.fingerprint_pairs(spark.createDataFrame(rows, DOC + ", fingerprint string").repartition(5)).collect()
    assert len(got) == len(texts)
    order = sorted(texts, reverse=True)
    after = dict(zip(order, [*order[1:], order[0]]))
    own = {i: fingerprint.chunk_sets([t.encode()])[0] for i, t in texts.items()}
    for r in got:
        t, n = texts[r.doc_id], texts[after[r.doc_id]]
        new = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        changed = fingerprint.chunk_sets([new.encode()])[0]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert fingerprint.from_string(r.fingerprint) == own[r.doc_id] and fingerprint.from_string(r.edited_fingerprint) == changed
        assert r.near_edited == fingerprint.containment(own[r.doc_id], changed)
        assert r.near_next == fingerprint.containment(own[r.doc_id], own[after[r.doc_id]])
        if len(t) > 400 and len(n) > len(t) // 2:
            assert 0.3 < r.near_edited < 0.7


def test_fingerprint_pair_edges(spark):
    pairs = fingerprint.fingerprint_pairs
    assert pairs(spark.createDataFrame([], DOC)).count() == 0
    one = pairs(spark.createDataFrame([(3, "abcdef")], DOC)).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    same = pairs(spark.createDataFrame([(3, "b"), (3, "a"), (None, "c"), (None, None), (9, "b")], DOC)).collect()
    assert len(same) == 5 and sum(r.doc_id is None for r in same) == 2
    assert len({r.fingerprint for r in same if r.n_chars == 1}) == 3
    assert len(pairs(spark.createDataFrame([(None, "c"), (None, "d")], DOC)).collect()) == 2
