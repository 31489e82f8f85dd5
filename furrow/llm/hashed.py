"""Tokens of many texts at once as hash values, in numpy: the input of the hashed classifiers.

A token is a run of letters, of digits, or of other characters that are not white space; a line feed is a token of
the last kind by itself. Hashes are of the lower-cased characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from .common import mix64, per_worker

LETTER, DIGIT, SYMBOL = 1, 2, 3
_BMP = 1 << 16


def _tables() -> list[np.ndarray]:
    """Class, lower case, hash value and upper case of each character of the basic plane; powers for the places."""
    return per_worker("characters", _make_tables)


def _make_tables() -> list[np.ndarray]:
    chars = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(_BMP)]
    kind = np.array([LETTER if c.isalpha() else DIGIT if c.isnumeric() else 0 if c.isspace() else SYMBOL
                     for c in chars], np.uint8)
    kind[10] = SYMBOL
    lower = np.array([ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars], np.uint32)
    value = mix64(lower.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    upper = np.array([c.isupper() for c in chars], bool)
    return [kind, lower, value, upper, mix64(np.arange(1, 65, dtype=np.uint64) << np.uint64(7)) | np.uint64(1)]


@dataclass
class Tokens:
    """`doc` ascends; `upper` tells tokens whose letters are all upper case, `first` those that begin so."""

    doc: np.ndarray
    hash: np.ndarray
    kind: np.ndarray
    size: np.ndarray
    upper: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    chars: np.ndarray  # lower-cased code points of all texts


def tokens(texts: list[str]) -> Tokens:
    kind_of, lower_of, value_of, upper_of, powers = _tables()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    cp = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = np.minimum(cp, _BMP - 1)
    kind = kind_of[cp]
    new = np.empty(len(cp), bool)
    new[:1] = True
    new[1:] = kind[1:] != kind[:-1]
    feed = cp == 10
    new |= feed
    new[1:] |= feed[:-1]
    begins = np.nonzero(new)[0]
    run = np.diff(np.append(begins, len(cp)))
    value = value_of[cp] * powers[(np.arange(len(cp)) - np.repeat(begins, run)) & 63]
    value[kind == 0] = 0
    hashes = mix64(np.add.reduceat(value, begins))
    capital = np.add.reduceat(upper_of[cp].astype(np.int32), begins)
    real = kind[begins] > 0
    begins, run, hashes, capital = begins[real], run[real], hashes[real], capital[real]
    doc = np.searchsorted(np.cumsum(sizes + 1), begins, "right")
    return Tokens(doc, hashes, kind[begins], run, capital == run, upper_of[cp[begins]], begins, lower_of[cp])


def prefix_hash(t: Tokens, length: int) -> np.ndarray:
    """Hash of each token's first `length` characters (of the token, if it is shorter)."""
    return next(prefix_hashes(t, (length,)))


def prefix_hashes(t: Tokens, lengths: tuple[int, ...], among: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """`prefix_hash` for ascending lengths, each going on from the sum of the one before, of the tokens `among` (all)."""
    _, _, value_of, _, powers = _tables()
    starts, sizes = (t.starts, t.size) if among is None else (t.starts[among], t.size[among])
    total, k = np.zeros(len(starts), np.uint64), 0
    for length in lengths:
        while k < length:
            at = np.minimum(starts + k, len(t.chars) - 1)
            total += np.where(k < sizes, value_of[t.chars[at]] * powers[k], np.uint64(0))
            k += 1
        yield mix64(total + np.uint64(length))
