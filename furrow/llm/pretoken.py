"""Cut texts into pieces that byte-level BPE treats independently, fast enough for whole corpora.

The public pattern never lets a match cross the place before a single space that is followed by something else than
white space, nor either side of a single line feed between two such characters. Texts whose only white space is of
that kind are cut there (many pieces repeat, so their tokens can be kept); any other text is cut into the pattern's
matches themselves.

A piece is a dictionary key: `word` stands for the text " word"; "\\nword" for itself; a tuple `(s,)` for s as it is.
"""

from __future__ import annotations

import public_tokenizers
import regex

MATCHES = regex.compile(public_tokenizers.PATTERN)
#: White space other than the blank and the line feed, and runs of these two.
ODD = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"] + ["  ", "\n\n", " \n", "\n "]


def is_odd(text: str) -> bool:
    """Whether the text has white space of another kind than the pieces allow."""
    return bool(text) and (text[0] in " \n" or text[-1] in " \n" or any([o in text for o in ODD]))


def pieces(text: str) -> list:
    if not text:
        return []
    if is_odd(text):
        return [(m,) for m in MATCHES.findall(text)]
    out = text.replace("\n", " \n").split(" ")
    out[0] = (out[0],)
    return out


def text_of(piece) -> str:
    if type(piece) is tuple:
        return piece[0]
    return piece if piece[0] == "\n" else " " + piece
