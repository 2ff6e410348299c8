"""Splitting text where a byte-level BPE pre-tokenizer is certain to split.

The pre-tokenizer pattern matches left to right without look-behind, and no
match that ends in a non-space character continues into white space. So the
position before a space or line feed that follows a non-space character is
always a match boundary, and what follows it tokenizes the same alone as in
the whole text.
"""

from __future__ import annotations

import re

# A run of spaces and line feeds with the characters up to the next run.
_UNITS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# White space other than space and line feed (Python's set contains every
# character that the tokenizers' own \s matches).
_OTHER_SPACE = re.compile(r"[^\S \n]")
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n])")


def units(text: str) -> list[str]:
    """``text`` cut at every safe boundary; joined, the units give ``text`` back."""
    if _OTHER_SPACE.search(text):
        return _BOUNDARY.split(text)
    return _UNITS.findall(text)


def safe_chunks(text: str, size: int) -> list[str]:
    """Chunks of about ``size`` characters, cut only at safe boundaries.

    A stretch without a safe boundary stays whole, however long it is.
    """
    out, start = [], 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        out.append(text[start:cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out
