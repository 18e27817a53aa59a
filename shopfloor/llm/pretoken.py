"""Splits text the way byte-level vocabularies do before merging, with arrays instead of a regex.

The split equals all matches of ``PATTERN``: characters are sorted into letters, numbers, white space
and others; a piece is a run of one sort with at most one space before it; of white space before
another character the last goes by itself or with what follows; and an apostrophe takes the endings
s, t, re, ve, m, ll, d along when it begins a piece.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import regex

#: Fixed value, which the vocabularies come with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OTHER, LETTER, NUMBER, SPACE = range(4)
BLOCK_CHARS = 1 << 20
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


@lru_cache(maxsize=1)
def sorts() -> np.ndarray:
    codes = np.arange(0x110000, dtype="<u4")
    codes[0xD800:0xE000] = 32
    every = codes.tobytes().decode("utf-32-le")  # a string of each character would take 80 MB for the moment
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, those in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(those, every):
            table[found.start():found.end()] = kind
    return table


def blocks(text: str):
    """Parts of a long text, cut where a piece begins in any case."""
    at = 0
    while len(text) - at > BLOCK_CHARS and (cut := _CUT.search(text, at + BLOCK_CHARS)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def split(text: str) -> list[str]:
    out: list[str] = []
    for block in blocks(text):
        if block:
            out += split_block(block)
    return out


def split_block(text: str) -> list[str]:
    char = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    sort = sorts()[char]
    n = len(char)
    begins = np.ones(n, bool)
    begins[1:] = sort[1:] != sort[:-1]
    after_space = np.flatnonzero((sort[1:] != SPACE) & (sort[:-1] == SPACE)) + 1
    begins[after_space - 1] = True
    begins[after_space] = char[after_space - 1] != 32
    at = np.flatnonzero(char == 39)
    if len(at):
        at = at[at + 1 < n]
        at = at[begins[at] & (sort[at + 1] == LETTER)]
        first, second = char[at + 1], np.where(at + 2 < n, char[np.minimum(at + 2, n - 1)], 0)
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = (first == ord("r")) & (second == ord("e")) | (first == ord("v")) & (second == ord("e")) \
            | (first == ord("l")) & (second == ord("l"))
        at, size = at[one | two], np.where(one, 2, 3)[one | two]
        begins[at + 1] = False
        begins[(at + size)[at + size < n]] = True
    start = np.flatnonzero(begins).tolist()
    return [text[a:b] for a, b in zip(start, [*start[1:], n], strict=True)]
