"""Splitting text before byte-level merges, over whole batches of texts at once.

The boundaries are those of `public_tokenizers.PATTERN`, found from character classes with numpy:
a piece is a run of letters, of numbers or of other characters with at most one space before it,
a contraction, or white space. A run of white space before other text leaves its last character
to stand alone, or to lead the next piece if it is a plain space.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: The endings that the pattern keeps together with an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@cache
def classes() -> np.ndarray:
    """Class of each code point."""
    every = "".join(map(chr, range(0x110000)))
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = kind
    return table


@cache
def blanks() -> frozenset[str]:
    return frozenset(map(chr, np.flatnonzero(classes() == SPACE).tolist()))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def boundaries(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Offsets at which a piece begins, in texts laid end to end.

    points: the code points of all texts; starts: the offset of each text that isn't empty.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True
    cut = first[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # white space with text of the same document behind it
    lead = np.zeros(n, bool)
    lead[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    cut |= lead
    plain = lead & (points == 32)
    at = np.flatnonzero(plain) + 1
    cut[at] = False
    _contractions(points, kind, first, cut)
    return np.flatnonzero(cut)


def _contractions(points, kind, first, cut) -> None:
    quote = np.flatnonzero((points == 39) & cut[: len(points)])
    if not len(quote):
        return
    n = len(points)
    for ending in CONTRACTIONS:
        fits = quote[quote + len(ending) < n]
        for i, c in enumerate(ending, 1):
            fits = fits[(points[fits + i] == ord(c)) & ~first[fits + i]]
        for i in range(1, len(ending) + 1):
            cut[fits + i] = False
        after = fits + len(ending) + 1
        cut[after[after < n]] = True


def split(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All pieces in order, the offset of each piece, and each text's number of pieces."""
    joined = "".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    cuts = boundaries(code_points(joined), offsets[:-1][lengths > 0])
    ends = np.append(cuts[1:], len(joined)).tolist()
    pieces = [joined[a:b] for a, b in zip(cuts.tolist(), ends)] if len(cuts) else []
    counts = np.diff(np.searchsorted(cuts, offsets))
    return pieces, cuts, counts
