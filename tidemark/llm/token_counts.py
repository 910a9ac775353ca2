"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

The last token of a prefix is the one token ending there that may follow the last token of the
shorter prefix before it, so one pass over a pre-token gives the count at each of its prefixes.
Counts are kept per character as differences of one byte. They answer how many tokens a text cut
anywhere has, and how much of it fits a budget, without encoding again.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pretokens
from tidemark.llm.common import mapped, texts_of

_SLICE = 1_000_000
_REMEMBERED = 200_000
_PAIRS_REMEMBERED = 300_000
NEVER = 1 << 30


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files of this kind."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Prefixes:
    """Counts at the prefixes of pre-tokens, remembered up to a bound."""

    def __init__(self, vocabulary_path: str):
        with open(vocabulary_path, encoding="utf-8") as file:
            spec = json.load(file)
        raw = _byte_letters()
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        as_bytes = lambda s: bytes(raw[c] for c in s)
        self.ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        #: the lengths of the tokens that end in each byte, longest first
        lengths: list[set[int]] = [set() for _ in range(256)]
        for t in self.ids:
            lengths[t[-1]].add(len(t))
        self.lengths = [sorted(x, reverse=True) for x in lengths]
        #: rank of a merge by its two ids; how a token was made
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            a, b, whole = self.ids[left], self.ids[right], self.ids[left + right]
            self.merges[a, b] = rank
            self.parts.setdefault(whole, (rank, a, b))
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stood at one edge of a token while it was merged, first to last, each
        with the rank at which the next took its place. side: 1 left, 2 right."""
        steps, until = [], NEVER
        while True:
            steps.append((token, until))
            if token not in self.parts:
                return steps[::-1]
            until, token = self.parts[token][0], self.parts[token][side]

    def follows(self, left: int, right: int) -> bool:
        """Whether encoding the bytes of both tokens gives just these two."""
        found = self.fits.get((left, right))
        if found is None:
            if len(self.fits) >= _PAIRS_REMEMBERED:
                self.fits.clear()
            found = self.fits[left, right] = self._follows(left, right)
        return found

    def _follows(self, left: int, right: int) -> bool:
        a, b = self.edge(left, 2), self.edge(right, 1)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            across = self.merges.get((x, y), NEVER)
            # of equal merges the leftmost goes first
            if across < x_until and across <= y_until and across < NEVER:
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def counts(self, piece: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters of a pre-token."""
        data = piece.encode()
        get, fits, follows, lengths = self.ids.get, self.fits.get, self.follows, self.lengths
        last, count = [-1], [0]
        for end in range(1, len(data) + 1):
            for size in lengths[data[end - 1]]:
                start = end - size
                if start > 0:
                    token = get(data[start:end])
                    if token is None or not (fits((last[start], token)) or follows(last[start], token)):
                        continue
                elif start < 0 or (token := get(data[:end])) is None:
                    continue
                last.append(token)
                count.append(count[start] + 1)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")
        if len(data) == len(piece):
            out = count[1:]
        else:
            at, out = 0, []
            for c in piece:
                at += len(c.encode())
                out.append(count[at])
        if piece[0] == "'" and piece[1:] in pretokens.CONTRACTIONS and len(piece) == 3:
            out[1] = 2  # half a contraction is an apostrophe and a letter
        return out

    @staticmethod
    def differences(counts: list[int]) -> bytes:
        return bytes([(b - a) & 255 for a, b in zip([0, *counts], counts)])

    def new(self, piece: str) -> bytes:
        """Of a pre-token that isn't among the recent ones; those before them are kept once more."""
        if len(self.known) >= _REMEMBERED:
            self.known, self.before = {}, self.known
        deltas = self.known[piece] = self.before.get(piece) or self.differences(self.counts(piece))
        return deltas

    def deltas(self, texts: list[str]) -> list[bytes]:
        """Per text one signed byte per character: by how much it changes the count."""
        units, shape = [], []
        for text in texts:
            parts = [text]
            for s in self.special:
                parts = [y for x in parts for y in _around(x, s)]
            shape.append(parts)
            units += [p[0] + p[1][:-1] if isinstance(p, tuple) else p for p in parts]
        found = iter(self._deltas(units))
        out = []
        for parts in shape:
            whole = []
            for p in parts:
                d = next(found)
                if isinstance(p, tuple):  # text, then a special string whose last character makes it one token
                    own = np.frombuffer(d, np.int8).astype(np.int64)
                    d += np.array([own[: len(p[0])].sum() + 1 - own.sum()], np.int8).tobytes()
                whole.append(d)
            out.append(b"".join(whole) if len(whole) != 1 else whole[0])
        return out

    def _deltas(self, texts: list[str]) -> list[bytes]:
        pieces, cuts, counts = pretokens.split(texts)
        new = self.new
        joined = b"".join([self.known.get(p) or new(p) for p in pieces])
        ends = np.cumsum([0, *map(len, texts)]).tolist()
        blanks = pretokens.blanks()
        last_pieces = set((np.cumsum(counts) - 1).tolist())
        # A cut just behind the last blank of a run makes the run one piece again.
        runs = [i for i, p in enumerate(pieces) if p[-1] in blanks and i not in last_pieces and pieces[i + 1][0] in blanks]
        if runs:
            changed = np.frombuffer(joined, np.int8).copy()
            for i in runs:
                at, run = int(cuts[i + 1]), pieces[i] + pieces[i + 1][0]
                own = self.counts(run)
                by = own[-1] - own[-2] - int(changed[at])
                changed[at] += by
                changed[at + 1] -= by
            joined = changed.tobytes()
        return [joined[a:b] for a, b in zip(ends, ends[1:])]


def _around(text: str | tuple[str, str], special: str) -> list:
    if isinstance(text, tuple) or special not in text:
        return [text]
    *before, rest = text.split(special)
    return [*((b, special) for b in before), rest]


@cache
def prefixes(vocabulary_path: str) -> Prefixes:
    return Prefixes(vocabulary_path)


def prefix_counts(df: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """All rows and columns, with n_bytes, n_tokens and prefix_deltas.

    prefix_deltas holds one signed byte per character; the sum of its first k is the exact number
    of tokens of the text's first k characters, and n_tokens is the whole sum. A null text counts
    as empty. Special strings inside a text are one token, as the library takes them by default.
    Columns of these names are replaced; repeated rows stay.
    """

    def run(part):
        texts = texts_of(part, "_text")
        deltas = prefixes(vocabulary_path).deltas(texts)
        tokens = [int(np.frombuffer(d, np.int8).sum(dtype=np.int64)) for d in deltas]
        return [pc.fill_null(pc.binary_length(part["_text"]), 0).cast("int64"), tokens, deltas]

    return mapped(df, text, _SLICE, {"n_bytes": "long", "n_tokens": "long", "prefix_deltas": "binary"}, run)


def count_at(position: int) -> Column:
    """Tokens of the first `position` characters, from prefix_deltas."""

    @F.pandas_udf("long")
    def counted(deltas: pd.Series) -> pd.Series:
        return deltas.map(lambda d: int(np.frombuffer(d[:position], np.int8).sum(dtype=np.int64)))

    return counted("prefix_deltas")


def within_budget(df: DataFrame, tokens: int, out: str = "fit_chars") -> DataFrame:
    """Adds the length in characters of the longest prefix of at most so many tokens."""

    @F.pandas_udf("long")
    def longest(deltas: pd.Series) -> pd.Series:
        def one(d: bytes) -> int:
            fits = np.flatnonzero(np.cumsum(np.frombuffer(d, np.int8), dtype=np.int64) <= tokens)
            return int(fits[-1]) + 1 if len(fits) else 0

        return deltas.map(one)

    return df.withColumn(out, longest("prefix_deltas"))
