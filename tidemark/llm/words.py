"""Splitting many texts into words at once, with array operations over their code points.

Two splits are known, those of the tokenizer files: ``plain`` words (letters, single digits, other
characters, white space dropped) and ``spaced`` words (letters, digits, other characters, each with
a space before it, and runs of white space).
"""

from __future__ import annotations

import functools
import re
import unicodedata
from dataclasses import dataclass

import numpy as np

SPACE, LETTER, NUMBER, OTHER, EDGE = range(5)
_QUOTE, _BLANK = ord("'"), ord(" ")
# Longer words are rare and may be anything, so they are never known by their hash.
HASHED = 256
_FACTOR = 0x9E3779B97F4A7C15 | 1


@functools.cache
def character_classes() -> np.ndarray:
    classes = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LN":
            classes[i] = LETTER if kind == "L" else NUMBER
        elif kind == "Z" or i in (9, 10, 11, 12, 13, 0x85):
            classes[i] = SPACE
    return classes


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


# Characters that are worked on at once; only a single word may be longer.
CHUNK = 1 << 17
# Where a text may be cut: white space that begins here belongs to what follows.
_CUT = re.compile(r"[!-~] ")


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept between calls, but for sizes that only very long words need."""
    return _kept_tables(n) if n <= 2 * CHUNK else _power_tables(n)


@functools.cache
def _kept_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _power_tables(n)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(_FACTOR, n), _powers(pow(_FACTOR, -1, 1 << 64), n)


@dataclass(frozen=True)
class Words:
    """Words of consecutive texts: word w is text[starts[w]:ends[w]], text d has the words from
    cuts[d] up to cuts[d + 1]."""

    text: str
    starts: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray
    hashes: np.ndarray

    def word(self, w: int) -> str:
        return self.text[self.starts[w]:self.ends[w]]


def _contractions(codes: np.ndarray, quotes: np.ndarray) -> np.ndarray:
    """Letters of a contraction after each quote: 0, 1 or 2."""
    padded = np.concatenate([codes[:], np.zeros(2, codes.dtype)])
    one, two = padded[quotes + 1], padded[quotes + 2]
    length = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
    for pair in ("re", "ve", "ll"):
        length[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
    return length


def _chunks(text: str, edges: np.ndarray, size: int) -> list[int]:
    """Where to cut the texts, so that each part has about ``size`` characters and splits like the whole."""
    bounds = [0]
    while bounds[-1] + size < len(text):
        aim = bounds[-1] + size
        edge = int(edges[np.searchsorted(edges, aim)]) + 1
        found = _CUT.search(text, aim, edge)
        bounds.append(found.start() + 1 if found else edge)
    if bounds[-1] < len(text):
        bounds.append(len(text))
    return bounds


def split_words(texts: list[str], spaced: bool, chunk: int = CHUNK) -> Words:
    """Takes memory for the words and, of ``chunk`` characters at a time, for each character."""
    text = "\n".join(texts) + "\n"
    edges = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    bounds = _chunks(text, edges, chunk)
    parts = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        inside = edges[np.searchsorted(edges, a):np.searchsorted(edges, b)] - a
        starts, ends, hashes = _split(text[a:b], inside, spaced)
        parts.append((starts + a, ends + a, hashes))
    starts, ends, hashes = (np.concatenate(p) for p in zip(*parts, strict=True))
    cuts = np.append(0, np.searchsorted(starts, edges))
    return Words(text, starts, ends, cuts, hashes)


def _split(text: str, edges: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = character_classes()[codes]
    kinds[edges] = EDGE
    n = len(codes)
    fresh = np.ones(n, bool)
    fresh[1:] = kinds[1:] != kinds[:-1]
    if not spaced:
        fresh |= kinds == NUMBER
    # A contraction begins where a run of other characters does, unless a space is taken along.
    quotes = np.flatnonzero(fresh & (codes == _QUOTE))
    if spaced:
        quotes = quotes[(quotes == 0) | (codes[quotes - 1] != _BLANK) | (kinds[quotes - 1] != SPACE)]
    extra = _contractions(codes, quotes)
    quotes, extra = quotes[extra > 0], extra[extra > 0]
    fresh[quotes + 1] = False
    behind = quotes + extra + 1
    fresh[behind[behind < n]] = True
    if spaced:
        # Of white space before a word, the last character stands alone or, a space, with the word.
        last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & (kinds[1:] != EDGE))
        fresh[last] = True
        fresh[last[codes[last] == _BLANK] + 1] = False
    starts = np.flatnonzero(fresh & (kinds != EDGE))
    bounds = np.append(np.flatnonzero(fresh), n)
    ends = bounds[np.searchsorted(bounds, starts, side="right")]
    if not spaced:
        words = kinds[starts] != SPACE
        starts, ends = starts[words], ends[words]
    return starts, ends, _hashes(codes, starts, ends)


def _hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of each word, from prefix sums of a polynomial; 0 for long words."""
    size = 1 << max(16, (len(codes) + 1).bit_length())
    powers, inverses = power_tables(size)
    mixed = codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= powers[:len(codes)]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed, out=sums[1:])
    found = (sums[ends] - sums[starts]) * inverses[starts]
    found ^= found >> np.uint64(32)
    found *= np.uint64(0x94D049BB133111EB)
    found ^= found >> np.uint64(29)
    found[ends - starts > HASHED] = 0
    return found


def blocks(texts: list[str], most_characters: int = 500_000):
    """Runs of consecutive texts of together about so many characters."""
    begin = held = 0
    for i, text in enumerate(texts):
        held += len(text) + 1
        if held >= most_characters or i + 1 == len(texts):
            yield begin, i + 1
            begin, held = i + 1, 0


def gather(pool: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pool's runs one after the other, and where each begins in the result (with the end)."""
    ends = np.concatenate([[0], lengths.cumsum()])
    return pool[np.arange(ends[-1]) + np.repeat(begins - ends[:-1], lengths)], ends
