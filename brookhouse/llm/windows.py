"""Hashes of all windows of consecutive words as numpy arrays, and the anchor of each window.

Words are runs of bytes other than space and \\t..\\r, unchanged. A word's hash is a polynomial over its bytes, a window's a
polynomial over its words, both taken from prefix sums modulo 2**64, so that a window costs the same at any length.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np

from brookhouse.llm.words import BYTE_VALUES, STEP, Texts, mix

BASE, BASE_2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


class Windows(NamedTuple):
    rows: np.ndarray  # the row of each window
    starts: np.ndarray  # its first word, counted in the row
    h1: np.ndarray
    h2: np.ndarray
    anchors: np.ndarray  # hash of its anchor
    marks: np.ndarray  # a hash for each place where an anchor stands


#: Bytes of text worked on at once, and the longest table of powers that a worker keeps (2**KEPT_BITS).
SLICE_BYTES = 1 << 20
KEPT_BITS = 21


def _powers(base: int, bits: int) -> np.ndarray:
    """base**0 .. base**(2**bits - 1) modulo 2**64."""
    steps = np.full(1 << bits, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_kept_powers = lru_cache(maxsize=8)(_powers)


def powers(base: int, n: int) -> np.ndarray:
    bits = max(n - 1, 1).bit_length()
    return (_kept_powers if bits < KEPT_BITS else _powers)(base, bits)[:n]


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hashes of values[start:end], the same wherever the span stands."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(pow(base, -1, 1 << 64), len(values) + 1)[starts]


def plain_hashes(t: Texts) -> np.ndarray:
    """A 64-bit hash of each word as it stands, upper and lower case apart."""
    if not len(t.starts):
        return np.zeros(0, np.uint64)
    return mix(spans(BYTE_VALUES[t.raw], t.starts, t.ends, BASE) + (t.ends - t.starts).astype(np.uint64) * STEP)


def _sliding(values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """`pick` (minimum or maximum) of each n values that follow each other, by doubling."""
    out, width = values, 1
    while width < n:
        step = min(width, n - width)
        out = pick(out[:-step], out[step:])
        width += step
    return out


def windows(t: Texts, n_words: int, anchor_words: int) -> Windows:
    """All windows of `n_words` words of the rows, in order. A window's anchor is its span of `anchor_words` words with the
    least hash; equal windows have equal anchors at equal places, so `marks` hold an anchor at least as often as there
    are places of any window that has it.
    """
    words = plain_hashes(t)
    if len(words) < n_words:
        empty = np.zeros(0, np.int64)
        return Windows(empty, empty, *[np.zeros(0, np.uint64)] * 4)
    first = np.arange(len(words) - n_words + 1)
    whole = t.row_of_word[first] == t.row_of_word[first + n_words - 1]
    at = first[whole]
    h1, h2 = (mix(spans(words, at, at + n_words, base)) for base in (BASE, BASE_2))
    every = np.arange(len(words) - anchor_words + 1)
    hashes = mix(spans(words, every, every + anchor_words, BASE_2)) | np.uint64(1)
    inside = n_words - anchor_words  # spans of a window but one
    least = np.where(whole, _sliding(hashes, inside + 1, np.minimum), np.uint64(0))
    edge = np.zeros(inside, np.uint64)
    chosen = _sliding(np.concatenate([edge, least, edge]), inside + 1, np.maximum) == hashes  # by some window around the span
    rows = t.row_of_word[at]
    return Windows(rows, at - t.word_starts[rows], h1, h2, least[at], hashes[chosen])
