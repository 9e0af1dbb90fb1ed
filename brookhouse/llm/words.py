"""Words and word shingles of whole Arrow batches as numpy arrays, without a Python loop over words.

A word is a run of bytes other than space and \\t..\\r; A-Z are lower-cased. Words and shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_random = np.random.default_rng(20240229)
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)


class Texts(NamedTuple):
    """Some rows of a batch: rows first..last, their bytes, and where their words start and end in them."""

    first: int
    last: int
    raw: np.ndarray
    row_starts: np.ndarray  # in bytes, one more than rows
    starts: np.ndarray
    ends: np.ndarray
    row_of_word: np.ndarray
    words_of_row: np.ndarray
    word_starts: np.ndarray  # in words, one more than rows


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """The rows of a string column in slices of about `slice_bytes`; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + slice_bytes, "right")) - 1)
        at = offsets[first : last + 1] - offsets[first]
        yield _words(first, last, data[offsets[first] : offsets[last]], at)
        first = last


def _words(first: int, last: int, raw: np.ndarray, at: np.ndarray) -> Texts:
    word = ~SPACE[raw]
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    closes = word.copy()
    closes[:-1] &= ~word[1:]
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]  # a row's end is a word's end, whatever follows
    opens[edges] = word[edges]
    closes[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    rows = np.searchsorted(at, starts, "right") - 1
    counts = np.bincount(rows, minlength=last - first)
    return Texts(first, last, raw, at, starts, ends, rows, counts, np.concatenate([[0], np.cumsum(counts)]))


def word_hashes(t: Texts) -> np.ndarray:
    if not len(t.starts):
        return np.zeros(0, np.uint64)
    lengths = t.ends - t.starts
    total = int(lengths.sum())
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(total) - np.repeat(begins, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), STEP), dtype=np.uint64)
    letters = LOWER[t.raw[place + np.repeat(t.starts, lengths)]]
    return mix(np.add.reduceat(BYTE_VALUES[letters] * powers[place], begins) + lengths.astype(np.uint64) * STEP)


def shingles(t: Texts, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all rows in order, repeats included, and where each row's begin (one more than rows).

    A row with fewer words has its whole sequence as one shingle, a row without words none.
    """
    words = word_hashes(t)
    counts = np.where(t.words_of_row >= n_words, t.words_of_row - n_words + 1, np.minimum(t.words_of_row, 1))
    begins = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(begins[-1], np.uint64)
    for length in range(1, n_words + 1):
        rows = np.flatnonzero(t.words_of_row == length if length < n_words else t.words_of_row >= n_words)
        if not len(rows):
            continue
        each = counts[rows]
        within = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        at = np.repeat(t.word_starts[rows], each) + within
        value = np.full(len(at), length, np.uint64) * STEP
        for k in range(length):
            value = mix(value + words[at + k])
        out[np.repeat(begins[rows], each) + within] = value
    return out, begins


def shingle_sets(t: Texts, n_words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each row."""
    values, begins = shingles(t, n_words)
    out = []
    for a, b in zip(begins[:-1], begins[1:], strict=True):
        own = np.sort(values[a:b])
        out.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
    return out
