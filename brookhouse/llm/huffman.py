"""Canonical length-limited Huffman codes over numpy arrays: code lengths, packing, and decoding many places at once."""

from __future__ import annotations

import numpy as np


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """The best code lengths of at most `limit` bits (package-merge); 0 for ids that do not occur."""
    ids = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(ids) < 2:
        lengths[ids] = 1
        return lengths
    if len(ids) > 1 << limit:
        raise ValueError(f"{len(ids)} ids need codes of more than {limit} bits")
    ids = ids[np.argsort(counts[ids], kind="stable")]
    own = counts[ids].astype(np.float64)
    merged, levels = own, []
    for _ in range(limit - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([own, packages])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(own))
        merged = both[order]
    out, take = np.zeros(len(ids), np.int64), 2 * len(ids) - 2
    for single in reversed(levels):
        n = int(single[:take].sum())  # the n smallest ids get one bit more, the packages are opened a level below
        out[:n] += 1
        take = 2 * (take - n)
    out[:take] += 1
    lengths[ids] = out
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: in the order of (length, id), each the next number of its length."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    out = np.zeros(len(lengths), np.uint64)
    sizes = lengths[ids].astype(np.int64)
    steps = np.concatenate([[0], np.left_shift(np.int64(1), 62 - sizes)]).cumsum()[:-1]
    out[ids] = steps >> (62 - sizes)
    return out


def decode_tables(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of the next `lengths.max()` bits the id and the number of bits of its code."""
    top = int(lengths.max(initial=1))
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    spans = np.left_shift(np.int64(1), top - lengths[ids].astype(np.int64))
    symbols, sizes = np.zeros(1 << top, np.uint32), np.zeros(1 << top, np.uint8)
    used = int(spans.sum())
    symbols[:used], sizes[:used] = np.repeat(ids, spans), np.repeat(lengths[ids], spans)
    return symbols, sizes


def pack(ids: np.ndarray, lengths: np.ndarray, code: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
    """The codes of ids as big-endian 32-bit words, and the bit offsets of every `every`-th id."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    word, over = at >> 5, (at & 31) + size - 32  # bits that go to the next word
    value = code[ids].astype(np.uint64)
    right = np.maximum(over, 0).astype(np.uint64)
    high = np.where(over > 0, value >> right, value << np.maximum(-over, 0).astype(np.uint64))
    low = np.where(over > 0, (value << (np.uint64(32) - right)) & np.uint64(0xFFFFFFFF), np.uint64(0))
    n = int(ends[-1] + 31 >> 5) if len(ids) else 0
    # codes do not overlap, so sums are the words; they are below 2**32 and exact as doubles
    words = np.bincount(word, high, n + 1) + np.bincount(word + 1, low, n + 1)[: n + 1]
    return words[:n].astype(">u4").tobytes(), at[::every].astype(np.uint32)


def unpack(payload: bytes, offsets: np.ndarray, n: int, every: int, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The n ids, decoded from all bit offsets in step."""
    return unpack_all([(payload, offsets, n)], every, symbols, sizes)[0]


def unpack_all(parts: list[tuple[bytes, np.ndarray, int]], every: int, symbols: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The ids of several payloads, each given with its bit offsets and number of ids: all offsets advance in step, and the
    more there are, the less a step costs each."""
    top = len(sizes).bit_length() - 1
    begins = np.cumsum([0, *(len(payload) // 4 for payload, _, _ in parts)])
    words = np.zeros(int(begins[-1]) + 2, np.uint64)
    words[:-2] = np.frombuffer(b"".join(payload for payload, _, _ in parts), ">u4")
    windows = (words[:-1] << np.uint64(32)) | words[1:]
    at = np.concatenate([offsets.astype(np.int64) + 32 * begin for (_, offsets, _), begin in zip(parts, begins[:-1], strict=True)])
    out, last = np.zeros((len(at), every), np.uint32), len(windows) - 1
    mask = np.uint64((1 << top) - 1)
    for step in range(every if len(at) else 0):
        shift = (64 - top - (at & 31)).astype(np.uint64)
        bits = (windows[np.minimum(at >> 5, last)] >> shift) & mask  # the last place of a payload may run past its end
        out[:, step] = symbols[bits]
        at += sizes[bits]
    cuts = np.cumsum([len(offsets) for _, offsets, _ in parts])
    return [own.ravel()[:n] for own, (_, _, n) in zip(np.split(out, cuts[:-1]), parts, strict=True)]
