"""A count-min sketch that tells whether a key may have come twice.

A key counts in `DEPTH` cells, and its estimate is the least of them, so it is never below the true count. As only "once"
and "more" matter, a cell is two bits, kept as two maps: cells met, and cells met again. Tasks send the maps of their
partition in compressed blocks, blocks are merged in Spark, and only the second map of the merged sketch is collected
and broadcast: at most `MOST_CELLS` / 8 bytes, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookhouse.llm.words import STEP, mix

DEPTH = 4
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 30
BLOCK_CELLS = 1 << 23
ROWS = "block int, met binary, again binary"


def cells_for(n_bytes: int) -> int:
    """Cells for a corpus of so many bytes of text: about ten for each anchor, a power of two within the bounds."""
    return min(max(1 << (n_bytes // 4).bit_length(), LEAST_CELLS), MOST_CELLS)


def places(keys: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each key, one row of the result for each of the `DEPTH` hash functions."""
    return np.stack([mix(keys + np.uint64(k * int(STEP) % 2**64)) & np.uint64(cells - 1) for k in range(DEPTH)]).astype(np.int64)


class Sketch:
    def __init__(self, cells: int):
        self.cells, self.met, self.again = cells, np.zeros(cells >> 3, np.uint8), np.zeros(cells >> 3, np.uint8)

    def add(self, keys: np.ndarray) -> None:
        for own in places(keys, self.cells):  # two functions may share a cell; that only raises its count
            own.sort()
            new = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
            twice = np.zeros(len(own), bool)
            twice[:-1] = ~new[1:]
            byte, bit = own >> 3, np.left_shift(np.uint8(1), (own & 7).astype(np.uint8))
            twice |= (self.met[byte] & bit) != 0
            np.bitwise_or.at(self.again, byte[twice], bit[twice])
            np.bitwise_or.at(self.met, byte[new], bit[new])

    def blocks(self) -> Iterator[pa.RecordBatch]:
        size = min(self.cells, BLOCK_CELLS) >> 3
        for block in range(len(self.met) // size):
            met = self.met[block * size : (block + 1) * size]
            if met.any():
                yield _row(block, met, self.again[block * size : (block + 1) * size])


def _row(block: int, met: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
    packed = [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in (met, again)]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], names=["block", "met", "again"])


def _bits(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True), np.uint8)


def _merge(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    at, met, again = None, None, None
    for batch in batches:
        for block, *maps in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            own_met, own_again = (_bits(x, size) for x in maps)
            if block != at:
                if at is not None:
                    yield _row(at, met, again)
                at, met, again = block, own_met.copy(), own_again.copy()
            else:
                again |= own_again | (met & own_met)
                met |= own_met
    if at is not None:
        yield _row(at, met, again)


def merged(blocks: DataFrame, cells: int) -> np.ndarray:
    """The map of cells met again, from the blocks of all tasks."""
    size = min(cells, BLOCK_CELLS) >> 3
    out = np.zeros(cells >> 3, np.uint8)
    rows = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(partial(_merge, size=size), ROWS).select("block", "again")
    for row in rows.toLocalIterator():  # cells / 8 bytes at most
        out[row.block * size : (row.block + 1) * size] = _bits(row.again, size)
    return out


def maybe_repeated(again: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that were added once at most."""
    out = np.ones(len(keys), bool)
    for own in places(keys, len(again) << 3):
        out &= (again[own >> 3] >> (own & 7).astype(np.uint8)) & 1 == 1
    return out


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
