"""Token ids of documents in a Huffman-coded block format.

A folder in this format has three tables, written and read by Spark on any file system:

- `codes`: (id, length), the canonical Huffman code of the global counts of ids, at most `LIMIT` bits;
- `blocks`: (part, block, start, doc_ids, sizes, checkpoints, payload): consecutive documents of about `BLOCK` ids. `start` is
  the number of ids before the block, `sizes` has the ids of each document, `payload` the codes, and `checkpoints` the bit
  offset (unsigned 32-bit, little-endian) of every `EVERY`-th id, from which decoding can begin;
- `ids`: the ids of blocks before coding; only needed while writing.

Documents are in ascending doc_id order (NULL first) by part, block and place in the block.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brookhouse.llm.huffman import code_lengths, codes, decode_tables, pack, unpack_all
from brookhouse.llm.scratch import folder
from brookhouse.llm.words import LOWER, SPACE, Texts, text_slices
from brookhouse.llm.workers import frugal

END = 1
LIMIT = 18
BLOCK = 1 << 16
EVERY = 256
#: Blocks decoded at once.
TOGETHER = 8
#: Pieces whose ids each of a worker's two generations of its memory holds at most.
REMEMBERED = 200_000
#: Bytes of text encoded at once.
SLICE_BYTES = 4 << 20

#: New pieces given to the library as one text, with this sign between them; pieces that have it are given alone.
GROUP, BETWEEN = 256, "|"

#: ASCII signs but the apostrophe, which can be part of a contraction.
_SIGN = np.zeros(256, bool)
_SIGN[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[b for b in range(0x80) if chr(b).isalnum()]] = True


class Encoder:
    """Encodes whole texts piece by piece, so that the library sees a repeated piece once.

    The tokenizer drops white space, never looks across it, and keeps letters and signs apart, so the ids of a text are
    those of its words, and the ids of a word those of what stands before its last signs and of these. It lower-cases
    as well, so pieces are looked up with A-Z lower-cased.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks fill the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.between,) = self._raw([BETWEEN])[0]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        out = list(map(self.young.get, pieces))
        absent = [i for i, ids in enumerate(out) if ids is None]
        if len(self.young) + len(absent) > REMEMBERED:
            self.old, self.young = self.young, {}
        new = []
        for i in absent:
            if (ids := self.old.get(pieces[i])) is not None:
                out[i] = self.young[pieces[i]] = ids
            else:
                new.append(i)
        for i, ids in zip(new, self._ask([pieces[i] for i in new]), strict=True):
            out[i] = self.young[pieces[i]] = ids
        return out

    def _ask(self, pieces: list[str]) -> list[bytes]:
        """The library's ids of each piece. Most of a call's time goes with the call, so pieces are joined to longer texts."""
        plain = [i for i, piece in enumerate(pieces) if BETWEEN not in piece and "<|" not in piece]
        groups = [plain[k : k + GROUP] for k in range(0, len(plain), GROUP)]
        out: list[bytes | None] = [None] * len(pieces)
        for group, coded in zip(groups, self._raw([f" {BETWEEN} ".join([pieces[i] for i in group]) for group in groups]), strict=True):
            ids = np.array(coded, np.uint32)
            cuts = [-1, *np.flatnonzero(ids == self.between).tolist(), len(ids)]
            if len(cuts) == len(group) + 1:
                held = ids.tobytes()
                for i, a, b in zip(group, cuts[:-1], cuts[1:], strict=True):
                    out[i] = held[4 * a + 4 : 4 * b]
        alone = [i for i, ids in enumerate(out) if ids is None]
        for i, coded in zip(alone, self._raw([pieces[i] for i in alone]), strict=True):
            out[i] = array("I", coded).tobytes()
        return out

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a string column."""
        for t in text_slices(column, SLICE_BYTES):
            if not len(t.starts):
                yield from [np.zeros(0, np.uint32)] * len(t.words_of_row)
                continue
            if b"<|" in t.raw.tobytes():  # a special token's string must stay as it is
                (starts, ends, rows), raw = (t.starts, t.ends, t.row_of_word), t.raw
            else:
                (starts, ends, rows), raw = _split_signs(t), LOWER[t.raw]
            sizes = ends - starts
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            letters = raw[~SPACE[raw]]  # pieces are in order and leave out nothing else
            coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
            held = self._ids(coded.dictionary.to_pylist())
            flat = np.frombuffer(b"".join(held), np.uint32)
            lengths = np.fromiter(map(len, held), np.int64, len(held)) // 4
            first = np.cumsum(lengths) - lengths
            which = coded.indices.to_numpy()
            n = lengths[which]
            ends_of = np.cumsum(n)
            ids = flat[np.arange(ends_of[-1], dtype=np.int32) + np.repeat((first[which] - ends_of + n).astype(np.int32), n)]
            cuts = np.cumsum(np.bincount(rows, n, len(t.words_of_row)).astype(np.int64))
            yield from np.split(ids, cuts[:-1])


def _split_signs(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the pieces: a word's last signs are a piece if they follow an ASCII letter or digit, or a
    Latin letter of two bytes."""
    cut, moved = t.ends.copy(), np.ones(len(t.ends), bool)
    while moved.any():
        moved = (cut - 1 > t.starts) & _SIGN[t.raw[cut - 1]]
        cut -= moved
    before, lead = t.raw[cut - 1], t.raw[np.maximum(cut - 2, 0)]
    latin = (cut - 2 >= t.starts) & (before >= 0x80) & (lead >= 0xC3) & (lead <= 0xC8)
    latin &= ~np.isin(lead.astype(int) << 8 | before, [0xC397, 0xC3B7, 0xC4B0])  # two signs, and a letter that becomes two
    cut = np.where(_ALNUM[before] | latin, cut, t.ends)
    two = cut < t.ends
    at = np.arange(len(cut)) + np.cumsum(two) - two
    n = len(cut) + int(two.sum())
    starts, ends, rows = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    starts[at], ends[at], rows[at] = t.starts, cut, t.row_of_word
    starts[at[two] + 1], ends[at[two] + 1], rows[at[two] + 1] = cut[two], t.ends[two], t.row_of_word[two]
    return starts, ends, rows


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """One per worker process, so that its tasks use what earlier ones have looked up."""
    return Encoder(path)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Encode the text of every row (NULL is empty, rows with equal doc_id follow each other) and append id 1 to each."""
    spark = docs.sparkSession
    tokenizer = str(Path(tokenizer or tokenizer_file()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(partial(_encode, tokenizer=tokenizer), "part int, block int, doc_ids array<long>, sizes array<int>, ids binary").write.option(
        "compression", "zstd").parquet(f"{path}/ids")
    ids = spark.read.parquet(f"{path}/ids")
    counted = ids.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # a row per id of the vocabulary
    counts = np.zeros(max((row.id for row in counted), default=0) + 1, np.int64)
    for row in counted:
        counts[row.id] = row.n
    lengths = code_lengths(counts, LIMIT)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, length int").coalesce(1).write.parquet(f"{path}/codes")
    size = ids.select("part", "block", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = size.groupBy("part").agg(F.sum("n").alias("n"))  # a row per file
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = size.join(parts.select("part", before.alias("before")), "part").select("part", "block", (F.col("before") + inside).alias("start"))
    ids.join(starts, ["part", "block"]).select("part", "block", "start", "doc_ids", "sizes", "ids").mapInArrow(
        partial(_pack, lengths=lengths), "part int, block int, start long, doc_ids array<long>, sizes array<int>, checkpoints binary, payload binary"
    ).write.parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of each document; ids are little-endian unsigned 32-bit integers."""
    return spark.read.parquet(f"{path}/blocks").mapInArrow(partial(_unpack, lengths=_lengths(spark, path), digest=False), "doc_id long, start long, ids binary")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from its decoded ids."""
    return spark.read.parquet(f"{path}/blocks").mapInArrow(
        partial(_unpack, lengths=_lengths(spark, path), digest=True), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _lengths(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/codes").collect()  # a row per id of the vocabulary
    lengths = np.zeros(max((row.id for row in rows), default=0) + 1, np.uint8)
    for row in rows:
        lengths[row.id] = row.length
    return lengths


@frugal
def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    encoder, part, block = shared_encoder(tokenizer), TaskContext.get().partitionId(), 0
    docs: list[int | None] = []
    ids: list[np.ndarray] = []
    held = 0

    def full() -> pa.RecordBatch:
        flat = np.concatenate(ids)
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([docs], pa.list_(pa.int64())),
            pa.array([[len(x) for x in ids]], pa.list_(pa.int32())), pa.array([_narrow(flat)], pa.binary()),
        ], ["part", "block", "doc_ids", "sizes", "ids"])

    end = np.array([END], np.uint32)
    for batch in batches:
        for doc, own in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
            own = np.concatenate([own, end])
            docs.append(doc)
            ids.append(own)
            held += len(own)
            if held >= BLOCK:
                yield full()
                docs, ids, held, block = [], [], 0, block + 1
    if docs:
        yield full()


def _narrow(ids: np.ndarray) -> bytes:
    """A byte for the width, then the ids in 2 or 4 bytes each."""
    wide = len(ids) and int(ids.max()) > 0xFFFF
    return b"\4" + ids.astype("<u4").tobytes() if wide else b"\2" + ids.astype("<u2").tobytes()


def _widen(held: bytes) -> np.ndarray:
    return np.frombuffer(held, "<u4" if held[0] == 4 else "<u2", offset=1).astype(np.uint32)


@frugal
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for held in batch.column(0):
            own = np.bincount(_widen(held.as_py()), minlength=len(counts))
            own[: len(counts)] += counts
            counts = own
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], ["id", "n"])


@frugal
def _pack(batches: Iterator[pa.RecordBatch], lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    code = codes(lengths)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            payload, offsets = pack(_widen(row.column(5)[0].as_py()), lengths, code, EVERY)
            yield pa.RecordBatch.from_arrays([*row.columns[:5], pa.array([offsets.astype("<u4").tobytes()], pa.binary()), pa.array([payload], pa.binary())],
                                             ["part", "block", "start", "doc_ids", "sizes", "checkpoints", "payload"])


@frugal
def _unpack(batches: Iterator[pa.RecordBatch], lengths: np.ndarray, digest: bool) -> Iterator[pa.RecordBatch]:
    symbols, sizes = decode_tables(lengths)
    for batch in batches:
        every_size = [batch.column(4)[i].values.to_numpy() for i in range(batch.num_rows)]
        decoded = (ids for k in range(0, batch.num_rows, TOGETHER) for ids in unpack_all(
            [(batch.column(6)[i].as_py(), np.frombuffer(batch.column(5)[i].as_py(), "<u4"), int(every_size[i].sum())) for i in range(k, min(k + TOGETHER, batch.num_rows))],
            EVERY, symbols, sizes))
        for i, ids in enumerate(decoded):
            doc_ids, own, start = batch.column(3)[i].values, every_size[i], batch.column(2)[i].as_py()
            ids = ids.astype("<u4")
            ends = np.cumsum(own, dtype=np.int64)
            each = [ids[a:b].tobytes() for a, b in zip(ends - own, ends, strict=True)]
            columns = [doc_ids, pa.array(start + ends - own)]
            if digest:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(own.astype(np.int64)), pa.array([zlib.crc32(x) for x in each], pa.int64())],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])
            else:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(each, pa.binary())], ["doc_id", "start", "ids"])


def token_table(docs: DataFrame) -> DataFrame:
    """Write docs in the format, to a new shared folder, and read their digests back."""
    path = folder(docs.sparkSession)
    write_tokens(docs, path)
    return token_digests(docs.sparkSession, path)


def op3_tokens(spark, sf_dir: str) -> DataFrame:
    return token_table(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
