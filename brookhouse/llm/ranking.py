"""Ranked lexical search: the best documents of each item, by accumulators of short lists and skipping over long ones.

Items are worked on in blocks whose texts fit `BLOCK_BYTES`; a block's terms are broadcast. One pass over all documents
writes, for each, how often it holds each term of the block, and counts what the scores need of the corpus. Then each
task turns its documents, `SHARD` at a time, into posting lists in document order and finds each item's best:

- postings of the short lists are summed at once into accumulators, which from then on are one list with a bound;
- this list and the long ones are walked document by document in their order. Lists whose bounds together do not reach the
  score needed so far propose no documents; they are only looked up for documents that others propose and that could
  still get into the best, from the highest bound down. The needed score rises on the way, so more lists drop out.

What all tasks found best is ranked again, first in parts and then for each item. Scores are whole numbers, so nothing
depends on the order of sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookhouse.llm.scratch import keep
from brookhouse.llm.windows import BASE_2, SLICE_BYTES, plain_hashes, spans
from brookhouse.llm.words import BYTE_VALUES, LOWER, Texts, text_slices

TOP = 20
#: Text of items worked on at once.
BLOCK_BYTES = 4 << 20
#: Documents of a task that are turned into posting lists at once, and documents walked at once.
SHARD, STRIDE = 1 << 16, 1 << 11
#: Lists are short while they hold, together, at most this part of the documents.
SHORT = 0.25

#: A-Z in lower case, and a space for every byte that is in no term: ASCII other than letters and digits.
_TERM = LOWER.copy()
_TERM[[b for b in range(0x80) if not chr(b).isalnum()]] = 0x20


class Block(NamedTuple):
    """Items, how many rows of the table each stands for, their terms' hashes, and (terms, repeats) of each item."""

    ids: list[int | None]
    copies: np.ndarray
    h1: np.ndarray
    h2: np.ndarray
    terms: list[tuple[np.ndarray, np.ndarray]]


def term_slices(column: pa.Array) -> Iterator[Texts]:
    """Texts whose words are terms: runs of letters, digits and characters beyond ASCII, with A-Z lower-cased."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if column.offset:
        column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    letters = _TERM[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    yield from text_slices(pa.LargeStringArray.from_buffers(len(column), offsets, pa.py_buffer(letters)), SLICE_BYTES)


def _hashes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    return plain_hashes(t), spans(BYTE_VALUES[t.raw], t.starts, t.ends, BASE_2)


def block_of(items: list[tuple[int | None, str | None, int]]) -> Block:
    """From (item_id, text, number of rows)."""
    parts = [(t, *_hashes(t)) for t in term_slices(pa.array([text for _, text, _ in items], pa.string()))]
    h1, h2 = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.uint64) for k in (1, 2))
    own, first, which = np.unique(h1, return_index=True, return_inverse=True)
    sizes = np.concatenate([p[0].words_of_row for p in parts]) if parts else np.zeros(0, np.int64)
    terms = [np.unique(part, return_counts=True) for part in np.split(which, np.cumsum(sizes)[:-1])] if len(sizes) else []
    return Block([i for i, _, _ in items], np.array([n for _, _, n in items], np.int64), own, h2[first], terms)


def _index(batches: Iterator[pa.RecordBatch], block: Broadcast) -> Iterator[pa.RecordBatch]:
    h1, h2 = block.value.h1, block.value.h2
    for batch in batches:
        for t in term_slices(batch.column("text")):
            n_rows, n_terms = len(t.words_of_row), max(len(h1), 1)
            own, second = _hashes(t)
            at = np.minimum(np.searchsorted(h1, own), n_terms - 1)
            hit = (h1[at] == own) & (h2[at] == second) if len(h1) else np.zeros(len(own), bool)
            keys, tf = np.unique(t.row_of_word[hit] * n_terms + at[hit], return_counts=True)
            cuts = np.searchsorted(keys, np.arange(n_rows + 1) * n_terms) * 4
            some = np.flatnonzero(t.words_of_row > 0)
            lists = [pa.BinaryArray.from_buffers(pa.binary(), n_rows, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(x.astype(np.int32))])
                     for x in (keys % n_terms, tf)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(t.first, t.last - t.first), pa.array(t.words_of_row, pa.int64()), *lists], names=["doc_id", "n", "terms", "tf"]
            ).take(pa.array(some))


def _document_counts(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    df = np.zeros(n_terms, np.int64)
    for batch in batches:
        df += np.bincount(_ints(batch.column("terms")), minlength=n_terms)
    term = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(df[term])], names=["term", "df"])


def _ints(column: pa.Array) -> np.ndarray:
    """The 32-bit integers of all values of a binary column in order."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int32)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def _lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if len(n) and 25 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([75 + 25 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 75 + 25 * n * n_docs // max(n_terms, 1)


def best(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents 0..n_docs-1 with the `top` highest sums above 0, and these; of equal sums the lower documents.

    A list is (documents in ascending order, what each adds, never below 0).
    """
    lists = sorted((x for x in lists if len(x[0])), key=lambda x: len(x[0]))
    held = np.cumsum([len(docs) for docs, _ in lists]) <= max(SHORT * n_docs, top)
    short, walks = [x for x, own in zip(lists, held, strict=True) if own], [x for x, own in zip(lists, held, strict=True) if not own]
    if short:
        docs, adds = (np.concatenate([x[k] for x in short]) for k in (0, 1))
        order = np.argsort(docs, kind="stable")
        docs, adds = docs[order], adds[order]
        begins = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        walks.append((docs[begins], np.add.reduceat(adds, begins)))  # the accumulators
    walks.sort(key=lambda x: int(x[1].max()))
    bounds = np.cumsum([int(x[1].max()) for x in walks])  # of the first lists together
    found, scores, needed = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    low = 0
    while low < n_docs:
        passive = int(np.searchsorted(bounds, needed, "right"))
        active = walks[passive:]
        if not active:
            break  # no document left can be among the best
        at = [int(np.searchsorted(docs, low)) for docs, _ in active]
        low = min((int(docs[k]) for (docs, _), k in zip(active, at, strict=True) if k < len(docs)), default=n_docs)
        high = min(low + STRIDE, n_docs)
        sums = np.zeros(max(high - low, 0), np.int64)
        for (docs, adds), k in zip(active, at, strict=True):
            end = int(np.searchsorted(docs, high))
            sums[docs[k:end] - low] += adds[k:end]
        chosen = np.flatnonzero(sums)
        for k in range(passive - 1, -1, -1):
            chosen = chosen[sums[chosen] + bounds[k] > needed]
            if not len(chosen):
                break
            docs, adds = walks[k]
            place = np.minimum(np.searchsorted(docs, chosen + low), len(docs) - 1)
            there = docs[place] == chosen + low
            sums[chosen[there]] += adds[place[there]]
        chosen = chosen[sums[chosen] > needed]
        if len(chosen):
            found, scores = np.concatenate([found, chosen + low]), np.concatenate([scores, sums[chosen]])
            order = np.lexsort((found, -scores))[:top]
            found, scores = found[order], scores[order]
            if len(scores) == top:
                needed = int(scores[-1])
        low = high
    return found, scores


def _rank(batches: Iterator[pa.RecordBatch], block: Broadcast, weight: Broadcast, n_docs: int, n_terms: int, top: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, SHARD):
            held.append(batch.slice(start, SHARD))
            size += held[-1].num_rows
            if size >= SHARD:
                yield _rank_shard(pa.Table.from_batches(held), block.value, weight.value, n_docs, n_terms, top)
                held, size = [], 0
    if size:
        yield _rank_shard(pa.Table.from_batches(held), block.value, weight.value, n_docs, n_terms, top)


def _rank_shard(shard: pa.Table, block: Block, weight: np.ndarray, n_docs: int, n_terms: int, top: int) -> pa.RecordBatch:
    shard = shard.sort_by("doc_id").combine_chunks()  # NULL last
    sizes = pc.binary_length(shard["terms"]).to_numpy() // 4
    docs = np.repeat(np.arange(shard.num_rows), sizes)
    terms, tf = (np.concatenate([_ints(x) for x in shard[name].chunks] or [np.zeros(0, np.int32)]).astype(np.int64) for name in ("terms", "tf"))
    m = _lengths(shard["n"].to_numpy(), n_docs, n_terms)[docs]
    adds = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
    order = np.argsort(terms, kind="stable")
    docs, adds = docs[order], adds[order]
    cuts = np.searchsorted(terms[order], np.arange(len(weight) + 1))
    items, places, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for item, (own, repeats) in enumerate(block.terms):
        found, score = best([(docs[cuts[k] : cuts[k + 1]], adds[cuts[k] : cuts[k + 1]] * n) for k, n in zip(own, repeats, strict=True)], shard.num_rows, top)
        items.append(np.full(len(found), item))
        places.append(found)
        scores.append(score)
    item = np.concatenate(items)
    return pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int32()), pa.array([block.ids[k] for k in item], pa.int64()), pa.array(block.copies[item], pa.int64()),
         shard["doc_id"].combine_chunks().take(pa.array(np.concatenate(places), pa.int64())), pa.array(np.concatenate(scores), pa.int64())],
        names=["item", "item_id", "copies", "doc_id", "score"])


def _highest(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def rank_block(docs: DataFrame, block: Block, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of the block's items."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(block)
    index = keep(docs.mapInArrow(partial(_index, block=shared), "doc_id long, n long, terms binary, tf binary"), "zstd")
    n_docs, n_terms = index.agg(F.count("*"), F.sum("n")).first()
    counts = np.zeros(len(block.h1), np.int64)
    for row in index.select("terms").mapInArrow(partial(_document_counts, n_terms=len(counts)), "term int, df long").groupBy("term").agg(
            F.sum("df").alias("df")).collect():  # a row per term of the block
        counts[row.term] = row.df
    weight = spark.sparkContext.broadcast(weights(n_docs, counts))
    found = index.mapInArrow(
        partial(_rank, block=shared, weight=weight, n_docs=n_docs, n_terms=n_terms or 0, top=top), "item int, item_id long, copies long, doc_id long, score long")
    parts = _highest(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64))), ["item", "part"], top).drop("rank")
    return _highest(parts, ["item"], top).select(
        "item_id", "rank", "doc_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("col")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of items (item_id, text) the `top` rows of docs (doc_id, text) with the
    highest scores above 0; equal scores by ascending doc_id, NULL last.

    A NULL or empty text has no terms: such an item finds nothing, such a document is not found and counts for nothing.
    Repeated rows are documents, or items, of their own. An empty table on either side gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = keep(items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                 .groupBy("item_id", "text").count())
    blocks = max(math.ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / block_bytes), 1)
    out = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()  # about block_bytes, or one longer item
        found = rank_block(docs, block_of([tuple(row) for row in sorted(rows, key=lambda r: (r.item_id is None, r.item_id, r.text))]), top)
        out = found if out is None else out.unionByName(found)
    return out


def op13_search(spark, sf_dir: str) -> DataFrame:
    return rank(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH tokens AS (
  SELECT r, doc_id, translate(unnest(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, totals GROUP BY term, n_docs),
m AS (SELECT r, 75 + (25 * n * n_docs) // n_terms AS m FROM sizes, totals),
items AS (
  SELECT i, item_id, term, count(*) AS q FROM (
    SELECT i, item_id, translate(unnest(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)) GROUP BY ALL),
scores AS (
  SELECT i, item_id, r, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term) JOIN m USING (r) GROUP BY i, item_id, r, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scores WHERE score > 0) WHERE rank <= 20
"""
