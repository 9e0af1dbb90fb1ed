"""MinHash near-dedup by an inverted join of signature coordinates.

Texts with equal shingle sets become one class. Each class posts its MinHash coordinates; a pair of classes can only
reach the match threshold T of H coordinates if it shares one of the H - T + 1 rarest coordinate values of either
(prefix filter), so only those are posted. Posting lists are walked in two rounds:

1. each member is compared with the roots of its list only and joins the one it collides with most, so a list of
   copies costs its length and not its square; these pairs are confirmed on the full sets and give first components;
2. lists whose members are all in one component are skipped whole; the others are merged to families that share
   members, and the full sets of a family's documents in different components are compared, each pair at most once. Only
   links that join two components are returned, so a family costs rows by its length here too.

A link that is never compared lies between classes that are connected already, so the components lose nothing. T is
set so that a pair at the similarity bound misses it with a probability of at most `MISS`. Long lists and families are
split into blocks; in a family, blocks of its largest component are compared with those of the others only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookhouse.llm.components import components
from brookhouse.llm.groups import sorted_groups
from brookhouse.llm.scratch import keep
from brookhouse.llm.words import mix, shingle_sets, text_slices
from brookhouse.llm.workers import frugal

COORDINATES = 32  # a power of two
MISS = 2e-5
#: Members of a posting list, and shingles of a family, that one task compares with each other.
BLOCK = 2048
BLOCK_SHINGLES = 500_000

_seeds = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The most collisions that a pair at the bound still reaches with a probability of 1 - miss."""
    p, below = percent / 100, 0.0
    for t in range(coordinates):
        below += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(1, t)
    return coordinates


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text).

    Documents are linked if 100 * intersection >= percent * union of their sets of `words`-word shingles; a text with
    fewer words is one shingle, and one without words (or NULL) has an empty set and no links. Rows with the same
    doc_id are one node. A row without doc_id is never linked, has no component_id and is kept.
    """
    signed = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                  .mapInArrow(partial(_sign, words=words), "doc_id long, n_shingles long, digest binary, signature array<long>"))
    full = signed.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = keep(full.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep").distinct())
    reps = full.join(classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
    postings, texts = _postings(reps, docs, match_threshold(percent))

    confirmed = keep(_confirm(_walk_roots(postings, match_threshold(percent)), texts, words, percent))
    first = keep(components(confirmed))
    late = _rest(postings, first, texts, words, percent)
    edges = confirmed.unionByName(late).unionByName(member.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = components(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    return (
        signed.select("doc_id", "n_shingles").join(found, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


@frugal
def _sign(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The lowest bits of a coordinate value are the coordinate's number, so that values tell coordinates apart."""
    for batch in batches:
        for t in text_slices(batch.column(1)):
            sets = shingle_sets(t, words)
            values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            sizes = np.array([len(own) for own in sets])
            some = np.flatnonzero(sizes)
            begins = np.concatenate([[0], np.cumsum(sizes[some])[:-1]]).astype(np.int64)
            signature = np.zeros((len(some), COORDINATES), np.int64)
            for k in range(COORDINATES if len(some) else 0):
                low = np.minimum.reduceat((values ^ _seeds[2 * k]) * (_seeds[2 * k + 1] | np.uint64(1)), begins)
                signature[:, k] = (low & np.uint64(-COORDINATES % 2**64) | np.uint64(k)).view(np.int64)
            ends = np.cumsum((sizes > 0) * COORDINATES)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(t.first, t.last - t.first),
                pa.array(sizes, pa.int64()),
                pa.array([hashlib.blake2b(own.tobytes(), digest_size=16).digest() for own in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(signature.ravel())),
            ], ["doc_id", "n_shingles", "digest", "signature"])


def _postings(reps: DataFrame, docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(post, id, blocks, values) of the prefixes, and (doc_id, text) of the classes that have any."""
    tokens = reps.select("doc_id", F.explode("signature").alias("post"))
    shared = tokens.groupBy("post").agg(F.count("*").alias("n")).where("n > 1")
    # A class with fewer than `threshold` shared values has no partner. Values that nobody shares come first in its
    # order, so they use up part of its prefix.
    prefix = F.size("values") - F.lit(threshold - 1)
    ordered = (
        tokens.join(shared, "post").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", "post"))).alias("values"))
        .where(F.size("values") >= threshold)
        .select("doc_id", "values", F.slice("values", F.lit(1), prefix).alias("prefix"))
    )
    ordered = keep(ordered.select("doc_id", F.col("values.post").alias("values"), "prefix"))
    postings = ordered.select(F.col("doc_id").alias("id"), "values", F.inline("prefix")).select(
        "post", "id", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), "values"
    )
    texts = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .join(ordered.select("doc_id"), "doc_id", "left_semi"))
    return postings, texts


def _dealt(postings: DataFrame, block: Column, *more: str) -> DataFrame:
    rows = postings.select("post", block.alias("block"), "id", "values", *more)
    return rows.repartition("post", "block").sortWithinPartitions("post", "block")


def _walk_roots(postings: DataFrame, threshold: int) -> DataFrame:
    block = F.pmod(F.xxhash64("id", "post"), F.col("blocks")).cast("int")
    return _dealt(postings, block).mapInArrow(partial(_roots, threshold=threshold), "a long, b long").distinct()


def _rest(postings: DataFrame, first: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that join all first components that any link between them joins."""
    placed = postings.select("post", "id").join(first.select(F.col("node").alias("id"), "component"), "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    each = placed.groupBy("post", "component").agg(F.min("id").alias("id"))
    mixed = each.groupBy("post").agg(F.count("*").alias("components"), F.min("id").alias("least")).where("components > 1")
    # a link lies in one list, so within the lists that share members
    star = keep(each.join(mixed, "post").select(F.col("least").alias("a"), F.col("component").alias("b"), "id", "component").distinct())
    sharing = star.select("a", F.col("id").alias("b")).unionByName(star.select(F.col("id").alias("a"), F.col("component").alias("b")))
    family = components(sharing).select(F.col("node").alias("component"), F.col("component").alias("family"))
    members = keep(postings.select("id").distinct().join(first.select(F.col("node").alias("id"), "component"), "id", "left")
                   .withColumn("component", F.coalesce("component", "id")).join(family, "component")
                   .join(texts.withColumnRenamed("doc_id", "id"), "id").select("family", "component", "id", "text")
                   .mapInArrow(partial(_with_set, words=words), "family long, component long, id long, size long, shingles binary"))
    sizes = members.groupBy("family", "component").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    sizes = sizes.groupBy("family").agg(
        F.max(F.struct("n", "component", "size")).alias("main"), F.sum("n").alias("n"), F.sum("size").alias("size"))
    blocks = lambda n, size: F.ceil(F.greatest(n / F.lit(BLOCK), size / F.lit(BLOCK_SHINGLES))).cast("int")
    plan = sizes.select("family", F.col("main.component").alias("main"), blocks(F.col("main.n"), F.col("main.size")).alias("m"),
                        blocks(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size")).alias("r")).where("r > 0")
    # blocks 0..m-1 hold the largest component and are not compared with each other, m..m+r-1 hold the others
    rows = members.join(plan, "family").withColumn("is_main", F.col("component") == F.col("main"))
    rows = rows.withColumn("block", F.when(F.col("is_main"), F.pmod(F.xxhash64("id"), F.col("m"))).otherwise(
        F.col("m") + F.pmod(F.xxhash64("id"), F.col("r"))).cast("int"))
    other = F.explode(F.when(F.col("is_main"), F.sequence("m", F.col("m") + F.col("r") - 1)).otherwise(F.sequence(F.lit(0), F.col("m") + F.col("r") - 1)))
    rows = rows.select("family", "component", "id", "block", "shingles", other.alias("other")).select(
        "family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "component", "id", "shingles")
    return rows.repartition("family", "low", "high").sortWithinPartitions("family", "low", "high").mapInArrow(
        partial(_join_blocks, percent=percent), "a long, b long")


@frugal
def _with_set(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for t in text_slices(batch.column(3)):
            sets = shingle_sets(t, words)
            own = batch.slice(t.first, t.last - t.first)
            yield pa.RecordBatch.from_arrays([*own.columns[:3], pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
                                             ["family", "component", "id", "size", "shingles"])


@frugal
def _join_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Compare the full sets of two blocks (or of one with itself) as long as they are in different components."""
    for group in sorted_groups(batches, ["family", "low", "high"]):
        ids, label, block = (group[name].to_numpy().copy() for name in ("id", "component", "block"))
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in group["shingles"]]
        sizes = np.array([len(x) for x in sets])
        begins = np.cumsum(sizes) - sizes
        known, flat = np.unique(np.concatenate(sets), return_inverse=True)
        has = np.zeros(len(known), bool)
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        second = np.flatnonzero(block == high)
        first = np.flatnonzero(block == low)
        if len(first) > len(second):
            first, second = second, first
        at = np.repeat(begins[second] - np.cumsum(sizes[second]) + sizes[second], sizes[second]) + np.arange(int(sizes[second].sum()))
        flat_second, begins_second = flat[at], np.cumsum(sizes[second]) - sizes[second]
        a, b = [], []
        for i in first if len(second) else ():
            own = flat[begins[i] : begins[i] + sizes[i]]
            has[own] = True
            both = np.add.reduceat(has[flat_second], begins_second, dtype=np.int64)
            has[own] = False
            linked = second[100 * both >= percent * (sizes[i] + sizes[second] - both)]
            for other in linked:
                if label[other] != label[i]:
                    a.append(int(ids[i]))
                    b.append(int(ids[other]))
                    label[label == label[other]] = label[i]
        yield _pairs(a, b)


def _matrix(values: pa.ChunkedArray) -> np.ndarray:
    """One row of coordinates per member; the value -1 - row, which nobody else has, stands for one that nobody shares."""
    values = values.combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = values.chunk(0)
    flat, rows = values.flatten().to_numpy(), np.repeat(np.arange(len(values)), values.value_lengths().to_numpy())
    out = np.repeat(-1 - np.arange(len(values))[:, None], COORDINATES, axis=1)
    bits = flat.astype(np.int64).view(np.uint64)
    out[rows, (bits % np.uint64(COORDINATES)).astype(np.int64)] = (bits // np.uint64(COORDINATES)).astype(np.int64)
    return out


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


@frugal
def _roots(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for group in sorted_groups(batches, ["post", "block"]):
        if group.num_rows < 2:
            continue
        ids, matrix = group["id"].to_numpy(), _matrix(group["values"])
        order = np.argsort(ids)
        ids, matrix = ids[order], matrix[order]
        roots, n = np.empty(len(ids), np.int64), 0
        table = np.empty_like(matrix)
        for i in range(len(ids)):
            if n:
                hits = (table[:n] == matrix[i]).sum(axis=1)
                best = int(hits.argmax())
                if hits[best] >= threshold:
                    a.append(int(ids[roots[best]]))
                    b.append(int(ids[i]))
                    continue
            roots[n], table[n] = i, matrix[i]
            n += 1
        if len(a) > 10_000:
            yield _pairs(a, b)
            a, b = [], []
    yield _pairs(a, b)


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        partial(_similar, words=words, percent=percent), "a long, b long")


@frugal
def _similar(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            left = [own for t in text_slices(part.column(2)) for own in shingle_sets(t, words)]
            right = [own for t in text_slices(part.column(3)) for own in shingle_sets(t, words)]
            good = []
            for x, y in zip(left, right, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def distinct_documents(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs without those that have a smaller doc_id in their component; rows with equal doc_id stay together."""
    dropped = near_duplicates(docs.select("doc_id", "text"), words, percent).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def op8_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), words=3, percent=85)
