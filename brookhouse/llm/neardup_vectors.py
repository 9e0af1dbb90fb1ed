"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors of unit length with a cosine of 0.93 are at most 0.374 apart. Each of `TABLES` tables cuts `PROJECTIONS` random
(Gaussian, hence 2-stable) projections into steps of `WIDTH` and uses the steps together as a bucket. Two vectors at that
distance share a bucket of some table with a probability of 0.9995, at a cosine of 0.97 with one of 1 - 2e-8; unrelated
ones share one of all tables with 0.006, so a label of many vectors compares under a hundredth of its pairs. Tables hold ids
only; a vector is sent where its bucket has a second one. All pairs of a bucket get the exact cosine, in double precision, with none left out: large buckets
are cut into blocks, and each pair of blocks is a task's group. Exact copies are one vector with a weight. A pair counts
in the first table whose bucket it shares, so links are summed per vector without listing them; for the components each
group returns only links that join what is not joined in it yet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from brookhouse.llm.components import components
from brookhouse.llm.groups import sorted_groups
from brookhouse.llm.scratch import keep
from brookhouse.llm.words import mix

TABLES, PROJECTIONS, WIDTH = 56, 12, 1.9
#: Vectors of a bucket that are compared within one group.
BLOCK = 1024


def linked_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors (vec_id, embedding, label).

    Only vectors with equal labels and lengths are compared. A vector that is NULL, empty, zero or has NULL or non-finite
    components, or has no label, links with nothing. Equal rows count once as a link of others; a row without vec_id is
    never linked, has no component_id and is kept.
    """
    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    embedding = F.col("embedding") if single else F.col("embedding").cast("array<double>").alias("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), embedding, "label")
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))) & F.exists("embedding", lambda x: x != 0)
    whole = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine).withColumns(
        {"h1": F.xxhash64("label", "embedding"), "h2": F.xxhash64(F.lit(1), "label", "embedding")})
    ids = whole.select("h1", "h2", "vec_id").distinct()
    classes = ids.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    member = keep(ids.join(classes, ["h1", "h2"]).select("vec_id", "rep", "weight"))
    reps = whole.join(classes, ["h1", "h2"]).where("vec_id = rep").dropDuplicates(["vec_id", "h1", "h2"])
    held = keep(reps.select("rep", "weight", F.xxhash64("label", F.size("embedding")).alias("own"), "embedding"))
    placed = keep(held.select("rep", "own", "embedding").mapInArrow(_place, "table int, bucket long, rep long"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    dealt = placed.join(shared, "bucket").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "table", "rep").join(held, "rep")
    links = keep(dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high").mapInArrow(
        partial(_link, cosine=cosine), "rep long, n long, other long"))
    counts = links.where("other is null").groupBy("rep").agg(F.sum("n").alias("n"))
    found = components(links.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    # a vec_id with several different vectors is in several classes
    several = member.groupBy("vec_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    if several.take(1):
        found = components(links.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")).unionByName(
            member.select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))))
    summed = member.join(counts, "rep", "left").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").groupBy("vec_id").agg(
        F.sum(F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.min(F.coalesce("component", "rep")).alias("component_id"))
    return rows.select("vec_id").join(summed, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


@lru_cache(maxsize=4)
def _tables(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Projections and offsets for vectors of a length; the same in every task."""
    r = np.random.default_rng(width)
    return r.standard_normal((width, TABLES * PROJECTIONS)), r.uniform(0, WIDTH, TABLES * PROJECTIONS)


def _unit(vectors: np.ndarray) -> np.ndarray:
    unit = vectors.astype(np.float64)
    unit /= np.abs(unit).max(axis=1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def _buckets(unit: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Hashes of the buckets of unit vectors, a column per table."""
    project, offset = _tables(unit.shape[1])
    steps = np.floor((unit @ project + offset) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), TABLES, PROJECTIONS)
    buckets = mix(own.view(np.uint64)[:, None] ^ np.arange(1, TABLES + 1, dtype=np.uint64))
    for k in range(PROJECTIONS):
        buckets = mix(buckets + steps[:, :, k])
    return buckets


def _matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of each length among the lists."""
    lengths = lists.value_lengths().to_numpy()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    begins = np.cumsum(lengths) - lengths
    for width in np.unique(lengths):
        rows = np.flatnonzero(lengths == width)
        yield rows, flat[begins[rows][:, None] + np.arange(width)]


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            rep, own = part.column(0).to_numpy(), part.column(1).to_numpy()
            for rows, vectors in _matrices(part.column(2)):
                buckets = _buckets(_unit(vectors), own[rows])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.tile(np.arange(TABLES, dtype=np.int32), len(rows))), pa.array(buckets.view(np.int64).ravel()), pa.array(np.repeat(rep[rows], TABLES)),
                ], ["table", "bucket", "rep"])


class _Near(NamedTuple):
    """Rows of a group that have a near one, and the pairs (i, j) of them."""

    table: int
    rep: np.ndarray
    weight: np.ndarray
    own: np.ndarray
    unit: np.ndarray
    i: np.ndarray
    j: np.ndarray


def _link(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    held: list[_Near] = []
    for group in sorted_groups(batches, ["bucket", "low", "high"]):
        near = _near(group, cosine) if group.num_rows > 1 else None
        if near is None:
            continue
        if held and (near.unit.shape[1] != held[0].unit.shape[1] or sum(len(x.rep) for x in held) + len(near.rep) > 2 * BLOCK or sum(len(x.i) for x in held) > BLOCK**2):
            yield _first_met(held)
            held = []
        held.append(near)
    if held:
        yield _first_met(held)


def _near(group: pa.Table, cosine: float) -> _Near | None:
    own, block = group["own"].to_numpy(), group["block"].to_numpy()
    low, high, table = (group[name][0].as_py() for name in ("low", "high", "table"))
    first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
    if not len(first) or not len(second):
        return None
    lists = group["embedding"].combine_chunks()
    unit = np.zeros((group.num_rows, lists.value_lengths().to_numpy().max()))  # lengths only differ if bucket hashes clash, and then so does `own`
    for rows, vectors in _matrices(lists):
        unit[rows, : vectors.shape[1]] = _unit(vectors)
    near = unit[first] @ unit[second].T >= cosine
    near &= own[first][:, None] == own[second]
    if low == high:
        near &= np.arange(len(first))[:, None] < np.arange(len(first))
    i, j = np.nonzero(near)
    if not len(i):
        return None
    linked, where = np.unique(np.concatenate([first[i], second[j]]), return_inverse=True)
    return _Near(table, group["rep"].to_numpy()[linked], group["weight"].to_numpy()[linked], own[linked], unit[linked], where[: len(i)], where[len(i) :])


def _first_met(groups: list[_Near]) -> pa.RecordBatch:
    """Pairs that share no bucket of an earlier table: their sums by vector, and for each group links that join its rows."""
    rep, weight = (np.concatenate([getattr(x, name) for x in groups]) for name in ("rep", "weight"))
    buckets = _buckets(np.concatenate([x.unit for x in groups]), np.concatenate([x.own for x in groups]))
    starts = np.cumsum([0, *(len(x.rep) for x in groups)])
    i, j = (np.concatenate([getattr(x, name) + start for x, start in zip(groups, starts, strict=False)]) for name in "ij")
    group = np.repeat(np.arange(len(groups)), [len(x.i) for x in groups])
    table = np.array([x.table for x in groups])[group]
    fresh = np.arange(len(i))
    for earlier in range(table.max()):
        fresh = fresh[(table[fresh] <= earlier) | (buckets[i[fresh], earlier] != buckets[j[fresh], earlier])]
    i, j, group = i[fresh], j[fresh], group[fresh]
    total = np.bincount(i, weight[j], len(rep)) + np.bincount(j, weight[i], len(rep))
    some = np.flatnonzero(total)
    a: list[int] = []
    b: list[int] = []
    for k in np.unique(group):
        start, end = np.searchsorted(group, [k, k + 1])
        x_of, others_of, base = i[start:end] - starts[k], j[start:end] - starts[k], rep[starts[k] : starts[k + 1]]
        label = np.arange(len(base))
        cuts = np.flatnonzero(np.diff(x_of)) + 1
        for x, others in zip(x_of[np.concatenate([[0], cuts])], np.split(others_of, cuts), strict=True):
            labels, where = np.unique(label[others], return_index=True)
            new = labels != label[x]
            if new.any():
                a += [int(base[x])] * int(new.sum())
                b += base[others[where[new]]].tolist()
                label[np.isin(label, labels)] = label[x]
    return _rows(rep[some], total[some].astype(np.int64), a, b)


def _rows(linked: np.ndarray, links: np.ndarray, a: list[int], b: list[int]) -> pa.RecordBatch:
    rep = np.concatenate([linked, np.array(a, np.int64)])
    n = np.concatenate([links, np.zeros(len(a), np.int64)])
    other = pa.concat_arrays([pa.nulls(len(rep) - len(a), pa.int64()), pa.array(b, pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(rep), pa.array(n), other], ["rep", "n", "other"])


def op1_embeddings(spark, sf_dir: str) -> DataFrame:
    return linked_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
