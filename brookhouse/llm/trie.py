"""The prefix trie of conversations, by range shards and a skeleton of the nodes that cross them.

A conversation is a row with its turns as 128-bit hashes of role and text (16 bytes a turn, no texts). Rows are
range-partitioned and sorted by (path, conv_id), so equal conversations may lie in several shards however many they are.
A node crosses a boundary between two shards only as a common prefix of the paths on both sides, so the nodes that cross
are the trie of the splitter paths: the skeleton. Of it each task needs only how deep its neighbours agree, and that is
what is broadcast: two depths per shard (`Skeleton`).

- Each task walks its shard in order with one open node per depth and finishes all nodes that do not cross.
- For a skeleton node it sends a partial aggregate of its members and of the finished nodes below. Partials are reduced by
  node. Sums over a skeleton subtree are differences of prefix sums, as skeleton nodes are numbered in preorder.
- The digest of a skeleton node's ends takes its members' ids in order; ids come in chunks, and a task holds one chunk.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookhouse.llm.scratch import checkpointed, keep

PATH = "array<struct<h1:bigint,h2:bigint>>"
#: Ids of a chunk, rows of a batch that a task sends, and skeleton nodes of a section of the prefix sums.
CHUNK, BATCH, SECTION = 8192, 8192, 4096
NOTHING = hashlib.sha256(b"").hexdigest()
NODE, PARTIAL, ENDS = range(3)
OUT = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
       "ends_sha256 string, node long, up long, stop long, last long, shard int, seq int, ids string")
NAMES = [part.split()[0] for part in OUT.split(", ")]
TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
KINDS = [TYPES[part.split()[1]] for part in OUT.split(", ")]


# --- paths --------------------------------------------------------------------------------------------------------


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) from (conv_id, turn, role, text): a hash and the code points of each turn, in order.

    Turns are ordered by `turn`, NULL first, and where it is equal by their hashes. A NULL role or text is empty, repeated
    rows are turns of their own, rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), role, text).alias("h2"),
            F.char_length(text).alias("size")).alias("turn"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return rows.select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["h1"].alias("h1"), t["h2"].alias("h2"))).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"))


def with_shared_heads(paths: DataFrame, most: int = 6, group: int = 100) -> DataFrame:
    """Conversations that begin as another: c takes the first h turns of conversation c - c % group (all if it has fewer,
    none if there is no such conversation) in place of its own first h, where h = crc32(decimal c) % most."""
    heads = paths.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", 1, most - 1).alias("head"), F.slice("sizes", 1, most - 1).alias("head_sizes"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    rows = paths.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", h).join(heads, "base", "left")

    def joined(head: str, own: str, kind: str):
        rest = F.slice(own, F.col("h") + 1, F.greatest(F.size(own) - F.col("h"), F.lit(0)))
        return F.concat(F.coalesce(F.slice(head, F.lit(1), F.col("h")), F.array().cast(kind)), rest)

    return rows.select("conv_id", joined("head", "path", PATH).alias("path"), joined("head_sizes", "sizes", "array<int>").alias("sizes"))


# --- skeleton -----------------------------------------------------------------------------------------------------


class Skeleton:
    """Where the shards that hold rows (`shards`, in order) meet: `across[b]` is the depth to which the paths on both sides
    of boundary b agree, `within[i]` the one to which a shard's first and last path do.

    Nodes of boundary b have the depths 0..across[b]; those up to kept[b] are also nodes of boundary b - 1, the others are
    new. Numbering the new ones boundary by boundary and downwards is a preorder.
    """

    def __init__(self, shards: list[int], across: list[int], within: list[int]):
        self.of = {shard: i for i, shard in enumerate(shards)}
        self.across = np.array(across, np.int64)
        self.kept = np.array([min(across[b - 1], within[b], across[b]) if b else -1 for b in range(len(across))], np.int64)
        self.base = np.concatenate([[0], np.cumsum(self.across - self.kept)])

    def nodes(self, b: int) -> tuple[list[int], list[int]]:
        """Number of the node of boundary b at each depth, and of the first node after its subtree."""
        if not 0 <= b < len(self.across):
            return [], []
        numbers, stops, first = [], [], b
        for depth in range(int(self.across[b]), -1, -1):
            while self.kept[first] >= depth:
                first -= 1
            after = np.flatnonzero(self.kept[b + 1 :] < depth)
            numbers.append(int(self.base[first] + depth - self.kept[first] - 1))
            stops.append(int(self.base[b + 1 + after[0]] if len(after) else self.base[-1]))
        return numbers[::-1], stops[::-1]


def _tokens(column: pa.Array) -> Iterator[np.ndarray]:
    """Each path as an array of (h1, h2)."""
    flat = column.flatten()
    pairs = np.stack([flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)], axis=1) if len(flat) else np.zeros((0, 2), np.int64)
    at = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    for a, b in zip(at[:-1], at[1:], strict=True):
        yield pairs[a:b]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differs = (a[:n] != b[:n]).any(axis=1)
    return int(differs.argmax()) if differs.any() else n


def _ends_of_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = last = None
    for batch in batches:
        if batch.num_rows:
            column = batch.column("path")
            first = column.slice(0, 1) if first is None else first
            last = column.slice(batch.num_rows - 1, 1)
    if first is not None:
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), first, last], names=["shard", "first", "last"])


def _depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = None
    for batch in batches:
        for shard, first, last in zip(batch.column("shard").to_pylist(), _tokens(batch.column("first")), _tokens(batch.column("last")), strict=True):
            values = [shard, -1 if before is None else _agree(before, first), _agree(first, last)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in values], names=["shard", "across", "within"])
            before = last


def skeleton_of(ordered: DataFrame) -> Skeleton:
    """From a table whose partitions are the shards; three numbers per shard come to the driver."""
    edges = ordered.select("path").mapInArrow(_ends_of_shard, f"shard int, first {PATH}, last {PATH}")
    rows = edges.repartition(1).sortWithinPartitions("shard").mapInArrow(_depths, "shard int, across int, within int").collect()
    rows = sorted(rows, key=lambda r: r.shard)
    return Skeleton([r.shard for r in rows], [r.across for r in rows[1:]], [r.within for r in rows])


# --- shards -------------------------------------------------------------------------------------------------------


class Open:
    """A node whose members are being read; `rows` are its finished children, which wait for its smallest member."""

    __slots__ = ("conv_id", "n", "children", "leaves", "saved", "last", "ends", "rows", "early")

    def __init__(self, last: int, early: bool):
        self.conv_id, self.n, self.children, self.leaves, self.saved, self.last, self.early = None, 0, 0, 0, 0, last, early
        self.ends, self.rows = array("q"), []

    def add(self, conv_id: int, n: int) -> None:
        self.n += n
        if self.conv_id is None or conv_id < self.conv_id:
            self.conv_id = conv_id


def _row(**values) -> tuple:
    return tuple(values.get(name) for name in NAMES)


def _walk(batches: Iterator[pa.RecordBatch], skeleton: Broadcast) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    held: list[tuple] = []
    for row in _nodes(batches, skeleton.value, shard):
        held.append(row)
        if len(held) == BATCH:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), KINDS, strict=True)], names=NAMES)


def _nodes(batches: Iterator[pa.RecordBatch], skeleton: Skeleton, shard: int) -> Iterator[tuple]:
    own = skeleton.of.get(shard)
    if own is None:
        return
    before, after = skeleton.nodes(own - 1), skeleton.nodes(own)
    opened: list[Open] = []
    path = None

    def close(depth: int, end: bool) -> Iterator[tuple]:
        x = opened.pop()
        crosses = before if x.early and depth < len(before[0]) else after if end and depth < len(after[0]) else None
        for row in x.rows:
            yield row[:3] + (None if crosses else x.conv_id,) + row[4:10] + (crosses[0][depth] if crosses else None,) + row[11:]
        if crosses:
            node = crosses[0][depth]
            yield _row(kind=PARTIAL, conv_id=x.conv_id, depth=depth, n_convs=x.n, n_children=x.children, n_leaves=x.leaves, saved_tokens=x.saved,
                       node=node, up=crosses[0][depth - 1] if depth else None, stop=crosses[1][depth], last=x.last)
            for k in range(0, len(x.ends), CHUNK):
                yield _row(kind=ENDS, node=node, shard=shard, seq=k // CHUNK, ids=",".join(map(str, x.ends[k : k + CHUNK])))
        else:
            x.leaves += not x.children
            x.saved += (x.n - 1) * x.last
            ends = hashlib.sha256(",".join(map(str, x.ends)).encode()).hexdigest() if x.ends else NOTHING
            row = _row(kind=NODE, conv_id=x.conv_id, depth=depth, n_convs=x.n, n_children=x.children, n_leaves=x.leaves, saved_tokens=x.saved, ends_sha256=ends)
            if not depth:
                yield row
        if depth:
            parent = opened[-1]
            parent.add(x.conv_id, x.n)
            if not crosses:
                parent.rows.append(row)
                parent.children += 1
                parent.leaves += x.leaves
                parent.saved += x.saved

    for batch in batches:
        sizes = batch.column("sizes").to_pylist()
        for conv_id, tokens, own_sizes in zip(batch.column("conv_id").to_pylist(), _tokens(batch.column("path")), sizes, strict=True):
            early = path is None
            if early:
                opened.append(Open(0, True))
                shared = 0
            else:
                shared = _agree(path, tokens)
                while len(opened) > shared + 1:
                    yield from close(len(opened) - 1, False)
            opened.extend(Open(size, early) for size in own_sizes[shared:])
            opened[-1].ends.append(conv_id)
            opened[-1].add(conv_id, 1)
            path = tokens.copy()
    while opened:
        yield from close(len(opened) - 1, True)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's ids; rows come sorted by node and place."""
    node, digest, out = None, None, []
    for batch in batches:
        for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if own == node:
                digest.update(b"," + ids.encode())
            else:
                if digest is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(ids.encode())
    if digest is not None:
        out.append((node, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([d for _, d in out])], names=["node", "ends_sha256"])


# --- the trie -----------------------------------------------------------------------------------------------------


def _skeleton_nodes(found: DataFrame) -> DataFrame:
    """Whole skeleton nodes from the shards' partials: node, up, and the columns of the trie but the parent."""
    partials = found.where(F.col("kind") == PARTIAL).groupBy("node").agg(
        *(F.max(c).alias(c) for c in ("depth", "up", "stop", "last")), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
    below = partials.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("skeleton_children"))
    nodes = partials.join(below, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("skeleton_children", F.lit(0)))
    nodes = keep(nodes.select(
        "node", "up", "stop", "depth", "conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("last")).alias("saved"), F.floor(F.col("node") / SECTION).alias("section")))
    sums = nodes.groupBy("section").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("section").rowsBetween(Window.unboundedPreceding, -1)  # a row per section
    inside = Window.partitionBy("section").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    sums = sums.select("section", *(F.coalesce(F.sum(c).over(ahead), zero).alias(f"{c}_ahead") for c in ("leaves", "saved")))
    sums = nodes.join(sums, "section").select(
        "node", *((F.col(f"{c}_ahead") + F.coalesce(F.sum(c).over(inside), zero)).alias(f"{c}_before") for c in ("leaves", "saved")))
    total = nodes.agg(F.max("node") + 1, F.sum("leaves"), F.sum("saved")).toDF("node", "leaves_before", "saved_before")
    stops = sums.unionByName(total).toDF("stop", "leaves_stop", "saved_stop")
    digests = found.where(F.col("kind") == ENDS).select("node", "shard", "seq", "ids").repartition("node").sortWithinPartitions("node", "shard", "seq").mapInArrow(
        _digests, "node long, ends_sha256 string")
    return nodes.join(sums, "node").join(stops, "stop").join(digests, "node", "left").select(
        "node", "up", "conv_id", "depth", "n_convs", "n_children", (F.col("leaves_stop") - F.col("leaves_before")).alias("n_leaves"),
        (F.col("saved_stop") - F.col("saved_before")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """A row for each distinct sequence of first d turns of any path, from d = 0; no rows without conversations.

    conv_id (smallest member), depth, parent_conv_id (NULL at the root), n_convs (members), n_children, n_leaves (childless
    nodes of its subtree), saved_tokens (over its subtree, all members but one times the code points of the last turn) and
    ends_sha256 (of the ids of members that end there, ascending, joined by commas). A conversation without turns ends at the
    root. `paths` as of `conversation_paths`, conv_ids distinct.
    """
    key = [F.col("path"), F.col("conv_id")]
    ranged = paths.repartitionByRange(shards, *key) if shards else paths.repartitionByRange(*key)
    ordered = checkpointed(ranged.sortWithinPartitions(*key).select("conv_id", "path", "sizes"))
    skeleton = paths.sparkSession.sparkContext.broadcast(skeleton_of(ordered))
    found = keep(ordered.mapInArrow(partial(_walk, skeleton=skeleton), OUT))
    crossing = keep(_skeleton_nodes(found))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    above = crossing.select(F.col("node").alias("up"), F.col("conv_id").alias("above"))
    nodes = found.where(F.col("kind") == NODE)
    below = nodes.where("up is not null").drop("parent_conv_id").unionByName(crossing, allowMissingColumns=True)
    return nodes.where("up is null").select(columns).unionByName(below.join(above, "up", "left").withColumnRenamed("above", "parent_conv_id").select(columns))


def op11_conversations(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(conversation_paths(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP11_SQL = r"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
own AS (
  SELECT conv_id AS c, list(md5(coalesce(role, '')) || md5(coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS p,
         list(length(coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
  SELECT c, p, l, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                  lambda v, b: xor(v >> 8, t[(xor(v, b) & 255) + 1])), 4294967295) % 6 AS h FROM own, steps),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(list_slice(b.p, 1, a.h), []), list_slice(a.p, a.h + 1, len(a.p))) AS p,
         list_concat(coalesce(list_slice(b.l, 1, a.h), []), list_slice(a.l, a.h + 1, len(a.l))) AS l
  FROM hashed a LEFT JOIN own b ON b.c = a.c - a.c % 100),
members AS (
  SELECT c, d, md5(array_to_string(list_slice(p, 1, d), '')) AS k, CASE WHEN d > 0 THEN md5(array_to_string(list_slice(p, 1, d - 1), '')) END AS up,
         CASE WHEN d > 0 THEN l[d] ELSE 0 END AS last, d = len(p) AS ends
  FROM (SELECT c, p, l, unnest(range(0, len(p) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n, any_value(last) AS last,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY d, k),
below AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN below USING (d, k)),
sums AS (
  SELECT m.d, m.k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n - 1) * q.last)::BIGINT AS saved_tokens
  FROM full_nodes q JOIN members m ON m.c = q.conv_id AND m.d <= q.d GROUP BY m.d, m.k)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON s.d = n.d AND s.k = n.k LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.up
"""
