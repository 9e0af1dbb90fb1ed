"""Substring dedup: words covered by a window that also starts earlier, found behind a count-min prefilter.

1. Each task counts the anchors of its texts in a sketch (`windows`, `sketch`); a window's anchor stands wherever the window
   does, so the merged sketch never estimates a window below its count.
2. Texts are read again. Only windows whose estimate is two or more are sent, once per document, and grouped exactly by
   their 128-bit hash: the smallest doc_id of each is its first document.
3. Documents meet the windows whose first document they are. Every window with a high estimate that is not such a first one,
   or not its document's earliest, goes. Windows estimated too high are first where they stand, so they stay.

A repeated window is never lost: its estimate is at least its count. With a corpus that outgrows the largest sketch more
windows are estimated too high and grouped; that costs shuffle, in proportion to the text, and changes no result.

Rows without doc_id keep all words and count for none. Rows with an equal doc_id are judged each for itself: neither is
earlier than the other, so repeated rows give equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookhouse.llm.sketch import ROWS, Sketch, cells_for, maybe_repeated, merged, text_bytes
from brookhouse.llm.windows import SLICE_BYTES, windows
from brookhouse.llm.words import Texts, text_slices

WINDOW, ANCHOR = 20, 10


def _count(batches: Iterator[pa.RecordBatch], cells: int, window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    sketch = Sketch(cells)
    for batch in batches:
        for t in text_slices(batch.column("text"), SLICE_BYTES):
            sketch.add(windows(t, window, anchor).marks)
    yield from sketch.blocks()


def _suspects(t: Texts, again: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and hashes of the windows with high estimates, and which of them are the earliest of their row."""
    w = windows(t, window, anchor)
    some = np.flatnonzero(maybe_repeated(again, w.anchors))
    rows, starts, h1, h2 = w.rows[some], w.starts[some], w.h1[some], w.h2[some]
    order = np.lexsort((starts, h2, h1, rows))
    same = np.zeros(len(some), bool)
    a, b = order[1:], order[:-1]
    same[1:] = (rows[a] == rows[b]) & (h1[a] == h1[b]) & (h2[a] == h2[b])
    earliest = np.empty(len(some), bool)
    earliest[order] = ~same
    return rows, starts, h1, h2, earliest


def _candidates(batches: Iterator[pa.RecordBatch], again: Broadcast, window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for t in text_slices(batch.column("text"), SLICE_BYTES):
            rows, _, h1, h2, earliest = _suspects(t, again.value, window, anchor)
            columns = [h1[earliest].view(np.int64), h2[earliest].view(np.int64), ids[t.first : t.last][rows[earliest]].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["h1", "h2", "doc_id"])


def _cut(batches: Iterator[pa.RecordBatch], again: Broadcast, window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, firsts = batch.column("doc_id"), batch.column("firsts")
        for t in text_slices(batch.column("text"), SLICE_BYTES):
            rows, starts, h1, _, earliest = _suspects(t, again.value, window, anchor)
            own = firsts.slice(t.first, t.last - t.first)
            keeps = earliest & _holds(own, rows, h1.view(np.int64))
            keeps |= ids.slice(t.first, t.last - t.first).is_null().to_numpy(zero_copy_only=False)[rows]
            at = t.word_starts[rows[~keeps]] + starts[~keeps]
            edges = np.zeros(len(t.starts) + 1, np.int64)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + window, -1)
            stays = np.cumsum(edges[:-1]) == 0
            removed = t.words_of_row - np.bincount(t.row_of_word[stays], minlength=len(t.words_of_row))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(t.first, t.last - t.first), pa.array(t.words_of_row, pa.int64()), pa.array(removed, pa.int64()), _joined(t, stays)],
                names=["doc_id", "n_words", "n_removed", "kept"])


def _holds(lists: pa.ListArray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the list of a row has a value; a NULL list has none."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(lists)), sizes)
    order = np.lexsort((flat, of))
    of, flat = of[order], flat[order]
    begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.zeros(len(rows), bool)
    cuts = np.searchsorted(rows, np.arange(len(lists) + 1))
    for row in np.flatnonzero((sizes > 0) & (cuts[1:] > cuts[:-1])):
        own = flat[begins[row] : begins[row + 1]]
        mine = slice(cuts[row], cuts[row + 1])
        at = np.searchsorted(own, values[mine])
        out[mine] = own[np.minimum(at, len(own) - 1)] == values[mine]
    return out


def _joined(t: Texts, stays: np.ndarray) -> pa.Array:
    """The words of each row that stay, joined by one space."""
    n = len(t.words_of_row)
    left = np.flatnonzero(stays)
    last = np.ones(len(left), bool)
    last[:-1] = t.row_of_word[left[1:]] != t.row_of_word[left[:-1]]
    stops = t.ends[left] + ~last  # with the white space after a word, but for a row's last one
    letters = t.raw.copy()
    letters[t.ends[left[~last]]] = 0x20
    edges = np.zeros(len(letters) + 1, np.int8)
    edges[t.starts[left]] += 1
    np.subtract.at(edges, stops, 1)
    chosen = letters[np.cumsum(edges[:-1], dtype=np.int8) > 0]
    sizes = np.bincount(t.row_of_word[left], stops - t.starts[left], n).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(chosen))


def deduplicate(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, cells: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of docs (doc_id, text).

    A word is a run of characters other than space and \\t..\\r. It goes if a window of `window` words that covers it also
    starts in a smaller doc_id, or earlier in its own text; `kept` has the others, joined by one space. A NULL text has no
    words and an empty `kept`. `cells`: size of the sketch, a power of two of at least 8; by default it follows the text.
    """
    if not 0 < anchor <= window:
        raise ValueError("an anchor lies within its window")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = docs.where("doc_id is not null")
    cells = cells or cells_for(text_bytes(counted))
    sizes = {"window": window, "anchor": anchor}
    blocks = counted.select("text").mapInArrow(partial(_count, cells=cells, **sizes), ROWS)
    again = spark.sparkContext.broadcast(merged(blocks, cells))
    found = counted.mapInArrow(partial(_candidates, again=again, **sizes), "h1 long, h2 long, doc_id long")
    firsts = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id")).groupBy("doc_id").agg(F.collect_list("h1").alias("firsts"))
    return docs.join(firsts, "doc_id", "left").select("doc_id", "text", "firsts").mapInArrow(
        partial(_cut, again=again, **sizes), "doc_id long, n_words long, n_removed long, kept string")


def op12_substrings(spark, sf_dir: str) -> DataFrame:
    kept = deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later),
kept AS (
  SELECT a.doc_id, a.i, a.w, b.i IS NOT NULL AS gone
  FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS w FROM words) a LEFT JOIN gone b ON a.doc_id = b.doc_id AND a.i = b.i),
sums AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(w, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN sums USING (doc_id)
"""
