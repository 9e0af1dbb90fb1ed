"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words. Each passage is encoded (shares of kinds of characters, repeats,
word shapes, hashed words), a gated attention learns from document labels alone how much each passage weighs, and the
weighted passage representation is scored. The whole text is encoded, however long it is; memory is that of one slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from brookhouse.llm.scratch import fresh
from brookhouse.llm.words import Texts, text_slices, word_hashes
from brookhouse.llm.workers import frugal

PASSAGE = 64
BUCKETS = 128
#: Labelled documents that the model is fitted on at most (the smallest hashes of their ids); all others are only scored.
SAMPLE = 4000

#: Kinds of bytes: each ASCII sign by itself, then digits, lower, upper, other letters' first bytes, the rest.
_KIND = np.zeros(256, np.int64)
_signs = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
for _n, _b in enumerate(_signs):
    _KIND[_b] = _n
_KIND[0x30:0x3A] = len(_signs)
_KIND[0x61:0x7B] = len(_signs) + 1
_KIND[0x41:0x5B] = len(_signs) + 2
_KIND[0xC0:] = len(_signs) + 3
_KIND[[*range(0x21), *range(0x7F, 0xC0)]] = len(_signs) + 4
KINDS = len(_signs) + 5
SHAPES = 6
WIDTH = KINDS + SHAPES + BUCKETS


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    encode_bias: np.ndarray
    attend: np.ndarray
    gate: np.ndarray
    weigh: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def passages(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """A row of `WIDTH` numbers for each passage of each row's text in order, and where each row's passages begin.

    A text without words is one passage of zeros.
    """
    counts = np.maximum(1, -(-t.words_of_row // PASSAGE))
    begins = np.concatenate([[0], np.cumsum(counts)])
    n = int(begins[-1])
    out = np.zeros((n, WIDTH), np.float32)
    if not len(t.starts):
        return out, begins
    place = np.arange(len(t.starts)) - t.word_starts[t.row_of_word]
    owner = begins[t.row_of_word] + place // PASSAGE
    lengths = t.ends - t.starts
    total = np.bincount(owner, lengths, n)[:, None] + 1e-9
    words = np.bincount(owner, minlength=n)[:, None] + 1e-9
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first - t.starts, lengths)
    kinds = np.bincount(np.repeat(owner, lengths) * KINDS + _KIND[t.raw[at]], minlength=n * KINDS).reshape(n, KINDS)
    out[:, :KINDS] = np.sqrt(kinds / total)
    hashes = word_hashes(t)
    order = np.lexsort((hashes, owner))
    again = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    capital = (_KIND[t.raw[t.starts]] == len(_signs) + 2) | (_KIND[t.raw[t.starts]] == len(_signs) + 3)
    last = _KIND[t.raw[t.ends - 1]] < len(_signs)
    shape = out[:, KINDS : KINDS + SHAPES]
    shape[:, 0] = np.bincount(owner[order][1:], again, n) / words[:, 0]
    shape[:, 1] = np.log1p(total / words)[:, 0]
    shape[:, 2] = np.log1p(words)[:, 0] / 4
    shape[:, 3] = np.bincount(owner, capital, n) / words[:, 0]
    shape[:, 4] = np.bincount(owner, last, n) / words[:, 0]
    shape[:, 5] = np.log1p(np.repeat(t.words_of_row, counts)) / 8
    buckets = np.bincount(owner * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS)
    out[:, KINDS + SHAPES :] = np.sqrt(buckets.reshape(n, BUCKETS) / words)
    out[begins[:-1][t.words_of_row == 0]] = 0
    return out, begins


def _sums(rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.add.reduceat(rows, begins[:-1], axis=0)


def _forward(m: Model, x: np.ndarray, begins: np.ndarray) -> tuple:
    x = (x - m.mean) * m.scale
    h = np.tanh(x @ m.encode + m.encode_bias)
    v, u = np.tanh(h @ m.attend), 1 / (1 + np.exp(-(h @ m.gate)))
    e = (v * u) @ m.weigh
    sizes = np.diff(begins)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins[:-1]), sizes))
    a = e / np.repeat(_sums(e, begins), sizes)
    z = _sums(a[:, None] * h, begins)
    return x, h, v, u, a, z, 1 / (1 + np.exp(-np.clip(z @ m.out + m.bias[0], -30, 30)))


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int | None = None, hidden: int = 32, inner: int = 16) -> Model:
    """Adam on the log loss of the bags' labels; the same bags in the same order give the same model.

    24 epochs, or, for few bags, as many as make 600 steps.
    """
    epochs = epochs or max(24, -(-600 // -(-len(bags) // 64)))
    r = np.random.default_rng(7)
    every = np.concatenate(bags)
    mean, scale = every.mean(axis=0), 1 / (every.std(axis=0) + 1e-2)
    draw = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    m = Model(mean, scale, draw(WIDTH, hidden), np.zeros(hidden, np.float32), draw(hidden, inner), draw(hidden, inner),
              np.zeros(inner, np.float32), np.zeros(hidden, np.float32), np.array([np.log(share / (1 - share))], np.float32))
    first, second, step = [np.zeros_like(p) for p in m[2:]], [np.zeros_like(p) for p in m[2:]], 0
    for epoch in range(epochs):
        order, rate = r.permutation(len(bags)), 4e-3 * (1 - epoch / epochs) + 2e-4
        for at in range(0, len(order), 64):
            own = order[at : at + 64]
            begins = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])])
            x, h, v, u, a, z, p = _forward(m, np.concatenate([bags[i] for i in own]), begins)
            g = ((p - labels[own]) / len(own)).astype(np.float32)
            sizes = np.diff(begins)
            gz = np.repeat(g[:, None] * m.out, sizes, axis=0)
            ga = (gz * h).sum(axis=1)
            ge = a * (ga - np.repeat(_sums(a * ga, begins), sizes))
            gv, gu = ge[:, None] * m.weigh * u * (1 - v * v), ge[:, None] * m.weigh * v * u * (1 - u)
            gh = (a[:, None] * gz + gv @ m.attend.T + gu @ m.gate.T) * (1 - h * h)
            grads = [x.T @ gh, gh.sum(axis=0), h.T @ gv, h.T @ gu, (v * u).T @ ge, z.T @ g, np.array([g.sum()])]
            step += 1
            for k, (old, grad) in enumerate(zip(m[2:], grads, strict=True)):
                grad = grad + (1e-4 * old if old.ndim == 2 else 0)
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                old -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return m


def _learnable(doc_id):
    """Rows with remainder 0 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on at most `sample` labelled documents that are not held out; None if there is none.

    Rows with a NULL doc_id, a quality other than 0 and 1 or several different labels teach nothing.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & _learnable(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("double").alias("quality"), F.max("quality").alias("most")).where("quality = most")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "quality")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")  # at most `sample` rows
        .mapInArrow(_encode, "doc_id long, quality double, bag binary").collect()
    )
    rows.sort(key=lambda row: (row.doc_id, row.bag))
    if not rows:
        return None
    bags = [np.frombuffer(row.bag, np.float32).reshape(-1, WIDTH) for row in rows]
    return fit(bags, np.array([row.quality for row in rows], np.float32))


@frugal
def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for t in text_slices(batch.column("text")):
            x, begins = passages(t)
            own = batch.slice(t.first, t.last - t.first)
            bags = [x[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("quality"), pa.array(bags, pa.binary())], ["doc_id", "quality", "bag"])


def score(docs: DataFrame, model: Model | None, name: str) -> DataFrame:
    """docs with a column `name`: how likely quality 1 is. NULL is the empty text; without a model every score is 0.5."""
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(partial(_score, text=_position(docs, "text"), model=model, names=schema.names), schema)


def _position(docs: DataFrame, name: str) -> int:
    return [column.lower() for column in docs.columns].index(name)


@frugal
def _score(batches: Iterator[pa.RecordBatch], text: int, model: Model | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.full(batch.num_rows, 0.5)
        if model:
            for t in text_slices(batch.column(text)):
                scores[t.first : t.last] = _forward(model, *passages(t))[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, "score").select(
        "doc_id", F.coalesce(~_learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The rows of docs whose score is at least `least`, with the columns of docs."""
    name = fresh(docs.columns, "score")
    return score(docs, train(docs, labels), name).where(F.col(name) >= least).drop(name)
