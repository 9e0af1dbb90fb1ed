"""Language identification by a linear-chain conditional random field over words.

A word's features are its first 1 to 3 and last 1 to 4 bytes, its byte pairs and triples (all hashed), and itself if it is
in the lexicon of the training texts. The states are the languages. Weights and transitions are learned together by
gradient descent on the log loss of the chain, computed by forward-backward, from sequences that switch between texts of
different languages. A text is labelled word by word with the posteriors of forward-backward over all its words; its
language is the one with most posterior mass.

Long texts cost no long loop: they are cut into segments whose transfer matrices are computed side by side, chained, and
then filled in, which gives exactly the posteriors of the whole chain.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookhouse.llm.words import LOWER, Texts, mix, text_slices

#: Documents of a language that the field is fitted on at most (the smallest hashes of their ids, none of more bytes than
#: SAMPLE_BYTES); all others are only labelled.
SAMPLE = 250
SAMPLE_BYTES = 1 << 16
HASHED = 1 << 16
LEXICON = 30_000
SEGMENT = 128
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True


class Field(NamedTuple):
    languages: list[str]
    lexicon: np.ndarray  # sorted hashes of words
    weights: np.ndarray  # (HASHED + words of the lexicon) x languages
    transitions: np.ndarray


def distinct_words(t: Texts) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a slice with A-Z lower-cased, and which of them each word is."""
    sizes = t.ends - t.starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    letters = LOWER[t.raw[np.arange(offsets[-1]) + np.repeat(t.starts - offsets[:-1], sizes)]]
    coded = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def features(words: pa.Array, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of all words in order, and where each word's begin (one more than words). Words without a letter have none."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)
    n = len(words)
    sizes = np.diff(offsets)
    lettered = np.bincount(np.repeat(np.arange(n), sizes), _LETTER[raw[offsets[0] : offsets[-1]]], n) > 0
    framed = np.zeros(int(sizes.sum()) + 2 * n + 4, np.uint64)  # each word between two marks
    begins = np.arange(n) * 2 + offsets[:-1] - offsets[0]
    place = np.arange(int(sizes.sum())) - np.repeat(offsets[:-1] - offsets[0], sizes)
    framed[np.repeat(begins, sizes) + 1 + place] = raw[offsets[0] : offsets[-1]].astype(np.uint64) + np.uint64(1)
    pair = framed[:-1] * np.uint64(257) + framed[1:]
    triple = pair[:-1] * np.uint64(257) + framed[2:]
    owners, ids = [], []

    def add(owner: np.ndarray, value: np.ndarray, kind: int) -> None:
        owners.append(owner)
        ids.append((mix(value + (np.uint64(kind) << np.uint64(48))) % np.uint64(HASHED)).astype(np.int64))

    every = np.arange(n)
    for kind, grams, more in ((1, pair, 1), (2, triple, 0)):
        each = sizes + more
        at = np.repeat(begins, each) + np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        add(np.repeat(every, each), grams[at], kind)
    for kind, length in enumerate((1, 2, 3), 3):
        own = every[sizes >= length]
        value = np.zeros(len(own), np.uint64)
        for k in range(length):
            value = value * np.uint64(257) + framed[begins[own] + 1 + k]
        add(own, value, kind)
    for kind, length in enumerate((1, 2, 3, 4), 6):
        own = every[sizes >= length]
        value = np.zeros(len(own), np.uint64)
        for k in range(length):
            value = value * np.uint64(257) + framed[begins[own] + sizes[own] - k]
        add(own, value, kind)
    if len(lexicon):
        hashes = hashes_of(words)
        at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
        known = lexicon[at] == hashes
        owners.append(every[known])
        ids.append(HASHED + at[known])
    owner, ids = np.concatenate(owners), np.concatenate(ids)
    keep = lettered[owner]
    owner, ids = owner[keep], ids[keep]
    order = np.argsort(owner, kind="stable")
    return ids[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def hashes_of(words: pa.Array) -> np.ndarray:
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw, sizes = np.frombuffer(data, np.uint8), np.diff(offsets)
    place = np.arange(int(sizes.sum())) - np.repeat(offsets[:-1] - offsets[0], sizes)
    value = mix(raw[offsets[0] : offsets[-1]].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)))
    return mix(np.add.reduceat(value, offsets[:-1] - offsets[0])) if len(words) else np.zeros(0, np.uint64)


def emissions(ids: np.ndarray, begins: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros((len(begins) - 1, weights.shape[1]), np.float32)
    some = np.flatnonzero(np.diff(begins))
    if len(some):
        out[some] = np.add.reduceat(weights[ids], begins[some], axis=0)
    return out


def posteriors(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """For each word the posterior of each state. scores: of all words of all texts in order; counts: words of each text."""
    return messages(scores, counts, transitions)[0]


def messages(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The posteriors and the forward messages, both summing to one for each word. A text starts from a uniform state
    before its first word."""
    n, states = scores.shape
    if not n:
        return np.zeros((0, states)), np.zeros((0, states))
    move = np.exp(transitions - transitions.max()).astype(np.float64)
    potential = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    segments = -(-counts // SEGMENT)
    total = int(segments.sum())
    text = np.repeat(np.arange(len(counts)), segments)
    number = np.arange(total) - np.repeat(np.cumsum(segments) - segments, segments)
    first = (np.cumsum(counts) - counts)[text] + number * SEGMENT
    length = np.minimum(SEGMENT, counts[text] - number * SEGMENT)
    longest = int(length.max())

    def at(step: int) -> tuple[np.ndarray, np.ndarray]:
        own = np.flatnonzero(length > step)
        return own, potential[first[own] + step]

    transfer = np.broadcast_to(np.eye(states), (total, states, states)).copy()
    for step in range(longest):
        own, p = at(step)
        m = (transfer[own] @ move) * p[:, None, :]
        transfer[own] = m / m.max(axis=(1, 2), keepdims=True)
    ahead = np.full((total, states), 1 / states)
    behind = np.ones((total, states))
    order = [np.flatnonzero(number == k) for k in range(int(number.max()) + 1)] if number.max() < 64 else np.split(
        np.argsort(number, kind="stable"), np.cumsum(np.bincount(number))[:-1])
    for own in order[1:]:
        x = np.einsum("ni,nij->nj", ahead[own - 1], transfer[own - 1])
        ahead[own] = x / x.sum(axis=1, keepdims=True)
    for own in reversed(order[1:]):
        x = np.einsum("nij,nj->ni", transfer[own], behind[own])
        behind[own - 1] = x / x.sum(axis=1, keepdims=True)
    out = np.empty((n, states))
    for step in range(longest):
        own, p = at(step)
        x = (ahead[own] @ move) * p
        ahead[own] = x / x.sum(axis=1, keepdims=True)
        out[first[own] + step] = ahead[own]
    forward = out.copy()
    for step in reversed(range(longest)):
        own, p = at(step)
        out[first[own] + step] *= behind[own]
        x = (p * behind[own]) @ move.T
        behind[own] = x / x.sum(axis=1, keepdims=True)
    return out / out.sum(axis=1, keepdims=True), forward


def loss_gradient(scores: np.ndarray, counts: np.ndarray, true: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the summed log loss of the texts' true states, by the scores of each word and by the transitions.

    The joint posterior of two neighbours is forward message times move times what the second's posterior adds to the
    message that reaches it. Before the first word stands a uniform state, in the loss of the true states as well.
    """
    post, forward = messages(scores, counts, transitions)
    wrong = post.copy()
    wrong[np.arange(len(true)), true] -= 1
    move = np.exp(transitions - transitions.max())
    starts = (np.cumsum(counts) - counts)[counts > 0]
    inner = np.ones(len(true), bool)
    inner[starts] = False
    b = np.flatnonzero(inner)
    joint = forward[b - 1][:, :, None] * move[None] * (post[b] / np.maximum(forward[b - 1] @ move, 1e-300))[:, None, :]
    grad = joint.sum(axis=0)
    np.add.at(grad, (true[b - 1], true[b]), -1)
    return wrong, grad + move / move.sum(axis=0) * wrong[starts].sum(axis=0)


def fit(texts: list[str], languages: list[str], epochs: int = 3, rate: float = 0.3) -> Field:
    """Adagrad over sequences of one to three pieces of texts; the same input in the same order gives the same field."""
    names = sorted(set(languages))
    r = np.random.default_rng(11)
    gold = np.array([names.index(x) for x in languages])
    words, index, owner = [], [], []
    done = 0
    for t in text_slices(pa.array(texts, pa.string()), 1 << 40):
        words, index = distinct_words(t)
        owner = t.row_of_word + done
    hashes = hashes_of(words)
    often = np.argsort(-np.bincount(index, minlength=len(words)), kind="stable")[:LEXICON]
    lexicon = np.unique(hashes[often])
    ids, begins = features(words, lexicon)
    weights = np.zeros((HASHED + len(lexicon), len(names)), np.float32)
    squares = np.full_like(weights, 1e-2)
    transitions, moved = np.zeros((len(names), len(names))), np.full((len(names), len(names)), 1e-2)
    cuts = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | ((np.arange(len(owner)) - np.searchsorted(owner, owner)) % 64 == 0))
    pieces = list(zip(cuts, [*cuts[1:], len(owner)], strict=True))
    for _ in range(epochs):
        order, at = r.permutation(len(pieces)), 0
        while at < len(order):
            chosen, counts = [], []
            while at < len(order) and len(counts) < 96:
                k = int(r.integers(1, 4))
                own = [np.arange(*pieces[i]) for i in order[at : at + k]]
                chosen += own
                counts.append(sum(map(len, own)))
                at += k
            place = np.concatenate(chosen)
            used, which = np.unique(index[place], return_inverse=True)
            sizes = np.diff(begins)[used]
            flat = ids[np.arange(int(sizes.sum())) + np.repeat(begins[used] - np.cumsum(sizes) + sizes, sizes)]
            scores = emissions(flat, np.concatenate([[0], np.cumsum(sizes)]), weights)[which]
            counts = np.array(counts)
            wrong, moves = loss_gradient(scores, counts, gold[owner[place]], transitions)
            delta = np.stack([np.bincount(which, wrong[:, s], len(used)) for s in range(len(names))], axis=1)
            grad = np.zeros_like(weights)
            np.add.at(grad, flat, np.repeat(delta, sizes, axis=0).astype(np.float32))
            grad /= len(counts)
            squares += grad * grad
            weights -= rate * grad / np.sqrt(squares)
            g = moves / len(counts)
            moved += g * g
            transitions -= rate * g / np.sqrt(moved)
    return Field(names, lexicon, weights, transitions)


def _learnable(doc_id):
    """Rows with remainder 2 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def train(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Fit on at most `sample` documents of each lang, with text and not held out; None if there is none.

    Of rows with equal doc_id and lang the one with the smallest text teaches, so neither repeated rows nor a very long
    text make the sample larger than `sample` times SAMPLE_BYTES for a language.
    """
    some = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & _learnable(F.col("doc_id"))
        & (F.octet_length("text") <= SAMPLE_BYTES) & (F.btrim("text", F.lit(" \t\r\n\x0b\x0c")) != ""))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = some.select("doc_id", "lang").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).drop("n")
    chosen = some.join(F.broadcast(ids), ["doc_id", "lang"])  # `sample` ids of a language at most
    rows = sorted(tuple(row) for row in chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect())
    return fit([row[2] for row in rows], [row[1] for row in rows]) if rows else None


def _label(batches: Iterator[pa.RecordBatch], field: Field | None, spans: bool) -> Iterator[pa.RecordBatch]:
    names = [*field.languages, UNKNOWN] if field else [UNKNOWN]
    for batch in batches:
        for t in text_slices(batch.column(1)):
            n = len(t.words_of_row)
            best, score = np.full(n, len(names) - 1), np.zeros(n)
            runs: list[list[dict]] = [[] for _ in range(n)]
            if field and len(t.starts):
                words, index = distinct_words(t)
                ids, begins = features(words, field.lexicon)
                lettered = np.diff(begins)[index] > 0
                post = posteriors(emissions(ids, begins, field.weights)[index], t.words_of_row[t.words_of_row > 0], field.transitions)
                mass = np.stack([np.bincount(t.row_of_word, post[:, s] * lettered, n) for s in range(post.shape[1])], axis=1)
                total = mass.sum(axis=1)
                known = total > 0
                known[known] = [_has_letter(t, row) for row in np.flatnonzero(known)]
                best[known] = mass[known].argmax(axis=1)
                score[known] = np.clip(mass[known].max(axis=1) / total[known], 0, 1)
                if spans:
                    label = np.where(lettered, post.argmax(axis=1), -1)
                    _runs(runs, np.flatnonzero(known), label, t, names)
            columns = [batch.column(0).slice(t.first, t.last - t.first), pa.array([names[i] for i in best], pa.string()), pa.array(score)]
            if spans:
                columns.append(pa.array(runs, pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("words", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "spans"][: len(columns)])


def _has_letter(t: Texts, row: int) -> bool:
    """Bytes tell it for ASCII letters; other letters are asked for."""
    raw = t.raw[t.row_starts[row] : t.row_starts[row + 1]]
    return bool((_LETTER[raw] & (raw < 0x80)).any()) or any(map(str.isalpha, raw[raw >= 0x80].tobytes().decode("utf-8", "ignore")))


def _runs(runs: list[list[dict]], rows: np.ndarray, label: np.ndarray, t: Texts, names: list[str]) -> None:
    for row in rows:
        a, b = t.word_starts[row], t.word_starts[row + 1]
        own = np.flatnonzero(label[a:b] >= 0)
        if len(own):
            cuts = own[np.concatenate([[0], np.flatnonzero(np.diff(label[a:b][own])) + 1])]
            ends = [*cuts[1:], b - a]
            runs[row] = [{"lang": names[label[a + x]], "start": int(x), "words": int(y - x)} for x, y in zip(cuts, ends, strict=True)]


def languages(docs: DataFrame, field: Field | None, spans: bool = True) -> DataFrame:
    """(doc_id, lang_pred, score, spans): the language with most posterior mass and its share, and the runs of words of one
    language (the place of the first word and their number; words without letters belong to the run before).

    Texts that are NULL or have no letter, and all texts without a field, are `und` with score 0 and have no spans.
    """
    kind = dict(docs.dtypes)["doc_id"]
    more = ", spans array<struct<lang:string,start:int,words:int>>" if spans else ""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        partial(_label, field=field, spans=spans), f"doc_id {kind}, lang_pred string, score double{more}")


def op6_languages(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return languages(docs, train(docs), spans=False).select(
        "doc_id", F.coalesce(~_learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
