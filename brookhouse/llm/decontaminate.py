"""Benchmark decontamination by SimHash of item-sized windows, with DataFrame functions only.

An item is its words; items with the same words are one. Its weighted shingles are runs of k = min(5, words of the item)
words, each weighing its number of characters. The similarity of two texts is the weighted multiset Jaccard of their
shingles: sum of w * min(m, m') over sum of w * max(m, m').

1. Windows. A window at the bound shares weight of at least `similarity` with the item, so it holds one of the item's
   heaviest shingles that weigh more than the rest may (its anchors), at any place in it. Around each anchor in a
   document all starts of windows with as many words as the item that hold the anchor are tried; those whose shingles
   that the item has too weigh at least `similarity` of the item and of the window are windows. No other can reach the
   bound.
2. Fingerprints. Windows and items get 64-bit weighted SimHashes. With `RADIUS` + 1 blocks of bits, two fingerprints
   within the radius agree in at least one block, so a join on (size, block, bits) finds all of them.
   A pair at the bound lies outside the radius with a probability of about 2e-4.
3. Candidates within the radius are verified by their exact weighted similarity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookhouse.llm.scratch import keep
from brookhouse.llm.sqlwords import words_of

WORDS = 5
SIMILARITY = 0.8
#: A pair at similarity 0.8 differs in 9.6 of 64 bits on average, with a deviation of 2.9.
RADIUS = 20
#: Part of a weight that a bound may be off by, as it is a product of doubles.
ROUNDING = 1e-9
#: Anchors that are sent to all tasks at most; more are joined by shuffle.
SMALL = 100_000


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): the documents that hold an item and where its best window starts.

    One row per document and item; `item_id` is the smallest of the items with the same words, `start` the number of
    words before the first of the best windows. Texts that are NULL or blank hold and are nothing; rows with equal
    doc_id are one document; rows without doc_id are reported with a NULL one.
    """
    items = keep(
        benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
        .groupBy("words").agg(F.min("item_id").alias("item_id"))
        .select("item_id", F.md5(F.concat_ws(" ", "words").cast("binary")).alias("item"), "words", F.size("words").alias("n"),
                F.least(F.size("words"), F.lit(WORDS)).alias("k"))
    )
    anchors = keep(_anchors(items, similarity))
    small = anchors.count() <= SMALL
    # rows of one doc_id, or without one, may have different texts
    texts = docs.select("doc_id", F.xxhash64("text").alias("key"), words_of(F.col("text")).alias("words"))
    weighed = items.withColumn("shingles", _shingles("words", "k")).select(
        "item", F.expr("shingles.h").alias("own"), F.expr("aggregate(shingles, 0L, (acc, s) -> acc + s.w)").alias("all"))
    windows = None
    for k in sorted(row.k for row in items.select("k").distinct().collect()):  # WORDS values at most
        found = _windows(texts, anchors.where(F.col("k") == k).drop("k"), weighed, k, small, similarity)
        windows = found if windows is None else windows.unionByName(found)
    if windows is None:
        windows = _windows(texts, anchors.drop("k"), weighed, WORDS, small, similarity)
    windows = keep(windows.distinct().withColumn("window", _shingles("window", "k")).withColumn("print", _fingerprint("window")))
    marked = keep(items.withColumn("shingles", _shingles("words", "k")).withColumn("print", _fingerprint("shingles")))
    near = (
        windows.select("doc_id", "key", "start", "n", "k", "print", _blocks("print"))
        .join(marked.select("item", "n", "k", F.col("print").alias("item_print"), _blocks("print")), ["n", "k", "block"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("doc_id", "key", "start", "n", "print", "item").distinct()
    )
    exact = _similarities(near, windows, marked).where(F.col("similarity") >= similarity)
    return exact.groupBy("doc_id", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("at"))).alias("best")).join(
        marked.select("item", "item_id", F.col("n").alias("n_words")), "item"
    ).select("doc_id", "item_id", F.round("best.similarity", 6).alias("similarity"), (-F.col("best.at")).alias("start"), "n_words")


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that hold no item, with the columns of docs; rows without doc_id stay."""
    held = leaks(docs, benchmark, similarity).where("doc_id is not null").select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti").select(docs.columns)


def _weight(shingle: Column) -> Column:
    return F.char_length(F.concat_ws("", shingle)).cast("long")


def _anchors(items: DataFrame, similarity: float) -> DataFrame:
    """(k, h, item, n): the heaviest shingles of each item, of more weight than a window at the bound may lack."""
    placed = items.select("item", "n", "k", "words", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("k"))).alias("offset"))
    shingle = F.slice("words", F.col("offset") + 1, F.col("k"))
    placed = placed.select("item", "n", "k", "offset", F.xxhash64(shingle).alias("h"), _weight(shingle).alias("w"))
    own = Window.partitionBy("item")
    before = F.sum("w").over(own.orderBy(F.desc("w"), "h", "offset").rowsBetween(Window.unboundedPreceding, -1))
    return (
        placed.withColumn("before", F.coalesce(before, F.lit(0))).withColumn("all", F.sum("w").over(own))
        .where(F.col("before") <= F.lit(1 - similarity + ROUNDING) * F.col("all")).select("k", "h", "item", "n").distinct()
    )


def _windows(texts: DataFrame, anchors: DataFrame, weighed: DataFrame, k: int, small: bool, similarity: float) -> DataFrame:
    """(doc_id, key, n, k, start, window): the item-sized windows that hold an anchor of k words and can still reach the bound.

    window is their words; at the end of a text it may have fewer than the item. A start that several anchors of an item
    share belongs to the first of them.
    """
    placed = texts.where(F.size("words") >= k).select("doc_id", "key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("pos"))
    placed = placed.withColumn("h", F.xxhash64(F.slice("words", F.col("pos") + 1, F.lit(k))))
    first = F.greatest(F.col("pos") - F.col("n") + k, F.lit(0))
    around = F.slice("words", F.col("first") + 1, F.col("pos") + F.col("n") - F.col("first")).alias("around")
    hit = ["doc_id", "key", "item", "n", "pos"]
    if small:
        found = placed.join(F.broadcast(anchors), "h").withColumn("first", first).select(*hit, "first", around)
    else:
        found = placed.drop("words").join(anchors, "h").select(*hit).distinct()
        whole = texts.select(F.col("doc_id").alias("d"), F.col("key").alias("t"), "words").dropDuplicates(["d", "t"])
        found = found.join(whole, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("t"))).withColumn("first", first).select(*hit, "first", around)
    before = F.lag("pos").over(Window.partitionBy("doc_id", "key", "item").orderBy("pos"))
    found = found.withColumn("from", F.greatest("first", F.coalesce(before + 1, F.lit(0)))).where("from <= pos")
    found = found.withColumn("around", F.expr("slice(around, from - first + 1, size(around))")).join(weighed, "item")
    # of each shingle from `from` on: what it weighs, and what of that the item has
    found = found.withColumn("around_shingles", _shingles("around", str(k))).withColumn(
        "weights", F.expr("transform(around_shingles, s -> named_struct('w', s.w, 'm', if(array_contains(own, s.h), s.w, 0L)))"))
    found = found.withColumn("sums", F.expr(
        f"transform(sequence(from, pos), i -> aggregate(slice(weights, i - from + 1, n - {k} + 1), named_struct('w', 0L, 'm', 0L), "
        "(acc, s) -> named_struct('w', acc.w + s.w, 'm', acc.m + s.m)))"))
    able = F.expr(f"filter(sequence(from, pos), i -> sums[i - from].m >= {similarity - ROUNDING!r}D * greatest(all, sums[i - from].w))")
    found = found.select("doc_id", "key", "n", "from", "around", F.explode(able).alias("start"))
    return found.select("doc_id", "key", "n", F.lit(k).alias("k"), "start", F.expr("slice(around, start - from + 1, n)").alias("window"))


def _shingles(words: str, k: str) -> Column:
    return F.expr(
        f"transform(sequence(0, size({words}) - {k}), i -> named_struct('h', xxhash64(slice({words}, i + 1, {k})), "
        f"'w', cast(char_length(concat_ws('', slice({words}, i + 1, {k}))) as bigint)))"
    )


def _fingerprint(shingles: str) -> Column:
    """Bit b is set if the shingles whose hash has it weigh more than the others."""
    return F.expr(
        f"aggregate(sequence(0, 63), 0L, (p, b) -> p | if(aggregate({shingles}, 0L, (acc, s) -> "
        "acc + if((shiftright(s.h, b) & 1L) = 1L, s.w, -s.w)) > 0L, shiftleft(1L, b), 0L))"
    )


def _blocks(fingerprint: str) -> Column:
    cuts = [64 * b // (RADIUS + 1) for b in range(RADIUS + 2)]
    return F.explode(F.array(*(
        F.struct(F.lit(b).alias("no"), F.shiftrightunsigned(fingerprint, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
        for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
    ))).alias("block")


def _similarities(near: DataFrame, windows: DataFrame, marked: DataFrame) -> DataFrame:
    """(doc_id, key, start, n, item, print, similarity) of the candidate pairs."""
    pair = ["doc_id", "key", "start", "n", "item"]
    window = near.join(windows.select(F.col("doc_id").alias("d"), F.col("key").alias("t"), F.col("start").alias("s"), F.col("n").alias("m"), F.col("print").alias("p"), "window"),
                       F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("t")) & (F.col("start") == F.col("s")) & (F.col("n") == F.col("m")) & (F.col("print") == F.col("p")))
    window = window.select(*pair, "print", F.inline("window")).select(*pair, "print", "h", "w", F.lit(1).alias("a"), F.lit(0).alias("b"))
    item = near.join(marked.select("item", "shingles"), "item").select(*pair, "print", F.inline("shingles"))
    both = window.unionByName(item.select(*pair, "print", "h", "w", F.lit(0).alias("a"), F.lit(1).alias("b")))
    each = both.groupBy(*pair, "print", "h", "w").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return each.groupBy(*pair, "print").agg(
        (F.sum(F.col("w") * F.least("a", "b")) / F.sum(F.col("w") * F.greatest("a", "b"))).alias("similarity")
    )


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
