"""Search keywords of page views: filter, split into words, count per time window."""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookhouse.operators.sizing import small_join


def search_keywords(page_info: DataFrame) -> DataFrame:
    """Keywords typed into the search page."""
    page = F.col("page")
    return page_info.filter(
        (page["last_page_id"] == "search") & (page["item_type"] == "keyword") & page["item"].isNotNull()
    ).select(page["item"].alias("keyword"), "ts")


def _listed(words: DataFrame) -> DataFrame:
    return words.select(F.col(words.columns[0]).alias("_word")).filter(F.length("_word") > 0).distinct()


# A distinct text stands for itself in joins and shuffles by its 128-bit hash.
KEY = ["_k1", "_k2"]


def _texts(df: DataFrame, text: str) -> DataFrame:
    texts = df.select(F.col(text).alias("_text")).filter(F.length("_text") > 0).distinct()
    return texts.select("_text", F.xxhash64("_text").alias("_k1"), F.xxhash64(F.lit(1), "_text").alias("_k2"))


def _matches(texts: DataFrame, listed: DataFrame) -> DataFrame:
    """(_k1, _k2, _at, _length): every place where a listed word stands in a text.

    All parts of a text that are as long as a listed word are joined with the list, by broadcast only if it fits. They are cut
    from the text's list of characters, so each costs its own length. No list is sent to the driver or to Python.
    """
    lengths = sorted(r[0] for r in listed.select(F.length("_word")).distinct().collect())  # no more than the longest word has
    sized = F.array(*map(F.lit, lengths)).cast("array<int>")
    split = texts.select(*KEY, F.regexp_extract_all("_text", F.lit("(?s)."), F.lit(0)).alias("_chars"))

    def cut(size):
        starts = F.when(F.size("_chars") >= size, F.sequence(F.lit(1), F.size("_chars") - size + 1))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda at: F.struct(
            at.alias("_at"), size.alias("_length"), F.array_join(F.slice("_chars", at, size), "").alias("_word")))

    parts = split.select(*KEY, F.inline(F.flatten(F.transform(sized, cut))))
    return small_join(parts, listed, ["_word"]).select(*KEY, "_at", "_length")


def dictionary_tokens(df: DataFrame, text: str, words: DataFrame) -> DataFrame:
    """One row per word, as column `word`: at each position the longest listed word, else a run of letters or digits, else
    nothing.

    The longest word at each position is a list as long as the text, so the text is walked once, by position.
    """
    texts = _texts(df, text)
    places = texts.select(*KEY, F.explode(F.sequence(F.lit(1), F.length("_text"))).alias("_at"), F.lit(0).alias("_length"))
    longest = places.unionByName(_matches(texts, _listed(words))).groupBy(*KEY, "_at").agg(F.max("_length").alias("_length"))
    dense = longest.groupBy(*KEY).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("_at", "_length"))), lambda x: x["_length"]).alias("_longest"))
    characters = F.regexp_extract_all("_text", F.lit("(?s)."), F.lit(0)).alias("_chars")
    lists = F.struct(F.expr(_LEFT).alias("_left"), F.expr(_SIGN).alias("_sign"), characters)
    once = texts.join(dense, KEY).select("_text", "_longest", F.inline(F.array(lists)))  # `inline` keeps them from being built again for each word
    cut = once.select("_text", F.expr(_WALK).alias("_words"))
    return df.join(cut, F.col(text) == F.col("_text")).withColumn("word", F.explode("_words")).drop("_text", "_words")


# Runs of letters and digits, and every other character alone; `_left` has, for each position, what is left of its run,
# `_sign` the other character.
_PIECES = "regexp_extract_all(_text, '(?s)[A-Za-z0-9]+|[^A-Za-z0-9]', 0)"
_LEFT = f"flatten(transform({_PIECES}, p -> if(p RLIKE '^[A-Za-z0-9]', sequence(length(p), 1, -1), array(0))))"
_SIGN = f"flatten(transform({_PIECES}, p -> if(p RLIKE '^[A-Za-z0-9]', array_repeat('', length(p)), array(p))))"
# The words found so far are kept as the text of their places: a list would be copied with every word.
_WALK = """
    aggregate(
        arrays_zip(_longest, _left, _sign),
        named_struct('at', 1, 'next', 1, 'found', ''),
        (s, x) -> named_struct(
            'at', s.at + 1,
            'next', CASE WHEN s.at < s.next THEN s.next WHEN x._longest > 0 THEN s.at + x._longest ELSE s.at + greatest(x._left, 1) END,
            'found', CASE WHEN s.at < s.next THEN s.found
                          WHEN x._longest > 0 THEN concat(s.found, s.at, ':', x._longest, ' ')
                          WHEN x._left > 0 THEN concat(s.found, s.at, ':', x._left, ' ')
                          WHEN x._sign RLIKE '[\\\\p{L}\\\\p{N}]' THEN concat(s.found, s.at, ':1 ')
                          ELSE s.found END),
        s -> transform(filter(split(s.found, ' '), w -> w <> ''), w -> array_join(
            slice(_chars, cast(substring_index(w, ':', 1) AS int), cast(substring_index(w, ':', -1) AS int)), '')))"""


def best_path(text: str, at: list[int], length: list[int]) -> list[str]:
    """Words of the best way through the graph of listed words (`at`, from 1, and `length` of each).

    Best covers most characters by listed words, then takes the fewest words, then the most even lengths, then the longest
    word at its end. Dynamic programming over the positions, so time follows text and graph. What is left uncovered gives its
    runs of ASCII letters and digits, and other letters and digits one by one.
    """
    ending: list[list[int]] = [[] for _ in range(len(text) + 1)]
    for start, size in zip(at, length):
        ending[start - 1 + size].append(size)
    best, last = [(0, 0, 0)], [0]
    for end in range(1, len(text) + 1):
        score, size = best[end - 1], 0
        for own in ending[end]:
            covered, words, squares = best[end - own]
            reached = (covered + own, words - 1, squares - own * own)
            if reached > score or reached == score and own > size:
                score, size = reached, own
        best.append(score)
        last.append(size)
    out, end, run = [], len(text), ""
    while end:
        size = last[end]
        c = text[end - 1]
        if not size and c.isascii() and c.isalnum():
            run = c + run
        else:
            out += [run] if run else []
            run = ""
            if size or c.isalnum():
                out.append(text[end - max(size, 1) : end])
        end -= max(size, 1)
    out += [run] if run else []
    return out[::-1]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _best_paths(text: pd.Series, at: pd.Series, length: pd.Series) -> pd.Series:
    return pd.Series([best_path(*x) for x in zip(text, at, length)])


def smart_tokens(df: DataFrame, text: str, words: DataFrame) -> DataFrame:
    """One row per word, as column `word`: the words of the best path through all listed words of the text.

    Unlike the longest word at each position, a path may give up a long word whose end belongs to the next one. The graph of
    each distinct text comes from one join with the list; only the path is found in Python, per text and in Arrow batches.
    """
    texts = _texts(df, text)
    graph = _matches(texts, _listed(words)).groupBy(*KEY).agg(F.collect_list(F.struct("_at", "_length")).alias("_graph"))
    places = F.coalesce("_graph", F.array().cast("array<struct<_at:int,_length:int>>"))
    cut = texts.join(graph, KEY, "left").select("_text", _best_paths("_text", places["_at"], places["_length"]).alias("_words"))
    return df.join(cut, F.col(text) == F.col("_text")).withColumn("word", F.explode("_words")).drop("_text", "_words")


def split_keywords(
    df: DataFrame, text: str, mode: str = "whitespace", pattern: str = r"\w+", words: DataFrame | None = None
) -> DataFrame:
    """One row per word of `text`, as column `word`.

    whitespace: parts between blanks. regex: all matches of `pattern`. For text without blanks, with the one-column table
    `words`: dictionary takes the longest word at each place, smart the best path over all words.
    """
    if mode == "whitespace":
        parts = F.split(F.trim(text), r"\s+")
    elif mode == "regex":
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    elif mode == "dictionary":
        return dictionary_tokens(df, text, words)
    elif mode == "smart":
        return smart_tokens(df, text, words)
    else:
        raise ValueError(mode)
    return df.withColumn("word", F.explode(parts)).filter(F.col("word") != "")


def count_by_window(words: DataFrame, size: str = "10 seconds", delay: str | None = "5 seconds") -> DataFrame:
    """Page views per keyword and tumbling window; `ts` in milliseconds."""
    timed = words.withColumn("row_time", F.timestamp_millis("ts"))
    if words.isStreaming and delay:
        timed = timed.withWatermark("row_time", delay)
    return (
        timed.groupBy(F.window("row_time", size), F.col("word").alias("keyword"))
        .agg(F.count("*").alias("views"))
        .select(
            F.unix_millis("window.start").alias("window_start"), F.unix_millis("window.end").alias("window_end"),
            "keyword", "views",
        )
    )
