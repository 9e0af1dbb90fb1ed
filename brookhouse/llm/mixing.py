"""Mixing sources to target weights by temperature, with DataFrame functions only.

The weight of a source is its share of all tokens (words) to the power alpha, normalised: 1 keeps the shares, 0 makes
sources equal. alpha is found by bisection (many-way: each job tries a whole grid) to meet either a target entropy, as
a share of that of equal weights, or a limit on how often a source is repeated within the budget; both are monotone in
alpha. A source's weight times the budget is its quota. Quotas are realised as block permutations: documents are dealt
to blocks by hash, whole passes over the source come first, the rest takes whole blocks in an order permuted by seed,
and the block that crosses the quota gives documents in a permuted order as long as they fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookhouse.llm.scratch import fresh, keep
from brookhouse.llm.sqlwords import words_of

SEED = 17
#: Tokens of a block on average.
BLOCK_TOKENS = 100_000
#: A section of a source's blocks are those whose hashes agree but for so many bits: 2**14 sections.
SECTION_BITS = 50
GRID, ROUNDS = 64, 5
#: How far the exponent may be off, and the digits of a weight that count.
STEP, DIGITS = 1 / GRID * (2 / GRID) ** (ROUNDS - 1), 9


def mixture(docs: DataFrame, budget: float = 1.0, entropy: float | None = None, repetition: float | None = 2.0, seed: int = SEED) -> DataFrame:
    """(doc_id, source, n_tokens, weight, copies) for each row of docs (doc_id, text, source).

    `budget` is in parts of all tokens. Give `entropy` (0 to 1) or `repetition` (alpha is then the smallest at which no
    source is repeated more often). A NULL source is a source of its own. Texts without words have 0 tokens: they
    follow the blocks that they are dealt to. Rows that agree in doc_id, source and length follow each other's fate
    unless the quota ends between them. A source whose documents do not fill its quota to the last token falls short by
    less than one document.
    """
    rows = keep(docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("n_tokens")))
    totals = keep(rows.groupBy("source").agg(F.sum("n_tokens").alias("t")))
    alpha = temperature(totals, budget, entropy, repetition)
    shares = totals.select("source", "t", (F.col("t") / F.nullif(F.sum("t").over(_everything()), F.lit(0))).alias("p"), F.sum("t").over(_everything()).alias("all"))
    power = F.when(F.col("t") > 0, F.pow("p", F.lit(alpha))).otherwise(0.0)
    weights = shares.select("source", "t", "all", power.alias("x")).withColumn("weight", F.col("x") / F.nullif(F.sum("x").over(_everything()), F.lit(0.0)))
    # the last digits of a power may differ between machines; the quota must not
    exact = F.round("weight", DIGITS) * F.col("all") * F.lit(float(budget))
    # a quota that is a whole number of passes but for the exponent's last step and the digits left out is one
    passes = F.round(exact / F.nullif(F.col("t"), F.lit(0))) * F.col("t")
    slack = exact * STEP * F.log(F.col("all") / F.min(F.nullif(F.col("t"), F.lit(0))).over(_everything())) + F.col("all") * F.lit(float(budget) * 10.0**-DIGITS)
    quota = F.when(F.abs(passes - exact) <= slack, passes).otherwise(F.floor(exact)).cast("long")
    plan = keep(
        weights.withColumn("quota", F.coalesce(quota, F.lit(0).cast("long")))
        .select("source", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.ceil(F.greatest(F.col("t"), F.lit(1)) / BLOCK_TOKENS).cast("long").alias("blocks"),
                F.when(F.col("t") > 0, F.floor(F.col("quota") / F.col("t"))).otherwise(0).cast("long").alias("passes"),
                F.when(F.col("t") > 0, F.col("quota") % F.col("t")).otherwise(0).cast("long").alias("rest"))
    )
    name = plan.withColumnRenamed("source", "of")
    dealt = rows.join(name, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn(
        "block", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.col("blocks")))
    # blocks come in the order of their hashes; sections of that order are summed first, so no task has all blocks of a source
    place = F.xxhash64(F.lit(seed), F.lit(1), "block")
    blocks = dealt.groupBy("source", "block", "rest").agg(F.sum("n_tokens").alias("b")).withColumn("section", F.shiftright(place, SECTION_BITS))
    sections = blocks.groupBy("source", "section").agg(F.sum("b").alias("s"))
    ahead = F.sum("s").over(Window.partitionBy("source").orderBy("section").rowsBetween(Window.unboundedPreceding, -1))
    sections = sections.select(F.col("source").alias("of"), F.col("section").alias("at"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    order = Window.partitionBy("source", "section").orderBy(place, "block")
    before = F.col("ahead") + F.coalesce(F.sum("b").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = blocks.join(sections, F.col("source").eqNullSafe(F.col("of")) & (F.col("section") == F.col("at"))).select(
        F.col("source").alias("of"), F.col("block").alias("no"), "b", (F.col("rest") - before).alias("room"))
    placed = dealt.join(room, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("no")))
    whole = placed.where((F.col("room") <= 0) | (F.col("b") <= F.col("room"))).withColumn(
        "more", ((F.col("room") > 0) & (F.col("b") <= F.col("room"))).cast("long"))
    crossing = placed.where((F.col("room") > 0) & (F.col("b") > F.col("room")))  # one block of a source at most
    inside = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed), F.lit(2), "doc_id"), "doc_id", "n_tokens")
    part = crossing.withColumn("more", (F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) <= F.col("room")).cast("long"))
    return whole.unionByName(part).select("doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), (F.col("passes") + F.col("more")).alias("copies"))


def _everything() -> Window:
    """All sources: a row each, which is why one task may hold them."""
    return Window.partitionBy(F.lit(0))


def temperature(totals: DataFrame, budget: float, entropy: float | None, repetition: float | None) -> float:
    """The exponent for (source, t). Sources without tokens do not count; without any tokens it is 1."""
    if (entropy is None) == (repetition is None):
        raise ValueError("give either entropy or repetition")
    some = totals.where("t > 0")
    total, sources = some.agg(F.sum("t"), F.count("*")).first()
    if not sources:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / GRID for k in range(GRID + 1)]
        tried = some.select(F.explode(F.array(*map(F.lit, grid))).alias("alpha"), (F.col("t") / F.lit(float(total))).alias("p"))
        tried = tried.select("alpha", "p", F.pow("p", F.col("alpha")).alias("x"))
        sums = tried.groupBy("alpha").agg(
            F.sum("x").alias("z"), F.sum(F.col("x") * F.log("p")).alias("l"), F.max(F.col("x") / F.col("p")).alias("r")
        ).select("alpha", (F.log("z") - F.col("alpha") * F.col("l") / F.col("z")).alias("entropy"), (F.lit(float(budget)) * F.col("r") / F.col("z")).alias("repeated"))
        # flat enough, or not repeated too often: the exponents that fit lie above (repetition) or below (entropy) one
        fits = F.col("repeated") <= repetition * (1 + 1e-12) if entropy is None else F.col("entropy") >= entropy * F.log(F.lit(float(sources))) * (1 - 1e-12)
        good = sorted(row.alpha for row in sums.where(fits).select("alpha").collect())  # GRID + 1 rows at most
        if not good:  # no exponent reaches the target: the shares as they are repeat least, equal weights are flattest
            return 1.0 if entropy is None else 0.0
        edge = good[0] if entropy is None else good[-1]
        at = grid.index(edge)
        low, high = (grid[max(0, at - 1)], edge) if entropy is None else (edge, grid[min(GRID, at + 1)])
    return high if entropy is None else low


def mixed_documents(docs: DataFrame, budget: float, repetition: float) -> DataFrame:
    """The rows of docs as often as the mixture takes them (not at all, once, or in several copies).

    Rows without doc_id are left out: nothing tells which of them the mixture took.
    """
    taken = mixture(docs, budget, None, repetition).where("doc_id is not null").groupBy("doc_id").agg(F.max("copies").alias("n"))
    n, copy, id_ = fresh(docs.columns, "n"), fresh(docs.columns, "copy"), fresh([*docs.columns, "n", "copy"], "of")
    taken = taken.where("n > 0").select(F.col("doc_id").alias(id_), F.col("n").alias(n))
    out = docs.join(taken, F.col("doc_id") == F.col(id_))
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(docs.columns)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    return mixture(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
