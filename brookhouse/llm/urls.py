"""URL filter: rules first, then trust and distrust propagated over the graph of hosts.

A url that a rule fits gets the rule's verdict. The others get their host's: trust is personalised PageRank from hosts
most of whose pages the rules allow, along links; distrust is the same from hosts most of whose pages they block, against
the links (who links to a bad host is suspect). A host is blocked if its distrust exceeds its trust by more than `MARGIN` times. Links
are those between different hosts in the pages' html, and between a host and the domain that it is part of, both ways. The
mass of hosts without links goes back to the seeds, and rounds go on until less than `SETTLED` of it still moves.

Both ranks are sums of a series: what seeds send in no, one, two, ... steps, each `DAMPING` times weaker. Mass that goes
back to the seeds only scales the sum, so it is accounted for by making it one at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookhouse.llm.pages import host_of
from brookhouse.llm.scratch import discard, keep

#: (verdict, host and path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
DAMPING, MARGIN = 0.85, 2.0
#: Mass on its way below which trust and distrust have settled, and steps after which that is an error.
SETTLED, ROUNDS = 1e-4, 500
#: Steps between two tables that are written.
STEPS = 8
#: What a row of the propagation is: on its way, or arrived.
TRUST, DISTRUST, TRUST_SUM, DISTRUST_SUM = range(4)
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s"'<>]+)"""


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for each row of pages (page_id, url, html).

    Of the rules that fit, the one with the longest text wins. A url that is NULL or has no :// has an empty host and
    path, fits no rule and is allowed. Equal rows count as often as they occur.
    """
    rest = F.when(F.instr(F.col("url"), "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumns(
        {"host": host_of(F.col("url")), "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # longer ones are asked first
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    rows = rows.withColumns({"rule": rule, "said": verdict})
    hosts = host_scores(rows)
    own = rows.select("page_id", "host", "path", "rule", "said").join(hosts, "host", "left")
    method = F.when(F.col("distrust") > MARGIN * F.col("trust"), "block").otherwise("allow")
    return own.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"),
                      F.round(F.coalesce("trust", F.lit(0.0)), 9).alias("trust"), F.round(F.coalesce("distrust", F.lit(0.0)), 9).alias("distrust"))


def host_scores(rows: DataFrame) -> DataFrame:
    """(host, trust, distrust) of all hosts with pages and links, from rows (host, html, said)."""
    seeds = rows.where("host <> ''").groupBy("host").agg(F.count_if(F.col("said") == "allow").alias("good"), F.count_if(F.col("said") == "block").alias("bad"), F.count("*").alias("n"))
    seeds = keep(seeds.select("host", (2 * F.col("good") > F.col("n")).cast("double").alias("good"), (2 * F.col("bad") > F.col("n")).cast("double").alias("bad")))
    linked = rows.where("host <> ''").select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("url"))
    linked = linked.select(F.col("host").alias("src"), host_of(F.concat(F.lit(":"), F.regexp_replace("url", "^[^/]*:", ""))).alias("dst")).where("dst <> '' and src <> dst")
    up = seeds.select("host", F.expr("substring(host, instr(host, '.') + 1)").alias("parent")).where("instr(host, '.') > 0 and instr(parent, '.') > 0")
    both = up.select(F.col("host").alias("src"), F.col("parent").alias("dst")).unionByName(up.select(F.col("parent").alias("src"), F.col("host").alias("dst")))
    links = linked.unionByName(both).distinct()
    out = links.groupBy("src").agg(F.count("*").alias("outs"))
    into = links.groupBy("dst").agg(F.count("*").alias("ins"))
    links = keep(links.join(out, "src").join(into, "dst").select("src", "dst", "outs", "ins"))
    total = seeds.agg(F.sum("good"), F.sum("bad")).first()
    known = links.select(F.col("src").alias("host")).unionByName(links.select(F.col("dst").alias("host"))).unionByName(seeds.select("host")).distinct()
    known = keep(known)

    def moves(kind: int, after: int, rows: DataFrame, host: str, to: str, share) -> DataFrame:
        return rows.select(F.col(host).alias("host"), F.lit(kind).alias("kind"), F.col(to).alias("to"), F.lit(after).alias("after"), share.alias("share"))

    steps = moves(TRUST, TRUST, links, "src", "dst", DAMPING / F.col("outs")).unionByName(moves(DISTRUST, DISTRUST, links, "dst", "src", DAMPING / F.col("ins")))
    for kind, after in ((TRUST, TRUST_SUM), (DISTRUST, DISTRUST_SUM), (TRUST_SUM, TRUST_SUM), (DISTRUST_SUM, DISTRUST_SUM)):
        steps = steps.unionByName(moves(kind, after, known, "host", "host", F.lit(1.0)))
    steps = keep(steps)
    now = keep(seeds.select("host", F.inline(F.array(
        F.struct(F.lit(TRUST).alias("kind"), (F.col("good") / F.lit(total[0] or 1.0)).alias("mass")),
        F.struct(F.lit(DISTRUST).alias("kind"), (F.col("bad") / F.lit(total[1] or 1.0)).alias("mass"))))).where("mass > 0"))
    done = 0
    while (now.where(F.col("kind").isin(TRUST, DISTRUST)).agg(F.sum("mass")).first()[0] or 0.0) >= SETTLED:
        if done >= ROUNDS:
            raise RuntimeError(f"trust and distrust have not settled after {done} steps")
        after = now
        for _ in range(STEPS):
            after = steps.join(after, ["host", "kind"]).groupBy(F.col("to").alias("host"), F.col("after").alias("kind")).agg(
                F.sum(F.col("share") * F.col("mass")).alias("mass"))
        after = keep(after)
        discard(now)
        now, done = after, done + STEPS
    part = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col("mass"))), F.lit(0.0))
    sums = keep(known.join(now, "host", "left").groupBy("host").agg(part(TRUST, TRUST_SUM).alias("trust"), part(DISTRUST, DISTRUST_SUM).alias("distrust")))
    trust, distrust = sums.agg(F.sum("trust"), F.sum("distrust")).first()
    return sums.select("host", (F.col("trust") / F.lit(trust or 1.0)).alias("trust"), (F.col("distrust") / F.lit(distrust or 1.0)).alias("distrust"))


def op10_urls(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
