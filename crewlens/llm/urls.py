"""URL filters: rules by host and path, and trust spread over the links between hosts.

Rules name a host and the start of a path; the longest rule that fits decides. Where none fits,
the host's place in the link graph does: trust starts at hosts with an allowed page and follows
links, distrust starts at hosts with a blocked page and runs against them, both as personalised
PageRank over host edges. A host is blocked if distrust makes up more than ``MOST_DISTRUST`` of
the two. Scores are handed on until none grows by more than ``TOLERANCE`` of itself; a host that
is reached for the first time grows by all of its score, so every host within reach gets one.

Nulls and edges: a null url, or one without ``://``, has an empty host and path, no rule and no
place in the graph, so it is allowed; a null page text has no links. Hosts that no seed reaches are allowed.
Repeated rows are judged alike, their links count each. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.llm.common import saved

ALLOW, BLOCK = "allow", "block"
RULES = (
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
)
DAMPING = 0.85
#: Growth of a score over ``CUT`` hops, as a share of it, at which it counts as final.
TOLERANCE = 1e-9
#: Hops between two writes.
CUT = 3
#: Hops that the SQL goes, by which 1e-11 of a score is left; the operator has no such end.
HOPS = 160
MOST_DISTRUST = 0.5
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct (size, rule, verdict); null if none does.

    Each suffix of the host is looked up in a map from hosts to their rules.
    """
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, rule in rules:
        by_host.setdefault(rule.split("/", 1)[0], []).append((verdict, rule))
    entries: list[Column] = []
    for name, own in by_host.items():
        made = [
            F.struct(
                F.lit(len(rule)).alias("size"),
                F.lit(rule).alias("rule"),
                F.lit(verdict).alias("verdict"),
                F.lit("/" + rule.split("/", 1)[1]).alias("path"),
            )
            for verdict, rule in own
        ]
        entries += [F.lit(name), F.array(*made)]
    known = F.create_map(*entries)
    labels = F.split(host, r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    fits = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(known, s)), lambda x: x.isNotNull()))
    return F.array_max(F.filter(fits, lambda r: F.startswith(path, r["path"])))


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts, counted: src, dst, links; needs (host, html)."""
    links = pages.where("host <> ''").select(
        F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("link")
    )
    target = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    return (
        links.select("src", host_of(target).alias("dst"))
        .where("dst <> '' AND dst <> src")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of (kind, host): seeds hold (kind, host), edges (kind, src, dst, links).

    Every seed starts with 1. A host hands ``damping`` of its score on along its edges by weight.
    Scores only grow; what is still on its way at the end is at most ``tolerance`` of a host's
    score, times the number of hops that lead to it.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("links").alias("all"))
    steps = saved(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("all")).alias("part")))
    none = F.lit(0.0)
    start = saved(seeds.distinct().select("kind", "host", F.lit(1 - damping).alias("score"), none.alias("before")))
    ranks = start
    while True:
        now = ranks
        for _ in range(CUT):
            handed = now.withColumnRenamed("host", "src").join(steps, ["kind", "src"]).select(
                "kind", F.col("dst").alias("host"), (F.col("score") * F.col("part") * damping).alias("score"), none.alias("before")
            )
            now = handed.unionByName(start).groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("before").alias("before"))
        old = ranks.select("kind", "host", none.alias("score"), F.col("score").alias("before"))
        ranks = saved(now.unionByName(old).groupBy("kind", "host").agg(F.sum("score").alias("score"), F.sum("before").alias("before")))
        if not ranks.agg(F.bool_or(F.col("score") - F.col("before") > tolerance * F.col("score"))).first()[0]:
            return ranks.select("kind", "host", "score")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: float = MOST_DISTRUST) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = parsed.withColumn("hit", longest_rule(F.col("host"), F.col("path"), rules))
    rows = saved(ruled.select("page_id", "host", "path", "hit.rule", "hit.verdict"))
    kind = F.when(F.col("verdict") == ALLOW, F.lit("trust")).otherwise(F.lit("distrust"))
    seeds = saved(rows.where("verdict IS NOT NULL").select(kind.alias("kind"), "host").distinct())
    found = saved(host_edges(parsed))
    edges = found.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        found.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    ranks = spread(edges, seeds)
    scores = ranks.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"),
    )
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    return rows.join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(F.coalesce(bad, F.lit(False)), F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
