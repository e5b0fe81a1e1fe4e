"""URL filter: host and path rules, and link-graph propagation where no rule fits.

Hosts are nodes. Links from their pages to other hosts are edges weighted by their number; a host and its parent
domain are joined both ways by an edge that weighs as much as one link, so that trust and distrust also pass between
the subdomains of a domain. Trust is a personalised PageRank from hosts with pages that a rule allows, along the links; distrust
runs from hosts with pages that a rule blocks, against them: who links to a blocked host is suspect. A host is
blocked where its distrust exceeds its trust by more than THRESHOLD times the mean rank of a host (1 / hosts), which a small leak
through a large shared domain does not reach.

Both walks run together until what is still on its way is at most TOLERANCE of a walk's mass. The rounds follow from the damping:
each leaves at most DAMPING of what was there. STEPS rounds make one plan, in which the edges are shuffled once; its ranks
are written to the shared folder.

Edges are summed per pair of hosts before anything else, so the graph has a row per pair and not per link.

Defined cases: null urls, and urls without ``://``, have an empty host and path, which no rule fits and no link reaches; hosts of
more than 253 characters, which no name server knows, and addresses in digits have no parent domain; a host that no seed reaches has neither
trust nor distrust and is allowed, and so is one with as much of both; null html has no links; repeated rows are judged alike, and each counts
as a page; html of any length is read whole; further columns are left aside; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricetrail.llm.common import lower_ascii, store

# Rules as (host and path, verdict).
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*((?:https?:)?//[^/?#"'<>\s]+)"""
DAMPING, TOLERANCE, STEPS, THRESHOLD = 0.85, 1e-4, 8, 0.25
LONGEST_HOST = 253


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as (length, rule, verdict). Rules stand in a map by their host,
    which is asked for the host and each of its parent domains."""
    by_host: dict[str, list[Column]] = {}
    for rule, verdict in rules:
        where = rule.partition("/")[0]
        by_host.setdefault(where, []).append(F.struct(
            F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"),
            F.lit(rule[len(where):]).alias("path"),
        ))
    table = F.create_map(*[x for where, fits in by_host.items() for x in (F.lit(where), F.array(*fits))])
    labels = F.split(host, r"\.")
    most = max((where.count(".") + 1 for where in by_host), default=1)
    domains = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - (most - 1)), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    known = F.flatten(F.filter(F.transform(domains, lambda d: F.try_element_at(table, d)), lambda f: f.isNotNull()))
    return F.array_max(F.filter(known, lambda r: F.startswith(path, r["path"])))


def read_pages(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Stored page_id, host, path, rule, verdict and the other hosts its links name."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    ruled = parsed.withColumn("r", _rule(F.col("host"), F.col("path"), rules))
    links = F.transform(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)),
        lambda u: lower_ascii(F.regexp_replace(u, r"^(?i:https?:)?//", "")),
    )
    return store(
        ruled.select(
            "page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"),
            F.filter(links, lambda h: h != F.col("host")).alias("links"),
        ),
        "url-pages",
    )


def domain_pairs(hosts: DataFrame) -> DataFrame:
    """src, dst: every host and its parent domain of two labels or more, and that one's, both ways."""
    labels = F.split("host", r"\.")
    named = hosts.where((F.char_length("host") <= LONGEST_HOST) & (F.size(labels) > 2) & ~F.col("host").rlike(r"^[0-9.:]+$"))
    names = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    up = (
        named.select(F.explode(F.arrays_zip(
            F.slice(names, 1, F.size(labels) - 2).alias("src"), F.slice(names, 2, F.size(labels) - 2).alias("dst")
        )).alias("e"))
        .select("e.src", "e.dst").distinct()
    )
    return up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, links: links between hosts by their number, and one each way between a host and its parent domain."""
    linked = (
        pages.where(F.col("host") != "").select(F.col("host").alias("src"), F.explode("links").alias("dst"))
        .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("links"))
    )
    linked = store(linked, "host-links")
    hosts = pages.select("host").unionByName(linked.select(F.col("dst").alias("host"))).distinct()
    domains = domain_pairs(hosts).withColumn("links", F.lit(1.0))
    return linked.unionByName(domains).groupBy("src", "dst").agg(F.sum("links").alias("links"))


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, steps: int = STEPS
) -> DataFrame:
    """Personalised PageRank (walk, host, rank) over (walk, src, dst, links) from seeds (walk, host, weight).

    A host without links passes its rank back to the seeds. That is the same as summing the rounds of a walk
    whose mass ends there, and scaling the sums of each walk to 1. A walk without seeds has no rows.
    """
    totals = seeds.groupBy("walk").agg(F.sum("weight").alias("total"))
    ranks = store(
        seeds.join(totals, "walk").select(
            "walk", "host", (F.col("weight") / F.col("total")).alias("moving"), (F.col("weight") / F.col("total")).alias("sum")
        ),
        "rank-seeds",
    )
    out = edges.groupBy("walk", "src").agg(F.sum("links").alias("out"))
    nodes = (
        edges.select("walk", F.col("src").alias("host")).unionByName(edges.select("walk", F.col("dst").alias("host")))
        .unionByName(seeds.select("walk", "host")).distinct()
    )
    # Every host also keeps its sum, as an edge to itself, so that a round is one join and one aggregate.
    ways = store(
        edges.join(out, ["walk", "src"])
        .select("walk", "src", "dst", (F.col("links") / F.col("out") * damping).alias("share"), F.lit(0.0).alias("keep"))
        .unionByName(nodes.select(
            "walk", F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(0.0).alias("share"), F.lit(1.0).alias("keep")
        )),
        "rank-ways",
    ).withColumnsRenamed({"walk": "on"})
    while True:
        for _ in range(steps):
            ranks = (
                ranks.join(ways, (F.col("walk") == F.col("on")) & (F.col("host") == F.col("src")))
                .groupBy("walk", F.col("dst").alias("host"))
                .agg(F.sum(F.col("moving") * F.col("share")).alias("moving"), F.sum(F.col("sum") * F.col("keep")).alias("kept"))
                .select("walk", "host", "moving", (F.col("kept") + F.col("moving")).alias("sum"))
            )
        ranks = store(ranks, "ranks")
        moving = ranks.groupBy("walk").agg(F.sum("moving").alias("m")).agg(F.max("m")).first()[0] or 0.0
        if moving * damping / (1 - damping) <= tolerance:
            break
    sums = ranks.groupBy(F.col("walk").alias("of")).agg(F.sum("sum").alias("all"))
    return ranks.join(sums, F.col("walk") == F.col("of")).select("walk", "host", (F.col("sum") / F.col("all")).alias("rank"))


def host_scores(pages: DataFrame) -> DataFrame:
    """host, trust, distrust, blocked of every host of the graph that a seed reaches."""
    edges = store(host_edges(pages), "host-edges")
    seeds = store(
        pages.where(F.col("rule").isNotNull()).groupBy(F.col("verdict").alias("walk"), "host")
        .agg(F.count(F.lit(1)).cast("double").alias("weight")),
        "url-seeds",
    )
    back = edges.select(F.lit("block").alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    ranks = propagate(edges.withColumn("walk", F.lit("allow")).unionByName(back), seeds)
    hosts = pages.select("host").unionByName(edges.select(F.col("src").alias("host"))).unionByName(
        edges.select(F.col("dst").alias("host"))
    ).distinct().count()

    def rank(walk: str) -> Column:
        return F.sum(F.when(F.col("walk") == walk, F.col("rank")).otherwise(0.0))

    scores = ranks.groupBy("host").agg(rank("allow").alias("trust"), rank("block").alias("distrust"))
    return scores.withColumn("blocked", F.col("distrust") - F.col("trust") > THRESHOLD / max(hosts, 1))


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust for every row of ``pages``."""
    read = read_pages(pages, RULES if rules is None else rules)
    scores = host_scores(read).withColumnRenamed("host", "of")
    zero = F.lit(0.0)
    by_graph = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return read.join(scores, F.col("host") == F.col("of"), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", by_graph).alias("verdict"),
        F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust"),
    )
