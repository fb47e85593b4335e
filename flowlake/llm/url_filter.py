"""URL filters by rules and link-graph propagation.

A rule is a host and the begin of a path; it fits its host and all subdomains, and the longest one
that fits decides a url. Urls that no rule fits are judged by host: trust spreads from hosts with
allowed pages along links (personalised PageRank), distrust spreads from hosts whose pages are
mostly blocked against the links, to the hosts that link to them. A host is blocked where its
distrust is above ``THRESHOLD`` of trust and distrust together; a host that neither reaches is
allowed.

Links are ``href`` targets with a host of their own (``scheme://host`` or ``//host``); relative
links stay on the host and carry nothing. Links are counted per pair of hosts before anything is
shuffled, ranks are whole numbers, so reruns agree, and each round is one written table.

A url that is NULL or has no ``://`` has an empty host and path, fits no rule, and is allowed. NULL
html has no links. Repeated rows give repeated results; a NULL page_id stays NULL; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowlake.llm.common import lower_ascii, written

# Rules as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
THRESHOLD = 0.5
DAMPING = 0.85
ROUNDS = 80
WHOLE = 10**15
SETTLED = 10**-4

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)href\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s>]+)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, URL, 1)), F.regexp_extract(url, URL, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or NULL."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of_host, begin in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(begin)
        rule = F.when(fits, F.lit(of_host + begin)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, links) between different hosts."""
    host, _ = url_parts(pages["url"])
    links = F.regexp_extract_all(F.coalesce(pages["html"], F.lit("")), F.lit(LINK), 1)
    return (
        pages.select(host.alias("source"), F.explode(links).alias("target"))
        .withColumn("target", lower_ascii(F.col("target")))
        .filter("source <> '' AND source <> target")
        .groupBy("source", "target").agg(F.count("*").alias("links"))
    )


def seeds(judged: DataFrame) -> DataFrame:
    """(host, kind, seed): shares of ``WHOLE`` of trusted and of blocked hosts, by pages."""
    by_host = judged.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("by_rule") == "allow").alias("allowed"),
        F.count_if(F.col("by_rule") == "block").alias("blocked"),
        F.count("*").alias("pages"),
    )
    mostly = F.col("blocked") * 2 > F.col("pages")
    trusted = by_host.filter(~mostly & (F.col("allowed") > 0)).select("host", F.lit("trust").alias("kind"), F.col("allowed").alias("weight"))
    blocked = by_host.filter(mostly).select("host", F.lit("distrust").alias("kind"), F.col("blocked").alias("weight"))
    every = written(trusted.unionByName(blocked), "url-seeds")
    totals = every.groupBy("kind").agg(F.sum("weight").alias("total"))
    return every.join(F.broadcast(totals), "kind").select(
        "host", "kind", F.round(F.col("weight") / F.col("total") * WHOLE).cast("long").alias("seed")
    )


def propagate(links: DataFrame, start: DataFrame) -> DataFrame:
    """(host, kind, rank) after personalised PageRank along the links for trust, against them for
    distrust. What a host without further links holds returns to the seeds."""
    start = written(start, "url-start")
    forward = links.select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to"), "links")
    backward = links.select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to"), "links")
    edges = forward.unionByName(backward)
    out = edges.groupBy("kind", "host").agg(F.sum("links").alias("out"))
    edges = written(
        edges.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("links") / F.col("out")).alias("share")),
        "url-edges",
    )
    ranks = start.withColumnRenamed("seed", "rank")
    if not edges.limit(1).count():
        return ranks
    for _ in range(ROUNDS):
        flow = (
            edges.join(ranks, ["kind", "host"])
            .select("kind", F.col("to").alias("host"), F.floor(F.col("rank") * F.col("share") * DAMPING).cast("long").alias("flow"))
            .groupBy("kind", "host").agg(F.sum("flow").alias("flow"))
        )
        # What did not flow on, the damped part included, starts again from the seeds.
        rest = flow.groupBy("kind").agg((F.lit(WHOLE) - F.sum("flow")).alias("rest"))
        again = start.join(F.broadcast(rest), "kind", "left").select(
            "kind", "host",
            F.floor(F.col("seed") / WHOLE * F.coalesce("rest", F.lit(WHOLE))).cast("long").alias("flow"),
        )
        new = written(
            flow.unionByName(again).groupBy("kind", "host").agg(F.sum("flow").alias("rank")).filter("rank > 0"),
            "url-ranks",
        )
        change = new.alias("n").join(ranks.alias("o"), ["kind", "host"], "full").agg(
            F.sum(F.abs(F.coalesce("n.rank", F.lit(0)) - F.coalesce("o.rank", F.lit(0)))).alias("change")
        ).first().change
        ranks = new
        if (change or 0) <= WHOLE * SETTLED:
            break
    return ranks


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule and verdict of every row."""
    host, path = url_parts(pages["url"])
    judged = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.select("*", rule.alias("rule"), verdict.alias("by_rule"))
    ranks = propagate(host_links(pages), seeds(judged))
    distrust = F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0))
    blocked = (
        ranks.groupBy("host").agg(distrust.alias("distrust"), F.sum("rank").alias("all"))
        .filter(F.col("distrust") > F.col("all") * threshold)
        .select("host", F.lit("block").alias("by_host"))
    )
    return judged.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict")
    )
