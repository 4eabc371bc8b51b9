"""URL filters: host and path rules, then link-graph propagation for what no rule judges.

The longest rule that fits decides. Other pages are judged by their host: personalised PageRank
spreads trust along links from hosts whose pages the rules mostly allow, and against the links it
spreads distrust from hosts whose pages the rules mostly block. Both are in units of a seed: a host whose links
all go to blocked hosts has a distrust of DAMPING, one with one such link in 500 has a 500th of it. A host is
blocked if its distrust is over FLOOR, and over MARGIN of the sum of both. Links are the absolute hrefs of the pages
("//host/path" included), as host pairs with counts; links within a host say nothing about others and are left out.

Ranks are joins and aggregations over hosts. Each round moves on what the round before added, until
nothing moves or no host gets as much as TOLERANCE; a round adds at most DAMPING of the one before, so there are some 30. Host
pairs are counted before they meet, so that a host with a third of all pages is one row; ranks are summed before the shuffle as well.

Nulls and edges: a null url or one without "://" has an empty host and path, fits no rule and is
allowed; a null html has no links; a null page_id stays; repeated rows are judged one by one and their links count
again; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ascii_lower, materialize

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
DAMPING, MARGIN, FLOOR, TOLERANCE = 0.85, 0.75, 0.2, 0.005
HREF = r"""(?i)href\x20*=\x20*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\x20>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^?#]*)", 1)
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/]*(.*)$", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: str, path: str, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that decides and its verdict, null where none fits; a few hundred rules at most."""
    rule = verdict = None
    for what, text in sorted(rules, key=lambda r: -len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((F.col(host) == domain) | F.col(host).endswith(f".{domain}")) & F.col(path).startswith(slash + rest)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(what)) if verdict is None else verdict.when(fits, F.lit(what))
    return rule, verdict


def with_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and rule_verdict for each row of pages."""
    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule("host", "path", rules)
    return out.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts with their counts."""
    host, _ = host_and_path(F.col("url"))
    hrefs = F.regexp_extract_all("html", F.lit(HREF), F.lit(1))
    links = pages.select(host.alias("src"), F.explode_outer(hrefs).alias("href")).where("href is not null")
    to, _ = host_and_path(F.when(F.col("href").startswith("//"), F.concat(F.lit("any:"), "href")).otherwise(F.col("href")))
    return links.select("src", to.alias("dst")).where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def weighted_links(edges: DataFrame) -> DataFrame:
    """(src, dst, w): the share that a link pair (src, dst, n) has of the links of src."""
    return edges.join(edges.groupBy("src").agg(F.sum("n").alias("total")), "src").select("src", "dst", (F.col("n") / F.col("total")).alias("w"))


def personalised_rank(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, rank) moved along links (src, dst, w) from seeds (host), which count 1 each.

    Limits mean the same for any number of hosts; what hosts without links hold flows nowhere.
    """
    added = seeds.select("host", F.lit(1.0).alias("rank"))
    ranks = [added]
    while True:
        moved = added.join(links, F.col("host") == F.col("src")).groupBy("dst").agg((F.sum(F.col("rank") * F.col("w")) * damping).alias("rank"))
        added = materialize(moved.select(F.col("dst").alias("host"), "rank"))
        most = added.agg(F.max("rank")).first()[0]
        if most is None:
            break
        ranks.append(added)
        if most < tolerance:
            break
    every = ranks[0]
    for more in ranks[1:]:
        every = every.union(more)
    return every.groupBy("host").agg(F.sum("rank").alias("rank"))


def host_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, margin: float = MARGIN, floor: float = FLOOR) -> DataFrame:
    """(host, trust, distrust, host_verdict) of the hosts that have any trust or distrust."""
    links = materialize(weighted_links(materialize(host_links(pages))))
    by_host = with_rules(pages, rules).where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("rule_verdict") == "allow").alias("good"), F.count_if(F.col("rule_verdict") == "block").alias("bad"))
    by_host = materialize(by_host)
    seeds = {kind: by_host.where(f"{kind} * 2 > n").select("host") for kind in ("good", "bad")}
    trust = personalised_rank(links, seeds["good"])
    distrust = personalised_rank(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"), seeds["bad"])
    both = trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full").fillna(0.0, ["trust", "distrust"])
    blocked = (F.col("distrust") > floor) & (F.col("distrust") > margin * (F.col("trust") + F.col("distrust")))
    return both.withColumn("host_verdict", F.when(blocked, "block").otherwise("allow"))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict for each row of pages."""
    judged = with_rules(pages, rules)
    hosts = materialize(host_verdicts(pages, rules)).where("host_verdict = 'block'").select("host", "host_verdict")
    out = judged.join(hosts, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"))
