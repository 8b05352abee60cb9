"""URL filters: rules on hosts and paths, and trust and distrust spread over the link graph of hosts.

Rules decide the urls they fit; the longest wins. Hosts with urls that rules allow are trusted seeds, hosts with urls
that rules block are distrusted ones, each by the share of its pages so judged. Trust follows links (personalised
PageRank), distrust runs against them: who links mainly to bad hosts is suspect, however many others do. A url without a
rule is blocked if its host's distrust exceeds its trust and reaches THRESHOLD of what a host with all its pages blocked
has by itself.

Host pairs are counted before they are joined, and a host is one row in each round, however many pages it has.
Defined results: a null url, or one without ``://``, has an empty host and path, which no rule fits and no link reaches;
null pages have no links; loops from a host to itself carry nothing; repeated rows and page_ids are judged each by
itself, and count as pages and links of their host; columns other than page_id, url and html are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, Scratch

FOLLOW, THRESHOLD = 0.85, 0.75
#: Rounds end when nothing moves by more than this.
MOVED = 1e-3
#: With more rules than this, they are joined by host instead of written out as one expression; both give the same.
INLINE = 64


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(pages: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """page_id, host, path, rule and allowed (null where no rule fits); other columns stay."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    parts = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    if len(ordered) <= INLINE:
        rule, allowed = F.lit(None).cast("string"), F.lit(None).cast("boolean")
        for r in reversed(ordered):
            fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
            rule, allowed = F.when(fits, r.text).otherwise(rule), F.when(fits, r.allow).otherwise(allowed)
        return parts.withColumns({"rule": rule, "allowed": allowed})
    table = pages.sparkSession.createDataFrame([(r.host, r.path, r.text, r.allow, k) for k, r in enumerate(ordered)], "h string, p string, t string, a boolean, k int")
    by_host = table.groupBy("h").agg(F.sort_array(F.collect_list(F.struct("k", "p", "t", "a"))).alias("all"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    urls = parts.select("host", "path").distinct()
    fits = urls.select("host", "path", F.explode(suffixes).alias("h")).join(F.broadcast(by_host), "h")  # the rules, given as a list
    fits = fits.select("host", "path", F.get(F.filter("all", lambda x: F.col("path").startswith(x["p"])), F.lit(0)).alias("m")).filter("m is not null")
    best = fits.groupBy("host", "path").agg(F.min("m").alias("m"))
    return parts.join(best, ["host", "path"], "left").withColumns({"rule": F.col("m.t"), "allowed": F.col("m.a")}).drop("m")


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, from the pages' absolute references."""
    link = F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""), F.lit(1)))
    links = pages.select(host_of(F.col("url")).alias("src"), link.alias("to"))
    dst = F.translate(F.regexp_extract("to", "//([^/?#]*)", 1), UPPER, LOWER)
    return links.select("src", dst.alias("dst")).filter("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def rounds_for(trusted: float) -> int:
    """Rounds after which nothing can move by more than MOVED: a round passes on at most FOLLOW of what all values moved
    by in the one before, which begins with the trust of all seeds, or with 1 for distrust, a mean."""
    return 1 + math.ceil(math.log(max(trusted, 1.0) / MOVED) / -math.log(FOLLOW))


def spread(edges: DataFrame, seeds: DataFrame, scratch: Scratch) -> DataFrame:
    """host, trust, distrust of the hosts of seeds (host, good, bad: shares of a host's pages) and of edges (src, dst, n).

    trust = good + FOLLOW * sum over links to the host of (the source's trust * the link's share of its links): a
    personalised PageRank, in units of what a wholly trusted host has by itself. (Mass that ends at a host without links
    starts again at the seeds, which changes all trust by one factor, so it needs no term here.)
    distrust = bad + (1 - bad) * FOLLOW * mean over the host's links of the target's distrust: against the links, and in
    the linking host's own shares, so that a popular blocked host is as bad to link to as an unknown one.
    Rounds go on until no value moves by more than MOVED, which rounds_for bounds for any graph."""
    out = edges.groupBy("src").agg(F.sum("n").alias("all"))
    share = scratch.write(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("share")), "share")
    named = edges.select(F.col("src").alias("host")).unionByName(edges.select(F.col("dst").alias("host"))).unionByName(seeds.select("host")).distinct()
    own = named.join(seeds, "host", "left").select("host", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("good", "bad")))
    state = scratch.write(own.withColumns({"trust": F.col("good"), "distrust": F.col("bad"), "moved": F.lit(1.0)}), "state0")
    most = rounds_for(state.agg(F.sum("good")).first()[0] or 0.0)
    for k in range(1, most + 1):
        ahead = share.join(state, share.src == state.host).select(F.col("dst").alias("host"), (F.col("share") * F.col("trust")).alias("t"), F.lit(0.0).alias("d"))
        back = share.join(state, share.dst == state.host).select(F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("share") * F.col("distrust")).alias("d"))
        got = ahead.unionByName(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        trust = F.col("good") + FOLLOW * F.coalesce("t", F.lit(0.0))
        distrust = F.col("bad") + (1 - F.col("bad")) * FOLLOW * F.coalesce("d", F.lit(0.0))
        new = state.join(got, "host", "left").select("host", "good", "bad", trust.alias("trust"), distrust.alias("distrust"), F.greatest(F.abs(trust - F.col("trust")), F.abs(distrust - F.col("distrust"))).alias("moved"))
        state = scratch.write(new, f"state{k}")
        scratch.drop(f"state{k - 1}")
        if (state.agg(F.max("moved")).first()[0] or 0.0) <= MOVED:
            return state.select("host", "trust", "distrust")
    raise ArithmeticError(f"trust and distrust still move after {most} rounds")


def url_filters(pages: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """A row for each of pages (page_id, url, html): page_id, host, path, rule, verdict."""
    scratch = Scratch(pages.sparkSession, "urls")
    rows = judged(pages.select("page_id", "url"), rules)
    hosts = rows.filter("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("allowed")).alias("good"), F.count_if(~F.col("allowed")).alias("bad"))
    hosts = scratch.write(hosts.select("host", (F.col("good") / F.col("n")).alias("good"), (F.col("bad") / F.col("n")).alias("bad")), "hosts")
    edges = scratch.write(host_links(pages.select("url", "html")), "edges")
    if edges.isEmpty():
        held = hosts.select("host", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    else:
        held = spread(edges, hosts.filter("good > 0 or bad > 0"), scratch)
    bad = held.filter((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= THRESHOLD - 1e-9))
    out = rows.join(bad.select("host", F.lit(True).alias("bad")), "host", "left")
    allow = F.coalesce(F.col("allowed"), F.col("bad").isNull())
    return out.select("page_id", "host", "path", "rule", F.when(allow, "allow").otherwise("block").alias("verdict"))
