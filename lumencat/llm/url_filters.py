"""URL filters: host/path rules, and link-graph trust for the hosts that no rule decides.

Trust is a personalised PageRank from trusted seeds along host links; distrust
is one from blocked seeds along reversed links (who links to a blocked host
inherits from it). A host's seed mass is the share of its pages that a rule
allows or blocks. Both are linear in the seeds, so they are kept unnormalised:
a lone fully blocked host scores 1 - damping. A host is blocked where
(distrust - trust) / (1 - damping) reaches the threshold. Hosts without links
out (or, reversed, in) keep their mass.

Everything is DataFrame functions. Pages are counted per host and links per
(source, target) before any join, so a hot host is one row of the graph; its
pages meet only the list of blocked hosts. Iterations stop when no score moves
by more than the tolerance, and each is checkpointed; scores that have not
settled after ``rounds`` (damping shrinks every change, so 300 serve any graph
that fits a cluster) are an error, never a result.

Defined results: null url or one without ``://``: empty host and path, no rule,
judged as the host ''; null html: no links; repeated pages count repeatedly;
empty table: no rows; a tie of rule lengths goes to the rule given first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


#: Production rules.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule, else nulls. The rules are a short fixed list."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(str(r))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(str(r))).otherwise(rule)
        action = F.when(fits, F.lit(r.action)).otherwise(action)
    return rule, action


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): counted links between different hosts, from absolute hrefs."""
    found = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), 1)).alias("dst"))
    found = found.withColumn("dst", F.translate("dst", UPPER, LOWER)).where((F.col("dst") != F.col("src")) & (F.col("src") != ""))
    return found.groupBy("src", "dst").agg(F.count("*").alias("n"))


def host_scores(seeds: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = 1e-4, rounds: int = 300) -> DataFrame:
    """(host, trust, distrust) of every host in seeds (host, trusted, blocked) or links (src, dst, n)."""
    links = checkpointed(links)
    ends = links.select(F.col("src").alias("host")).unionByName(links.select(F.col("dst").alias("host"))).distinct()
    state = seeds.join(ends, "host", "full").select("host", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trusted", "blocked")])
    state = checkpointed(state.withColumns({"trust": (1 - damping) * F.col("trusted"), "distrust": (1 - damping) * F.col("blocked")}))
    if links.isEmpty():
        return state.select("host", "trust", "distrust")
    out = links.groupBy("src").agg(F.sum("n").alias("out_n"))
    into = links.groupBy("dst").agg(F.sum("n").alias("in_n"))
    weighted = links.join(out, "src").join(into, "dst")
    weighted = checkpointed(weighted.select("src", "dst", (F.col("n") / F.col("out_n")).alias("w_out"), (F.col("n") / F.col("in_n")).alias("w_in")))
    for _ in range(rounds):
        forward = weighted.join(state.select(F.col("host").alias("src"), "trust"), "src")
        backward = weighted.join(state.select(F.col("host").alias("dst"), "distrust"), "dst")
        moved = forward.select(F.col("dst").alias("host"), (F.col("trust") * F.col("w_out")).alias("t"), F.lit(0.0).alias("d")).unionByName(
            backward.select(F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("w_in")).alias("d"))
        )
        sums = moved.groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        new = state.join(sums, "host", "left").select(
            "host",
            "trusted",
            "blocked",
            ((1 - damping) * F.col("trusted") + damping * F.coalesce("t", F.lit(0.0))).alias("new_trust"),
            ((1 - damping) * F.col("blocked") + damping * F.coalesce("d", F.lit(0.0))).alias("new_distrust"),
            F.greatest(
                F.abs((1 - damping) * F.col("trusted") + damping * F.coalesce("t", F.lit(0.0)) - F.col("trust")),
                F.abs((1 - damping) * F.col("blocked") + damping * F.coalesce("d", F.lit(0.0)) - F.col("distrust")),
            ).alias("change"),
        )
        new = checkpointed(new)
        change = new.agg(F.max("change")).first()[0] or 0.0
        state = new.select("host", "trusted", "blocked", F.col("new_trust").alias("trust"), F.col("new_distrust").alias("distrust"))
        if change <= tolerance * (1 - damping):
            break
    else:
        raise RuntimeError(f"scores did not settle in {rounds} rounds")
    return state.select("host", "trust", "distrust")


def filter_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, damping: float = 0.85, threshold: float = 0.5, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block) of every page."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html).alias("html"))
    judged = judged.withColumns({"rule": rule, "action": action})

    def share(what: str) -> Column:
        return F.avg(F.when(F.col("action") == what, 1.0).otherwise(0.0))

    seeds = judged.groupBy("host").agg(share("allow").alias("trusted"), share("block").alias("blocked"))
    scores = host_scores(seeds, host_links(judged), damping)
    bad = scores.where((F.col("distrust") - F.col("trust")) / (1 - damping) >= threshold).select("host", F.lit(True).alias("bad"))
    verdict = F.coalesce("action", F.when(F.col("bad"), "block").otherwise("allow"))
    return judged.drop("html").join(bad, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
