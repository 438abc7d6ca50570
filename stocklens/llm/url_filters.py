"""URL filters: rules first, then trust and distrust spread over links of hosts.

Every host that has pages a rule allows starts with trust in proportion to
them, every host that has pages a rule blocks with distrust. Personalised PageRank carries trust along links
and distrust against them (who links to a bad host is suspect). A host whose
distrust outweighs its trust is blocked where no rule speaks for a page.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import dropped, stored

BLOCK, ALLOW = "block", "allow"
HOPS = 4  # links a round follows
SETTLED = 1e-6  # share of a host's mass that a round may still change
EVEN = 1e-4  # share of a host's mass by which trust and distrust may differ and count as equal
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'\s<>]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule(BLOCK, "net", "/"),
    Rule(ALLOW, "example.net", "/en/"),
    Rule(BLOCK, "example.com", "/de/"),
    Rule(ALLOW, "org", "/fr/"),
)


def _lower(host: Column) -> Column:
    return F.translate(host, CAPITALS, CAPITALS.lower())


def with_host(pages: DataFrame) -> DataFrame:
    """page_id, host and path of every page; both empty without a scheme."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    df = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    df = df.withColumn("raw", F.regexp_extract("rest", "^[^/?#]*", 0))
    path = F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), "^[^?#]*", 0)
    return df.select("page_id", _lower(F.col("raw")).alias("host"), path.alias("path"))


def _fits(rule: Rule) -> Column:
    host = F.col("host")
    return ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)


def with_rule(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds the longest rule that fits, and its verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        rule = F.when(_fits(r), F.lit(r.text)).otherwise(rule)
        verdict = F.when(_fits(r), F.lit(r.verdict)).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("ruled", verdict)


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, and from a host to the one it is under.

    A host counts as linked, in both directions, with the nearest host above it
    that has pages: blog.a.example.com with a.example.com, or with example.com
    where the former has none. Links without a host stay on their own host and
    say nothing.
    """
    own = with_host(pages.select("page_id", "url")).select("host")
    hosts = own.where("host != ''").groupBy("host").count()
    linking = pages.where(F.col("html").contains("//"))
    targets = with_host(linking.select(F.struct("html").alias("page_id"), "url")).select(
        F.col("host").alias("src"),
        F.explode(F.regexp_extract_all(F.col("page_id.html"), F.lit(LINK), F.lit(1))).alias("dst"),
    )
    links = (
        targets.select("src", _lower(F.col("dst")).alias("dst"))
        .where("src != dst AND src != ''")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )
    labels = F.split("host", "[.]")
    names = F.transform(F.sequence(F.lit(2), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    above = hosts.where(F.size(labels) > 1).select("host", F.explode(names).alias("up")).where("up != ''")
    over = (
        above.join(hosts.select(F.col("host").alias("up")), "up")
        .groupBy("host")
        .agg(F.max_by("up", F.length("up")).alias("up"))
    )
    both = over.select(F.explode(F.array(
        F.struct(F.col("host").alias("src"), F.col("up").alias("dst")), F.struct(F.col("up").alias("src"), F.col("host").alias("dst"))
    )).alias("link")).select("link.*")
    return (
        links.union(both.withColumn("n", F.lit(1).cast("long")))
        .groupBy("src", "dst")
        .agg(F.sum("n").alias("n"))
    )


def seeds(ruled: DataFrame) -> DataFrame:
    """(host, trust, distrust): how many pages of a host a rule allows, and blocks."""
    return ruled.where("host != ''").groupBy("host").agg(
        F.count_if(F.col("ruled") == ALLOW).cast("double").alias("trust"),
        F.count_if(F.col("ruled") == BLOCK).cast("double").alias("distrust"),
    )


def propagate(links: DataFrame, start: DataFrame, damping: float = 0.85) -> DataFrame:
    """(host, trust, distrust) of personalised PageRank.

    Trust and distrust start in proportion to a host's pages. Mass on hosts without links
    ends there, which scales all shares alike. Each round joins the shares
    held so far with the links, ``HOPS`` times over, and is written out. Rounds end when none changes
    the mass of any host by more than ``SETTLED`` of it, so that no host that a
    seed reaches is left out; every page counts 1 until then.
    """
    out = links.groupBy("src").agg(F.sum("n").alias("total"))
    forth = links.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share"))
    total = links.groupBy("dst").agg(F.sum("n").alias("total"))
    back = links.join(total, "dst").select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("n") / F.col("total")).alias("share")
    )
    edges = stored(
        forth.withColumn("kind", F.lit("trust")).union(back.withColumn("kind", F.lit("distrust"))),
        "links",
    ).withColumnRenamed("src", "host")
    sums = start.agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).first()
    weight = {k: 1.0 / sums[k] if sums[k] else 0.0 for k in ("trust", "distrust")}
    kinds = [
        start.where(F.col(k) > 0).select("host", F.lit(k).alias("kind"), F.col(k).alias("mass"))
        for k in weight
    ]
    source = stored(kinds[0].union(kinds[1]), "seeds")
    held = restart = source.withColumn("mass", F.col("mass") * (1 - damping))
    settled, last = False, None
    while not settled:
        now = held
        for _ in range(HOPS):
            moved = now.join(edges, ["host", "kind"]).select(
                F.col("dst").alias("host"), "kind", (F.col("mass") * F.col("share") * damping).alias("mass")
            )
            now = moved.union(restart).groupBy("host", "kind").agg(F.sum("mass").alias("mass"))
        after = now.withColumn("last", F.lit(0.0))
        before = held.select("host", "kind", F.lit(0.0).alias("mass"), F.col("mass").alias("last"))
        fresh = stored(
            after.union(before).groupBy("host", "kind").agg(F.sum("mass").alias("mass"), F.sum("last").alias("last")),
            "ranks",
        )
        settled = fresh.where(F.abs(F.col("mass") - F.col("last")) > SETTLED * F.col("mass")).isEmpty()
        held = fresh.select("host", "kind", "mass")
        if last:
            dropped(last)
        last = fresh
    amount = lambda k: F.sum(F.when(F.col("kind") == k, F.col("mass") * weight[k]).otherwise(0.0)).alias(k)
    return held.groupBy("host").agg(amount("trust"), amount("distrust"))


def judged_pages(
    pages: DataFrame, rules: Sequence[Rule] = RULES, limit: float = 0.5
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page.

    A rule decides alone. Else a page is blocked where distrust makes up more
    than ``limit`` of its host's trust and distrust; a host that neither
    reaches is allowed. Null urls have empty host and path and are allowed,
    null html has no links, repeated rows stay.
    """
    ruled = with_rule(with_host(pages), rules)
    ranks = propagate(host_links(pages), seeds(ruled)).withColumnRenamed("host", "ranked")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    bad = distrust - limit * (trust + distrust) > EVEN * (trust + distrust)  # not by the order of a sum
    return ruled.join(ranks, F.col("host") == F.col("ranked"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, BLOCK).otherwise(ALLOW)).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
