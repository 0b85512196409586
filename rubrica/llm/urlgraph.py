"""Url verdicts: path rules first, then trust and distrust carried along the links between hosts."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rubrica.llm.common import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query, as (verdict, host, path).
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(host: Column) -> Column:
    """The name of a host in the link graph, for pages and link targets alike: without user and port."""
    return F.regexp_replace(F.regexp_replace(F.translate(host, UPPER, UPPER.lower()), "^.*@", ""), ":[0-9]*$", "")


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none; of equal names the first."""
    choice = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        choice = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(choice)
    return choice


def host_links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst, pages): how many pages of a host link to another host. Links inside a host carry nothing."""
    target = F.explode(F.array_distinct(F.regexp_extract_all(F.col(html_col), F.lit(LINK), 1)))
    named = pages.select(F.col("node").alias("src"), target.alias("raw")).where("src <> ''")
    links = named.select("src", node_of(F.col("raw")).alias("dst")).where("dst <> '' and dst <> src")
    return links.groupBy("src", "dst").agg(F.count("*").alias("pages"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-4) -> DataFrame:
    """(host, trust, distrust) of every host that either kind of mass reaches.

    Personalised PageRank with restart at the seeds (``kind`` trust along the links, ``kind`` distrust against them), both
    in one walk. The seeds of a kind share a mass of 1, so that a kind does not weigh more by having more seeds: a step is a join of the mass with the outgoing shares and a sum with map-side partials. Each round is
    written to the shared folder; the walk ends when no host is new and the mass moved is at most ``tolerance`` of the
    seeds' mass. Each round moves at most ``damping`` of what the last one moved, and no mass reaches a host later than
    the longest of all shortest link paths from the seeds. Mass of a host without links is not carried on.
    """
    ways = links.selectExpr("'trust' as kind", "src as host", "dst as to", "pages").union(
        links.selectExpr("'distrust' as kind", "dst as host", "src as to", "pages")
    )
    out = ways.groupBy("kind", "host").agg(F.sum("pages").alias("total"))
    ways = ways.join(out, ["kind", "host"]).selectExpr("kind", "host", "to", "pages / total as share")
    ways = written(ways, "url-links")
    counts = seeds.groupBy("kind").agg(F.count("*").alias("seeds"))
    restart = written(seeds.join(counts, "kind").selectExpr("kind", "host", "1D / seeds as mass"), "url-restart")
    mass = restart
    if ways.limit(1).count():
        total = 1.0
        reached = 0
        while True:
            moved = mass.join(ways, ["kind", "host"]).select(
                "kind", F.col("to").alias("host"), (F.lit(damping) * F.col("mass") * F.col("share")).alias("new"), F.lit(0.0).alias("old")
            )
            still = restart.select("kind", "host", (F.lit(1 - damping) * F.col("mass")).alias("new"), F.lit(0.0).alias("old"))
            held = mass.select("kind", "host", F.lit(0.0).alias("new"), F.col("mass").alias("old"))
            step = reduce(DataFrame.union, [moved, still, held]).groupBy("kind", "host")
            step = written(step.agg(F.sum("new").alias("mass"), F.sum("old").alias("old")), "url-mass")
            change, hosts = step.agg(F.sum(F.abs(F.col("mass") - F.col("old"))), F.count("*")).first()
            mass = step.select("kind", "host", "mass")
            if hosts == reached and (change or 0.0) <= tolerance * total:
                break
            reached = hosts
    part = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind)
    return mass.groupBy("host").agg(part("trust"), part("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, spam_share: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for every row of ``pages`` (page_id, url, html).

    A rule that fits decides. Other pages go by their host: it is blocked if distrust makes up more than ``spam_share``
    of the trust and distrust that reach it, and allowed otherwise, so also if neither reaches it. A host is a trusted
    seed if rules allow over half of its pages, a blocked one if they block over half. A null url, or one without
    ``://``, has an empty host and path, no rule, and is allowed. Repeated rows repeat; an empty table gives no rows;
    null html has no links. Other columns are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    placed = pages.select("page_id", "url", "html").withColumns({"host": host, "path": path, "node": node_of(host)})
    ruled = placed.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    share = lambda verdict: F.avg(F.when(F.col("found.verdict") == verdict, 1.0).otherwise(0.0)).alias(verdict)
    hosts = ruled.where("node <> ''").groupBy(F.col("node").alias("host")).agg(share("allow"), share("block"))
    kind = F.when(F.col("allow") > 0.5, "trust").when(F.col("block") > 0.5, "distrust")
    seeds = written(hosts.select("host", kind.alias("kind")).where("kind is not null"), "url-seeds")
    mass = propagate(host_links(placed), seeds)
    joined = ruled.select("page_id", "host", "path", "found", "node").join(mass.withColumnRenamed("host", "node"), "node", "left")
    none = F.lit(0.0)
    trust, distrust = F.coalesce("trust", none), F.coalesce("distrust", none)
    carried = F.when(distrust > F.lit(spam_share) * (trust + distrust), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", carried).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"),
    )
