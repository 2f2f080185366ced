"""Verdicts on urls: rules first, then trust and distrust that spread over links between hosts.

A rule holds for a host and its subdomains and for paths that start with the rule's path; the
longest matching rule decides. Urls without a rule are judged by their host. Pages that a rule
allows are seeds of a personalised PageRank over host links; pages that a rule blocks are seeds of
the same walk over reversed links, so that those who link to blocked hosts lose standing. Both are
expressed per page of the host: a host that no link touches has the shares of its own pages. A
host is blocked if its distrust reaches BLOCK_AT and exceeds its trust.

Defined cases: a null url or one without "://" has an empty host and path and takes no part in the
graph; such a url, and a host without any evidence, is allowed; a null html has no links; links of
a host to itself are ignored, and several links of one page to one host count once; repeated rows
count as pages of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import written

DAMPING = 0.85
# The walk ends once a round moves less than this, in pages of the seeds: no host's value per page
# then changes by more.
TOLERANCE = 1e-6
BLOCK_AT = 0.5

_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def matching_rule(rules: tuple[Rule, ...], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that holds, else nulls."""
    out = F.lit(None)
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        own = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, own).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): the number of pages of a host that link to another host."""
    to = F.array_distinct(
        F.transform(
            F.regexp_extract_all("html", F.lit(_LINK), 1),
            lambda host: F.translate(host, ascii_uppercase, ascii_lowercase),
        )
    )
    return (
        pages.select(F.col("host").alias("src"), F.explode(to).alias("dst"))
        .where("src <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def spread(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, trust, distrust) masses of both walks, each of total 1 if it has a seed.

    ``seeds``: host, trust, distrust. The walks run together, as rows of kind trust and distrust.
    Mass at a host without outgoing steps returns to the seeds. Hosts and links stay distributed;
    each round is written, and only its total change and the returning mass reach the driver.
    """
    forward = links.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
    backward = links.select(
        F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"
    )
    steps = forward.unionByName(backward)
    out = steps.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    steps = written(
        steps.join(out, ["kind", "src"]).select(
            "kind", "src", "dst", (F.col("weight") / F.col("all")).alias("share")
        ),
        "host-steps",
    )
    kinds = F.stack(F.lit(2), F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))
    start = seeds.select("host", kinds.alias("kind", "start")).where("start > 0")
    sums = start.groupBy("kind").agg(F.sum("start").alias("sum"))
    totals = {row[0]: row[1] for row in sums.collect()}  # one row per kind
    start = written(
        start.join(F.broadcast(sums), "kind").select(  # one row per kind
            "kind", "host", (F.col("start") / F.col("sum")).alias("start")
        ),
        "host-seeds",
    )
    mass = start.select("kind", "host", F.col("start").alias("mass"))
    # Nothing moves without links or seeds. A round moves 2 at most, each later one DAMPING of that.
    rounds = 0
    if totals and not steps.isEmpty():
        rounds = max(1, ceil(log(TOLERANCE / (2 * sum(totals.values()))) / log(DAMPING)))
    in_pages = F.when(F.col("kind") == "trust", totals.get("trust", 0.0)).otherwise(
        totals.get("distrust", 0.0)
    )
    leaving = steps.select("kind", F.col("src").alias("host")).distinct()
    for _ in range(rounds):
        stuck = mass.join(leaving, ["kind", "host"], "left_anti").groupBy("kind").agg(F.sum("mass"))
        back = {row[0]: row[1] for row in stuck.collect()}  # one row per kind
        returned = F.when(F.col("kind") == "trust", back.get("trust", 0.0)).otherwise(
            back.get("distrust", 0.0)
        )
        walked = (
            mass.withColumnRenamed("host", "src")
            .join(steps, ["kind", "src"])
            .groupBy("kind", F.col("dst").alias("host"))
            .agg((DAMPING * F.sum(F.col("mass") * F.col("share"))).alias("mass"))
        )
        restart = start.select(
            "kind", "host", (F.col("start") * (1 - DAMPING + DAMPING * returned)).alias("mass")
        )
        step = walked.unionByName(restart).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        before = mass.select("kind", "host", F.col("mass").alias("before"))
        step = written(
            step.join(before, ["kind", "host"], "left").select(
                "kind", "host", "mass", F.abs(F.col("mass") - F.coalesce("before", F.lit(0.0))).alias("change")
            ),
            "host-mass",
        )
        mass = step.select("kind", "host", "mass")
        if step.agg(F.sum(F.col("change") * in_pages)).first()[0] < TOLERANCE:
            break
    return mass.groupBy("host").agg(
        *(
            F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind)
            for kind in ("trust", "distrust")
        )
    )


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict."""
    url = F.col("url").cast("string")
    parsed = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("html").cast("string")
    ).withColumns(
        {name: F.coalesce(name, F.lit("")) for name in ("host", "path")}
    )
    matched = parsed.withColumn("match", matching_rule(rules, F.col("host"), F.col("path")))
    seeds = (
        matched.where("host <> ''")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("match.verdict") == "allow").cast("double").alias("trust"),
            F.count_if(F.col("match.verdict") == "block").cast("double").alias("distrust"),
        )
    )
    seeds = written(seeds, "hosts")
    masses = spread(host_links(parsed), seeds)
    totals = seeds.agg(F.sum("trust").alias("allowed"), F.sum("distrust").alias("blocked"))
    allowed, blocked = totals.first()
    own = seeds.select("host", "pages", (F.col("distrust") / F.col("pages")).alias("own"))
    per_page = own.join(masses, "host")
    trust = F.col("trust") * (allowed or 0.0) / F.col("pages")
    # What a host passes on to those who link to it does not clear its own pages.
    distrust = F.greatest("own", F.col("distrust") * (blocked or 0.0) / F.col("pages"))
    refused = per_page.where((distrust >= BLOCK_AT) & (distrust > trust)).select(
        "host", F.lit("block").alias("by_host")
    )
    return matched.join(refused, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("match.rule").alias("rule"),
        F.coalesce("match.verdict", "by_host", F.lit("allow")).alias("verdict"),
    )
