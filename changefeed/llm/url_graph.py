"""URL filters by propagation over the graph of hosts that link to each other.

Rules allow or block a host, its subdomains and a path prefix. Pages that a rule decides
are the seeds: trust starts at hosts by the share of their pages that is allowed and flows
along links, distrust starts by the share that is blocked and flows against them (who links to
bad hosts is suspect). Both are personalised PageRanks, computed together as iterated joins
and sums over host edges. Beside each runs the PageRank that starts at every host alike; of
what reaches a host, the part that came from seeds is its trust or distrust, from 0 to 1. A
host is blocked, for the pages that no rule decides, if most of what reaches it against the
links is distrust, and more than its trust: a mixed host, or one bad link, is not enough.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.llm.common import ascii_lower, written

DAMPING = 0.85
# Rounds end when they move less than this part of all mass, or after so many.
TOLERANCE, MOST_ROUNDS = 1e-4, 100
# Rounds between written copies; a longer plan is slow to make and to repair.
ROUNDS_A_COPY = 4
# A host is blocked if its distrust, from 0 to 1, exceeds this and its trust.
MAX_DISTRUST = 0.5
# The links of one host may be a third of all: they meet its mass in so many tasks.
SALTS = 8


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host and all below it, and paths with a prefix."""

    verdict: str
    pattern: str

    def __post_init__(self) -> None:
        if self.verdict not in ("allow", "block") or "/" not in self.pattern:
            raise ValueError(f"not a rule: {self}")

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def url_host(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(after)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule], verdict: str | None = None) -> Column:
    """The longest rule that fits, or null; the first of equally long ones.

    The list of rules comes from the caller as Python values and goes into the plan.
    """
    choice = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        choice = F.when(fits, F.lit(rule.verdict if verdict else rule.pattern)).otherwise(choice)
    return choice


def ruled(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id``, ``host``, ``path``, the rule that fits and what it says."""
    located = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    return located.withColumn("rule", fitting_rule(host, path, rules)).withColumn(
        "said", fitting_rule(host, path, rules, "verdict")
    )


def node(host: Column) -> Column:
    """A host in the graph: without user and port, which links may or may not name."""
    return ascii_lower(F.regexp_replace(host, r"^.*@|:\d*$", ""))


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts: ``src``, ``dst``, number of links; hosts as nodes.

    Links are absolute or scheme-relative ``href`` values; relative ones stay on the host.
    """
    targets = F.regexp_extract_all(
        F.coalesce(F.col("html"), F.lit("")),
        F.lit(r"(?i)\bhref\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s>]+)"),
        F.lit(1),
    )
    links = pages.select(node(url_host(F.col("url"))).alias("src"), F.explode(targets).alias("dst"))
    return (
        links.withColumn("dst", node(F.col("dst")))
        .where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("links"))
    )


def propagate(
    seeds: DataFrame, edges: DataFrame, *, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """Trust and distrust of hosts, from 0 to 1: ``host``, ``trust``, ``distrust``.

    ``seeds`` has every ``host`` that has pages, with the shares ``allowed`` and ``blocked`` of
    them. One table holds four flows: an edge is a step from ``src`` to ``dst`` for trust and
    its base, and back for distrust and its base. Hosts that are only linked to start with the
    bases' mass alone. Mass that reaches a host without onward links is lost, in a flow and in
    its base alike.
    """
    edges = written(edges, "host-edges")
    ahead = edges.select(F.explode(F.array(F.lit("trust"), F.lit("onward"))).alias("flow"), F.col("src").alias("at"), F.col("dst").alias("to"), "links")
    back = edges.select(F.explode(F.array(F.lit("distrust"), F.lit("back"))).alias("flow"), F.col("dst").alias("at"), F.col("src").alias("to"), "links")
    ways = ahead.unionByName(back).withColumn("salt", F.pmod(F.xxhash64("to"), F.lit(SALTS)).cast("int"))
    out = ways.groupBy("flow", "at").agg(F.sum("links").alias("all_links"))
    out = out.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    steps = written(
        ways.join(out, ["flow", "at", "salt"]).select(
            "flow", "at", "salt", "to", (F.col("links") / F.col("all_links")).alias("share")
        ),
        "host-steps",
    )
    hosts = seeds.select("host", "allowed", "blocked").unionByName(
        edges.select(F.explode(F.array("src", "dst")).alias("host"), F.lit(0.0).alias("allowed"), F.lit(0.0).alias("blocked"))
    ).groupBy("host").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    flows = {"trust": F.col("allowed"), "onward": F.lit(1.0), "distrust": F.col("blocked"), "back": F.lit(1.0)}
    start = hosts.select(
        F.explode(F.array(*(F.struct(F.lit(f).alias("flow"), m.alias("mass")) for f, m in flows.items()))).alias("s"),
        F.col("host").alias("at"),
    ).select("s.flow", "at", "s.mass")
    start = written(start.where("mass > 0"), "host-seeds")
    total = start.agg(F.sum("mass")).first()[0] or 0.0
    mass = start
    for number in range(1, MOST_ROUNDS + 1 if total and not steps.isEmpty() else 1):
        salted = mass.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        moved = salted.join(steps, ["flow", "at", "salt"]).select(
            "flow", F.col("to").alias("at"), (damping * F.col("mass") * F.col("share")).alias("mass")
        )
        again = start.withColumn("mass", (1 - damping) * F.col("mass"))
        before, mass = mass, moved.unionByName(again).groupBy("flow", "at").agg(F.sum("mass").alias("mass"))
        if number % ROUNDS_A_COPY == 1:
            mass = written(mass, "host-mass")
            if number == 1:
                continue
            change = mass.unionByName(before.withColumn("mass", -F.col("mass"))).groupBy("flow", "at").agg(
                F.abs(F.sum("mass")).alias("moved")
            )
            if change.agg(F.sum("moved")).first()[0] <= tolerance * total:
                break
    of = lambda flow: F.sum(F.when(F.col("flow") == flow, F.col("mass")).otherwise(0.0))
    sums = mass.groupBy(F.col("at").alias("host")).agg(*(of(f).alias(f) for f in flows))
    return sums.select(
        "host",
        (F.col("trust") / F.col("onward")).alias("trust"),
        (F.col("distrust") / F.col("back")).alias("distrust"),
    )


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, *, max_distrust: float = MAX_DISTRUST
) -> DataFrame:
    """A verdict for every page: the rule's, else that of its host.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is
    allowed, as is any host that no distrust reached. Repeated pages are judged alike and
    count each. No pages give no rows. Columns other than ``page_id``, ``url`` and ``html``
    are ignored.
    """
    judged = ruled(pages, rules)
    of = lambda verdict: F.count_if(F.col("said").eqNullSafe(verdict)) / F.count(F.lit(1))
    seeds = judged.where(F.col("host") != "").groupBy(node(F.col("host")).alias("host")).agg(
        of("allow").alias("allowed"), of("block").alias("blocked")
    )
    scores = propagate(written(seeds, "url-seeds"), host_edges(pages)).withColumnRenamed("host", "__host")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    suspect = (distrust > max_distrust) & (distrust > trust)
    return judged.join(scores, node(F.col("host")) == F.col("__host"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("said", F.when(suspect, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
