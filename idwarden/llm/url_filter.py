"""URL filters: rules first, link-graph propagation for the rest.

A rule is a host and a path prefix; it fits the host and its subdomains, and the longest rule that fits wins. Every
other url gets the verdict of its host. The shares of a host's pages that rules allow and block make it a seed: trust flows from
the allowed along the links between hosts (personalised PageRank), distrust from the blocked against them, so that hosts
that link to blocked ones lose standing; a host passes distrust on as far as its own pages are not allowed. Distrust is taken
twice: split among all who link to a host, and by the share of a linker's own links, which does not shrink with their number;
the larger counts. A host is blocked if it has ``BLOCK_FROM`` of distrust or more, and more than trust. The share of its own pages
that rules decide alike counts as well, if it is over ``MOSTLY``.

Only DataFrame functions: links are taken from href and src attributes, counted per pair of hosts before they are
shuffled. Ranks are written to the shared folder every few rounds.

NULL urls and urls without ``://`` have an empty host and path, which no rule fits; the host '' is judged like any other. NULL
html has no links. Repeated pages count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idwarden.llm.store import save, small

DAMPING, ROUNDS, ROUNDS_A_FILE, BLOCK_FROM = 0.85, 20, 5, 0.02
MOSTLY = 0.5

#: Attributes whose value is a link.
LINK = r"(?i)(?:href|src)\s*=\s*[\"']?([^\"'\s>]+)"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _split(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host.lower(), f"/{path}"


def matching_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column, value: int) -> Column:
    """The rule (0) or verdict (1) of the longest rule that fits, else NULL."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r[0])):
        name, prefix = _split(rule[0])
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        out = F.when(fits, F.lit(rule[value])) if out is None else out.when(fits, F.lit(rule[value]))
    return out if out is not None else F.lit(None).cast("string")


def parsed(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict of each page."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    return parts.select(
        "page_id", "host", "path",
        matching_rule(rules, F.col("host"), F.col("path"), 0).alias("rule"),
        matching_rule(rules, F.col("host"), F.col("path"), 1).alias("ruled"),
    )


def links(pages: DataFrame) -> DataFrame:
    """source, target and count of links between different hosts."""
    own = F.coalesce(host_of(F.col("url")), F.lit(""))
    found = pages.select(own.alias("source"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
    absolute = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    return (
        found.where(absolute.contains("://"))
        .select("source", host_of(absolute).alias("target"))
        .where("source <> target AND target <> ''")
        .groupBy("source", "target").agg(F.count("*").alias("n"))
    )


def seeds(judged: DataFrame) -> DataFrame:
    """host and the shares of its pages that are allowed and blocked."""
    share = lambda verdict: F.avg(F.when(F.col("ruled") == verdict, 1.0).otherwise(0.0))
    return judged.groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))


def propagate(edges: DataFrame, start: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """host, the trust and distrust it receives after ``rounds`` of personalised PageRank, and its allowed and blocked shares.

    edges: source, target, n; start: host, allowed, blocked. ``leads`` is distrust by the share of a host's own links.
    """
    linked = edges.select(F.explode(F.array("source", "target")).alias("host")).distinct()
    others = linked.join(start, "host", "left_anti").select("host", F.lit(0.0).alias("allowed"), F.lit(0.0).alias("blocked"))
    hosts = save(start.unionByName(others), "hosts")
    out = edges.groupBy("source").agg(F.sum("n").alias("out"))
    into = edges.groupBy("target").agg(F.sum("n").alias("in"))
    weighted = edges.join(out, "source").join(into, "target")
    along = weighted.select(
        F.col("source").alias("host"), F.col("target").alias("to"), (F.col("n") / F.col("out")).alias("along"), F.lit(0.0).alias("against"), F.lit(0.0).alias("leading"))
    against = weighted.select(
        F.col("target").alias("host"), F.col("source").alias("to"), F.lit(0.0).alias("along"), (F.col("n") / F.col("in")).alias("against"), (F.col("n") / F.col("out")).alias("leading"))
    step = small(save(along.unionByName(against), "host-steps"))
    trust = lambda got: F.lit(1 - DAMPING) * F.col("allowed") + got
    distrust = lambda got: (1 - F.col("allowed")) * (F.lit(1 - DAMPING) * F.col("blocked") + got)
    ranks = hosts.select("host", trust(F.lit(0.0)).alias("trust"), distrust(F.lit(0.0)).alias("distrust"), distrust(F.lit(0.0)).alias("leads"))
    for k in range(1, rounds + 1):
        moved = ranks.join(step, "host").groupBy(F.col("to").alias("host")).agg(
            (DAMPING * F.sum(F.col("trust") * F.col("along"))).alias("t"), (DAMPING * F.sum(F.col("distrust") * F.col("against"))).alias("d"),
            (DAMPING * F.sum(F.col("leads") * F.col("leading"))).alias("l"))
        got = hosts.join(moved, "host", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("t", "d", "l")})
        if k == rounds:
            return save(got.select("host", F.col("t").alias("trust"), F.col("d").alias("distrust"), F.col("l").alias("leads"), "allowed", "blocked"), "host-ranks")
        ranks = got.select("host", trust(F.col("t")).alias("trust"), distrust(F.col("d")).alias("distrust"), distrust(F.col("l")).alias("leads"))
        if k % ROUNDS_A_FILE == 0:
            ranks = save(ranks, "host-ranks")
    return hosts.select("host", *(F.lit(0.0).alias(c) for c in ("trust", "distrust", "leads")), "allowed", "blocked")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], block_from: float = BLOCK_FROM) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of ``pages`` (page_id, url, html)."""
    judged = parsed(pages, rules)
    ranks = propagate(save(links(pages), "host-links"), seeds(judged))
    own = lambda share: F.when(F.col(share) > MOSTLY, F.lit(1 - DAMPING) * F.col(share)).otherwise(0.0)
    trust, distrust = F.col("trust") + own("allowed"), F.greatest("distrust", "leads") + own("blocked")
    blocked = (distrust >= block_from) & (distrust > trust)
    verdicts = ranks.select("host", F.when(blocked, "block").otherwise("allow").alias("host_verdict"))
    return judged.join(small(verdicts), "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "host_verdict", F.lit("allow")).alias("verdict"),
    )
