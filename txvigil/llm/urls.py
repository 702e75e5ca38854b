"""URL filters: rules by host and path, and trust propagated over the graph of hosts.

A rule decides the pages it fits. For all other pages the host decides: trust flows from
hosts with allowed pages along the edges of the host graph (personalised PageRank), distrust
flows from hosts with blocked pages against them, and a host whose distrust exceeds its
trust is blocked. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from txvigil.llm.common import discard, stored

DAMPING = 0.85
# The rounds there are at least; there are more as long as they reach hosts.
ROUNDS = 10
# Distrust has to exceed trust by this share of it, far above what the order of additions can
# change; scores shrink with the number of pages, so no absolute difference would do.
MARGIN = 1e-9
_STORE_EVERY = 5
_BLOCKED = "_host_is_blocked"

_URL = r"://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?(//[^/?#"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith(f".{self.host}")
        return own & path.startswith(self.path)


RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def lower(text: Column) -> Column:
    """Lower case of A-Z only."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both are empty for a null URL and one without ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    return pages.withColumns(
        {"host": lower(F.regexp_extract(text, _URL, 1)), "path": F.regexp_extract(text, _URL, 2)}
    )


def ruled(pages: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """Adds ``rule`` and ``ruling`` of the longest rule that fits, null where none does.

    The rules are given as values, so there are only so many; they become one expression.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = rule.fits(F.col("host"), F.col("path"))
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return pages.withColumns({"rule": name, "ruling": verdict})


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, weight): pages of one host that link to another, and subdomains.

    Links are absolute ones in the pages' markup. A subdomain is run by whoever runs the
    domain above it, so the two are joined both ways with the weight of one page.
    """
    linked = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(_LINK), F.lit(1))
    to = F.array_distinct(F.transform(linked, lambda x: lower(F.substring(x, 3, 1 << 30))))
    links = pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(to).alias("dst"))
    links = links.filter("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))
    above = F.regexp_extract("src", r"^[^.]+\.(.*\..*)$", 1)
    below = pages.select(F.col("host").alias("src")).distinct().select("src", above.alias("dst"))
    below = below.filter("dst <> ''").withColumn("weight", F.lit(1).cast("long"))
    back = below.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    edges = links.unionByName(below).unionByName(back)
    return edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def seeds(pages: DataFrame) -> DataFrame:
    """(kind, host, seed): shares of the allowed pages, and of the blocked ones, per host."""
    found = pages.filter("host <> '' AND ruling IS NOT NULL")
    found = found.groupBy(F.col("ruling").alias("kind"), "host").agg(F.count("*").alias("_n"))
    whole = found.groupBy("kind").agg(F.sum("_n").alias("_all"))
    return found.join(whole, "kind").select("kind", "host", (F.col("_n") / F.col("_all")).alias("seed"))


def propagated(edges: DataFrame, seed: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING):
    """(kind, host, score) after ``rounds`` of propagation from the seeds, or as many as it takes
    until no further host is reached, so that no distance from a seed is too far.

    Both kinds move in one join: trust along the edges, distrust against them. Each round
    adds up per host before the shuffle; the scores of a hub are one row, so an uneven join
    can be split. What a host without outgoing edges holds does not flow on.
    """
    ways = edges.withColumn("kind", F.lit("allow")).unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight").withColumn(
            "kind", F.lit("block")
        )
    )
    out = ways.groupBy("kind", "src").agg(F.sum("weight").alias("_out"))
    shares = ways.join(out, ["kind", "src"])
    shares = stored(
        shares.select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("_out")).alias("share"))
    )
    start = stored(seed)
    scores = start.withColumnRenamed("seed", "score")
    kept, reached, number = None, 0, 0
    while True:
        moved = scores.join(shares, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score")
        )
        again = start.select("kind", "host", ((1 - damping) * F.col("seed")).alias("score"))
        scores = moved.unionByName(again).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        number += 1
        if number % _STORE_EVERY and number != rounds:
            continue
        scores, before = stored(scores), kept
        kept = scores
        if before is not None:
            discard(before)
        # A round keeps all hosts that the one before has reached from a seed.
        found = scores.count()
        if number >= rounds and found == reached:
            return scores
        reached = found


def host_verdicts(scores: DataFrame) -> DataFrame:
    """(host, blocked) for every host that anything has reached."""

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0))

    return scores.groupBy("host").agg((of("block") > of("allow") * (1 + MARGIN)).alias("blocked"))


def judged(
    pages: DataFrame, rules: Sequence[UrlRule] = RULES, url: str = "url", html: str = "html"
) -> DataFrame:
    """Adds host, path, rule and verdict to all pages; columns of these names are replaced.

    A host that nothing has reached is allowed. Null URLs and URLs without host have no
    host to judge by and are allowed too. Repeated pages are judged alike. Other columns stay as
    they are, except one named as ``_BLOCKED``, which is dropped. An empty table stays empty.
    """
    own = ("host", "path", "rule", "ruling", "verdict", _BLOCKED)
    pages = ruled(split_url(pages.drop(*[c for c in own if c not in (url, html)]), url), rules)
    scores = propagated(host_edges(pages, html), seeds(pages))
    verdicts = host_verdicts(scores).withColumnRenamed("blocked", _BLOCKED)
    blocked = F.coalesce(_BLOCKED, F.lit(False))
    other = F.when(blocked, "block").otherwise("allow")
    return (
        pages.join(verdicts, "host", "left")
        .withColumn("verdict", F.coalesce("ruling", other))
        .drop("ruling", _BLOCKED)
    )
