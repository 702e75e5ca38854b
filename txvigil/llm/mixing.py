"""Mixing sources to target weights.

Sources may overlap: a document belongs to one or more. Documents are first added up by
membership pattern, so that what is routed does not grow with the documents but with the
patterns. A minimum-cost flow sends words from patterns to the quotas of their sources; the
second and third use of a pattern's words costs more than the one before. Then documents are
laid out in seeded order, and every source takes its stretch of that line.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from txvigil.llm.common import WORD, components, one_row, stored

WEIGHTS = (5, 2, 1)
REPEATS = 3
SEED = 17
# Seeded order is cut into this many stretches for its running sums (three hex digits).
_BUCKETS = 3


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Text keys that keep the null source apart from any other."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def pattern(members: Column) -> Column:
    """Membership pattern of an array of sources; repeats and order do not matter."""
    keyed = F.transform(members, source_key)
    return F.coalesce(F.array_sort(F.array_distinct(keyed)), F.array().cast("array<string>"))


def targets(
    patterns: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS
) -> DataFrame:
    """Per source: its key, words and target, from patterns with their words (``capacity``).

    Sources by code point, null last, weigh as ``weights`` say, over and over. The words of
    all documents are shared by weight; no target passes ``repeats`` times its source's
    words, and what is over is shared again among the rest. With sources in ascending order
    of the level at which they are full, the first that is not full sets the level of all.
    There is one row per source here, which is what the two global windows sort.
    """
    total = patterns.agg(F.coalesce(F.sum("capacity"), F.lit(0)).alias("_total"))
    sizes = patterns.select("capacity", F.explode("pattern").alias("key"))
    sizes = sizes.groupBy("key").agg(F.sum("capacity").alias("source_size"))
    order = F.row_number().over(Window.orderBy(F.col("key") == "n", "key")) - 1
    weighed = F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int"))
    full = F.lit(repeats) * F.col("source_size")
    rows = one_row(sizes.withColumn("weight", weighed), total).withColumn("_full", full)
    filling = Window.orderBy(F.col("_full") / F.col("weight"), "key")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("_total") - F.coalesce(F.sum("_full").over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(rest)
    rows = rows.withColumn("_level", level)
    first = F.when(F.col("_full") >= F.col("weight") * F.col("_level"), F.col("_level"))
    everything = Window.orderBy(F.col("_full") / F.col("weight"), "key").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    found = F.first(first, ignorenulls=True).over(everything)
    share = F.coalesce(F.col("weight") * found, F.col("_full").cast("double"))
    return rows.select(
        "key", "source_size", F.least(F.col("_full").cast("double"), share).alias("target")
    )


def min_cost_flow(
    capacities: list[int], members: list[list[int]], quotas: list[int], repeats: int = REPEATS
) -> dict[tuple[int, int], int]:
    """Words from each pattern to each of its sources, at the least cost of repetition.

    Successive shortest paths: start -> pattern (one arc per repetition, dearer each time)
    -> source -> end. Costs are small integers, so a label-correcting search is enough.
    """
    patterns, start = len(capacities), 0
    end = 1 + patterns + len(quotas)
    to: list[int] = []
    left: list[int] = []
    price: list[int] = []
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def arc(a: int, b: int, most: int, cost: int) -> int:
        for x, y, m, c in ((a, b, most, cost), (b, a, 0, -cost)):
            out[x].append(len(to))
            to.append(y)
            left.append(m)
            price.append(c)
        return len(to) - 2

    routes = {}
    for p, capacity in enumerate(capacities):
        for use in range(repeats):
            arc(start, 1 + p, capacity, use * use)
        for s in members[p]:
            routes[p, s] = arc(1 + p, 1 + patterns + s, repeats * capacity, 0)
    for s, quota in enumerate(quotas):
        arc(1 + patterns + s, end, quota, 0)
    while True:
        cost: list[float] = [float("inf")] * (end + 1)
        came = [-1] * (end + 1)
        cost[start] = 0
        todo, waiting = deque([start]), {start}
        while todo:
            waiting.discard(node := todo.popleft())
            for a in out[node]:
                if left[a] and cost[node] + price[a] < cost[to[a]]:
                    cost[to[a]], came[to[a]] = cost[node] + price[a], a
                    if to[a] not in waiting:
                        waiting.add(to[a])
                        todo.append(to[a])
        if came[end] < 0:
            return {route: left[a ^ 1] for route, a in routes.items() if left[a ^ 1]}
        path, node = [], end
        while node != start:
            path.append(came[node])
            node = to[came[node] ^ 1]
        most = min(left[a] for a in path)
        for a in path:
            left[a] -= most
            left[a ^ 1] += most


def routes(patterns: DataFrame, quotas: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Per pattern: its words and [(source, first word, word after the last)] on its line.

    Patterns that share no source, not even through others, are routed in separate tasks.
    """
    arcs = patterns.withColumn("key", F.explode("pattern"))
    pairs = arcs.select(F.element_at("pattern", 1).alias("a"), F.col("key").alias("b"))
    pairs = pairs.filter("a <> b").distinct()
    arcs = arcs.join(quotas.select("key", F.round("target").cast("long").alias("quota")), "key")
    arcs = arcs.withColumn("_first", F.element_at("pattern", 1))
    if pairs.isEmpty():
        arcs = arcs.withColumn("_part", F.col("_first"))
    else:
        parts = components(pairs).select(F.col("node").alias("_first"), "component")
        arcs = arcs.join(parts, "_first", "left")
        arcs = arcs.withColumn("_part", F.coalesce("component", "_first"))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(pattern=[tuple(p) for p in rows["pattern"]])
        lines = rows.drop_duplicates("pattern").sort_values("pattern")
        quota = rows.drop_duplicates("key").sort_values("key")
        number = {k: i for i, k in enumerate(quota["key"])}
        flow = min_cost_flow(
            [int(c) for c in lines["capacity"]],
            [[number[k] for k in p] for p in lines["pattern"]],
            [int(q) for q in quota["quota"]],
            repeats,
        )
        found = []
        for p, (line, capacity) in enumerate(zip(lines["pattern"], lines["capacity"], strict=True)):
            at, taken = 0, []
            for key in line:
                if n := flow.get((p, number[key]), 0):
                    taken.append({"key": key, "first": at, "after": at + n})
                    at += n
            found.append((list(line), int(capacity), taken))
        return pd.DataFrame(found, columns=["pattern", "capacity", "taken"])

    columns = arcs.select("_part", "pattern", "capacity", "key", "quota")
    return columns.groupBy("_part").applyInPandas(
        solve,
        "pattern array<string>, capacity long, "
        "taken array<struct<key: string, first: long, after: long>>",
    )


def seeded(docs: DataFrame, doc_id: str, seed: int = SEED) -> DataFrame:
    """Adds the words before each document in the seeded order of its pattern.

    The order is cut into stretches by the first digits of its hash: one running sum over
    the stretches of a pattern, one inside each stretch, so that no task holds a pattern.
    """
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), key))
    docs = docs.withColumn("_hash", hashed).withColumn("_cut", F.substring("_hash", 1, _BUCKETS))
    sums = docs.groupBy("pattern", "_cut").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("pattern").orderBy("_cut").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = sums.select(
        "pattern", "_cut", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("pattern", "_cut").orderBy("_hash", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    own = F.coalesce(F.sum("size").over(inside), F.lit(0))
    docs = docs.withColumn("_own", own).join(sums, ["pattern", "_cut"])
    return docs.withColumn("at", F.col("_before") + F.col("_own")).drop(
        "_hash", "_cut", "_own", "_before"
    )


def copies(repeats: int = REPEATS) -> Column:
    """How often the sources take a document: once for each time its middle is in a stretch."""

    def hits(stretch: Column) -> Column:
        counted = F.lit(0)
        for turn in range(repeats):
            middle = 2 * (F.col("at") + turn * F.col("capacity")) + F.col("size")
            inside = (middle >= 2 * stretch["first"]) & (middle < 2 * stretch["after"])
            counted = counted + inside.cast("int")
        return counted

    each = F.aggregate("taken", F.lit(0), lambda n, stretch: n + hits(stretch))
    return F.coalesce(each, F.lit(0))


def mix(
    docs: DataFrame,
    members: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(documents with pattern, size and copies; sources with key, source_size and target).

    ``members`` is the array of a document's sources. A document without any source is not
    taken, nor is an empty one missed: its words are none. Repeated rows are separate
    documents in one place of the order. An empty table gives two empty tables.
    """
    sized = stored(
        docs.select(F.col(doc_id).alias("doc_id"), words(text).alias("size"), pattern(members).alias("pattern"))
    )
    patterns = stored(sized.groupBy("pattern").agg(F.sum("size").alias("capacity")))
    sources = stored(targets(patterns, weights, repeats))
    routed = stored(routes(patterns, sources, repeats))
    placed = seeded(sized, "doc_id", seed).join(routed, "pattern", "left")
    return placed.select("doc_id", "pattern", "size", copies(repeats).alias("copies")), sources
