"""Merkle manifest of a dataset: a root over all rows, and what each row needs to prove itself.

Leaves are numbered per group by sorting in ranges and adding up the sizes of the ranges, so no
group needs a task of its own. Runs of 4096 leaves, four levels of the tree, are one task's
work; their roots are the leaves of the next round, until one is left of each group. Then the
way to the root is handed down the same rounds.

A parent keeps a copy of its hash state from before each child. To fold a changed leaf, the
state at its slot is taken up again and gets only the replacement and the siblings to its
right; so it goes up, level by level. Above the run the states hold what lies to the left of
the run's path; they are made once for all leaves of the run.

Rows with null fields, empty or very long texts, equal rows and equal or null ids are leaves like
all others; equal ids are in the order of their digests. Other columns are ignored. An empty
table has no rows in its manifest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from txvigil.llm.common import stored

# Children of a node, and levels that one task builds at once.
WAYS, LEVELS = 8, 4

_PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: every field with its length in bytes, or ``-`` where it is null."""
    texts = [f.cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``place``, from 0 in the given order within the group, and ``many``, its size.

    ``group`` must not be null.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # Numbers of Spark's own: the task in the upper bits, then the row of the task.
    ranged = stored(ranged.withColumn("_number", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_number", 33))
    sizes = ranged.groupBy(group, "_range").agg(F.min("_number").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
            "many": F.sum("_n").over(whole),
        }
    )
    placed = ranged.join(sizes, [group, "_range"])
    placed = placed.withColumn("place", F.col("_before") + F.col("_number") - F.col("_first"))
    return placed.drop("_number", "_range", "_first", "_before", "_n")


def height(many: int, most: int = LEVELS) -> int:
    """Levels above the leaves that one run builds, of a tree of so many leaves."""
    levels = 0
    while many > 1 and levels < most:
        many, levels = -(-many // WAYS), levels + 1
    return levels


class Run:
    """The tree over one run of digests, with the states of its parents."""

    def __init__(self, leaves: list[bytes], levels: int) -> None:
        self.levels = [leaves]
        self.states: list[list] = []
        for _ in range(levels):
            below, above, states = self.levels[-1], [], []
            for start in range(0, len(below), WAYS):
                state = sha256()
                for child in below[start : start + WAYS]:
                    states.append(state.copy())
                    state.update(child)
                above.append(state.hexdigest().encode())
            self.states.append(states)
            self.levels.append(above)

    def beside(self, slot: int) -> Iterator[tuple[bytes, bytes]]:
        """Siblings to the left and to the right, from the leaf up."""
        for below in self.levels[: len(self.states)]:
            start = slot - slot % WAYS
            yield b"".join(below[start:slot]), b"".join(below[slot + 1 : start + WAYS])
            slot //= WAYS

    def folded(self, slot: int, digest: bytes) -> bytes:
        """The run's root with another digest in a slot."""
        for below, states in zip(self.levels, self.states, strict=False):
            digest = resumed(states[slot], digest, below[slot + 1 : slot - slot % WAYS + WAYS])
            slot //= WAYS
        return digest


def resumed(state, digest: bytes, right: list[bytes]) -> bytes:
    state = state.copy()
    state.update(digest)
    for sibling in right:
        state.update(sibling)
    return state.hexdigest().encode()


def _run(rows: pa.Table, digest: str, most: int) -> tuple[pa.Table, Run]:
    rows = rows.sort_by("place")
    levels = height(rows["many"][0].as_py(), most)
    return rows, Run([d.encode() for d in rows[digest].to_pylist()], levels)


def _roots(rows: pa.Table, most: int) -> pa.Table:
    """The run as one leaf of the next round."""
    rows, run = _run(rows, "digest", most)
    first = rows.slice(0, 1).to_pylist()[0]
    return pa.table(
        {
            "tree": [first["tree"]],
            "place": [first["place"] // WAYS**most],
            "many": [-(-first["many"] // WAYS**most)],
            "digest": [run.levels[-1][0].decode()],
        }
    )


def _paths(rows: pa.Table, above: pa.Table, most: int) -> pa.Table:
    """The siblings of every node of a run on its way up, with those of the run itself."""
    rows, run = _run(rows, "digest", most)
    up = above.to_pylist()[0]
    made = {"tree": rows["tree"], "place": rows["place"], "lefts": [], "rights": []}
    for slot in range(rows.num_rows):
        pairs = [(left.decode(), right.decode()) for left, right in run.beside(slot)]
        made["lefts"].append([left for left, _ in pairs] + up["lefts"])
        made["rights"].append([right for _, right in pairs] + up["rights"])
    made["lefts"] = pa.array(made["lefts"], pa.list_(pa.string()))
    made["rights"] = pa.array(made["rights"], pa.list_(pa.string()))
    for name in ("subroot", "root"):
        made[name] = pa.array([up[name]] * rows.num_rows, pa.string())
    return pa.table(made)


def _proofs(rows: pa.Table, above: pa.Table, most: int) -> pa.Table:
    """Every leaf of a run with its proof, and the root as its claimed digest gives it."""
    rows, run = _run(rows, "leaf", most)
    up = above.to_pylist()[0]
    lefts, rights = ([text.encode() for text in up[side]] for side in ("lefts", "rights"))
    states = [sha256(left) for left in lefts]
    proofs, folded = [], []
    for slot, claim in enumerate(rows["claim"].to_pylist()):
        proof = sha256()
        for left, right in run.beside(slot):
            proof.update(left)
            proof.update(right)
        for left, right in zip(lefts, rights, strict=True):
            proof.update(left)
            proof.update(right)
        proofs.append(proof.hexdigest())
        digest = run.folded(slot, claim.encode())
        for state, right in zip(states, rights, strict=True):
            digest = resumed(state, digest, [right])
        folded.append(digest.decode())
    many = rows.num_rows
    return pa.table(
        {
            "id": rows["id"],
            "leaf": rows["leaf"],
            "subroot": pa.array([up["subroot"]] * many, pa.string()),
            "root": pa.array([up["root"]] * many, pa.string()),
            "proof_sha256": proofs,
            "folded_root": folded,
            "verified": [root == up["root"] for root in folded],
        }
    )


# PySpark looks at how many parameters a function has, so the number of levels is bound first.
def _bound(work: Callable, most: int) -> Callable:
    if work is _roots:
        return lambda rows: work(rows, most)
    return lambda rows, above: work(rows, above, most)


def _climbed(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Nodes (tree, place, many, digest) and the roots of their runs, round by round."""
    rounds, run = [nodes], F.expr(f"place div {WAYS**most}").alias("run")
    while rounds[-1].filter("many > 1").limit(1).count():
        schema = "tree string, place long, many long, digest string"
        roots = rounds[-1].groupBy("tree", run).applyInArrow(_bound(_roots, most), schema)
        rounds.append(stored(roots))
    return rounds


def _handed_down(rows: DataFrame, above: DataFrame, work: Callable, schema: str, most: int) -> DataFrame:
    """Applies ``work`` to every run and the path of its root."""
    runs = rows.groupBy("tree", F.expr(f"place div {WAYS**most}").alias("run"))
    ways = above.groupBy("tree", F.col("place").alias("run"))
    return runs.cogroup(ways).applyInArrow(_bound(work, most), schema)


def _ways(rounds: list[DataFrame], top: DataFrame, most: int) -> DataFrame:
    """Paths of the nodes of the first round, given those of the last."""
    paths = top
    for nodes in reversed(rounds[:-1]):
        paths = stored(_handed_down(nodes, paths, _paths, f"tree string, place long, {_PATH}", most))
    return paths


def manifest(
    rows: DataFrame, group: str, key: str, leaf: Column, claim: Column, levels: int = LEVELS
) -> DataFrame:
    """Leaf, roots and proof of every row, and whether its claimed digest folds to the root.

    Returns id (the ``key``), leaf, subroot (of the row's group), root, proof_sha256, folded_root
    and verified. A null group comes first, others by their bytes. ``levels`` of the tree are built in
one task; any number gives the same result.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit(""))
    leaves = rows.select(F.col(key).alias("id"), leaf.alias("leaf"), claim.alias("claim"), tree.alias("tree"))
    leaves = stored(numbered(leaves, "tree", ["id", "leaf", "claim"]))

    rounds = _climbed(leaves.select("tree", "place", "many", F.col("leaf").alias("digest")), levels)
    subroots = rounds[-1].select(F.col("tree").alias("group"), F.col("digest"), F.lit("").alias("tree"))
    subroots = stored(numbered(subroots, "tree", ["group"]))
    upper = _climbed(subroots.select("tree", "place", "many", "digest"), levels)
    nothing = F.array().cast("array<string>")
    root = upper[-1].select(
        "tree", "place", nothing.alias("lefts"), nothing.alias("rights"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    ways = _ways(upper, root, levels).drop("subroot")
    heads = subroots.select("place", "group", F.col("digest").alias("subroot"))
    tops = ways.join(heads, "place").select(
        F.col("group").alias("tree"), F.lit(0).cast("long").alias("place"), "lefts", "rights", "subroot", "root"
    )
    above = _ways(rounds[1:], stored(tops), levels)
    shown = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _handed_down(leaves, above, _proofs, shown, levels)
