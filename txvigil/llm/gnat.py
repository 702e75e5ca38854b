"""Hard negatives by exact search in a multiway tree of split points (GNAT).

Whole-number vectors get one more coordinate that brings all of them to the same length; then a
score, their inner product with an anchor, is a distance and a window of scores an annulus
around the anchor. Inner nodes of the tree have up to 16 split points; a row belongs to the
nearest one, and each split point knows the range of its distances to the rows of every
sibling. A sibling whose range does not meet what the annulus allows is left out with all below
it. Leaves are compared exactly, in blocks.

Split points come from a sample of at most ``SAMPLE`` rows; every row is in the tree. Rows of a
leaf are dealt to blocks of bounded size, anchors that are near each other to chunks; a chunk
meets only the blocks of leaves that one of its anchors cannot leave out. Positives are
searched twice: at home for a first radius, then in all that is left within it.

Rows with a null id, label or vector, or a component that is null or not finite, take no part.
Vectors of different length are not compared. Rows that repeat an id are different rows but for
an anchor's own id: they are neither its positives nor its negatives, and of several the
first by label and vector is the anchor. Equal rows take a place each. Other columns are
ignored. An empty table gives an empty result. Vectors so long that doubles would round their
scores are compared in full, without a tree, by whole numbers of any size; a score that does not
fit a long ends the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from txvigil.llm.common import stored

# Rows that split points are taken from, split points of a node, rows that a leaf should have.
SAMPLE, WAYS, LEAF = 8192, 16, 2048
# Rows of a block and anchors of a chunk.
BLOCK, CHUNK = 8192, 4096
POSITIVES = NEGATIVES = 5
# Part of a positive's score, in hundredths, that a negative's must reach and not exceed.
LEAST, MOST = 80, 100
_EXACT = 2.0**53

_FOUND = "anchor long, place int, id long, score long"


def grid(vectors: pa.Array) -> np.ndarray:
    """Components as whole numbers of 1/256; exact, as doubles or, if too large, as Python's."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(256 * flat).reshape(len(vectors), len(flat) // max(len(vectors), 1))


class Tree:
    """Split points of vectors of one length: nodes in a list, children by number."""

    def __init__(self, sample: np.ndarray, rows: int, length: float) -> None:
        self.length = length
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self._split(sample, ceil(rows / LEAF))

    def _split(self, sample: np.ndarray, leaves: int) -> int:
        """A node for so many leaves; -1 - n for leaf n."""
        ways = min(WAYS, leaves, len(np.unique(sample, axis=0)) if leaves > 1 else 1)
        if ways < 2:
            self.leaves += 1
            return -self.leaves
        number = len(self.points)
        self.points.append(_apart(sample, ways))
        self.children.append([])
        nearest = self.distances(number, sample, self.lifted(sample)).argmin(1)
        made = [self._split(sample[nearest == way], ceil(leaves / ways)) for way in range(ways)]
        self.children[number] = made
        return number

    def lifted(self, values: np.ndarray) -> np.ndarray:
        """The coordinate that brings rows to the same length."""
        return np.sqrt(np.maximum(self.length**2 - np.einsum("ij,ij->i", values, values), 0))

    def distances(self, node: int, values: np.ndarray, extra: np.ndarray) -> np.ndarray:
        points = self.points[node]
        squares = np.einsum("ij,ij->i", values, values) + extra**2
        inner = values @ points.T + np.outer(extra, self.lifted(points))
        return np.sqrt(np.maximum(squares[:, None] + self.length**2 - 2 * inner, 0))

    def placed(self, values: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
        """Leaf of every row; per node on the way the rows, their child and all distances."""
        extra, leaf, steps = self.lifted(values), np.zeros(len(values), np.int64), []
        todo = [(0, np.arange(len(values)))] if self.points else []
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            apart = self.distances(node, values[rows], extra[rows])
            child = apart.argmin(1)
            steps.append((node, rows, child, apart))
            for way, below in enumerate(self.children[node]):
                if below < 0:
                    leaf[rows[child == way]] = -below - 1
                else:
                    todo.append((below, rows[child == way]))
        return leaf, steps

    def reached(self, values: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """Which leaves (columns) may hold rows between two distances of an anchor (rows)."""
        seen = np.zeros((len(values), self.leaves), bool)
        if not self.points:
            return ~seen
        slack = 1e-9 * self.length + 1e-6
        todo, extra = [(0, np.arange(len(values)))], np.zeros(len(values))
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            apart = self.distances(node, values[rows], extra[rows])
            most = apart + outer[rows, None] + slack
            least = np.maximum(apart - outer[rows, None], inner[rows, None] - apart) - slack
            # anchors x split points x siblings
            alive = (self.low[node] <= most[:, :, None]) & (self.high[node] >= least[:, :, None])
            alive = alive.all(1)
            for way, below in enumerate(self.children[node]):
                if below < 0:
                    seen[rows[alive[:, way]], -below - 1] = True
                else:
                    todo.append((below, rows[alive[:, way]]))
        return seen


def _apart(sample: np.ndarray, ways: int) -> np.ndarray:
    """Rows of the sample that are far from each other, each the farthest from those before."""
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < ways:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def grown(rows: DataFrame) -> dict[int, Tree]:
    """A tree per length of vector: its split points from a bounded sample, ranges from all rows.

    Lengths that the sample does not have, or with vectors beyond what doubles hold exactly, go
    without a tree: all their rows are one leaf.
    """
    def grid_square(total: Column, x: Column) -> Column:
        return total + F.pow(256 * F.abs(x.cast("double")) + 1, F.lit(2.0))

    # No less than the length of the vector on the grid.
    squares = F.aggregate("vector", F.lit(0.0), grid_square)
    longest = rows.groupBy("dim").agg(F.max(squares).alias("longest"), F.count("*").alias("rows"))
    drawn = rows.select("dim", "vector", F.xxhash64("vec_id", "vector").alias("draw")).orderBy("draw").limit(SAMPLE)
    dims = drawn.select("dim").distinct()
    about = {r["dim"]: r for r in longest.join(dims, "dim").collect()}
    by_dim: dict[int, list] = {}
    for row in drawn.collect():
        by_dim.setdefault(row["dim"], []).append(row["vector"])
    trees = {}
    for dim, vectors in by_dim.items():
        if not dim or about[dim]["longest"] >= _EXACT:
            continue
        sample = np.floor(256 * np.array(vectors, float).reshape(len(vectors), dim))
        trees[dim] = Tree(sample, about[dim]["rows"], np.sqrt(about[dim]["longest"]))
    return trees


def _by_dim(part: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    dims = part["dim"].to_numpy()
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield int(dim), rows, grid(part["vector"].take(pa.array(rows)))


def _leaves(trees: dict[int, Tree]) -> Callable:
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            leaf = np.zeros(part.num_rows, np.int64)
            for dim, rows, values in _by_dim(part):
                if dim in trees:
                    leaf[rows] = trees[dim].placed(values)[0]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaf)], names=[*part.schema.names, "leaf"])

    return work


def _ranges(trees: dict[int, Tree]) -> Callable:
    """Least and greatest distance of every split point to the rows of each sibling, per task."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = {d: [np.full((len(p), len(p)), np.inf) for p in t.points] for d, t in trees.items()}
        high = {d: [np.full((len(p), len(p)), -np.inf) for p in t.points] for d, t in trees.items()}
        for part in parts:
            for dim, _, values in _by_dim(part):
                if dim not in trees:
                    continue
                for node, _, child, apart in trees[dim].placed(values)[1]:
                    for way in np.unique(child):
                        of = apart[child == way]
                        low[dim][node][:, way] = np.minimum(low[dim][node][:, way], of.min(0))
                        high[dim][node][:, way] = np.maximum(high[dim][node][:, way], of.max(0))
        for dim, tables in low.items():
            for node, table in enumerate(tables):
                point, way = np.nonzero(np.isfinite(table))
                if len(point):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(point), dim, np.int32)), pa.array(np.full(len(point), node, np.int32)),
                            pa.array(point.astype(np.int32)), pa.array(way.astype(np.int32)),
                            pa.array(table[point, way]), pa.array(high[dim][node][point, way]),
                        ],
                        names=["dim", "node", "point", "way", "low", "high"],
                    )

    return work


def measure(trees: dict[int, Tree], rows: DataFrame) -> None:
    """Sets the trees' ranges; as many numbers as split points have siblings come to the driver."""
    for tree in trees.values():
        tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
        tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    found = rows.select("dim", "vector").mapInArrow(
        _ranges(trees), "dim int, node int, point int, way int, low double, high double"
    )
    found = found.groupBy("dim", "node", "point", "way").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    for r in found.collect():
        trees[r.dim].low[r.node][r.point, r.way] = r.low
        trees[r.dim].high[r.node][r.point, r.way] = r.high


def _visits(trees: dict[int, Tree]) -> Callable:
    """Leaves that the anchors of a chunk reach between the scores ``most`` and ``least``."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            chunk = part["chunk"].to_numpy()
            least, most = (part[c].to_numpy(zero_copy_only=False).astype(float) for c in ("least", "most"))
            for dim, rows, values in _by_dim(part):
                if dim in trees:
                    tree = trees[dim]
                    base = np.einsum("ij,ij->i", values, values) + tree.length**2
                    inner, outer = (np.sqrt(np.maximum(base - 2 * s[rows], 0)) for s in (most, least))
                    seen = tree.reached(values, inner, outer)
                else:
                    seen = np.ones((len(rows), 1), bool)
                which, leaf = np.nonzero(seen)
                pairs = np.unique(np.stack([chunk[rows][which], leaf], 1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(pairs), dim, np.int32)), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                    ],
                    names=["dim", "chunk", "leaf"],
                )

    return work


def scores(anchors: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; by Python's own where doubles would round."""
    if not len(anchors) or not len(values):
        return np.zeros((len(anchors), len(values)), np.int64)
    bound = np.sqrt((anchors**2).sum(1).max() * (values**2).sum(1).max())
    if bound < _EXACT:
        return (anchors @ values.T).astype(np.int64)
    whole = [np.vectorize(int, otypes=[object])(side) for side in (anchors, values)]
    return (whole[0] @ whole[1].T).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, some: np.ndarray, n: int) -> np.ndarray:
    """Places of the first by score, then id."""
    return some[np.lexsort((ids[some], -score[some]))[:n]]


def _positives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    made: list[tuple] = []
    table = scores(grid(anchors["vector"].combine_chunks()), grid(rows["vector"].combine_chunks()))
    for score, anchor, label in zip(table, anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), strict=True):
        some = np.flatnonzero((labels == label) & (ids != anchor))
        for at in _best(score, ids, some, POSITIVES):
            made.append((anchor, 0, int(ids[at]), int(score[at])))
    return _table(made)


def _negatives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    made: list[tuple] = []
    table = scores(grid(anchors["vector"].combine_chunks()), grid(rows["vector"].combine_chunks()))
    for score, row in zip(table, anchors.drop_columns("vector").to_pylist(), strict=True):
        anchor = row["vec_id"]
        within = (score >= row["least"]) & (score <= row["most"])
        within = np.flatnonzero(within & (labels != row["label"]) & (ids != anchor))
        if not len(within):
            continue
        for place, positive in enumerate(row["positives"]):
            least, most = -(-LEAST * positive["score"] // 100), MOST * positive["score"] // 100
            fits = within[(score[within] >= least) & (score[within] <= most)]
            for at in _best(score, ids, fits, NEGATIVES):
                made.append((anchor, place, int(ids[at]), int(score[at])))
    return _table(made)


def _table(made: list[tuple]) -> pa.Table:
    columns = list(zip(*made, strict=True)) or [[]] * 4
    kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64()
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "place", "id", "score"]
    )


def searched(rows: DataFrame, anchors: DataFrame, visits: DataFrame, work: Callable) -> DataFrame:
    """Applies ``work`` to every block of a visited leaf and the chunk of anchors that visits it."""
    blocks = rows.select("dim", "leaf", "block").distinct()
    cell = ["dim", "chunk", "leaf", "block"]
    left = rows.join(visits, ["dim", "leaf"]).select(*cell, "vec_id", "label", "vector")
    right = anchors.drop("leaf").join(visits.join(blocks, ["dim", "leaf"]), ["dim", "chunk"])
    # Both sides stem from the same tables; new names keep their columns apart.
    right = right.toDF(*right.columns)
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(work, _FOUND)


def first(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first by score, then id, of every key, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def usable(rows: DataFrame, vector: str, label: Column, key: str) -> DataFrame:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    chosen = rows.select(F.col(key).alias("vec_id"), label.alias("label"), F.col(vector).alias("vector"), finite.alias("ok"))
    chosen = chosen.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND ok").drop("ok")
    return chosen.withColumn("dim", F.size("vector"))


def mined(
    rows: DataFrame, anchor: Callable[[Column], Column], vector: str = "embedding",
    label: str | Column = "label", key: str = "vec_id",
) -> DataFrame:
    """Per anchor and positive its first negatives: anchor_id, positive_id, rank, negative_id, scores.

    ``anchor`` says of an id whether its row is one; there should be far fewer of them than rows.
    """
    kept = usable(rows, vector, F.col(label) if isinstance(label, str) else label, key)
    kept = stored(kept)
    trees = grown(kept)
    kept = stored(kept.mapInArrow(_leaves(trees), f"{_ddl(kept)}, leaf long"))
    measure(trees, kept)

    sizes = kept.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks"))
    kept = stored(kept.join(sizes, ["dim", "leaf"]).withColumn("block", dealt).drop("blocks"))

    chosen = kept.filter(anchor(F.col("vec_id"))).drop("block")
    chosen = stored(chosen.groupBy("vec_id").agg(F.min_by(F.struct("dim", "leaf", "label", "vector"), F.struct("label", "vector")).alias("r")))
    chosen = chosen.select("vec_id", "r.*")
    counts = chosen.groupBy("dim", "leaf").count()
    earlier = Window.partitionBy("dim").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("dim", "leaf", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"), "count")
    # Leaves with few anchors share a chunk, one with many has several.
    spread = F.pmod(F.xxhash64("vec_id"), F.col("count"))
    chunk = F.expr("start").cast("long") + spread
    chosen = chosen.join(starts, ["dim", "leaf"]).withColumn("chunk", F.floor(chunk / CHUNK)).drop("start", "count")
    chosen = stored(chosen)

    home = chosen.select("dim", "chunk", "leaf").distinct()
    near = first(searched(kept, chosen, home, _positives), ["anchor"], POSITIVES)
    radius = near.groupBy(F.col("anchor").alias("vec_id")).agg(
        F.when(F.count("*") == POSITIVES, F.min("score")).alias("least")
    )
    wanted = chosen.join(radius, "vec_id", "left").withColumns(
        {"least": F.coalesce(F.col("least").cast("double"), F.lit(float("-inf"))), "most": F.lit(float("inf"))}
    )
    visits = _planned(wanted, trees)
    positives = stored(first(searched(kept, chosen, visits, _positives), ["anchor"], POSITIVES))

    per_anchor = positives.groupBy(F.col("anchor").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives")
    )
    asked = chosen.join(per_anchor, "vec_id").withColumns(
        {
            "most": F.aggregate("positives", F.lit(0).cast("long"), lambda m, p: F.greatest(m, p["score"])),
            "least": F.aggregate("positives", F.lit(2**62), lambda m, p: F.least(m, _least(p["score"]))),
        }
    )
    asked = stored(asked.filter("most >= 0 AND least <= most"))
    visits = _planned(asked, trees)
    found = searched(kept, asked, visits, _negatives)
    ranked = first(found, ["anchor", "place"], NEGATIVES)
    named = positives.select(
        F.col("anchor"), (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return ranked.join(named, ["anchor", "place"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def _least(score: Column) -> Column:
    """No more than what a negative must reach; none can if the positive's score is negative."""
    return F.when(score >= 0, F.floor(score.cast("decimal(20,0)") * LEAST / 100).cast("long"))


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)


def _planned(wanted: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Distinct (dim, chunk, leaf) that some anchor of the chunk cannot leave out."""
    spans = wanted.select("dim", "vector", "chunk", F.col("least").cast("double"), F.col("most").cast("double"))
    return stored(spans.mapInArrow(_visits(trees), "dim int, chunk long, leaf long").distinct())
