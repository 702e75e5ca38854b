"""Near-duplicate vectors by counting collisions on sorted projections.

Every vector gets a number of one-dimensional projections. A projection is sorted within a cell,
the signs of further projections, and two vectors collide in it if they are in the same cell
and within a window around each other on the line. Pairs that collide often enough are
compared exactly. The count asked for follows from the chance that a pair just at the threshold
collides once: the largest with which it is still found with probability ``RECALL``. All this is
the same at any size; cells keep windows short as the data grow.

Groups of copies make no pairs. Equal vectors are one node. Around the middle of a crowded
cell, vectors within half the threshold's angle form a ball: all of them are links of each
other, and they go on as one item with a range on every line. Two items are all linked, not
linked, or, where their radii leave it open, compared member by member.

Only rows with equal label and vectors of equal length are compared. Rows with a null label or
a vector that is null, empty, zero or not finite throughout link with nothing and stand for
themselves. Rows that repeat an id are links of each other only if their vectors are; rows
without id link like others, and a group of only such has no component id. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, comb, erf, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txvigil.llm.common import components, stored

THRESHOLD, RECALL = 0.98, 0.99
TABLES, SIGNS, SEED = 24, 20, 11
# Half the width of a window, in standard deviations of the difference of a pair at the threshold.
REACH = 2.5
# Cells by so many signs with so many vectors are crowded; their middles are looked up by so many tables.
CORE_SIGNS, CROWD, LOOKUPS = 32, 16, 8
_SLACK = 1e-7
_STEP = 2048


def count_needed(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The most collisions that a pair at the threshold still has with this probability."""
    once = (1 - acos(threshold) / pi) ** SIGNS * erf(REACH / sqrt(2))
    chance, needed = 1.0, 0
    while True:
        chance -= comb(TABLES, needed) * once**needed * (1 - once) ** (TABLES - needed)
        if chance < recall:
            return max(needed, 1)
        needed += 1


def lines(dim: int, tables: int, signs: int, seed: int = SEED) -> np.ndarray:
    """Random unit vectors: for every table those of the signs and one for the line."""
    dice = np.random.default_rng([seed, dim, tables, signs])
    drawn = dice.standard_normal((tables * (signs + 1), dim))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def usable(vector: str) -> Column:
    """Whether a vector has only finite components and not only zeros."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrices(vectors: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their unit vectors in double precision, by length of vector."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    ends = np.cumsum(sizes)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        values = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
        values = values / np.abs(values).max(axis=1, keepdims=True)
        yield rows, values / np.linalg.norm(values, axis=1, keepdims=True)


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """One 64-bit number of several."""
    state = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for part in parts:
            state = (state ^ np.asarray(part).astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            state = state ^ (state >> np.uint64(29))
            state = state * np.uint64(0x94D049BB133111EB)
            state = state ^ (state >> np.uint64(32))
    return state.view(np.int64)


def _cells(
    unit: np.ndarray, family: np.ndarray, tables: int, signs: int
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """For blocks of vectors, their cell in every table and their place on its line."""
    dim = unit.shape[1]
    drawn = lines(dim, tables, signs).T
    powers = 1 << np.arange(signs, dtype=np.int64)
    for start in range(0, len(unit), _STEP):
        block = slice(start, start + _STEP)
        placed = (unit[block] @ drawn).reshape(-1, tables, signs + 1)
        bits = (placed[:, :, :signs] > 0) @ powers
        cells = mixed(family[block, None], bits)
        # The table is readable in the lowest bits.
        yield block, (cells & ~31) | np.arange(tables), placed[:, :, signs]


def _placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of items in all tables: cell, item and its window on the line."""
    width = sqrt(2 - 2 * THRESHOLD) * REACH / 2
    for part in parts:
        items, families = (part[c].to_numpy() for c in ("item", "family"))
        for rows, unit in matrices(part["vector"]):
            half = width / sqrt(unit.shape[1])
            for block, cells, places in _cells(unit, families[rows], TABLES, SIGNS):
                item = np.repeat(items[rows[block]], TABLES)
                cells, low, high = cells.ravel(), places.ravel() - half, places.ravel() + half
                # A ball's vectors in the same cell become one range at once.
                order = np.lexsort((item, cells))
                cells, item, low, high = cells[order], item[order], low[order], high[order]
                new = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]) | (item[1:] != item[:-1])])
                if len(cells):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cells[new]), pa.array(item[new]),
                            pa.array(np.minimum.reduceat(low, new)), pa.array(np.maximum.reduceat(high, new)),
                        ],
                        names=["cell", "item", "low", "high"],
                    )


def _collided(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of items whose windows overlap, with the table as a bit; rows come sorted by cell and low.

    Only rows whose window may still meet one to come are kept from batch to batch.
    """
    kept = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)]
    for part in parts:
        held = len(kept[0])
        columns = [part[c].to_numpy() for c in ("cell", "item", "low", "high")]
        cell, item, low, high = (np.concatenate(both) for both in zip(kept, columns, strict=True))
        if not len(cell):
            continue
        number = np.cumsum(np.r_[0, cell[1:] != cell[:-1]])
        # Lines lie within a few units, so that one sorted axis holds all cells.
        axis = number * 16.0
        last = np.searchsorted(axis + low, axis + high, "right")
        first = np.maximum(np.arange(len(cell)) + 1, held)
        many = np.maximum(last - first, 0)
        for rows in np.array_split(np.arange(len(cell)), many.sum() // (1 << 20) + 1):
            n = many[rows]
            one = np.repeat(rows, n)
            two = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[rows], n)
            other = item[one] != item[two]
            one, two = one[other], two[other]
            a, b = np.minimum(item[one], item[two]), np.maximum(item[one], item[two])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(np.int64(1) << (cell[one] & 31))],
                names=["a", "b", "tables"],
            )
        open_still = (cell == cell[-1]) & (high >= low[-1])
        kept = [column[open_still] for column in (cell, item, low, high)]


def _cosines(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cosine of the vectors x and y of every row, null if they are not of one family."""
    for part in parts:
        made = np.full(part.num_rows, np.nan)
        right = {}
        for rows, unit in matrices(part["y"]):
            for at, row in enumerate(rows):
                right[row] = unit[at]
        family = part["family_x"].to_numpy() == part["family_y"].to_numpy()
        for rows, unit in matrices(part["x"]):
            same = np.array([family[r] and len(right[r]) == unit.shape[1] for r in rows], bool)
            if same.any():
                others = np.stack([right[r] for r in rows[same]])
                made[rows[same]] = np.einsum("ij,ij->i", unit[same], others)
        names = [n for n in part.schema.names if n not in ("x", "y", "family_x", "family_y")]
        arrays = [part[n] for n in names]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(made, from_pandas=True)], names=[*names, "cosine"]
        )


def compared(pairs: DataFrame, one: DataFrame, two: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs with the cosine of their vectors; ``one`` and ``two`` have the key, family and vector."""
    left = one.select(F.col(one.columns[0]).alias(a), F.col("family").alias("family_x"), F.col("vector").alias("x"))
    right = two.select(F.col(two.columns[0]).alias(b), F.col("family").alias("family_y"), F.col("vector").alias("y"))
    fields = [f for f in pairs.schema.fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", cosine double"
    joined = pairs.join(left, a).join(right, b).select(*pairs.columns, "family_x", "x", "family_y", "y")
    return joined.mapInArrow(_cosines, schema)


def _cores(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        families, core = part["family"].to_numpy(), np.empty(part.num_rows, np.int64)
        for rows, unit in matrices(part["vector"]):
            for block, cells, _ in _cells(unit, families[rows], 1, CORE_SIGNS):
                core[rows[block]] = cells[:, 0]
        yield pa.RecordBatch.from_arrays([part["node"], pa.array(core)], names=["node", "core"])


def _sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the unit vectors of a batch, by core."""
    for part in parts:
        cores, families = part["core"].to_numpy(), part["family"].to_numpy()
        for rows, unit in matrices(part["vector"]):
            keys, first, place = np.unique(cores[rows], return_index=True, return_inverse=True)
            sums = np.zeros((len(keys), unit.shape[1]))
            np.add.at(sums, place, unit)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys), pa.array(families[rows][first]), pa.array(np.bincount(place)),
                    pa.array(list(sums), pa.list_(pa.float64())),
                ],
                names=["core", "family", "n", "sums"],
            )


def _looked_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the first tables only, without windows."""
    for part in parts:
        keys, families = part.column(0).to_numpy(), part["family"].to_numpy()
        for rows, unit in matrices(part["vector"]):
            for block, cells, _ in _cells(unit, families[rows], LOOKUPS, SIGNS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(keys[rows[block]], LOOKUPS)), pa.array(cells.ravel())],
                    names=["key", "cell"],
                )


def nodes_of(rows: DataFrame, vector: str, label: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Distinct (label, vector) with an own number, and every row's digest of both."""
    digests = [F.xxhash64(label, vector), F.xxhash64(vector, label)]
    marked = rows.select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"),
        (F.col(label).isNotNull() & usable(vector)).alias("used"),
        digests[0].alias("h1"), digests[1].alias("h2"),
    )
    family = F.xxhash64("label", F.size("vector"))
    distinct = marked.filter("used").groupBy("h1", "h2").agg(
        F.first(family).alias("family"), F.first("vector").alias("vector"),
        F.min("id").alias("first_id"), F.count("*").alias("many"),
    )
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()))
    return nodes, marked.select("id", "used", "h1", "h2")


def balls(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Nodes that lie around the middle of a crowded cell: node, ball and their angle to it.

    A node near several middles belongs to that of the most crowded cell.
    """
    cored = stored(nodes.mapInArrow(_cores, "node long, core long"))
    crowded = cored.groupBy("core").agg(F.count("*").alias("crowd")).filter(F.col("crowd") >= CROWD)
    crowded = stored(crowded)
    inside = nodes.join(cored.join(crowded.select("core"), "core"), "node").select("core", "family", "vector")
    sums = inside.mapInArrow(_sums, "core long, family long, n long, sums array<double>")
    sums = sums.select("core", "family", F.posexplode("sums").alias("at", "x"))
    middle = sums.groupBy("core", "family", "at").agg(F.sum("x").alias("x"))
    middle = middle.groupBy("core", "family").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))
    middles = stored(
        middle.join(crowded, "core").select("core", "family", F.col("v.x").alias("vector"), "crowd").filter(usable("vector"))
    )
    cells = nodes.select("node", "family", "vector").mapInArrow(_looked_up, "key long, cell long")
    own = middles.select("core", "family", "vector").mapInArrow(_looked_up, "key long, cell long")
    near = cells.withColumnRenamed("key", "node").join(own.withColumnRenamed("key", "core"), "cell")
    near = near.select("node", "core").distinct()
    angle = F.acos(F.least(F.greatest("cosine", F.lit(-1.0)), F.lit(1.0)))
    vectors = nodes.select("node", "family", "vector")
    placed = compared(near, vectors, middles.select("core", "family", "vector"), "node", "core")
    placed = placed.withColumn("angle", angle).filter(F.col("angle") <= acos(threshold) / 2 - _SLACK)
    best = placed.join(middles.select("core", "crowd"), "core")
    best = best.groupBy("node").agg(F.max_by(F.struct("core", "angle"), F.struct("crowd", "core")).alias("best"))
    return best.select("node", F.col("best.core").alias("core"), F.col("best.angle").alias("angle")), middles


def linked(
    rows: DataFrame, vector: str = "embedding", label: str = "label", key: str = "vec_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row id, n_links (rows whose vector is linked with it), component_id, kept."""
    nodes, marked = nodes_of(rows, vector, label, key)
    inside, middles = balls(nodes, threshold)
    inside = stored(inside)
    heads = inside.groupBy("core").agg(F.min("node").alias("item"), F.max("angle").alias("radius"))
    members = stored(
        nodes.select("node", "family", "vector", "many", "first_id")
        .join(inside.join(heads, "core").select("node", "item"), "node", "left")
        .withColumn("item", F.coalesce("item", "node"))
    )
    sizes = members.groupBy("item").agg(F.sum("many").alias("weight"), F.min("first_id").alias("first_id"))
    ball = heads.join(middles, "core").select("item", "family", "vector", "radius")
    single = nodes.select(F.col("node").alias("item"), "family", "vector")
    single = single.join(inside.select(F.col("node").alias("item")), "item", "left_anti")
    shapes = ball.unionByName(single.withColumns({"radius": F.lit(0.0), "vector": F.col("vector").cast("array<double>")}))
    items = stored(shapes.join(sizes, "item"))

    placed = members.select("item", "family", "vector").mapInArrow(
        _placed, "cell long, item long, low double, high double"
    )
    sorted_lines = placed.repartition("cell").sortWithinPartitions("cell", "low")
    hits = sorted_lines.mapInArrow(_collided, "a long, b long, tables long")
    counted = hits.groupBy("a", "b").agg(F.bit_or("tables").alias("tables"))
    pairs = stored(counted.filter(F.bit_count("tables") >= count_needed(threshold)).select("a", "b"))

    vectors = items.select("item", "family", "vector")
    judged = compared(pairs, vectors, vectors, "a", "b")
    for side in "ab":
        judged = judged.join(
            items.select(F.col("item").alias(side), F.col("radius").alias(f"r_{side}"), F.col("weight").alias(f"w_{side}")), side
        )
    reach, limit = F.col("r_a") + F.col("r_b"), acos(threshold)
    angle = F.acos(F.least(F.greatest("cosine", F.lit(-1.0)), F.lit(1.0)))
    verdict = (
        F.when(F.col("cosine").isNull(), "none")
        .when(reach == 0, F.when(F.col("cosine") >= threshold, "all").otherwise("none"))
        .when(angle - reach > limit + _SLACK, "none")
        .when(angle + reach <= limit - _SLACK, "all")
        .otherwise("open")
    )
    judged = stored(judged.withColumn("verdict", verdict).filter("verdict <> 'none'"))
    whole, unclear = judged.filter("verdict = 'all'"), judged.filter("verdict = 'open'")
    gained = whole.select(F.col("a").alias("item"), F.col("w_b").alias("n")).unionAll(whole.select("b", "w_a"))
    gained = gained.groupBy("item").agg(F.sum("n").alias("by_item"))

    belongs = members.select("node", "item")
    one = belongs.select(F.col("item").alias("a"), F.col("node").alias("x_node"))
    two = belongs.select(F.col("item").alias("b"), F.col("node").alias("y_node"))
    open_pairs = unclear.select("a", "b").join(one, "a").join(two, "b")
    details = members.select("node", "family", "vector")
    found = compared(open_pairs, details, details, "x_node", "y_node").filter(F.col("cosine") >= threshold)
    found = stored(found)
    many = members.select("node", "many")
    sides = found.select(F.col("x_node").alias("to"), F.col("y_node").alias("node"))
    sides = sides.unionAll(found.select("y_node", "x_node")).join(many, "node")
    single_gain = sides.groupBy(F.col("to").alias("node")).agg(F.sum("many").alias("by_node"))

    groups = components(whole.select("a", "b").unionAll(found.select("a", "b")).distinct())
    groups = groups.select(F.col("node").alias("item"), "component")
    named = items.select("item", "weight", "first_id").join(groups, "item", "left").join(gained, "item", "left")
    named = named.withColumn("component", F.coalesce("component", "item"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select("item", "weight", "by_item", "component_id")

    result = nodes.select("node", "h1", "h2").join(belongs, "node").join(named, "item").join(single_gain, "node", "left")
    links = F.col("weight") - 1 + F.coalesce("by_item", F.lit(0)) + F.coalesce("by_node", F.lit(0))
    result = stored(result.select("h1", "h2", links.alias("n_links"), "component_id"))
    joined = marked.filter("used").join(result, ["h1", "h2"]).select("id", "n_links", "component_id")
    alone = marked.filter("NOT used").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
