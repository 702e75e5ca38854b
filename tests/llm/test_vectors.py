"""Collision counting and the tree of split points against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txvigil.llm import gnat, projections

KIND = "vec_id long, embedding array<float>, label int, node long, item string, score double, chunk int"
NAN, INF = float("nan"), float("inf")


def vectors(seed, crowds=(60, 9), alone=150, dim=16):
    """Random directions of two labels, crowds of near copies around some, equal ones, ties."""
    dice = np.random.default_rng(seed)
    rows = [(v, int(dice.integers(2))) for v in dice.standard_normal((alone, dim))]
    for crowd in crowds:
        middle = dice.standard_normal(dim)
        middle /= np.linalg.norm(middle)
        for _ in range(crowd):
            rows.append((middle * dice.uniform(0.5, 3) + dice.standard_normal(dim) * 0.02, int(dice.random() < 0.1)))
    rows += rows[:5] + rows[-20:]
    values = [([float(np.float32(x)) for x in v], label) for v, label in rows]
    random.Random(seed).shuffle(values)
    return [(n, v, label, n, "x", 0.5, 1) for n, (v, label) in enumerate(values)]


ODD = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1),
    (5, [0.0, 0.0], 1), (6, [NAN, 1.0], 1), (7, [1.0, None], 1), (8, [INF, 0.0], 1), (9, [], 1),
    (10, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.001], 1), (11, [1.0, 0.0], None), (100, [3.0, 0.5], 1),
    (14, [1.0, 0.3], 3), (200, [-1.0, 0.0], 1), (300, [1.0], 5), (100, [3.0, 0.6], 2), (0, [0.0, 1.0], 1),
]


def linked_by_hand(rows):
    ok = []
    for at, row in enumerate(rows):
        v, label = row[1], row[2]
        fine = v and label is not None and all(x is not None and abs(x) < INF for x in v) and any(v)
        if fine:
            ok.append(at)
    near = {at: set() for at in range(len(rows))}
    for a in ok:
        for b in ok:
            x, y = rows[a][1], rows[b][1]
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y):
                x, y = np.array(x), np.array(y)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    near[a].add(b)
    out = []
    for at in near:
        seen, todo = {at}, [at]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        ids = [rows[i][0] for i in seen if rows[i][0] is not None]
        least = min(ids, default=None)
        out.append((rows[at][0], len(near[at]), least, rows[at][0] == least))
    return out


def by_text(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_links(spark, seed):
    """Pairs found by chance are all but certain here: crowds are balls or collide often."""
    rows = vectors(seed)
    result = projections.linked(spark.createDataFrame(rows, KIND)).collect()
    wanted = linked_by_hand(rows)
    assert {r[0]: r[2:] for r in result} == {r[0]: r[2:] for r in wanted}
    found, all_links = sum(r.n_links for r in result), sum(r[1] for r in wanted)
    assert 0.99 * all_links <= found <= all_links


def test_links_of_odd_rows(spark):
    rows = [(*row, 0, "x", 0.5, 1) for row in ODD]
    result = projections.linked(spark.createDataFrame(rows, KIND)).collect()
    assert by_text(result) == by_text(linked_by_hand(rows))


def test_crowds_are_balls(spark):
    """Near copies of one vector go on as one item and make no pairs."""
    frame = spark.createDataFrame(vectors(3, crowds=(400,), alone=20), KIND)
    nodes, _ = projections.nodes_of(frame, "embedding", "label", "vec_id")
    inside, _ = projections.balls(nodes)
    assert inside.groupBy("core").count().agg(F.max("count")).first()[0] > 250


def test_recall_at_the_threshold():
    """Pairs with a cosine of just 0.98 collide often enough."""
    dice, dim = np.random.default_rng(5), 64
    a = dice.standard_normal((400, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    aside = dice.standard_normal((400, dim))
    aside -= (aside * a).sum(1, keepdims=True) * a
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * aside
    family = np.zeros(400, np.int64)
    sides = []
    for side in (a, b):
        blocks = list(projections._cells(side, family, projections.TABLES, projections.SIGNS))
        sides.append([np.concatenate([block[n] for block in blocks]) for n in (1, 2)])
    (cells_a, at_a), (cells_b, at_b) = sides
    window = projections.REACH * np.sqrt((2 - 2 * 0.98) / dim)
    hits = ((cells_a == cells_b) & (np.abs(at_a - at_b) <= window)).sum(1)
    assert (hits >= projections.count_needed()).mean() > 0.97


def test_windows_across_batches():
    """Sorted rows cut anywhere give the same pairs as all at once."""
    import pyarrow as pa

    dice = np.random.default_rng(6)
    cell = np.sort(dice.integers(0, 4, 300)) * 32
    low = dice.uniform(-1, 1, 300)
    order = np.lexsort((low, cell))
    cell, low = cell[order], low[order]
    item = dice.integers(0, 120, 300)
    high = low + dice.uniform(0, 0.1, 300)
    whole = pa.RecordBatch.from_arrays([pa.array(x) for x in (cell, item, low, high)], names=["cell", "item", "low", "high"])
    wanted = {
        (min(item[i], item[j]), max(item[i], item[j]))
        for i in range(300) for j in range(i)
        if cell[i] == cell[j] and item[i] != item[j] and low[i] <= high[j] and low[j] <= high[i]
    }
    for size in (300, 7, 1):
        parts = [whole.slice(n, size) for n in range(0, 300, size)]
        found = {(r["a"], r["b"]) for batch in projections._collided(iter(parts)) for r in batch.to_pylist()}
        assert found == wanted


def mined_by_hand(rows, every):
    ok = []
    for row in rows:
        key, v, label = row[:3]
        if None not in (key, v, label) and all(x is not None and abs(x) < INF for x in v):
            ok.append((key, label, [int(np.floor(256 * x)) for x in v], v))
    anchors = {}
    for key, label, grid, v in ok:
        if key % every == 0:
            anchors[key] = min(anchors.get(key, (label, v, grid)), (label, v, grid))
    out = []
    for anchor, (label, _, grid) in anchors.items():
        scored = [
            (-sum(x * y for x, y in zip(grid, g, strict=True)), key, l)
            for key, l, g, _ in ok if len(g) == len(grid) and key != anchor
        ]
        scored.sort()
        for s, positive, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(anchor, positive, n + 1, key, -s, -t) for n, (t, key, _) in enumerate(fits)]
    return out


@pytest.mark.parametrize("leaf", [2048, 12])
def test_negatives(spark, monkeypatch, leaf):
    """Also with many small leaves, blocks and chunks, and few split points."""
    rows = vectors(7, crowds=(60, 40))
    if leaf < 2048:
        for name, value in (("LEAF", leaf), ("WAYS", 3), ("BLOCK", 9), ("CHUNK", 5), ("SAMPLE", 90)):
            monkeypatch.setattr(gnat, name, value)
    found = gnat.mined(spark.createDataFrame(rows, KIND), lambda key: key % 5 == 0).collect()
    assert by_text(found) == by_text(mined_by_hand(rows, 5))
    assert found


def test_negatives_of_odd_rows(spark):
    rows = [(*row, 0, "x", 0.5, 1) for row in ODD]
    found = gnat.mined(spark.createDataFrame(rows, KIND), lambda key: key % 100 == 0).collect()
    assert by_text(found) == by_text(mined_by_hand(rows, 100))


def test_scores_that_doubles_round(spark):
    big = [(n, [float(2**22 + n), float(n % 3)], n % 2, 0, "x", 0.5, 1) for n in range(40)]
    kind = KIND.replace("array<float>", "array<double>")
    found = gnat.mined(spark.createDataFrame(big, kind), lambda key: key % 20 == 0).collect()
    assert by_text(found) == by_text(mined_by_hand(big, 20))


def test_siblings_are_left_out():
    """Well separated crowds: an anchor reaches its own, not all."""
    dice = np.random.default_rng(8)
    middles = dice.standard_normal((8, 16)) * 300
    values = np.floor(np.concatenate([m + dice.standard_normal((300, 16)) for m in middles]))
    length = np.sqrt((values**2).sum(1).max())
    tree = gnat.Tree(values[::5], 8 * 2048, length)
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [-low for low in tree.low]
    leaf, steps = tree.placed(values)
    for node, _, child, apart in steps:
        for way in np.unique(child):
            tree.low[node][:, way] = apart[child == way].min(0)
            tree.high[node][:, way] = apart[child == way].max(0)
    inner = np.zeros(len(values))
    own = values @ values.T
    outer = np.sqrt(np.maximum((values**2).sum(1) + length**2 - 2 * np.sort(own, 1)[:, -6], 0))
    seen = tree.reached(values, inner, outer)
    assert seen[np.arange(len(values)), leaf].all()
    assert seen.mean() < 0.5


@pytest.mark.parametrize("operator", [projections.linked, lambda rows: gnat.mined(rows, lambda key: key % 5 == 0)])
def test_no_rows(spark, operator):
    assert operator(spark.createDataFrame([], KIND)).count() == 0
