"""The manifest against plain hashing."""

import random
from hashlib import sha256
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from txvigil.llm import manifest
from txvigil.llm.manifest import height, leaf_digest

KIND = "doc_id long, lang string, text string, place long, tree string, run int, claim string, leaf string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(*fields):
    return digest(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def levels(nodes):
    all_levels = [nodes]
    while len(all_levels[-1]) > 1:
        below = all_levels[-1]
        all_levels.append([digest(*below[n : n + 8]) for n in range(0, len(below), 8)])
    return all_levels


def folded(tree, slot, node):
    beside = []
    for below in tree[:-1]:
        start = slot - slot % 8
        run = below[start : start + 8]
        beside += run[: slot - start] + run[slot - start + 1 :]
        node = digest(*run[: slot - start], node, *run[slot - start + 1 :])
        slot //= 8
    return beside, node


def by_hand(rows):
    """Rows are (doc_id, lang, text)."""
    made = [(lang, doc, leaf_by_hand(doc, lang, text), leaf_by_hand(doc, lang, text and text.lower())) for doc, lang, text in rows]
    made.sort(key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, *r[2:]))
    trees = [(lang, list(own)) for lang, own in groupby(made, key=lambda r: r[0])]
    docs = {lang: levels([r[2] for r in own]) for lang, own in trees}
    top = levels([docs[lang][-1][0] for lang, _ in trees])
    for number, (lang, own) in enumerate(trees):
        for slot, (_, doc, leaf, claim) in enumerate(own):
            beside, node = folded(docs[lang], slot, claim)
            more, root = folded(top, number, node)
            yield doc, leaf, docs[lang][-1][0], top[-1][0], digest(*beside, *more), root, root == top[-1][0]


def made(spark, rows, levels=4):
    frame = spark.createDataFrame([(*row, 1, "t", 2, "c", "l") for row in rows], KIND)
    fields = [F.col("doc_id"), F.col("lang")]
    leaf, claim = (leaf_digest([*fields, text]) for text in (F.col("text"), F.lower("text")))
    return [tuple(r) for r in manifest.manifest(frame, "lang", "doc_id", leaf, claim, levels).collect()]


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_against_plain_hashing(spark, levels):
    """Trees of one, of a run, of several rounds; equal rows and ids, nulls, empty and long texts."""
    dice = random.Random(1)
    rows = [(n % 700, dice.choice("abc"), dice.choice(["X", "y", "", None, "é" * 999])) for n in range(900)]
    rows += [(n, "one" if n == 5 else None, "T") for n in range(65)] + [(None, "ä", "Z"), (None, None, None)] * 2
    rows += [(n, f"lang {n}", "w") for n in range(70)] + [(1, "", "W"), (1, "", "W")]
    assert sorted(made(spark, rows, levels), key=str) == sorted(by_hand(rows), key=str)


@pytest.mark.parametrize("rows", [[], [(1, "a", "X")], [(1, None, None)]])
def test_hardly_any_rows(spark, rows):
    assert made(spark, rows) == list(by_hand(rows))


def test_height():
    assert [height(n) for n in (0, 1, 2, 8, 9, 64, 65, 4096, 4097, 10**9)] == [0, 0, 1, 1, 2, 2, 3, 4, 4, 4]


def test_states_resume():
    """Any slot of a run with a last node of fewer children."""
    leaves = [f"{n:064x}".encode() for n in range(83)]
    run = manifest.Run(leaves, 3)
    for slot in (0, 7, 8, 79, 80, 82):
        changed = [*leaves[:slot], b"f" * 64, *leaves[slot + 1 :]]
        assert run.folded(slot, b"f" * 64) == manifest.Run(changed, 3).levels[-1][0]
