"""Quality rules, line dedup, Jaccard join, substring dedup and winnowing by brute force."""

import random
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from txvigil.llm import jaccard, lines, quality, repeats, winnowing
from txvigil.llm.common import beside, stored, stored_bytes
from txvigil.llm.suffixes import repeated_starts


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


# Quality rules


def test_measures():
    text = "a b c x a b c\nsame line\n\nsame line\n $ &"
    assert quality.measure(text) == (13, 25, 2, 1, 6)
    assert quality.measure(None) == quality.measure("") == (0, 0, 0, 0, 0)
    assert quality.repeated_words([b"a"] * 5) == 5


def test_hosts_are_shrunk(spark):
    rows = [("good", False)] * 95 + [("good", True)] * 5 + [("bad", True)] * 90 + [("bad", False)] * 10
    rows += [("small", True)] + [(None, False)] * 20
    docs = spark.createDataFrame(rows, "source string, base_failed boolean")
    rates = {r.host: r.rate for r in quality.host_rates(docs).collect()}
    assert rates["bad"] > 0.8 and rates["good"] < 0.1 and rates[None] < 0.2
    assert 0.5 < rates["small"] < 1
    kept = quality.with_verdicts(docs, quality.host_rates(docs)).groupBy("source", "kept").count()
    assert {tuple(r) for r in kept.collect()} == {
        ("good", True, 95), ("good", False, 5), ("bad", False, 100), ("small", False, 1), (None, True, 20),
    }


def test_quality_of_odd_rows(odd, none):
    judged = quality.measured(odd)
    judged = quality.with_verdicts(judged, quality.host_rates(judged))
    rows = judged.collect()
    assert len(rows) == odd.count()
    assert {r.n_words for r in rows if not (r.text or "").strip()} == {0}
    assert rows[0].node == "y" and rows[0].n == 1.5
    empty = quality.measured(none)
    assert quality.with_verdicts(empty, quality.host_rates(empty)).collect() == []


# Line dedup


def removed_lines(docs):
    places = sorted((d, i, frozenset(t.split())) for d, text in docs if text for i, t in enumerate(text.split("\n")))
    gone = set()
    for x, (d, i, own) in enumerate(places):
        for _, _, other in places[:x]:
            if own and other and 100 * len(own & other) >= 80 * len(own | other):
                gone.add((d, i))
                break
    return gone


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_brute_force(spark, seed):
    dice = random.Random(seed)
    vocabulary = [f"w{int(dice.paretovariate(0.7))}" for _ in range(200)]
    pool = [[dice.choice(vocabulary) for _ in range(dice.choice([1, 2, 4, 5, 6, 9, 15, 40]))] for _ in range(25)]
    docs = []
    for doc in range(60):
        text = []
        for _ in range(dice.randint(1, 5)):
            line = list(dice.choice(pool))
            for _ in range(dice.choice([0, 0, 1, 2])):
                line[dice.randrange(len(line))] = dice.choice(vocabulary)
            text.append(" ".join(line) if dice.random() < 0.95 else "  ")
        docs.append((doc, "\n".join(text)))
    found = lines.duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r.doc, i) for r in found.collect() for i in r.lines} == removed_lines(docs)


def test_lines_of_odd_rows(odd, none):
    rows = lines.deduped(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text == ""  # "... again", without id and so the first, has 17 of 18 words
    assert by_id[2].text is None and by_id[2].n_removed == 0
    assert by_id[4].text == " \n\t "
    assert by_id[9].text == "x y\n\nnext line" and by_id[9].n_removed == 1
    assert lines.deduped(none).collect() == []


def test_lines_beside_columns_of_any_name(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e\nx", 7, "k"), (2, "a b c d e\ny", 8, "l")], "doc_id long, text string, _doc int, _lines string"
    )
    found = {(r.doc_id, r.text, r._doc, r._lines) for r in lines.deduped(docs).collect()}
    assert found == {(1, "a b c d e\nx", 7, "k"), (2, "y", 8, "l")}


def test_line_dedup_keeps_no_table_of_lines(spark, monkeypatch):
    """Contents and signed lines are removed once nothing reads them; what comes after needs the disk."""
    made, original = [], lines.stored

    def stored_(rows, free=False):
        made.append(original(rows, free))
        return made[-1]

    monkeypatch.setattr(lines, "stored", stored_)
    found = lines.duplicates(texts(spark, "a b c d e f\nx y", "a b c d e f\nx z", "a b c d e g\nf b c d e a"))
    assert {r.doc for r in found.collect()} == {1, 2}
    left = [t for t in made if any(Path(urlparse(file).path).exists() for file in t.inputFiles())]
    assert not [t.columns for t in left if {"content", "bits", "a_line", "_places"} & set(t.columns)]


def test_levels_of_words(spark):
    docs = spark.createDataFrame([("a b a",), ("a c\na a a a",), (None,), ("",)], "text string")
    levels = lines.word_levels(docs, "text")
    numbers = docs.select(lines.by_rarity(F.col("text"), levels).alias("w")).collect()
    assert [[w >> 57 for w in r.w or ()] for r in numbers] == [[1, 3], [1, 3], [], []]


def test_crowd_around_a_line_that_is_not_the_first(spark):
    """Lines that share a rare word with an unlike earlier one still meet each other."""
    base = [f"c{i}" for i in range(20)]
    docs = [(0, " ".join(["rare", *(f"o{i}" for i in range(20))]))]
    for doc in range(1, 40):
        docs.append((doc, " ".join(["rare", *base[:doc % 20], *base[doc % 20 + 1:], f"u{doc}"])))
    found = lines.duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r.doc, i) for r in found.collect() for i in r.lines} == removed_lines(docs)


def test_light_words_make_few_rows_and_heavy_ones_are_still_compared(spark):
    """Sets of sizes far apart, with prefix words of few and of very many occurrences."""
    docs, dice = [], random.Random(5)
    frequent = [f"f{i}" for i in range(12)]
    for doc in range(150):
        own = [f"r{dice.randrange(60)}" for _ in range(dice.choice([0, 2, 9]))]
        docs.append((doc, " ".join([*frequent[: dice.choice([4, 5, 6, 9, 12])], *own])))
    found = lines.duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r.doc, i) for r in found.collect() for i in r.lines} == removed_lines(docs)


def test_pairs_by_light_words(spark):
    """One row a pair, the earlier line first, also where it is the larger set."""
    bits = 0
    rows = [(3 << 57, 1, 0, 0, 9, bits), (3 << 57, 2, 0, 0, 8, bits), (3 << 57, 3, 0, 1, 9, bits), (3 << 57, 4, 0, 0, 5, bits)]
    rows = spark.createDataFrame(rows, "word long, doc long, line int, at int, n int, bits long")
    found = {tuple(r) for r in lines.light_pairs(rows, 80).collect()}
    assert found == {(1, 0, 2, 0), (1, 0, 3, 0), (2, 0, 3, 0)}


def test_table_of_word_counts_is_in_no_plan(spark, monkeypatch):
    """Every description of a plan that holds it repeats its bytes on the driver."""
    sizes, original = [], lines.stored

    def stored_(rows, free=False):
        plan = rows._jdf.queryExecution()
        sizes.append(len(plan.optimizedPlan().toString()) + len(plan.executedPlan().toString()))
        return original(rows, free)

    monkeypatch.setattr(lines, "stored", stored_)
    lines.duplicates(texts(spark, "a b c d e f\nx y", "a b c d e g\nx y")).collect()
    assert max(sizes) < 100_000


# Jaccard join


def groups(sets, threshold):
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for d, a in sets.items():
        for e, b in sets.items():
            if d < e and a and b and 100 * len(a & b) >= threshold * len(a | b):
                x, y = sorted((root(d), root(e)))
                label[y] = x
    return {d: root(d) for d in sets}


def shingle_set(text, words):
    own = (text or "").encode().lower().split()
    if not own:
        return set()
    return {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))}


@pytest.mark.parametrize(("words", "threshold", "bucket"), [(4, 85, 8), (5, 80, 8), (4, 85, 2), (1, 85, 3)])
def test_jaccard_against_brute_force(spark, monkeypatch, words, threshold, bucket):
    dice = random.Random(words * bucket)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [dice.choice(vocabulary) for _ in range(30)]
    docs = []
    for _ in range(12):
        base = [dice.choice(vocabulary) for _ in range(dice.choice([3, 8, 20, 60, 150]))]
        for _ in range(dice.randint(1, 14)):
            copy = list(base)
            for _ in range(dice.randint(0, max(1, len(base) // 20))):
                copy[dice.randrange(len(copy))] = dice.choice(vocabulary)
            if dice.random() < 0.3:
                copy += passage
            docs.append(" ".join(copy))
    docs += [docs[0], docs[0].upper(), "one", "ONE", None, "", " "]
    frame = texts(spark, *docs)
    monkeypatch.setattr(jaccard.links, "__defaults__", (bucket,))
    found = jaccard.grouped(frame, words=words, threshold=threshold)
    sets = {i: shingle_set(t, words) for i, t in enumerate(docs)}
    assert {r.doc_id: r.component_id for r in found.collect()} == groups(sets, threshold)
    assert {r.doc_id: r.n_shingles for r in found.collect()} == {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("kind", [(1, 1, 0), (3, 3, 1), (6, 2, 0), (9, 0, 2)])
def test_deletion_neighbourhoods(kind):
    """Sets that differ by no more than their cover agree in a key, deletion or not."""
    m, wide, spare = kind
    dice = random.Random(m)
    differ = m + wide - spare - 1
    original = jaccard.allocation
    jaccard.allocation = lambda band, threshold: kind
    try:
        for _ in range(300):
            a = {dice.getrandbits(64) for _ in range(30)}
            drop = dice.randint(0, min(differ, 2))
            b = set(sorted(a)[drop:]) | {dice.getrandbits(64) for _ in range(differ - drop)}
            sizes = sorted(len(own) for own in (a, b))
            if 100 * sizes[0] < 85 * sizes[1]:
                continue
            # A set's signatures are those of its own and of the neighbouring band; any pair may agree.
            keys = [[], []]
            for of, own in zip(keys, (a, b), strict=True):
                for hashed, flags, _ in jaccard.signatures(np.array(sorted(own), np.uint64), 85):
                    of.append({k: f & 1 for k, f in zip(hashed.tolist(), flags.tolist(), strict=True)})
            shared = [
                k for one in keys[0] for two in keys[1] for k in one.keys() & two.keys() if not (one[k] and two[k])
            ]
            assert shared
    finally:
        jaccard.allocation = original


@pytest.mark.parametrize("size", [6, 15])
def test_jaccard_links_longer_variants_to_a_shared_base(spark, size):
    """Variants are like the base but not like each other, and fill its large segments."""
    dice = random.Random(size)
    docs = []
    for base in range(4):
        words = [f"b{base}w{i}" for i in range(size + 3)]
        docs += [" ".join(words), " ".join(words)]
        longer = [[f"x{dice.getrandbits(40)}" for _ in range(1 if size == 6 else 2)] for _ in range(40)]
        docs += [" ".join(words + more) for more in longer]
    found = jaccard.grouped(texts(spark, *docs))
    sets = {i: shingle_set(t, 4) for i, t in enumerate(docs)}
    assert {r.doc_id: r.component_id for r in found.collect()} == groups(sets, 85)


def test_documents_are_rows_of_the_jaccard_index(odd):
    """Texts are cut into shingles once for the index and for what is told of a document."""
    rows = jaccard.signed(odd, 4, 85).collect()
    documents = Counter((r.doc_id, r.n) for r in rows if r.flags == jaccard._DOCUMENT)
    expected = odd.select("doc_id", "text").collect()
    assert documents == Counter((r.doc_id, len(shingle_set(r.text, 4))) for r in expected)
    assert all(0 <= r.key < 1 << 48 for r in rows)


def test_jaccard_of_odd_rows(odd, none):
    rows = jaccard.grouped(odd).collect()
    assert len(rows) == odd.count()
    assert Counter((r.doc_id, r.component_id) for r in rows if r.doc_id in (1, 5)) == {(1, 1): 1, (5, 1): 2}
    assert {r.n_shingles for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert jaccard.grouped(none).collect() == []


# Substring dedup


def cut(docs, length=50):
    out, seen = {}, set()
    for doc in sorted({d for d, _ in docs}):
        new = set()
        for d, text in docs:
            if d == doc:
                raw = (text or "").encode()
                hit = bytearray(len(raw))
                for i in range(len(raw) - length + 1):
                    if raw[i : i + length] in seen:
                        hit[i : i + length] = b"\1" * length
                    new.add(raw[i : i + length])
                out.setdefault(doc, []).append(bytes(c for c, h in zip(raw, hit, strict=True) if not h))
        seen |= new
    return {d: sorted(v) for d, v in out.items()}


def test_substrings_against_brute_force(spark):
    dice = random.Random(3)
    pool = ["".join(dice.choice("abcdé \n") for _ in range(dice.randint(20, 160))) for _ in range(12)]
    docs = [(i // 2 * 2 if i % 7 == 0 else i, "".join(dice.choice(pool) for _ in range(dice.randint(0, 6)))) for i in range(60)]
    docs += [(70, "a" * 400), (71, "a" * 120), (72, "ab" * 90), (73, None), (74, "b" + "a" * 49)]
    rows = repeats.deduped(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(bytes(r.kept))
        assert r.n_bytes - r.n_removed == len(r.kept)
    assert {d: sorted(v) for d, v in found.items()} == cut(docs)


@pytest.mark.parametrize("memory", [0, 2_000, 1 << 26])
def test_suffix_order_spills(memory):
    dice = random.Random(memory)
    for _ in range(60):
        letters, length = dice.choice(["ab", "abc", "\0\xff", "abcdefgh"]), dice.choice([2, 3, 7, 12])
        strings = ["".join(dice.choice(letters) for _ in range(dice.randint(0, 50))).encode("latin-1") for _ in range(6)]
        owners = np.array([dice.randint(0, 3) for _ in strings])
        least = {}
        for s, o in zip(strings, owners, strict=True):
            for i in range(len(s) - length + 1):
                least[s[i : i + length]] = min(o, least.get(s[i : i + length], o))
        expected = [[i for i in range(len(s) - length + 1) if least[s[i : i + length]] < o] for s, o in zip(strings, owners, strict=True)]
        found = repeated_starts(strings, owners, length, memory)
        assert [f.tolist() for f in found] == expected


def test_strings_worth_sorting():
    """All that share fifty bytes with another owner's are sorted, and not simply everything."""
    dice, kept_of, all_of = random.Random(8), 0, 0
    pool = ["".join(dice.choice("abcdefgh ") for _ in range(dice.randint(16, 70))) for _ in range(40)]
    strings, found, owners = [], [], []
    for owner in range(120):
        raw = "".join(dice.choice(pool) for _ in range(6)).encode()
        raw += (b"ab" * 60, b"a" * 90, b"")[owner % 3]
        for anchor, first, last in zip(*repeats.anchors(raw), strict=True):
            strings.append(raw[first : last + repeats.LENGTH])
            found.append(anchor)
            owners.append(owner)
    kept = repeats.may_repeat(strings, np.array(found), np.array(owners))
    holders = {}
    for s, o in zip(strings, owners, strict=True):
        for i in range(len(s) - repeats.LENGTH + 1):
            holders.setdefault(s[i : i + repeats.LENGTH], set()).add(o)
    for s, worth in zip(strings, kept, strict=True):
        shared = any(len(holders[s[i : i + repeats.LENGTH]]) > 1 for i in range(len(s) - repeats.LENGTH + 1))
        assert worth or not shared
        kept_of, all_of = kept_of + worth, all_of + 1
    assert 0 < kept_of < all_of


def test_beside_bounds_rows_and_bytes(spark):
    rows = stored(spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v")))
    plans = [beside(rows), beside(rows, most=999), beside(rows, size=1000)]
    broadcast = ["broadcast" in r._jdf.queryExecution().analyzed().toString().lower() for r in plans]
    assert broadcast == [True, False, False]
    assert stored_bytes(rows.select("id")) <= stored_bytes(rows)


def test_substrings_of_odd_rows(odd, none):
    rows = repeats.deduped(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.doc_id, len(r.kept)) for r in rows if r.doc_id in (1, 5)} == {(1, 0), (5, 0)}
    assert {r.n_bytes for r in rows if r.doc_id in (2, 3)} == {0}
    assert repeats.deduped(none).collect() == []


# Winnowing


def test_winnowing_against_brute_force():
    dice = random.Random(4)
    for size in (0, 1, 15, 16, 17, 47, 48, 300):
        text = "".join(dice.choice("abä") for _ in range(size))
        hashes, places = winnowing.fingerprint(text)
        if not text:
            assert not len(hashes)
            continue
        grams = winnowing.gram_hashes(winnowing.code_points(text)).tolist()
        window = min(winnowing.WINDOW, len(grams))
        expected = set()
        for i in range(len(grams) - window + 1):
            part = grams[i : i + window]
            expected.add(i + max(j for j, h in enumerate(part) if h == min(part)))
        assert places.tolist() == sorted(expected)
        assert hashes.tolist() == [grams[p] for p in places]


def test_shared_runs_share_a_hash():
    dice = random.Random(5)
    run = "".join(dice.choice("abcdefgh ") for _ in range(winnowing.GUARANTEE))
    for _ in range(50):
        a, b = ("".join(dice.choice("ijkl") for _ in range(80)) for _ in range(2))
        x, y = (winnowing.fingerprint(t[:30] + run + t[30:])[0] for t in (a, b))
        assert winnowing.likeness(x, y) > 0
    assert winnowing.likeness(x, x) == 1


def test_next_rows(spark, odd, none):
    def name(row, following):
        return {"next": following["doc_id"]}

    docs = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "doc_id long").repartition(5)
    for partitions in (1, 4, 30):
        rows = winnowing.next_rows(docs, "doc_id", "next long", name, partitions).collect()
        assert {(r.doc_id, r.next) for r in rows} == {(i, (i + 1) % 101) for i in range(101)}
    ids = [r.next for r in winnowing.next_rows(odd, "doc_id", "next long", name, 3).collect()]
    assert Counter(ids) == Counter(r.doc_id for r in odd.collect())
    assert winnowing.next_rows(none, "doc_id", "next long", name, 3).collect() == []
    assert winnowing.fingerprints(none).collect() == []
    kept = winnowing.fingerprints(odd).filter(F.size("hashes") == 0).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {2, 3}
