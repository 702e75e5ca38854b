"""Exact n-gram Jaccard join by partitioning the universe.

The shingles of a document are hashed into segments. Two similar documents differ in at
most H shingles, so with enough segments some segment differs in none, or in one at most.
Documents are compared only if they agree in such a segment:

- sizes fall into bands, each with its own H and its own number of segments; a document is
  indexed in its own band and looks into the band below as well;
- an ``exact`` segment is indexed as it is; a segment with a one-deletion neighbourhood is
  also indexed without each of its shingles and then covers one difference more. How many
  there are of either kind is chosen per band for the least expected number of rows;
- every band has spare segments, so a document may leave out the segments that tell nothing
  or cost most: empty ones, and those that more than ``BUCKET`` documents share. A pair is
  found if both have left out no more than they can spare. Documents that would have to
  leave out more keep these segments, and so do all others that share one with them.

In the large segments that are left all documents are compared with a central one, then
only those that this has not put into one group, and only if short bit masks do not already
tell them apart. What agrees is verified on the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from txvigil.llm.common import beside, components, stored

WORDS = 4
THRESHOLD = 85
# Segments of up to this many documents are compared in full.
BUCKET = 8
MASK = 1024

# Odd numbers with well spread bits.
_ODD = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)
_DELETED, _OWN, _WIDE = 1, 2, 4
# Flags of a row that is a document, not a segment of one.
_DOCUMENT = -(1 << 31)
# Bits of a key that are left out: what agrees by chance is verified like anything else.
_SHORTER = np.uint64(16)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[2]
    h = (h ^ (h >> np.uint64(29))) * _ODD[3]
    return h ^ (h >> np.uint64(32))


class Shingles:
    """Distinct shingles of texts as sorted 64-bit hashes; remembers the hashes of words."""

    def __init__(self, words: int = WORDS, remember: int = 200_000):
        self.words, self.remember = words, remember
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        """None without a word; the whole sequence as one with fewer words than a shingle."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > self.remember:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.array([known[w] for w in words], np.uint64)
        size = min(self.words, len(words))
        joined = np.full(len(words) - size + 1, len(words) if size < self.words else 0, np.uint64)
        for i in range(size):
            # Hashed together with its place, so the order of the words counts.
            place = np.uint64(int(_ODD[1]) * (i + 1) & (1 << 64) - 1)
            joined += _mix(hashes[i : i + len(joined)] ^ place)
        return np.unique(_mix(joined))


@lru_cache(maxsize=None)
def band_starts(threshold: int = THRESHOLD, most: int = 1 << 40) -> np.ndarray:
    """Smallest size of each band: similar sets are in the same or in neighbouring bands."""
    starts = [1]
    while starts[-1] < most:
        starts.append(starts[-1] * 100 // threshold + 1)
    return np.array(starts, np.int64)


@lru_cache(maxsize=None)
def allocation(band: int, threshold: int = THRESHOLD) -> tuple[int, int, int]:
    """(segments, those with one-deletion neighbourhoods, spare cover) of a band.

    The cover of an exact segment is one difference, of the other kind two; it has to be
    H + 1 and something to spare for what documents of the band typically leave out.
    """
    starts = band_starts(threshold)
    least, most = int(starts[band]), int(starts[band + 1]) - 1
    differ = (most + most * 100 // threshold) * (100 - threshold) // (100 + threshold)
    # The least that covers H; what small sets leave out beyond it is found all the same.
    options = [(differ + 1, 0)] if differ == 0 else [(differ // 2 + 1, differ // 2 + 1)]
    for part in (0.0, 0.25, 0.5, 1.0):
        m = 1
        while m <= least:
            wide = round(m * part)
            lost = exp(-least / m) * ((m - wide) + wide * (2 + least / m))
            if m + wide - differ - 1 >= int(lost + 3 * sqrt(lost)):
                options.append((m, wide))
                break
            m += max(1, m // 64)

    def cost(option: tuple[int, int]) -> float:
        m, wide = option
        # A segment of few shingles is shared by chance: it costs like several rows.
        return (m - wide) * (1 + 4 * exp(-least / m / 2)) + wide * (1 + least / m)

    m, wide = min(options, key=cost)
    return m, wide, m + wide - differ - 1


def signatures(shingles: np.ndarray, threshold: int = THRESHOLD) -> Iterator[tuple]:
    """(keys, flags, spare) in the document's own band and in the one below."""
    n = len(shingles)
    band = int(np.searchsorted(band_starts(threshold), n, "right")) - 1
    mixed = _mix(shingles + _ODD[0])
    for own, at in ((True, band), (False, band - 1)):
        if at < 0:
            continue
        m, wide, spare = allocation(at, threshold)
        segment = (shingles >> np.uint64(7)) % np.uint64(m)
        place = segment.astype(np.int64)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, place, mixed)
        count = np.bincount(place, minlength=m)
        wides = np.arange(m) < wide
        spare -= int((count == 0).sum() + ((count < 2) & wides).sum())
        label = np.uint64(at + 1) << np.uint64(32)
        keep = np.flatnonzero(count > 0) if spare >= 0 else np.arange(m)
        keys = [_mix(sums[keep] + _ODD[1] * (keep.astype(np.uint64) + label))]
        flags = [np.where(wides[keep], _WIDE, 0) | (_OWN if own else 0)]
        if wide:
            drop = np.flatnonzero((place < wide) & ((count[place] > 1) | (spare < 0)))
            rest = sums[place[drop]] - mixed[drop]
            keys.append(_mix(rest + _ODD[1] * (segment[drop] + label)))
            flags.append(np.full(len(drop), _DELETED | _WIDE | (_OWN if own else 0)))
        yield np.concatenate(keys), np.concatenate(flags), spare


_SIGNED = "key long, node long, n int, flags int, doc_id long"


def signed(docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """The index: one row per segment (or deletion) of every different set of shingles.

    Copies within a task are indexed once. ``flags`` also hold what the set can spare. Every
    document (doc_id, text) is a row too, under a key of no meaning, so that it is read once.
    """

    kinds = {"key": np.int64, "node": np.int64, "n": np.int32, "flags": np.int32}

    def batch(columns: list[list], doc_ids: pa.Array | None = None) -> pa.RecordBatch:
        joined = [np.concatenate(c) for c in zip(*columns, strict=True)]
        joined[0] = joined[0] >> _SHORTER
        arrays = [pa.array(a.astype(k)) for a, k in zip(joined, kinds.values(), strict=True)]
        arrays.append(pa.nulls(len(joined[0]), pa.int64()) if doc_ids is None else doc_ids)
        return pa.RecordBatch.from_arrays(arrays, names=[*kinds, "doc_id"])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(words), set()
        before = 0
        for part in parts:
            rows: list[list] = []
            nodes, sizes = [], []
            size = 0
            for text in part.column(1):
                found = shingles.of(text.as_py())
                node = node_id(found)
                nodes.append(node)
                sizes.append(len(found))
                if not len(found) or node in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(node)
                for keys, flags, spare in signatures(found, threshold):
                    n = len(keys)
                    flags = flags + 8 * max(spare, -1)
                    rows.append([keys, np.full(n, node), np.full(n, len(found)), flags])
                    size += n
                if size > 200_000:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)
            if nodes:
                own = np.array(nodes, np.int64)
                places = np.arange(before, before + len(own)).astype(np.uint64)
                keys = _mix(own.view(np.uint64) + places * _ODD[1])
                before += len(own)
                yield batch([[keys, own, np.array(sizes), np.full(len(own), _DOCUMENT)]], part.column(0))

    return docs.select("doc_id", "text").mapInArrow(work, _SIGNED)


def node_id(shingles: np.ndarray) -> int:
    """Identity of a set, the same for all its copies."""
    return int(_mix(np.array([_mix(shingles).sum() + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def _pairs(rows: np.ndarray, threshold: int) -> np.ndarray:
    """Pairs of nodes within buckets of equal size; rows are (bucket, member) records."""
    first, second = np.triu_indices(rows.shape[1], 1)
    a, b = rows[:, first].ravel(), rows[:, second].ravel()
    fine = (a["node"] != b["node"]) & ((a["flags"] | b["flags"]) & _OWN > 0)
    fine &= (a["flags"] & b["flags"] & _DELETED) == 0
    fine &= 100 * np.minimum(a["n"], b["n"]) >= threshold * np.maximum(a["n"], b["n"])
    a, b = a["node"][fine], b["node"][fine]
    return np.stack([np.minimum(a, b), np.maximum(a, b)], 1)


def buckets(index: DataFrame, threshold: int, bucket: int = BUCKET) -> DataFrame:
    """(a, b) of every pair in a small bucket, and the rows of large ones (key not null).

    A document (n not null, but no key) is passed on, its id as a and its node as b. Keys arrive sorted; no more than a small bucket is held back at a time.
    """
    kind = np.dtype([("key", "i8"), ("node", "i8"), ("n", "i4"), ("flags", "i4")])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, kind)
        hot = None  # the large bucket whose rows are passed on

        def split(rows: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, hot
            starts = np.flatnonzero(np.r_[True, rows["key"][1:] != rows["key"][:-1]])
            sizes = np.diff(np.r_[starts, len(rows)])
            if not last and sizes[-1] <= bucket and rows["key"][-1] != hot:
                held = rows[starts[-1] :]
                starts, sizes = starts[:-1], sizes[:-1]
            else:
                held = rows[:0]
            large = (sizes > bucket) | (rows["key"][starts] == hot)
            pairs = [np.zeros((0, 2), np.int64)]
            for size in range(2, bucket + 1):
                of = starts[(sizes == size) & ~large]
                if len(of):
                    pairs.append(_pairs(rows[of[:, None] + np.arange(size)], threshold))
            found = np.unique(np.concatenate(pairs), axis=0)
            passed = rows[: int(starts[-1] + sizes[-1]) if len(starts) else 0][np.repeat(large, sizes)]
            if len(rows) and not len(held):
                hot = rows["key"][-1] if large[-1] else None
            nulls = lambda n, t: pa.nulls(n, t)
            if len(found):
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[:, 0]), pa.array(found[:, 1]), nulls(n, pa.int64()), nulls(n, pa.int32()), nulls(n, pa.int32())],
                    names=names,
                )
            if len(passed):
                n = len(passed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(passed["node"])), nulls(n, pa.int64())]
                    + [pa.array(np.ascontiguousarray(passed[c])) for c in ("key", "n", "flags")],
                    names=names,
                )

        names = ["a", "b", "key", "n", "flags"]
        for part in parts:
            rows = np.empty(part.num_rows, kind)
            for i, name in enumerate(kind.names):
                rows[name] = part.column(i).to_numpy()
            document = rows["flags"] == _DOCUMENT
            if document.any():
                passed = part.take(pa.array(np.flatnonzero(document)))
                n = passed.num_rows
                nothing = pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [passed.column(4), passed.column(1), nothing[0], passed.column(2), nothing[1]], names=names
                )
            rows = np.concatenate([held, rows[~document]])
            if len(rows):
                yield from split(rows, False)
        if len(held):
            yield from split(held, True)

    spark = index.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = index.repartition(partitions, "key").sortWithinPartitions("key")
    return ordered.mapInArrow(work, "a long, b long, key long, n int, flags int")


def verified(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, threshold: int
) -> DataFrame:
    """Pairs of nodes (a, b) whose documents really are similar.

    Only texts of documents in a pair are read out and moved; a document is represented by
    the first of its copies.
    """
    named = nodes.select("node", "doc_id")
    used = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    used = stored(named.join(beside(stored(used)), "node", "left_semi"))
    texts = docs.select("doc_id", "text").join(beside(used), "doc_id").select("node", "text")

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        recent: dict[int, np.ndarray] = {}

        def of(node: int, text: str) -> np.ndarray | None:
            if node not in recent:
                found = shingles.of(text)
                if node_id(found) != node:
                    return None  # another text under a repeated id
                if len(recent) >= 64:
                    del recent[next(iter(recent))]
                recent[node] = found
            return recent[node]

        for part in parts:
            a, b = (part.column(i).to_pylist() for i in (0, 1))
            fine = []
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                p, q = of(x, part.column(2)[i].as_py()), of(y, part.column(3)[i].as_py())
                if p is None or q is None:
                    fine.append(False)
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                fine.append(100 * both >= threshold * (len(p) + len(q) - both))
            chosen = pa.array(np.flatnonzero(fine))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(chosen), part.column(1).take(chosen)], names=["a", "b"]
            )

    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(texts.toDF(side, f"{side}_text"), side)
    return stored(sides.select("a", "b", "a_text", "b_text").mapInArrow(work, "a long, b long"))


def masks(nodes: DataFrame, used: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(node, mask): which of ``MASK`` bits an odd number of the shingles of a set falls on.

    Two sets differ in at least as many shingles as their masks differ in bits.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for part in parts:
            rows: list[np.ndarray] = []
            for text in part.column(1):
                found = shingles.of(text.as_py())
                odd = np.bincount((found % np.uint64(MASK)).astype(np.int64), minlength=MASK) % 2
                rows.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(rows, kind)], names=["node", "mask"]
            )

    named = stored(nodes.select("node", "doc_id").join(beside(used), "node", "left_semi"))
    texts = docs.select("doc_id", "text").join(beside(named), "doc_id").select("node", "text")
    found = texts.mapInArrow(work, "node long, mask array<bigint>")
    return stored(found.groupBy("node").agg(F.first("mask").alias("mask")))


def near(a: str, b: str, threshold: int):
    """What can be said of two members of a segment before their texts are read."""
    fewer, more = F.least(f"{a}n", f"{b}n"), F.greatest(f"{a}n", f"{b}n")
    either = F.col(f"{a}flags").bitwiseOR(F.col(f"{b}flags")).bitwiseAND(F.lit(_OWN)) > 0
    both = F.col(f"{a}flags").bitwiseAND(F.col(f"{b}flags")).bitwiseAND(F.lit(_DELETED)) == 0
    differ = F.lit(0)
    for i in range(MASK // 64):
        differ = differ + F.bit_count(F.col(f"{a}mask")[i].bitwiseXOR(F.col(f"{b}mask")[i]))
    most = (100 - threshold) * (F.col(f"{a}n") + F.col(f"{b}n"))
    return (100 * fewer >= threshold * more) & either & both & ((100 + threshold) * differ <= most)


def links(
    docs: DataFrame, words: int, threshold: int, bucket: int = BUCKET
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b) between different sets that connect all that are similar.

    Within a group not every link is listed, but none that joins two groups is missing. Also
    every document as (doc_id, n_shingles, node) and every node as (node, doc_id).
    """
    found = stored(buckets(signed(docs, words, threshold), threshold, bucket), free=True)
    sized = found.filter("key IS NULL AND n IS NOT NULL").select(
        F.col("a").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("b")).alias("node")
    )
    nodes = stored(sized.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    pairs = stored(found.filter("key IS NULL AND n IS NULL").select("a", "b").distinct())
    large = found.filter("key IS NOT NULL").select("key", F.col("a").alias("node"), "n", "flags")
    large = large.distinct()

    # Documents that can do without their large segments are found in the small ones.
    spare = F.shiftright("flags", 3)
    own = F.col("flags").bitwiseAND(F.lit(_OWN)).alias("own")
    units = F.when(F.col("flags").bitwiseAND(F.lit(_DELETED)) > 0, 0).otherwise(
        F.when(F.col("flags").bitwiseAND(F.lit(_WIDE)) > 0, 2).otherwise(1)
    )
    needs = large.groupBy("node", own).agg(F.sum(units).alias("units"), F.max(spare).alias("spare"))
    needs = needs.filter("units > spare").select("node", "own", F.lit(True).alias("hard"))
    # A deletion is no loss of its own, so two that can do without are found, but not one of
    # them by another that cannot: these are compared with all members of their segments.
    marked = large.withColumn("own", own).join(beside(stored(needs)), ["node", "own"], "left")
    marked = stored(marked.drop("own").withColumn("hard", F.coalesce("hard", F.lit(False))))
    keys = stored(marked.filter("hard").select("key").distinct())
    hard = stored(marked.join(beside(keys), "key", "left_semi"))
    used = stored(hard.select("node").distinct())
    hard = stored(hard.join(masks(nodes, used, docs, words), "node"))
    fields = ("node", "n", "flags", "mask", "hard")

    # The hub of a segment is its member whose segments are shared most: the least edited.
    counts = hard.groupBy("key").agg(F.count("*").alias("members"))
    ranks = hard.select("key", "node").join(counts, "key")
    ranks = ranks.groupBy("node").agg(F.sum("members").alias("rank"))
    hubs = hard.join(ranks, "node").groupBy("key").agg(
        F.max_by(F.struct(*fields), F.struct("rank", "node")).alias("hub")
    )
    hubs = hubs.select("key", *[F.col(f"hub.{c}").alias(f"a_{c}") for c in fields])
    others = hard.select("key", *[F.col(c).alias(f"b_{c}") for c in fields])

    def between(rows: DataFrame) -> DataFrame:
        rows = rows.filter(near("a_", "b_", threshold))
        return rows.select(
            F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")
        ).distinct()

    star = between(others.join(hubs, "key").filter("a_node <> b_node"))
    pairs = stored(pairs.union(star).distinct())
    linked = verified(pairs, nodes, docs, words, threshold)

    # What is still apart within a large segment is compared, members of one group are not.
    groups = components(linked).toDF("node", "part")
    parted = hard.join(groups, "node", "left").withColumn("part", F.coalesce("part", "node"))
    mixed = parted.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y"))
    mixed = stored(mixed.filter("x <> y").select("key"))
    parted = stored(parted.join(beside(mixed), "key", "left_semi"))
    a, b = (
        parted.select("key", *[F.col(c).alias(f"{s}_{c}") for c in (*fields, "part")])
        for s in ("a", "b")
    )
    apart = "a_node < b_node AND a_part <> b_part AND (a_hard OR b_hard)"
    rest = between(a.join(b, "key").filter(apart))
    rest = stored(rest.join(pairs, ["a", "b"], "left_anti"))
    return stored(linked.union(verified(rest, nodes, docs, words, threshold))), sized, nodes


def grouped(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    The component is the smallest id that links lead to, the document's own included.
    Texts without a word (null, empty, white space) are linked with nothing, not even each
    other. Repeated ids are one document each, linked like copies. An empty table gives
    none.
    """

    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    linked, sized, nodes = links(docs, words, threshold)
    parts = components(linked).toDF("node", "part")
    smallest = (
        nodes.join(parts, "node", "left")
        .withColumn("part", F.coalesce("part", "node"))
    )
    lowest = smallest.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    ids = smallest.join(lowest, "part").select("node", "component_id")
    return sized.join(ids, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
