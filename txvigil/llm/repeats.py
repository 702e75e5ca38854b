"""Exact substring dedup over all documents, by suffix order.

Every string of ``LENGTH`` bytes has an anchor that depends on it alone: the least of the
hashes of its short runs. Only what lies around anchors that two documents share can repeat,
and equal strings lie around equal anchors, so the bytes around shared anchors are dealt out
by anchor: a shard then holds all places where its strings occur. Each shard is put in
suffix order by external induced sorting (``suffixes``), where equal strings are neighbours,
and every string is compared with the earliest document that has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from txvigil.llm.common import beside, stored
from txvigil.llm.suffixes import repeated_places

LENGTH = 50
GRAM = 16
# Bytes of a shard that are sorted at once; a single anchor may have more.
SHARD = 8 << 20
_NULL = -(1 << 63)
_ANCHOR_SHIFT = np.uint64(24)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _gram_hashes(raw: bytes, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes, a power of two, from every place on."""
    data = np.frombuffer(raw, np.uint8).astype(np.uint64)
    # Double up: runs of 2, 4, 8, ... bytes from runs of half the size.
    width, hashes = 1, data + np.uint64(1)
    while width < gram:
        hashes = hashes[:-width] * _ODD[width % 2] + (hashes[width:] ^ (hashes[width:] >> np.uint64(31)))
        hashes *= _ODD[1]
        hashes ^= hashes >> np.uint64(29)
        width *= 2
    return hashes


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(hashes, first starts, last starts): per anchor, the strings that have it.

    A string is given by where it starts. A run of starts with the same anchor is one entry,
    so the entries cover every string of the text once.
    """
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = _gram_hashes(raw, gram)
    least = hashes >> _ANCHOR_SHIFT
    window, width = length - gram + 1, 1
    while width < window:
        step = min(width, window - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    change = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    last = np.r_[change[1:], len(least)] - 1
    return least[change].astype(np.int64), change, last


def _spans(firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ranges; ranges that touch are one."""
    order = np.argsort(firsts, kind="stable")
    firsts, ends = firsts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, firsts[1:] > ends[:-1]]
    return firsts[new], ends[np.r_[np.flatnonzero(new)[1:] - 1, len(ends) - 1]]


def _runs(string: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(string, first, end) of the maximal runs that strings of ``length`` at these places cover."""
    if not len(starts):
        return string, starts, starts
    new = np.r_[True, (string[1:] != string[:-1]) | (starts[1:] > starts[:-1] + length)]
    return string[new], starts[new], starts[np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]] + length


def may_repeat(
    strings: list[bytes], anchor: np.ndarray, owners: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> np.ndarray:
    """Whether a string can share ``length`` bytes around its anchor with another owner's.

    What they share has the anchor's run of bytes at the same place, so at least half of the
    rest before it or half of it behind is shared as well. Only strings that agree in one of
    these halves are worth sorting; nothing that repeats is left out.
    """
    raw = np.frombuffer(b"".join(strings), np.uint8)
    half = (length - gram + 1) // 2
    if half < gram or len(raw) < gram:
        return np.ones(len(strings), bool)
    hashes = _gram_hashes(raw.tobytes(), gram)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    ends = np.cumsum(sizes)
    own = np.repeat(np.arange(len(strings)), sizes)[: len(hashes)]
    at = np.flatnonzero((hashes >> _ANCHOR_SHIFT).astype(np.int64) == anchor[own])
    own = own[at]
    at, own = at[at + gram <= ends[own]], own[at + gram <= ends[own]]
    before = at - half >= ends[own] - sizes[own]
    behind = at + gram + half <= ends[own]
    keys, kinds = [], []
    for side, (begin, fits) in enumerate(((at - half, before), (at + gram, behind))):
        begin = begin[fits]
        # Two runs that overlap cover the half.
        key = hashes[begin] * _ODD[0] + (hashes[begin + half - gram] ^ hashes[at[fits]]) * _ODD[1]
        keys.append((key & ~np.uint64(1)) | np.uint64(side))
        kinds.append(own[fits])
    key, kind = np.concatenate(keys), np.concatenate(kinds)
    kept = np.zeros(len(strings), bool)
    if len(key):
        order = np.argsort(key)
        key, kind = key[order], kind[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        held = owners[kind]
        several = np.minimum.reduceat(held, starts) != np.maximum.reduceat(held, starts)
        kept[kind[np.repeat(several, np.diff(np.r_[starts, len(key)]))]] = True
    return kept


def _marked(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, doc, row) of every different anchor of a text."""
    names = ["anchor", "doc", "row"]
    for part in parts:
        found: list[list] = [[], [], []]
        size = 0
        for doc, row, text in zip(*part.columns, strict=True):
            own = np.unique(anchors(text.as_py().encode())[0])
            columns = own, np.full(len(own), doc.as_py()), np.full(len(own), row.as_py())
            for column, values in zip(found, columns, strict=True):
                column.append(values)
            size += len(own)
            if size > 200_000:
                yield _joined(found, names)
                found, size = [[], [], []], 0
        if size:
            yield _joined(found, names)


def _shared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of anchors that occur in more than one document; sorted by (anchor, doc).

    A row is passed on as soon as its anchor is known to be shared, so a frequent anchor is
    never held.
    """
    held = [np.zeros(0, np.int64)] * 3  # rows of the last anchor while only one document has it
    passed = None  # the last anchor if it is known to be shared

    for part in parts:
        rows = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, part.columns, strict=True)]
        anchor, doc = rows[0], rows[1]
        if not len(anchor):
            continue
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.r_[starts, len(anchor)])
        several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
        if anchor[0] == passed:
            several[0] = True
        chosen = np.repeat(several, sizes)
        passed = anchor[-1] if several[-1] else None
        held = [c[:0] if several[-1] else c[starts[-1] :] for c in rows]
        if chosen.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[2][chosen]), pa.array(anchor[chosen])], names=["row", "anchor"]
            )


def _around(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, doc, row, start, context) of a text's shared anchors, and finished ranges.

    A context that this task has already seen in an earlier document repeats in full; its
    range (start, end) is final, without a context. Others are for the shards to decide.
    """
    seen: dict[bytes, int] = {}
    names = ["anchor", "doc", "row", "start", "end", "context"]
    for part in parts:
        found: list[list] = [[] for _ in names]
        size = 0
        for doc, row, text, wanted in zip(*(part.column(i) for i in range(4)), strict=True):
            doc, row, raw = doc.as_py(), row.as_py(), text.as_py().encode()
            own, firsts, lasts = anchors(raw)
            chosen = np.isin(own, wanted.values.to_numpy())
            for a, first, last in zip(
                own[chosen].tolist(), firsts[chosen].tolist(), (lasts[chosen] + LENGTH).tolist(), strict=True
            ):
                context = raw[first:last]
                known = seen.setdefault(context, doc)
                if known > doc:
                    seen[context] = doc
                values = a, doc, row, first, last, None if known < doc else context
                for column, value in zip(found, values, strict=True):
                    column.append(value)
                size += last - first
            if len(seen) > 200_000:
                seen.clear()
            if size > 4 << 20:
                yield _batch(found, names)
                found, size = [[] for _ in names], 0
        if found[0]:
            yield _batch(found, names)


def _joined(columns: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)


def _batch(columns: list[list], names: list[str]) -> pa.RecordBatch:
    arrays = [pa.array(c, pa.binary() if n == "context" else pa.int64()) for n, c in zip(names, columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _sorted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated ranges (row, start, end) of the contexts of a shard, sorted by anchor.

    Equal contexts are sorted once, for the earliest document that has them.
    """
    names = ["row", "start", "end"]
    held: list[tuple[pa.RecordBatch, int]] = []
    size, last_anchor = 0, None

    def solve(part: pa.Table) -> pa.RecordBatch | None:
        contexts = part.column("context").to_pylist()
        anchor, doc, row, start = (part.column(c).to_numpy() for c in ("anchor", "doc", "row", "start"))
        number: dict[bytes, int] = {}
        kind = np.array([number.setdefault(c, len(number)) for c in contexts], np.int64)
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, kind, doc)
        strings = list(number)
        of = np.empty(len(number), np.int64)
        of[kind] = anchor
        chosen = np.flatnonzero(may_repeat(strings, of, least))
        string, firsts, ends = np.zeros((3, 0), np.int64)
        if len(chosen):
            places = repeated_places([strings[k] for k in chosen.tolist()], least[chosen], LENGTH)
            string, firsts, ends = _runs(*places, LENGTH)
        runs = np.zeros(len(number) + 1, np.int64)
        np.add.at(runs, chosen[string] + 1, 1)
        begins = np.cumsum(runs)
        # Later documents lose the whole context, the earliest one what others hold of it.
        later = doc > least[kind]
        own = np.flatnonzero(~later)
        times = runs[kind[own] + 1]
        each = np.repeat(own, times)
        run = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begins[kind[own]], times)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        out = (
            np.r_[row[later], row[each]],
            np.r_[start[later], start[each] + firsts[run]],
            np.r_[start[later] + sizes[kind[later]], start[each] + ends[run]],
        )
        return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names) if len(out[0]) else None

    for part in parts:
        if not part.num_rows:
            continue
        column = part.column("anchor").to_numpy()
        lengths = pc.binary_length(part.column("context")).to_numpy()
        new = np.flatnonzero(np.r_[column[0] != last_anchor, column[1:] != column[:-1]])
        last_anchor, begin = column[-1], 0
        for at in new:
            if size + int(lengths[begin:at].sum()) >= SHARD and (held or at > begin):
                held.append(part.slice(begin, at - begin))
                if (done := solve(pa.Table.from_batches(held))) is not None:
                    yield done
                held, size, begin = [], 0, at
        held.append(part.slice(begin))
        size += int(lengths[begin:].sum())
    if held and (done := solve(pa.Table.from_batches(held))) is not None:
        yield done


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, spans): the maximal removed runs of each text; sorted by row."""
    row, held = None, []

    def ended() -> tuple[int, bytes]:
        firsts, ends = (np.concatenate(c) for c in zip(*held, strict=True))
        return row, np.stack(_spans(firsts, ends), 1).astype("<i8").tobytes()

    for part in parts:
        if not part.num_rows:
            continue
        out: list[tuple] = []
        rows, firsts, ends = (c.to_numpy() for c in part.columns)
        bounds = np.r_[np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]), len(rows)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if rows[a] != row:
                if held:
                    out.append(ended())
                row, held = int(rows[a]), []
            held.append((firsts[a:b], ends[a:b]))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out]), pa.array([o[1] for o in out], pa.binary())], names=["row", "spans"]
            )
    if held:
        last = ended()
        yield pa.RecordBatch.from_arrays([pa.array([last[0]]), pa.array([last[1]], pa.binary())], names=["row", "spans"])


def removed_spans(docs: DataFrame) -> DataFrame:
    """(row, spans) of the texts that lose bytes, from (doc, row, text) of all texts.

    ``row`` tells rows with the same document id apart. Ranges are pairs of 64-bit numbers.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long_enough = docs.filter(F.octet_length("text") >= LENGTH)
    # Copies of a whole text lose everything; only the first ones are looked into.
    equal = [F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g")]
    copied = long_enough.groupBy(*equal).agg(F.min("doc").alias("_first"), F.count("*").alias("_n"))
    copied = stored(copied.filter("_n > 1").drop("_n"))
    hashed = long_enough.select("*", *equal).join(beside(copied), ["h", "g"], "left")
    copy = F.col("doc") > F.coalesce("_first", F.col("doc"))
    first = hashed.filter(~copy).select("doc", "row", "text")
    whole = hashed.filter(copy).select(
        "row", F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end")
    )

    marks = first.mapInArrow(_marked, "anchor long, doc long, row long")
    marks = marks.repartition(partitions, "anchor").sortWithinPartitions("anchor", "doc")
    shared = stored(marks.mapInArrow(_shared, "row long, anchor long"), free=True)
    wanted = shared.groupBy("row").agg(F.collect_list("anchor").alias("wanted"))
    around = first.join(wanted, "row").select("doc", "row", "text", "wanted")
    around = stored(
        around.mapInArrow(
            _around, "anchor long, doc long, row long, start long, end long, context binary"
        ),
        free=True,
    )
    dealt = around.filter("context IS NOT NULL").select("anchor", "doc", "row", "start", "context")
    dealt = dealt.repartition(partitions, "anchor").sortWithinPartitions("anchor")
    found = dealt.mapInArrow(_sorted, "row long, start long, end long")
    found = found.union(around.filter("context IS NULL").select("row", "start", "end")).union(whole)
    found = found.repartition(partitions, "row").sortWithinPartitions("row")
    return stored(found.mapInArrow(_merged, "row long, spans binary"), free=True)


def deduped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every row.

    A null text is empty, a null id smaller than any other. Rows that share an id are
    compared with smaller ids only. What is kept may no longer be UTF-8, so it is binary.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL))
    own = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), key.alias("doc"), F.xxhash64(key, own).alias("row"), own.alias("text"))
    spans = removed_spans(rows.select("doc", "row", "text"))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[list] = [[] for _ in range(5)]
            for value, found in zip(part.column("text"), part.column("spans"), strict=True):
                raw, left, at = value.as_py().encode(), [], 0
                ranges = np.frombuffer(found.as_py() or b"", "<i8").reshape(-1, 2).tolist()
                for first, end in ranges:
                    left.append(raw[at:first])
                    at = end
                left.append(raw[at:])
                kept = b"".join(left)
                values = len(raw), len(raw) - len(kept), len(ranges), kept, sha256(kept).hexdigest()
                for column, v in zip(out, values, strict=True):
                    column.append(v)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    joined = rows.join(beside(spans), "row", "left").select("doc_id", "text", "spans")
    kind = dict(docs.dtypes)[doc_id]
    return joined.mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    )
