"""Document fingerprints by winnowing.

Rolling hashes of all runs of k characters; of every window of w neighbouring hashes the
smallest is chosen, the rightmost where several are. Two texts that share a run of at least
k + w - 1 characters share a chosen hash, at matching places of that run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from txvigil.llm.common import unused, with_columns

K = 16
WINDOW = 32
GUARANTEE = K + WINDOW - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def gram_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hashes of all runs of k code points; a shorter text is one run."""
    k = min(k, len(points))
    n = len(points) - k + 1
    # Horner's rule over k shifted views is the rolling hash without its sequential loop.
    total = np.zeros(n, np.uint64)
    wide = points.astype(np.uint64)
    for i in range(k):
        total *= _BASE
        total += wide[i : i + n] + np.uint64(1)
    total ^= total >> np.uint64(29)
    total *= _MIX
    return (total >> np.uint64(32)).astype(np.uint32)


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the chosen hashes, ascending; ties go to the right.

    Hash and place are joined into one number so that the smallest is also the rightmost,
    and the minimum of a window is that of two overlapping windows of half its size.
    """
    if not len(hashes):
        return np.zeros(0, np.int64)
    window = min(window, len(hashes))
    places = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << 32) - 1)
    least = (hashes.astype(np.uint64) << np.uint64(32)) | (low - places)
    width = 1
    while width < window:
        step = min(width, window - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return (low - np.unique(least & low))[::-1].astype(np.int64)


def fingerprint(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(chosen hashes, their places) in text order; none for a null or empty text."""
    if not text:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    hashes = gram_hashes(code_points(text), k)
    places = winnow(hashes, window)
    return hashes[places], places


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two fingerprints' distinct hashes (Jaccard); two empty ones are equal."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Adds ``hashes`` and ``places`` (arrays of long), a row at a time, without a shuffle."""
    def work(texts: pa.Array) -> list[pa.Array]:
        found = [fingerprint(t.as_py(), k, window) for t in texts]
        kind = pa.list_(pa.int64())
        return [
            pa.array([h.astype(np.int64) for h, _ in found], kind),
            pa.array([p for _, p in found], kind),
        ]

    return with_columns(docs, [text], "hashes array<bigint>, places array<bigint>", work)


def next_rows(
    docs: DataFrame,
    key: str,
    added: str,
    work: Callable[[dict, dict], dict],
    partitions: int,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Rows in ascending order of ``key``, each seen by ``work`` with the row after it.

    One shuffle by ranges of the key. The ranges start at keys that occur, and the row a
    range starts with is also sent to the range before (the first of all to the last), so
    every range knows what follows it. The cut points are one value per partition. A null key
    comes first; rows of the same key are in order of their columns. ``work`` returns the
    ``added`` columns (DDL); the columns in ``drop`` are left out of the result.
    """
    ids = docs.select(F.coalesce(F.col(key), F.lit(-(1 << 63))).alias("_key"))
    share = [i / partitions for i in range(partitions)]
    cuts = sorted({int(c) for c in ids.stat.approxQuantile("_key", share, 0.1 / partitions)})
    least = ids.agg(F.min("_key")).first()[0]
    if least is not None:
        cuts = sorted({least, *_present(ids, cuts)})
    bounds = np.array(cuts, np.int64)
    columns = docs.columns
    range_, guest_ = unused("_range", columns), unused("_guest", columns)

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index(key)
        for part in parts:
            if not part.num_rows:
                continue
            keys = part.column(at).cast(pa.int64()).fill_null(-(1 << 63)).to_numpy()
            own = np.searchsorted(bounds, keys, "right") - 1
            again = np.flatnonzero(bounds[own] == keys)
            rows = np.concatenate([np.arange(len(keys)), again])
            to = np.concatenate([own, (own[again] - 1) % len(bounds)])
            guest = np.arange(len(rows)) >= len(keys)
            taken = part.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int64()), pa.array(guest, pa.bool_()), *taken.columns],
                names=[range_, guest_, *columns],
            )

    def walk(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far
        place = None  # its range
        seen = False  # a guest row has ended the range
        for part in parts:
            out = []
            for row in part.to_pylist():
                here, guest = row.pop(range_), row.pop(guest_)
                if here != place:
                    held, place, seen = None, here, False
                if seen:
                    continue  # a second guest: the same key again
                if held is not None:
                    found = held | work(held, row)
                    out.append({c: found[c] for c in out_type.names})
                held, seen = row, guest
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    dealt = docs.mapInArrow(
        deal,
        T.StructType(
            [T.StructField(range_, T.LongType()), T.StructField(guest_, T.BooleanType())]
            + docs.schema.fields
        ),
    )
    ordered = dealt.repartition(partitions, range_).sortWithinPartitions(
        range_, guest_, F.col(key).asc_nulls_first(), *[c for c in columns if c != key]
    )
    kept = [f for f in docs.schema.fields if f.name not in drop]
    out_type = T.StructType([*kept, *T._parse_datatype_string(added).fields])
    schema = to_arrow_schema(out_type)
    return ordered.mapInArrow(walk, out_type)


def _present(ids: DataFrame, cuts: list[int]) -> list[int]:
    """Of the candidate cut points those that occur as keys; as many as partitions at most."""
    found = ids.filter(F.col("_key").isin(cuts)).distinct().collect() if cuts else []
    return [row[0] for row in found]
