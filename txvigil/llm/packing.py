"""Cost-balanced packing of documents into sequences.

A document is tokenised and closed by an end id; its ids are cut into pieces of at most one
sequence. A task packs its own rows in blocks of bounded size: as many sequences as the
block fills exactly, the last ones at powers of two, so that nothing is padded. Pieces go in
descending order of estimated cost to the sequence with the lowest cost so far that has
room; a piece that no sequence has room for is cut where the cheapest one is full.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

LENGTH = 2048
END = 1
BLOCK = 1 << 20
# Cost of a piece: length, plus length squared over this (attention within the piece).
QUADRATIC = 4096
_MARK, _MARK_ID = "<|endoftext|>", 50256

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)


@lru_cache(maxsize=1)
def encoder(path: str | None = None):
    """The byte-level vocabulary, in the form of ranks (same ids as its tokenizers file)."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    return tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def token_ids(text: str | None, path: str | None = None) -> np.ndarray:
    """Ids of the text and the end id. The vocabulary's own end mark in a text is one id."""
    encode = encoder(path).encode_ordinary
    ids: list[int] = []
    for number, part in enumerate((text or "").split(_MARK)):
        if number:
            ids.append(_MARK_ID)
        ids += encode(part)
    ids.append(END)
    return np.array(ids, np.uint32)


def capacities(tokens: int, length: int = LENGTH) -> list[int]:
    """Sequence lengths that add up to ``tokens``: full ones, then powers of two."""
    rest = tokens % length
    return [length] * (tokens // length) + [
        1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1
    ]


def pack(lengths: list[int], length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of the block."""
    room = np.array(capacities(sum(lengths), length), np.int64)
    size, cost = room.copy(), np.zeros(len(room))
    taken = 0
    pieces = []
    for document, n in enumerate(lengths):
        for start in range(0, n - n % length, length):  # a whole sequence, the highest cost
            room[taken], cost[taken] = 0, np.inf
            yield document, start, length, taken, 0
            taken += 1
        if n % length:
            pieces.append((n % length, document, n - n % length))
    # Descending by length, which is descending by cost.
    pieces.sort(key=lambda p: (-p[0], p[1]))
    for n, document, start in pieces:
        while n:
            fits = np.flatnonzero(room >= n)
            if len(fits):
                at, put = int(fits[np.argmin(cost[fits])]), n
            else:
                # None has room: fill the one with the most, cheapest first among equals.
                most = np.flatnonzero(room == room.max())
                at = int(most[np.argmin(cost[most])])
                put = int(room[at])
            yield document, start, put, at, int(size[at] - room[at])
            room[at] -= put
            cost[at] += put + put * put / QUADRATIC
            start, n = start + put, n - put


def packed(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = None
) -> DataFrame:
    """Pieces of all documents, one row each, in ``PIECES``; no shuffle.

    A null or empty text is a document of its end id alone. Rows are packed one by one, so
    repeated documents are all kept. ``sequence_id`` joins the task's partition number and
    a running number. A table without rows has no sequences.
    """

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, used = TaskContext.get().partitionId() << 40, 0
        block: list[tuple] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal used
            rows, last = [], -1
            for document, start, n, sequence, offset in pack([len(ids) for _, ids in block]):
                key, ids = block[document]
                crc = zlib.crc32(ids[start : start + n].astype("<u4").tobytes())
                rows.append((key, start, n, crc, len(ids), base + used + sequence, offset))
                last = max(last, sequence)
            used += last + 1
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=[f.split()[0] for f in PIECES.split(", ")],
            )

        for part in parts:
            for key, value in zip(part.column(0), part.column(1), strict=True):
                ids = token_ids(value.as_py(), path)
                block.append((key.as_py(), ids))
                tokens += len(ids)
                if tokens >= BLOCK:
                    yield flush()
                    block, tokens = [], 0
        if block:
            yield flush()

    return docs.select(doc_id, text).mapInArrow(work, PIECES)
