"""Suffix order by external induced sorting.

Suffixes that start a rise after a fall (seeds) are sorted first, level by level: seeds that
the first symbols do not tell apart are sorted by the next ones. The order of all others
follows: one pass upwards induces the suffixes that are larger than the one after them, one
pass downwards the smaller ones. Induction is a monotone priority queue: what is scanned in
order pushes the suffix before it to the queue of that one's first symbol, where it arrives
in order again. The tuples in the queues are a suffix and the length of the prefix it shares
with the tuple before it, which is one more than the least such length among all that were
scanned between the two. Queues spill to disk beyond a budget of memory, and so do the
arrays over the text if it is large, so that a shard may be larger than memory.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from itertools import groupby

import numpy as np

# Symbols: 0 ends a string, byte b is b + 1.
SYMBOLS = 257
_PACK, _BITS = 7, 9
MEMORY = 64 << 20
CHUNK = 1 << 20


class Space:
    """Memory up to a budget, files of a temporary folder beyond it."""

    def __init__(self, folder: str, memory: int = MEMORY):
        self.folder, self.left, self.files = folder, memory, 0

    def path(self) -> str:
        self.files += 1
        return os.path.join(self.folder, f"{self.files}.bin")

    def array(self, size: int, kind: type) -> np.ndarray:
        bytes_needed = size * np.dtype(kind).itemsize
        if bytes_needed <= self.left:
            self.left -= bytes_needed
            return np.zeros(size, kind)
        return np.memmap(self.path(), kind, "w+", shape=(size,))


class Queue:
    """Tuples (suffix, shared) in the order of arrival; the newest are in memory."""

    __slots__ = ("space", "waiting", "done", "held")

    def __init__(self, space: Space):
        self.space, self.held = space, 0
        self.waiting: list[tuple] = []
        self.done: list[tuple] = []

    def push(self, suffixes: np.ndarray, shared: np.ndarray) -> None:
        used = suffixes.nbytes + shared.nbytes
        if used > self.space.left:
            self.waiting, self.done = self._spilled(self.waiting), self._spilled(self.done)
            self.space.left += self.held
            self.held = 0
        self.waiting.append((suffixes, shared))
        self.held += used
        self.space.left -= used

    def _spilled(self, blocks: list[tuple]) -> list[tuple]:
        out: list[tuple] = []
        for on_disk, run in groupby(blocks, key=lambda block: isinstance(block[0], str)):
            run = list(run)
            if not on_disk:
                path = self.space.path()
                with open(path, "wb") as file:
                    for side in (0, 1):
                        for block in run:
                            block[side].tofile(file)
                run = [(path, sum(len(block[0]) for block in run))]
            out += run
        return out

    @staticmethod
    def _read(block: tuple) -> tuple[np.ndarray, np.ndarray]:
        if not isinstance(block[0], str):
            return block
        path, n = block
        with open(path, "rb") as file:
            return np.fromfile(file, np.int64, n), np.fromfile(file, np.int16, n)

    def scan(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples, also those pushed while it runs; small pushes are put together."""
        while self.waiting:
            blocks, self.waiting = self.waiting, []
            while blocks:
                if isinstance(blocks[0][0], str):
                    taken = 1
                else:
                    taken, size = 0, 0
                    while taken < len(blocks) and size < CHUNK:
                        size += len(blocks[taken][0])
                        taken += 1
                block = blocks[0]
                if taken > 1:
                    block = tuple(np.concatenate([b[i] for b in blocks[:taken]]) for i in (0, 1))
                blocks = blocks[taken:]
                self.done.append(block)
                yield self._read(block)

    def backwards(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for block in reversed(self.done):
            suffixes, shared = self._read(block)
            yield suffixes[::-1], shared[::-1]

    def clear(self) -> None:
        self.waiting, self.done = [], []
        self.space.left += self.held
        self.held = 0


def _packed(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    key = np.zeros(len(places), np.uint64)
    for i in range(_PACK):
        key = (key << np.uint64(_BITS)) | text[places + i].astype(np.uint64)
    return key


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading symbols that two packed keys share."""
    different = a ^ b
    shared = np.zeros(len(a), np.int16)
    for i in range(_PACK):
        shared += (different >> np.uint64(_BITS * (_PACK - 1 - i))) == 0
    return shared


def sorted_seeds(text: np.ndarray, seeds: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds in order of their first ``limit`` symbols, and what each shares with the one before."""
    key = _packed(text, seeds)
    order = np.argsort(key, kind="stable")
    seeds, key = seeds[order], key[order]
    shared = np.zeros(len(seeds), np.int16)
    same = np.zeros(len(seeds), bool)
    if len(seeds):
        shared[1:] = _common(key[1:], key[:-1])
        same[1:] = key[1:] == key[:-1]
    depth = _PACK
    while depth < limit and same.any():
        members = np.flatnonzero(same | np.r_[same[1:], False])
        group = np.cumsum(~same)[members]
        key = _packed(text, seeds[members] + depth)
        order = np.lexsort((key, group))
        seeds[members] = seeds[members][order]
        key = key[order]
        at = np.flatnonzero(same[members])  # never the first of a group
        shared[members[at]] = depth + _common(key[at], key[at - 1])
        same[members[at]] = key[at] == key[at - 1]
        depth += _PACK
    return seeds, np.minimum(shared, limit).astype(np.int16)


class _Least:
    """Least value of any range of a block."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.n, powers = n, n.bit_length()
        self.levels = np.empty((powers, n), np.int16)
        self.levels[0] = values
        for power in range(1, powers):
            width, last = 1 << (power - 1), self.levels[power - 1]
            np.minimum(
                last[: n - 2 * width + 1], last[width : n - width + 1],
                out=self.levels[power, : n - 2 * width + 1],
            )

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Both ends included."""
        # Exact for every length below 2 ** 53.
        power = np.frexp((last - first + 1).astype(np.float64))[1].astype(np.int64) - 1
        flat, row = self.levels.ravel(), power * self.n
        return np.minimum(flat[row + first], flat[row + last - (1 << power) + 1])


class _Induction:
    """One pass: what is scanned pushes the suffix before it if that is of the given type."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, space: Space, limit: int):
        self.text, self.wanted, self.limit = text, wanted, limit
        self.queues = [Queue(space) for _ in range(SYMBOLS)]
        # Least shared length since the last push to each queue; -1 before the first.
        self.least = np.full(SYMBOLS, -1, np.int16)

    def scanned(self, suffixes: np.ndarray, shared: np.ndarray) -> None:
        if not len(suffixes):
            return
        before = suffixes - 1
        at = np.flatnonzero(before >= 0)
        at = at[self.wanted[before[at]]]
        lowest = shared.min()
        last_push = np.full(SYMBOLS, -1, np.int64)
        if len(at):
            symbol = self.text[before[at]]
            order = np.argsort(symbol, kind="stable")
            at, symbol = at[order], symbol[order]
            first = np.r_[True, symbol[1:] != symbol[:-1]]
            start = np.r_[0, at[:-1] + 1]
            start[first] = 0
            least = _Least(shared)
            new = least.of(start, at)
            new[first] = np.minimum(new[first], self.least[symbol[first]])
            new = np.minimum(new + 1, self.limit).astype(np.int16)
            bounds = np.r_[np.flatnonzero(first), len(at)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                self.queues[symbol[a]].push(before[at[a:b]], new[a:b])
            ends = bounds[1:] - 1
            last_push[symbol[ends]] = at[ends]
            # From the last push on the count starts again, with what came after it.
            rest = np.full(len(ends), self.limit, np.int16)
            open_ = at[ends] < len(suffixes) - 1
            rest[open_] = least.of(at[ends][open_] + 1, np.full(open_.sum(), len(suffixes) - 1))
            self.least = np.minimum(self.least, lowest)
            self.least[symbol[ends]] = rest
        else:
            self.least = np.minimum(self.least, lowest)


def suffixes_descending(
    text: np.ndarray, limit: int, folder: str, memory: int = MEMORY
) -> Iterator[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
    """Per first symbol, from the last to the first: its suffixes in descending order.

    ``text`` are symbols of which the last is 0. With each suffix comes the length, up to
    ``limit``, of what it shares with the larger suffix before it. Suffixes that share that
    much are in any order.
    """
    n = len(text)
    space = Space(folder, memory)
    padded = space.array(n + limit + _PACK, np.uint16)
    padded[:n] = text
    text = padded
    # Neighbouring equal symbols are one run; its type is whether what follows is larger.
    ends = np.flatnonzero(np.r_[text[: n - 1] != text[1:n], True])
    starts = np.r_[0, ends[:-1] + 1]
    rising = np.r_[text[ends[:-1]] < text[ends[:-1] + 1], False]
    smaller = space.array(n, bool)
    smaller[:] = np.repeat(rising, ends - starts + 1)
    run = space.array(n, np.int16)  # symbols left in the run, up to the limit
    run[:] = np.minimum(np.repeat(ends, ends - starts + 1) - np.arange(n) + 1, limit)
    seeds = starts[1:][rising[1:] & ~rising[:-1]]
    seeds, shared = sorted_seeds(text, seeds, limit)
    bounds = np.searchsorted(text[seeds], np.arange(SYMBOLS + 1)) if len(seeds) else np.zeros(
        SYMBOLS + 1, np.int64
    )

    larger = np.logical_not(smaller)
    up = _Induction(text, larger, space, limit)
    up.queues[int(text[n - 1])].push(np.array([n - 1]), np.zeros(1, np.int16))
    up.least[int(text[n - 1])] = limit
    for symbol in range(SYMBOLS):
        last = None
        for part, common in up.queues[symbol].scan():
            up.scanned(part, common)
            last = part[-1]
        own = seeds[bounds[symbol] : bounds[symbol + 1]]
        if len(own):
            common = shared[bounds[symbol] : bounds[symbol + 1]].copy()
            common[0] = 0 if last is None else min(run[last], run[own[0]])
            up.scanned(own, common)
    down = _Induction(text, smaller, space, limit)
    for symbol in range(SYMBOLS - 1, -1, -1):
        found = []
        last = None
        for part, common in down.queues[symbol].scan():
            down.scanned(part, common)
            found.append((part, common))
            last = part[-1]
        carried = None  # what the suffix before (the larger one) shares with the next
        for part, common in up.queues[symbol].backwards():
            shifted = np.empty_like(common)
            shifted[1:] = common[:-1]
            if carried is None:
                shifted[0] = 0 if last is None else min(run[last], run[part[0]])
            else:
                shifted[0] = carried
            carried = common[-1]
            down.scanned(part, shifted)
            found.append((part, shifted))
        down.queues[symbol].clear()
        up.queues[symbol].clear()
        yield symbol, found


def repeated_places(
    strings: list[bytes], owners: np.ndarray, length: int, memory: int = MEMORY
) -> tuple[np.ndarray, np.ndarray]:
    """(string, start), ascending: substrings of ``length`` that a smaller owner's also holds."""
    total = sum(map(len, strings)) + len(strings)
    ends = np.cumsum([len(s) + 1 for s in strings])
    text = np.zeros(total, np.uint16)
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    text[:] = raw
    text += 1
    text[ends - 1] = 0
    owner = np.repeat(owners, np.diff(np.r_[0, ends]))
    hit = np.zeros(total, bool)
    with tempfile.TemporaryDirectory() as folder:
        for _, blocks in suffixes_descending(text, length, folder, memory):
            if not blocks:
                continue
            places = np.concatenate([b[0] for b in blocks])
            shared = np.concatenate([b[1] for b in blocks])
            first = shared < length
            first[0] = True
            group = np.cumsum(first) - 1
            least = np.minimum.reduceat(owner[places], np.flatnonzero(first))
            hit[places] = owner[places] > least[group]
    places = np.flatnonzero(hit)
    string = np.searchsorted(ends, places, "right")
    # A start too near the end of its string has run on into the next.
    within = places < ends[string] - length
    places, string = places[within], string[within]
    return string, places - np.r_[0, ends[:-1]][string]


def repeated_starts(
    strings: list[bytes], owners: np.ndarray, length: int, memory: int = MEMORY
) -> list[np.ndarray]:
    """Per string: where a substring of ``length`` starts that a smaller owner's also holds."""
    string, starts = repeated_places(strings, owners, length, memory)
    return np.split(starts, np.searchsorted(string, np.arange(1, len(strings))))
