"""External induced suffix sorting of many strings in lockstep.

SA-IS with its two induction passes driven by monotone priority queues: the
key is a symbol, and suffix tuples of one key leave in the order in which
they came.  The queues keep a bounded number of tuples in memory and write
the rest to files of the task's own temporary folder.  All strings of a
batch advance together, symbol by symbol, so every step is one array
operation whatever the number of strings; the symbols of large batches lie
in a mapped file.  Only strings whose S* substrings repeat are reduced and
sorted again; the recursion ends where no names repeat, or, as in external
induced sorting generally, in a reduced text that memory holds easily (at most
``DIRECT`` symbols): prefix doubling sorts it, as its alphabet is so large that
a queue's steps would move a handful of suffixes each.
"""

from __future__ import annotations

import heapq
import os
import shutil
import tempfile

import numpy as np

#: Suffix tuples that a queue keeps in memory, and symbols kept outside a mapped file.
QUEUE_ROWS = 4_000_000
MAPPED_ROWS = 32_000_000
#: Symbols of a reduced text up to which it is sorted by prefix doubling.
DIRECT = 1 << 20


class Scratch:
    """A temporary folder of the task, removed at the end."""

    def __enter__(self) -> "Scratch":
        self.path, self.n = tempfile.mkdtemp(prefix="induced-"), 0
        return self

    def __exit__(self, *_) -> None:
        shutil.rmtree(self.path, ignore_errors=True)

    def name(self) -> str:
        self.n += 1
        return os.path.join(self.path, str(self.n))

    def array(self, values: np.ndarray) -> np.ndarray:
        """The values, in a mapped file if they are many."""
        if len(values) < MAPPED_ROWS:
            return values
        out = np.memmap(self.name(), values.dtype, "w+", shape=values.shape)
        out[:] = values
        return out


class BucketQueue:
    """Monotone priority queue of positions: lowest symbol first (highest with sign -1), then first in first out."""

    def __init__(self, scratch: Scratch, seeds, sign: int = 1):
        self.scratch, self.rows, self.sign = scratch, 0, sign
        self.held: dict[int, list] = {}
        self.file = None
        self.keys = [sign * c for c in seeds]
        self.known = set(seeds)
        heapq.heapify(self.keys)

    def push(self, keys: np.ndarray, positions: np.ndarray) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, positions = keys[order], positions[order]
        at = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        held, known = self.held, self.known
        ends = [*at.tolist(), len(keys)]
        a = 0
        for c, b in zip(keys[[0, *at.tolist()]].tolist(), ends):
            if c in held:
                held[c].append(positions[a:b])
            else:
                held[c] = [positions[a:b]]
                if c not in known:
                    known.add(c)
                    heapq.heappush(self.keys, self.sign * c)
            a = b
        self.rows += len(keys)
        if self.rows > QUEUE_ROWS:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = open(self.scratch.name(), "w+b")
        self.file.seek(0, os.SEEK_END)
        for parts in self.held.values():
            for i, p in enumerate(parts):
                if isinstance(p, np.ndarray):
                    parts[i] = (self.file.tell(), len(p))
                    self.file.write(p.astype(np.int64).tobytes())
        self.rows = 0

    def next(self) -> int | None:
        """The next symbol with seeds or queued tuples."""
        return self.sign * heapq.heappop(self.keys) if self.keys else None

    def pop(self, key: int) -> np.ndarray | None:
        parts = self.held.pop(key, None)
        if parts is None:
            return None
        out = []
        for p in parts:
            if isinstance(p, tuple):
                self.file.seek(p[0])
                p = np.frombuffer(self.file.read(8 * p[1]), np.int64)
            else:
                self.rows -= len(p)
            out.append(p)
        return out[0] if len(out) == 1 else np.concatenate(out)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S); string ends (0) are S."""
    n = len(text)
    step = np.empty(n, np.int8)
    step[:-1] = np.sign(text[1:] - text[:-1])
    step[-1] = 1
    step[text == 0] = 1
    at = np.where(step != 0, np.arange(n), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    return step[nxt] > 0


def _induce(text: np.ndarray, small: np.ndarray, starts: np.ndarray, low: np.ndarray, scratch: Scratch) -> np.ndarray:
    """All suffixes in order of (symbol, rank) from the given order of the S* suffixes.

    ``starts`` marks first positions of strings.  Strings share the queues;
    suffixes of one string keep their order among the others.
    """
    by = np.argsort(text[low], kind="stable")
    low = low[by]
    keys = text[low]
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))).tolist() + [len(low)]
    seeds = {int(keys[a]): low[a:b] for a, b in zip(cuts, cuts[1:])}
    queue, larger = BucketQueue(scratch, seeds), {}
    # suffixes whose predecessor in the string is L, is S
    after_small = np.zeros(len(text), bool)
    after_small[1:] = small[:-1]
    after_large = ~after_small & ~starts
    after_small &= ~starts

    def before(found: np.ndarray, among: np.ndarray) -> np.ndarray:
        return found[among[found]] - 1

    while (c := queue.next()) is not None:  # L suffixes, symbols rising
        got = []
        while (found := queue.pop(c)) is not None:
            got.append(found)
            prev = before(found, after_large)
            queue.push(text[prev], prev)
        if got:
            larger[c] = np.concatenate(got)
        if c in seeds:
            prev = before(seeds[c], after_large)
            queue.push(text[prev], prev)
    queue.close()
    queue, smaller = BucketQueue(scratch, larger, -1), {}
    while (c := queue.next()) is not None:  # S suffixes, symbols falling
        got = []
        while (found := queue.pop(c)) is not None:
            got.append(found)
            prev = before(found, after_small)
            queue.push(text[prev], prev)
        if got:
            smaller[c] = np.concatenate(got)[::-1]
        if c in larger:
            prev = before(larger[c][::-1], after_small)
            queue.push(text[prev], prev)
    queue.close()
    # the ends of the strings are S* and never induced
    parts = [seeds[0]] if 0 in seeds else []
    for c in sorted(larger.keys() | smaller.keys()):
        parts += [d[c] for d in (larger, smaller) if c in d]
    return np.concatenate(parts)


def _by_string(group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The positions string by string, in their order inside each."""
    own = group[order]
    return order[np.argsort(own.astype(np.uint16) if group[-1] < 1 << 16 else own, kind="stable")]


def _doubled(text: np.ndarray, group: np.ndarray) -> np.ndarray:
    """As ``suffix_order``, by ranks of prefixes that double in length."""
    key = group.astype(np.int64) * (int(text.max()) + 1) + text
    order = np.argsort(key, kind="stable")
    key, rank, slots, size = key[order], np.empty(len(text), np.int64), np.arange(len(text)), 1
    while True:
        # equal prefixes have the rank of the first of them
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        slots = slots[~(new & np.concatenate((new[1:], [True])))]
        if not len(slots):
            return order
        # an end is alone in its string, so equal prefixes go on inside theirs
        found = order[slots]
        key = rank[found] * len(text) + rank[found + size]
        by = np.argsort(key, kind="stable")
        order[slots], key, size = found[by], key[by], 2 * size


def suffix_order(text: np.ndarray, group: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Positions sorted by (string, suffix).

    ``group`` numbers the strings from 0 in order; the last symbol of each
    is 0 and no other symbol is.
    """
    n = len(text)
    text = scratch.array(text)
    small = _types(text)
    starts = np.empty(n, bool)
    starts[0] = True
    starts[1:] = group[1:] != group[:-1]
    low = np.flatnonzero(small[1:] & ~small[:-1] & ~starts[1:]) + 1
    # a string that is only its end has no L before it
    alone = np.flatnonzero(starts & (text == 0))
    if len(low):
        order = _induce(text, small, starts, low, scratch)
        is_low = np.zeros(n, bool)
        is_low[low] = True
        by = _by_string(group, order[is_low[order]])  # S* substrings in order, string by string
        names, again = _names(text, group, low, by)
        ranked = by
        if again.any():
            owner = group[low]
            held = again[owner]
            low, names, owner = low[held], names[held], owner[held]
            dense = np.cumsum(np.concatenate(([0], owner[1:] != owner[:-1])))
            inner = _doubled(names, dense) if len(low) <= DIRECT else suffix_order(names, dense, scratch)
            ranked[again[group[by]]] = low[inner]
        order = _induce(text, small, starts, ranked, scratch)
    else:
        order = np.empty(0, np.int64)
    if len(alone):
        order = np.concatenate([alone, order])
    return _by_string(group, order)


def _names(text: np.ndarray, group: np.ndarray, low: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every S* substring within its string, in text order (a string's end gets 0), and which
    strings have two of one rank."""
    n = len(text)
    power = np.uint64(0x9E3779B97F4A7C15)
    # sums of symbols times powers: equal substrings have equal differences after scaling
    mixed = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(32)
    pw = np.full(n + 1, power)
    pw[0] = 1
    pw = np.multiply.accumulate(pw)
    sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(mixed * pw[:-1])))
    nxt = np.empty(len(low), np.int64)
    nxt[:-1] = low[1:] + 1
    nxt[-1] = low[-1] + 1
    end = text[low] == 0
    nxt[end] = low[end] + 1
    size = nxt - low
    print_ = (sums[nxt] - sums[low]) * pw[n - low]
    where = np.searchsorted(low, by)
    new = np.ones(len(by), bool)
    a, b = where[1:], where[:-1]
    own = group[by]
    new[1:] = (print_[a] != print_[b]) | (size[a] != size[b]) | (own[1:] != own[:-1])
    rank = np.cumsum(new) - 1
    first = np.concatenate(([True], own[1:] != own[:-1]))
    rank -= np.repeat(rank[first], np.diff(np.concatenate((np.flatnonzero(first), [len(by)]))))
    names = np.empty(len(low), np.int64)
    names[where] = rank
    again = np.zeros(int(group[-1]) + 1, bool)
    again[own[~new]] = True
    return names, again
