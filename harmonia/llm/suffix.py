"""Operator 7: removal of repeated passages by external induced suffix sorting.

A byte goes if a ``length``-byte string that covers it also starts earlier
(smaller document, or same document and earlier place).

1. Shards.  Each ``length``-byte window is keyed by the smallest
   fingerprint of the 24-byte strings inside it, so equal windows have equal
   keys wherever they are.  Consecutive windows of one key form a segment
   (about 40 windows).  Equal segments collapse, first inside a task, then
   by key; of these only the first has windows that can be first occurrences.
2. A key whose different segments have more than ``MAX_SHARD`` bytes is split
   again, by the 128-bit fingerprint of the whole window: what then meets is
   equal, so nothing of it is left to sort.  Later windows are found inside
   the task first; only the first of each goes on to its key.
3. Other keys with different segments, or with a segment that may repeat inside
   itself, are sorted: their segments' texts form the strings of a shard,
   and ``induced.suffix_order`` sorts all suffixes with disk-backed
   priority queues through recursive induction.  Neighbours in this order
   that share a prefix of ``length`` bytes are equal windows; all but the
   smallest place of a class are later ones.
4. The bytes under later windows are merged by document and removed.

Cases: null text counts as empty; texts shorter than ``length`` are kept
whole; matches never cross documents; rows without an id are documents of
their own, told apart by their text, and come before all others; rows that
repeat an id are one document; other columns are ignored; no rows: no rows.
Ids are integers above -2**62.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harmonia.llm.common import sql_type
from harmonia.llm.induced import Scratch, suffix_order

LENGTH = 100
GRAM = 24
#: Windows per segment at most (a place inside it fits a byte).
MAX_WINDOWS = 256
#: Segments that a task collects before it collapses equal ones.
COLLAPSE_ROWS = 600_000
#: Bytes of segments handed on together.
FLUSH_BYTES = 4 << 20
#: Symbols sorted together.
BATCH_SYMBOLS = 1_500_000
#: Bytes of different segments above which a key is split by window fingerprints.
MAX_SHARD = 1_000_000
#: Rows without an id have numbers below this, by 62 bits of the text's hash.
NO_ID = -(1 << 62)
#: What becomes of a segment: cut as a copy, sorted, or split into its windows.
COPY, SORT, SPLIT = 0, 1, 2

_P = np.random.default_rng(7).integers(0, 2**63, 16, np.uint64) * np.uint64(2) + np.uint64(1)


def _spread(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every run of ``width`` values."""
    n = 1
    while n * 2 <= width:
        x = pick(x[:-n], x[n:])
        n *= 2
    return pick(x[:len(x) - (width - n)], x[width - n:]) if width > n else x


def grams(data: np.ndarray) -> np.ndarray:
    """Fingerprints of all 24-byte strings (16 + 8 bytes)."""
    h = data.astype(np.uint64) * _P[0] ^ _P[1]
    eight = None
    for i, n in enumerate((1, 2, 4, 8)):
        h = h[:-n] * _P[2 + i] + h[n:]
        if n == 4:
            eight = h
    h = h[:-8] * _P[8] + eight[16:]
    h = (h ^ (h >> np.uint64(31))) * _P[9]
    return h ^ (h >> np.uint64(29))


def segments(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, starts and window counts of the segments, and which may repeat inside themselves."""
    width = length - GRAM + 1
    h = grams(data)
    key = _spread(h, width, np.minimum)
    first = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
    count = np.diff(np.concatenate((first, [len(key)])))
    # smallest strings of some window, in order; a value that comes twice in a row recurs inside a segment
    pad = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(h == _spread(np.concatenate((pad, key, pad)), width, np.maximum))
    again = h[at][1:][h[at][1:] == h[at][:-1]]
    loop = np.isin(key[first], again) if len(again) else np.zeros(len(first), bool)
    if count.max() > MAX_WINDOWS:
        parts = -(-count // MAX_WINDOWS)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, loop = np.repeat(first, parts) + inner * MAX_WINDOWS, np.repeat(loop, parts)
        count = np.diff(np.concatenate((first, [len(key)])))
    return key[first], first, count, loop


def _scan(docs: DataFrame, length: int) -> DataFrame:
    """Segments ``h, g`` (key, text fingerprint), ``d, p, n, loop`` of the first place, ``more`` places.

    Equal segments of a task are collapsed here; ``p`` is the first byte.
    """
    def flush(cols: list) -> pa.RecordBatch:
        h, g, d, p, n, loop = (np.concatenate(c) for c in zip(*cols))
        order = np.lexsort((p, d, g, h))
        h, g, d, p, n, loop = (c[order] for c in (h, g, d, p, n, loop))
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])))
        at = np.flatnonzero(new)
        rest = np.flatnonzero(~new)
        offsets = np.concatenate((np.searchsorted(rest, at), [len(rest)])).astype(np.int32)
        more = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(d[rest]), pa.array(p[rest])], ["d", "p"]))
        return pa.RecordBatch.from_arrays(
            [pa.array(h[at].view(np.int64)), pa.array(g[at].view(np.int64)), pa.array(d[at]), pa.array(p[at]),
             pa.array(n[at].astype(np.int32)), pa.array(loop[at]), more], names=["h", "g", "d", "p", "n", "loop", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = t.encode() if t else b""
                if len(raw) < length:
                    continue
                h, p, n, loop = segments(np.frombuffer(raw, np.uint8), length)
                view = memoryview(raw)
                g = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(p.tolist(), (p + n + length - 1).tolist())),
                                np.uint64, len(p))
                held.append((h, g, np.full(len(p), d, np.int64), p, n, loop))
                rows += len(p)
            if rows >= COLLAPSE_ROWS:
                yield flush(held)
                held, rows = [], 0
        if held:
            yield flush(held)

    return docs.select("d", "text").mapInArrow(run, "h bigint, g bigint, d bigint, p bigint, n int, loop boolean, "
                                "more array<struct<d:bigint,p:bigint>>")


def _ranges_of(d: np.ndarray, p: np.ndarray, length: int) -> pa.RecordBatch:
    """Rows ``d, cuts`` of the shard schema for the windows at ``d, p``, in order of their places."""
    new = np.concatenate(([True], (d[1:] != d[:-1]) | (p[1:] > p[:-1] + length)))
    last = np.concatenate((new[1:], [True]))
    cuts = pa.StructArray.from_arrays([pa.array(p[new]), pa.array(p[last] + length)], ["a", "b"])
    doc = d[new]
    at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    return _shard_rows(doc[at], doc[at], np.zeros(len(at), np.int64), cuts=pa.ListArray.from_arrays(
        np.concatenate((at, [len(doc)])).astype(np.int32), cuts))


def _shard_rows(h, d, p, n=None, text=None, cuts=None, g=None) -> pa.RecordBatch:
    rows = len(h)
    cols = [pa.array(h, pa.int64()), pa.array(d, pa.int64()), pa.array(p, pa.int64()), pa.array(n, pa.int32()) if n is not None else None,
            pa.array(text, pa.binary()) if text is not None else None, cuts, pa.array(g, pa.int64()) if g is not None else None]
    return pa.RecordBatch.from_arrays([pa.nulls(rows, k) if c is None else c for c, k in zip(cols, SHARD_TYPES)], names=SHARD_NAMES)


SHARD_NAMES = ["h", "d", "p", "n", "text", "cuts", "g"]
SHARD_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
               pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.int64()]


def _split_windows(raw: bytes, p: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and 128-bit fingerprints (two columns) of all windows of the segments."""
    at = np.repeat(p - np.cumsum(n) + n, n) + np.arange(n.sum())
    view = memoryview(raw)
    prints = b"".join([xxhash.xxh3_128_digest(view[x:x + length]) for x in at.tolist()])
    return at, np.frombuffer(prints, np.int64).reshape(-1, 2)


def _firsts(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], length: int) -> Iterator[pa.RecordBatch]:
    """The first of equal windows as rows ``h, g, d, p``, the others as ranges."""
    d, p, w = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((p, d, w[:, 1], w[:, 0]))
    d, p, w = d[order], p[order], w[order]
    new = np.concatenate(([True], (w[1:] != w[:-1]).any(1)))
    yield _shard_rows(w[new, 0], d[new], p[new], g=w[new, 1])
    if not new.all():
        d, p = d[~new], p[~new]
        order = np.lexsort((p, d))
        yield _ranges_of(d[order], p[order], length)


def _to_sort(held: list[tuple]) -> pa.RecordBatch:
    h, d, p, n, text = zip(*held)
    return _shard_rows(*(np.concatenate(c) for c in (h, d, p, n)), [x for t in text for x in t])


def _to_cut(held: list[tuple]) -> pa.RecordBatch:
    d, a, b = zip(*held)
    cuts = pa.StructArray.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
    ends = np.cumsum([0, *map(len, a)]).astype(np.int32)
    return _shard_rows(d, d, np.zeros(len(d), np.int64), cuts=pa.ListArray.from_arrays(ends, cuts))


def cut_texts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Documents with their marked segments, ``d, text, .., segs``, to shard rows; rows of many documents go on together."""
    held, windows = [], 0
    for batch in batches:
        segs = batch.column(batch.num_columns - 1)
        h, p, n, kind = (segs.values.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        to_sort, sort_bytes, to_cut = [], 0, []
        bounds = segs.offsets.to_pylist()
        for d, t, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bounds, bounds[1:]):
            raw = t.encode() if t else b""
            own = kind[x:y]
            at = x + np.flatnonzero(own == SORT)
            if len(at):
                text = [raw[u:u + k + length - 1] for u, k in zip(p[at].tolist(), n[at].tolist())]
                to_sort.append((h[at], np.full(len(at), d, np.int64), p[at], n[at], text))
                sort_bytes += sum(map(len, text))
                if sort_bytes > FLUSH_BYTES:
                    yield _to_sort(to_sort)
                    to_sort, sort_bytes = [], 0
            at = x + np.flatnonzero(own == COPY)
            if len(at):
                to_cut.append((d, *merge_ranges(p[at], p[at] + n[at] + length - 1, len(raw))))
            at = x + np.flatnonzero(own == SPLIT)
            if len(at):
                place, prints = _split_windows(raw, p[at], n[at].astype(np.int64), length)
                held.append((np.full(len(place), d, np.int64), place, prints))
                windows += len(place)
                if windows >= COLLAPSE_ROWS:
                    yield from _firsts(held, length)
                    held, windows = [], 0
        if to_sort:
            yield _to_sort(to_sort)
        if to_cut:
            yield _to_cut(to_cut)
    if held:
        yield from _firsts(held, length)


def _texts(docs: DataFrame, marked: DataFrame, length: int) -> DataFrame:
    """What goes to the shards, ``h, d, p, n, text, cuts, g``.

    ``marked``: ``d, h, p, n, kind``.  Segments of kind ``SORT`` get their
    text, cut out of their documents; the windows of kind ``SPLIT`` pass by
    their fingerprint ``h, g``.  Segments of kind ``COPY`` are copies of
    earlier ones and need no text; their merged byte ranges pass as one row
    per document with the ranges in ``cuts``.
    """
    lists = marked.groupBy("d").agg(F.collect_list(F.struct("h", "p", "n", "kind")).alias("segs"))

    # no column is pruned here, so that the last join can read the same exchange of the documents
    return docs.join(lists, "d").mapInArrow(
        lambda batches: cut_texts(batches, length),
        "h bigint, d bigint, p bigint, n int, text binary, cuts array<struct<a:bigint,b:bigint>>, g bigint")


def later_windows(text: list[bytes], count: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and place of every window that is not the first of its class.

    Segments come in order of their places, by group; windows are compared
    inside groups.
    """
    sizes = np.fromiter(map(len, text), np.int64, len(text))
    ends = np.concatenate((group[1:] != group[:-1], [True]))
    room = sizes + 1 + ends  # a separator after each segment, an end after each group
    start = np.cumsum(room) - room
    symbols = np.ones(int(room.sum()), np.int32)  # 0 end, 1 separator, bytes from 2
    raw = np.frombuffer(b"".join(text), np.uint8)
    symbols[np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(len(raw))] = raw.astype(np.int32) + 2
    symbols[(start + room - 1)[ends]] = 0
    owner = np.repeat(np.arange(len(text)), room)
    string = np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))
    with Scratch() as scratch:
        order = suffix_order(symbols, string[owner], scratch)
    place = order - start[owner[order]]
    order = order[place < count[owner[order]]]  # suffixes that start a window, in order
    seg = owner[order]
    place = order - start[seg]
    # common prefixes of neighbours: fingerprints find the long ones, the bytes confirm them
    mixed = symbols.astype(np.uint64) * _P[10] ^ _P[11]
    pw = np.full(len(mixed) + 1, _P[12])
    pw[0] = 1
    pw = np.multiply.accumulate(pw)
    sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(mixed * pw[:-1])))
    print_ = (sums[order + length] - sums[order]) * pw[len(mixed) - order - length]
    same = np.flatnonzero((print_[1:] == print_[:-1]) & (string[seg[1:]] == string[seg[:-1]]))
    if len(same):
        at = np.cumsum(sizes)[seg] - sizes[seg] + place
        window = np.lib.stride_tricks.sliding_window_view(raw, length)
        for a in range(0, len(same), 100_000):
            rows = same[a:a + 100_000]
            equal = (window[at[rows]] == window[at[rows + 1]]).all(1)
            same[a:a + 100_000][~equal] = -1
    new = np.ones(len(order), bool)
    new[same[same >= 0] + 1] = False
    rank = seg * MAX_WINDOWS + place
    first = np.minimum.reduceat(rank, np.flatnonzero(new)) if len(order) else rank
    gone = rank[rank != first[np.cumsum(new) - 1]] if len(order) else rank
    gone.sort()
    return gone // MAX_WINDOWS, gone % MAX_WINDOWS


def sort_shards(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Byte ranges ``d, a, b`` under windows that are equal to earlier ones, from segments with texts
    and from the windows of split keys, in order of ``h, g, d, p``."""
    def work(t: pa.Table) -> pa.RecordBatch | None:
        h, d, p, n = (t.column(c).to_numpy() for c in "hdpn")
        seg, place = later_windows(t.column("text").to_pylist(), n.astype(np.int64), h, length)
        if not len(seg):
            return None
        d, p = d[seg], p[seg] + place
        new = np.concatenate(([True], (seg[1:] != seg[:-1]) | (p[1:] != p[:-1] + 1)))
        last = np.concatenate((new[1:], [True]))
        return pa.RecordBatch.from_arrays([pa.array(d[new]), pa.array(p[new]), pa.array(p[last] + length)], names=["d", "a", "b"])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments go on to be sorted, ready ranges and later windows of split keys to ``ready``."""
        last = None
        for batch in batches:
            if batch.column(6).null_count < batch.num_rows:
                split = batch.filter(batch.column(6).is_valid())
                h, d, p, g = (split.column(i).to_numpy() for i in (0, 1, 2, 6))
                later = np.concatenate(([last == (h[0], g[0])], (h[1:] == h[:-1]) & (g[1:] == g[:-1])))
                last = h[-1], g[-1]
                if later.any():
                    ready.append(pa.RecordBatch.from_arrays(
                        [pa.array(d[later]), pa.array(p[later]), pa.array(p[later] + length)], names=["d", "a", "b"]))
                batch = batch.filter(batch.column(6).is_null())
            if batch.column(5).null_count < batch.num_rows:
                done = batch.filter(batch.column(5).is_valid())
                ranges = done.column(5).flatten()
                ready.append(pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(done.column(1).to_numpy(), done.column(5).value_lengths().to_numpy())),
                     ranges.field(0), ranges.field(1)], names=["d", "a", "b"]))
                batch = batch.filter(batch.column(5).is_null())
            yield batch

    ready: list[pa.RecordBatch] = []

    def whole(held: list[pa.RecordBatch], ended: bool) -> Iterator[pa.Table]:
        """Runs of whole keys, of ``BATCH_SYMBOLS`` at most or of a single key; the last key waits for more rows."""
        t = pa.Table.from_batches(held).combine_chunks()
        h = t.column("h").to_numpy()
        ends = np.append(np.flatnonzero(h[1:] != h[:-1]) + 1, [len(h)] if ended else []).astype(np.int64)
        held.clear()
        if not len(ends):
            held.append(t.to_batches()[0])
            return
        size = np.cumsum(pc.binary_length(t.column("text")).to_numpy().astype(np.int64))[ends - 1]
        a, done = 0, 0
        while (n := int(np.searchsorted(ends, a, "right"))) < len(ends):
            n = max(n, int(np.searchsorted(size, done + BATCH_SYMBOLS, "right")) - 1)
            if n == len(ends) - 1 and not ended:
                break
            yield t.slice(a, ends[n] - a)
            a, done = int(ends[n]), int(size[n])
        if a < len(h):
            held.extend(t.slice(a).to_batches())

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in passed(batches):
        while ready:
            yield ready.pop()
        if batch.num_rows:
            held.append(batch)
            size += batch.column(4).nbytes
            if size > BATCH_SYMBOLS:
                for t in whole(held, False):
                    if out := work(t):
                        yield out
                size = sum(x.column(4).nbytes for x in held)
    if held:
        for t in whole(held, True):
            if out := work(t):
                yield out
    while ready:
        yield ready.pop()


def _sorted(segs: DataFrame, length: int) -> DataFrame:
    return (segs.repartition("h").sortWithinPartitions("h", "g", "d", "p")
            .mapInArrow(lambda batches: sort_shards(batches, length), "d bigint, a bigint, b bigint"))


def shards(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Segments to sort, windows of split keys and ready ranges (see ``_texts``) of ``docs``: ``d, text``."""
    by_key = Window.partitionBy("h")
    copies = Window.partitionBy("h", "g").orderBy("d", "p")
    seen = _scan(docs, length).withColumns({
        "mixed": F.min("g").over(by_key) != F.max("g").over(by_key),
        "nth": F.row_number().over(copies), "f": F.first(F.struct("d", "p")).over(copies)})
    seen = seen.withColumn("size", F.sum(F.when(F.col("nth") == 1, F.col("n") + (length - 1))).over(by_key))
    # one list per document for both kinds, so that the scan and its exchange run once
    copy = F.transform("more", lambda m: F.struct(m["d"].alias("d"), m["p"].alias("p"), F.lit(COPY).alias("kind")))
    kind = F.when(F.col("nth") > 1, COPY).when(F.col("size") > MAX_SHARD, SPLIT).otherwise(SORT)
    own = F.struct("d", "p", kind.alias("kind"))
    marked = (seen.filter("nth > 1 or mixed or loop or size(more) > 0")
              .select("h", "n", "f", (F.col("mixed") | F.col("loop")).alias("open"),
                      F.explode(F.concat(F.array(own), copy)).alias("at"))
              .filter(F.when(F.col("at.kind") != COPY, F.col("open")).otherwise(F.struct("at.d", "at.p") != F.col("f")))
              .select("at.d", "h", "at.p", "n", "at.kind"))
    return _texts(docs, marked, length)


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Byte ranges ``d, a, b`` to remove (they may overlap) of ``docs``: ``d, text``."""
    return _sorted(shards(docs, length), length)


def merge_ranges(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by ranges, clipped to ``size``."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.minimum(np.maximum.accumulate(b[order]), size)
    new = np.concatenate(([True], a[1:] > b[:-1]))
    return a[new], b[np.concatenate((new[1:], [True]))]


def _cut_out(raw: bytes, cuts: pa.ListScalar) -> tuple[bytes, int, int]:
    """Remaining bytes, and the number of removed bytes and runs."""
    if not cuts.is_valid:
        return raw, 0, 0
    a, b = merge_ranges(cuts.values.field(0).to_numpy(), cuts.values.field(1).to_numpy(), len(raw))
    edges = [0, *np.stack((a, b), 1).ravel().tolist(), len(raw)]
    return b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])), int((b - a).sum()), len(a)


def _keyed(docs: DataFrame, doc_id: str, text: str, others: tuple[str, ...] = ()) -> DataFrame:
    own = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 2) + F.lit(-(1 << 63))
    return docs.select(F.coalesce(F.col(doc_id).cast("bigint"), own).alias("d"), F.col(text).alias("text"),
                       *[F.col(c).alias(f"x{i}") for i, c in enumerate(others)])


def _cut_lists(keyed: DataFrame, length: int) -> DataFrame:
    return repeated_ranges(keyed, length).groupBy("d").agg(F.collect_list(F.struct("a", "b")).alias("cuts"))


def measure_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    The documents are shuffled once: both joins read the same exchange.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for d, t, cuts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                raw = t.encode() if t else b""
                kept, gone, spans = _cut_out(raw, cuts)
                row = (None if d < NO_ID else d, len(raw), gone, spans, hashlib.sha256(kept).hexdigest())
                for c, v in zip(out, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, [pa.int64()] * 4 + [pa.string()])],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    keyed = _keyed(docs, doc_id, text)
    got = keyed.join(_cut_lists(keyed, length), "d", "left").select("d", "text", "cuts").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return got.withColumn("doc_id", F.col("doc_id").cast(sql_type(docs, doc_id)))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with all columns and the remaining text; a character that loses bytes is dropped.

    The documents are shuffled once: both joins read the same exchange.
    """
    others = [c for c in docs.columns if c != text]
    place = [1 if c == text else 2 + others.index(c) for c in docs.columns]
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [_cut_out(t.encode(), cuts)[0].decode(errors="ignore") if t is not None and cuts.is_valid else t
                   for t, cuts in zip(batch.column(1).to_pylist(), batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == 1 else batch.column(i) for i in place], names=names)

    keyed = _keyed(docs, doc_id, text, tuple(others))
    return keyed.join(_cut_lists(keyed, length), "d", "left").mapInArrow(run, docs.schema)
