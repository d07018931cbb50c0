"""Operator 4: best-fit packing improved by swap-based local search.

Texts become token ids (a public tokenizer's file is a parameter) with a
closing id; only documents longer than a sequence are cut.  Full pieces are
sequences of their own.  The other pieces are dealt by hash into shards of a
bounded number of rows; each shard is packed by best fit in order of
falling length, then improved: one piece for one, two for one, or a piece
moved, between underfull sequences, as long as the sum of squared fills
grows, which empties the emptiest sequences.

Every shard leaves about half a sequence unfilled, so the bound on a shard
costs next to nothing.

Cases: null or empty text: one piece that holds only the closing id;
repeated rows are pieces of their own; other columns are ignored; no rows:
no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmonia.llm.bpe_rank import byte_alphabet
from harmonia.llm.common import LATIN_L, LATIN_N, LATIN_S, cut, is_latin, sql_type

LENGTH = 2048
CLOSING = 0
#: Pieces per shard on average.
SHARD_ROWS = 20_000
#: Encoded words kept per worker; the table is emptied when it is full.
MAX_WORDS = 300_000
#: Fixed value: the byte-level pattern, and the same for texts below U+0100.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN = re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{LATIN_S}{LATIN_L}{LATIN_N}]").replace(r"\p{L}", f"[{LATIN_L}]")
                   .replace(r"\p{N}", f"[{LATIN_N}]").replace(r"\s", f"[{LATIN_S}]").replace(r"\S", f"[^{LATIN_S}]"))
#: The emptiest sequences whose pieces are offered to the others.
DONORS = 24


class Words:
    """Token ids by words of the byte-level pattern, with recent words kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.kept: dict[str, bytes] = {}
        self.short = _ranked(path)

    def _whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids.  Texts beyond U+00FF or with control strings take the library's way."""
        if not is_latin(text) or any(map(text.__contains__, self.special)):
            return self._whole(text)
        words, kept = LATIN.findall(text), self.kept
        if len(kept) >= MAX_WORDS:
            kept.clear()
        code = self.short.encode_ordinary if self.short else None
        for w in set(words).difference(kept):
            kept[w] = np.array(code(w), "<u4").tobytes() if code else self._whole(w)
        return b"".join(map(kept.__getitem__, words))


def _ranked(path: str):
    """The same vocabulary as merge ranks, where the file's merges are in order of their ids."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids = model["vocab"]
    merged = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(set(merged)) or merged[0] != 256:
        return None
    byte = {c: b for b, c in enumerate(byte_alphabet())}
    ranks = {bytes(byte[c] for c in t): i for t, i in ids.items() if all(c in byte for c in t)}
    singles = all(ranks[bytes([b])] < 256 for b in range(256))
    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if singles else None


@lru_cache(maxsize=2)
def load(path: str) -> Words:
    return Words(path)


def pieces(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
           length: int = LENGTH) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``; the first piece of a cut document is the shorter one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, closing = load(vocabulary), np.array([CLOSING], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                who, no, start, size, crc = [], [], [], [], []
                for row, ids in enumerate(part.column(1).to_pylist()):
                    ids = coder.encode(ids or "") + closing
                    n = len(ids) // 4
                    k = -(-n // length)
                    a, first = 0, n - length * (k - 1)
                    for i in range(k):
                        b = a + (length if i else first)
                        who.append(row)
                        no.append(i)
                        start.append(a)
                        size.append(b - a)
                        crc.append(zlib.crc32(ids[4 * a:4 * b]))
                        a = b
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(who, pa.int64())), pa.array(no, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(doc_id, text).mapInArrow(
        run, f"doc_id {sql_type(docs, doc_id)}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of indices: pieces of falling length go to the fullest bin that takes them."""
    by_space: list[list[int]] = [[] for _ in range(room + 1)]
    spaces, bins = 0, []  # bit s of spaces: a bin with space s exists
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        n = sizes[i]
        fit = spaces >> n
        if fit:
            s = n + (fit & -fit).bit_length() - 1
            b = by_space[s].pop()
            if not by_space[s]:
                spaces &= ~(1 << s)
            bins[b].append(i)
        else:
            s, b = room, len(bins)
            bins.append([i])
        if s - n:
            by_space[s - n].append(b)
            spaces |= 1 << (s - n)
    return bins


def improve(bins: list[list[int]], sizes: list[int], room: int, donors: int = DONORS) -> list[list[int]]:
    """Local search on the sum of squared fills.

    The pieces of the emptiest bins are offered to every other underfull
    bin, fullest first: a piece is moved there, or exchanged for a smaller
    one, or two pieces are exchanged for one.  Each change shifts load from
    an emptier to a fuller bin, so the sum grows and the search ends; it is
    repeated while it empties bins.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    while True:
        under = sorted((b for b in range(len(bins)) if 0 < fill[b] < room), key=lambda b: fill[b])
        give, take = under[:donors], under[donors:][::-1]
        if not take and len(give) > 1:
            give, take = give[:len(give) // 2], give[len(give) // 2:][::-1]
        pool = sorted((sizes[i], i, b) for b in give for i in bins[b])
        for t in take:
            while (space := room - fill[t]) and pool and _exchange(t, space, pool, bins, sizes, fill):
                pass
        emptied = [b for b in give if not bins[b]]
        if not emptied:
            return [b for b in bins if b]


def _exchange(t: int, space: int, pool: list, bins: list, sizes: list, fill: list) -> bool:
    """The change that fills bin t most, if there is one."""
    best, gain = None, 0
    k = bisect_right(pool, (space, 1 << 60, 0)) - 1
    if k >= 0:
        best, gain = (None, [pool[k]]), pool[k][0]
    for a in bins[t]:
        n = sizes[a]
        if gain == space:
            break
        k = bisect_right(pool, (n + space, 1 << 60, 0)) - 1
        if k >= 0 and pool[k][0] - n > gain:
            best, gain = (a, [pool[k]]), pool[k][0] - n
        lo, hi = 0, bisect_left(pool, (n + space, 0, 0)) - 1
        while lo < hi and gain < space:
            two = pool[lo][0] + pool[hi][0]
            if two > n + space:
                hi -= 1
                continue
            if two - n > gain and (pool[lo][2] == pool[hi][2]):  # both from one bin, whose load the change shifts
                best, gain = (a, [pool[lo], pool[hi]]), two - n
            lo += 1
    if not best or any(fill[t] <= fill[p[2]] - gain for p in best[1]):
        return False
    out, new = best
    source = new[0][2]
    for p in new:
        pool.remove(p)
        bins[source].remove(p[1])
        bins[t].append(p[1])
    if out is not None:
        bins[t].remove(out)
        bins[source].append(out)
        insort(pool, (sizes[out], out, source))
    fill[t] += gain
    fill[source] -= gain
    return True


def pack(pieces: DataFrame, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset``; ``pieces`` must be cheap to read again (cut)."""
    part = pieces.filter(F.col("length") < length)
    full = pieces.filter(F.col("length") >= length)
    shards = -(-part.count() // shard_rows) or 1
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    schema = ", ".join(f"`{k}` {v}" for k, v in kinds.items()) + ", sequence_id bigint, offset bigint"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = int(pdf["_shard"].iloc[0])
        pdf = pdf.drop(columns="_shard").sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=False)
        sizes = pdf["length"].tolist()
        bins = improve(best_fit(sizes, length), sizes, length)
        seq, off = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                seq[i], off[i] = shard << 32 | k, at
                at += sizes[i]
        return pdf.assign(sequence_id=seq, offset=off)

    dealt = part.withColumn("_shard", F.pmod(F.xxhash64(*kinds, F.lit("shard")), F.lit(shards)))
    packed = dealt.groupBy("_shard").applyInPandas(run, schema)
    alone = full.withColumns({"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")})
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return pack(cut(pieces(docs, vocabulary, doc_id, text)))
