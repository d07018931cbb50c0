"""Operator 3: near-duplicate groups by b-bit MinHash.

Every text becomes the set of its distinct five-word shingles (64-bit
fingerprints).  ``BANDS * ROWS`` minima are kept; bands of minima give the
candidates, and the low ``BITS`` bits of the minima, packed, give a
collision-corrected similarity estimate by counting equal fields.  Pairs
whose estimate could be 0.75 within ``Z`` standard deviations are confirmed
on the full sets.

No bucket is expanded into its pairs.  Equal sets collapse into one
representative first.  Buckets only say which representatives can be
connected: each is linked to the smallest of its bucket, and the connected
families are cut into blocks of bounded size.  A task gets two blocks,
compares packed signatures row by row, skips pairs already known to be
connected, and returns a spanning forest of the confirmed links, so hot
groups spread over tasks and the output stays linear.

A link of similarity 0.75 shares no band with probability below 3e-7
(5e-9 at 0.8), and misses the estimate with probability below 1e-9.

Cases: null, empty or wordless text: no shingles, linked with nothing;
fewer than five words: the whole sequence is the one shingle; repeated rows
of an id are one document; a null id is linked with nothing and kept; other
columns are ignored; no rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harmonia.llm.common import connected_components, cut, in_block_pairs, keyed_runs, sql_type

WORDS = 5
PERCENT = 75
BANDS, ROWS, BITS = 56, 5, 4
HASHES = BANDS * ROWS
Z = 6.0
#: A block holds about this many documents or shingles, whichever is reached first.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1_500_000
#: Word hashes kept per worker; the table is emptied when it is full.
MAX_WORDS = 300_000

_rng = np.random.default_rng(3)
_A = _rng.integers(0, 2**31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES, np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_words: dict[bytes, int] = {}


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct fingerprints of the five-word shingles."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z, split on space and 9 to 13
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) >= MAX_WORDS:
        _words.clear()
    for w in set(words).difference(_words):
        _words[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    code = np.full(count, size, np.uint64)
    for i in range(size):
        code = _mix64(code * _MIX + h[i:i + count])
    return np.unique(code)


def minima(codes: np.ndarray) -> np.ndarray:
    """The smallest value of every hash function over a set."""
    x = (codes >> np.uint64(32)).astype(np.uint32)[:, None]
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(low, (x[i:i + 1024] * _A + _B).min(0), out=low)
    return low


def _fields(low: np.ndarray) -> np.ndarray:
    return (_mix64(low.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(low: np.ndarray) -> bytes:
    """Low bits of the mixed minima, two fields a byte."""
    f = _fields(low)
    return (f[0::2] | f[1::2] << 4).tobytes()


def bands(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    rows = low.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for i in range(ROWS):
        key = _mix64(key * _STEP + rows[:, i])
    return key.view(np.int64)


def least_matches() -> int:
    """Equal fields below which a pair is not within Z deviations of the threshold."""
    hit = PERCENT / 100 + (1 - PERCENT / 100) / (1 << BITS)
    return int(np.floor(HASHES * hit - Z * np.sqrt(HASHES * hit * (1 - hit))))


def similarity(matches: int) -> float:
    """Collision-corrected estimate from the number of equal fields."""
    chance = 1 / (1 << BITS)
    return (matches / HASHES - chance) / (1 - chance)


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, digest`` (of the set), ``bands, sig``; the last three null without shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, keys, sig = [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingles(t)
                n.append(len(s))
                low = minima(s) if len(s) else None
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                keys.append(bands(low) if len(s) else None)
                sig.append(packed(low) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "bands", "sig"])

    return docs.select(doc_id, text).mapInArrow(
        run, f"doc_id {sql_type(docs, doc_id)}, n_shingles bigint, digest binary, bands array<bigint>, sig binary")


def families(reps: DataFrame) -> DataFrame:
    """``rep, family``: representatives that share band keys, directly or through others."""
    keys = reps.select("rep", F.explode("bands").alias("key"))
    first = F.first("rep").over(Window.partitionBy("key").orderBy("rep"))  # the keys move once
    edges = keys.select("rep", first.alias("m")).filter("rep > m")
    found = connected_components(edges, "rep", "m").select(F.col("node").alias("rep"), F.col("component").alias("family"))
    return found.unionByName(found.select(F.col("family").alias("rep"), "family").distinct())


def _links(ids: np.ndarray, side: np.ndarray, sizes: np.ndarray, sig: np.ndarray, texts: list) -> list[tuple[int, int]]:
    """Spanning links among the documents of two blocks (side 0 and 1), or of one (side 2 only)."""
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    one = side[left[0]] == 2 if len(left) else False
    label = np.arange(len(ids))
    cols, col_sizes = sig[right], sizes[right]
    ones = np.uint64(0x1111111111111111)
    sets: dict[int, np.ndarray] = {}
    need, out = least_matches(), []

    def of(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingles(texts[i])
        return sets[i]

    for k, i in enumerate(left):
        js = right[k + 1:] if one else right
        far = slice(k + 1, None) if one else slice(None)
        fits = (label[js] != label[i]) & (100 * np.minimum(col_sizes[far], sizes[i])
                                          >= PERCENT * np.maximum(col_sizes[far], sizes[i]))
        at = np.flatnonzero(fits)
        if not len(at):
            continue
        x = cols[far][at] ^ sig[i]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        same = HASHES - np.bitwise_count(x & ones).sum(1, dtype=np.int64)
        js = js[at[same >= need]]
        if not len(js):
            continue
        js = js[np.argsort(-same[same >= need], kind="stable")]
        mine = of(i)
        for j in js:
            if label[j] == label[i]:
                continue
            theirs = of(j)
            small, big = (mine, theirs) if len(mine) < len(theirs) else (theirs, mine)
            pos = np.searchsorted(big, small)
            both = int((big[np.minimum(pos, len(big) - 1)] == small).sum())
            if 100 * both >= PERCENT * (len(mine) + len(theirs) - both):
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]
    return out


def confirmed_links(members: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Spanning links ``a, b`` inside families; ``members``: ``rep, family, n_shingles, sig``."""
    stats = (members.groupBy("family").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
             .select("family", F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK_ROWS),
                                          F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    texts = docs.select(F.col(doc_id).alias("rep"), F.col(text).alias("text")).filter("rep is not null")
    rows = in_block_pairs(members.join(stats, "family").join(texts, "rep").dropDuplicates(["rep"]), "rep", "blocks")
    rows = rows.select("family", "bi", "bj", "side", "rep", "n_shingles", "sig", "text")
    keys = ["family", "bi", "bj"]
    width = -(-HASHES * BITS // 64) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in keyed_runs(batches, keys):
            sig = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in t.column("sig").to_pylist()), np.uint64)
            out = _links(t.column("rep").to_numpy(), t.column("side").to_numpy(), t.column("n_shingles").to_numpy(),
                         sig.reshape(t.num_rows, -1), t.column("text").to_pylist())
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "rep")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept``."""
    sigs = cut(signatures(docs, doc_id, text))
    known = sigs.filter("digest is not null and doc_id is not null")
    reps = known.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").alias("rep"), "n_shingles", "bands", "sig")).alias("x")).select("digest", "x.*")
    reps = cut(reps)
    members = families(reps).join(reps.select("rep", "n_shingles", "sig"), "rep")
    links = confirmed_links(members, docs, doc_id, text)
    groups = connected_components(links, "a", "b").select(F.col("node").alias("rep"), "component")
    owner = reps.select("digest", "rep").join(groups, "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component"))
    got = sigs.select("doc_id", "n_shingles", "digest").join(owner, "digest", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return got.select("doc_id", "n_shingles", comp.alias("component_id"), F.col("doc_id").eqNullSafe(comp).alias("kept"))
