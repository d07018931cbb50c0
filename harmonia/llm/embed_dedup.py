"""Operator 2: near-duplicate vectors by randomised-rotation binary codes.

Vectors are normalised and rotated by seeded random rotations; the signs are
the code, and the inner product of the rotated vector with its own sign
vector is stored as the code's correction factor.  The signs of one vector,
divided by its factor, give an unbiased estimate of its inner product with
another one; the spread of the estimate shrinks with the angle, so a true
link at the threshold is known to score above a bound.  Pairs below it are
dropped, the others are recomputed exactly in double precision.

Candidates share the 16 signs of a band (40 bands): a link at 0.98 shares
none with probability 4e-8.  A pair is handled only in its first common
band, where its links are counted and joined, so pairs are never written.
Equal vectors collapse into one class with a count first; large buckets are
cut into blocks that meet in pairs.

Cases: null labels; null, empty or zero vectors, and vectors with null or
non-finite components link with nothing; vectors of different lengths are
not compared; repeated rows are vectors of their own (each counts as a
link); a null id is linked with nothing and kept; other columns are ignored;
no rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmonia.llm.common import connected_components, cut, in_block_pairs, keyed_runs

THRESHOLD = 0.98
BANDS, BAND_BITS = 40, 16
BITS = BANDS * BAND_BITS
#: Standard deviations of the estimate allowed to a true link.
Z = 6.0
#: Vectors per block of a bucket.
BLOCK_ROWS = 2048


@lru_cache(maxsize=8)
def rotations(dim: int) -> np.ndarray:
    """Stacked random rotations, one sign bit a row (at least BITS rows)."""
    rng = np.random.default_rng(dim)
    return np.vstack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-BITS // dim))])


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated unit vectors, packed signs, and correction factors by rotation."""
    dim = x.shape[1]
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    y = unit @ rotations(dim).T
    factors = np.abs(y).reshape(len(x), -1, dim).sum(2) / np.sqrt(dim)
    return y, np.packbits(y[:, :BITS] >= 0, axis=1), factors


def estimates(y: np.ndarray, signs: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Unbiased inner products of rotated vectors (rows) with coded ones (columns)."""
    dim = y.shape[1] // factors.shape[1]
    scale = np.repeat(1 / (factors * np.sqrt(dim) * factors.shape[1]), dim, axis=1)
    return y.astype(np.float32) @ (signs * scale).astype(np.float32).T


def margins(factors: np.ndarray, dim: int, threshold: float) -> np.ndarray:
    """How far a link at the threshold may be estimated below it, by coded vector."""
    if dim < 4:
        return np.full(len(factors), np.inf)
    spread = ((1 - np.minimum(factors, 1) ** 2) / factors ** 2 / (dim - 1)).sum(1)
    return Z * np.sqrt(1 - threshold ** 2) * np.sqrt(spread) / factors.shape[1]


def _usable(vec: Column, label: Column) -> Column:
    whole = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(vec) > 0) & whole & F.exists(vec, lambda v: v != 0), F.lit(False))


def sketch(classes: DataFrame) -> DataFrame:
    """Add ``keys`` (one per band, with label and length mixed in) to ``rep, label, embedding, n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vecs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            keys: list = [None] * len(vecs)
            for dim in sorted(set(map(len, vecs))):
                at = [i for i, v in enumerate(vecs) if len(v) == dim]
                _, code, _ = encode(np.array([vecs[i] for i in at], np.float64))
                word = code.view(">u2").astype(np.uint64) | (np.arange(BANDS, dtype=np.uint64) << np.uint64(16))
                for i, w in zip(at, word):
                    seed = np.uint64(xxhash.xxh3_64_intdigest(f"{labels[i]}:{dim}"))
                    z = (w + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ seed
                    z = (z ^ z >> np.uint64(31)) * np.uint64(0xC2B2AE3D27D4EB4F)
                    keys[i] = (z ^ z >> np.uint64(29)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "keys"])

    classes = classes.select("rep", "label", "embedding", "n")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, fields + ", keys array<bigint>")


def _links(key: int, t: pa.Table, threshold: float) -> dict | None:
    """Links of one pair of blocks of a bucket: weighted counts, and a root per vector."""
    ids, side, n = (t.column(c).to_numpy() for c in ("rep", "side", "n"))
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    if not len(left) or not len(right):
        return None
    x = np.array(t.column("embedding").to_pylist(), np.float64)
    keys = np.array(t.column("keys").to_pylist(), np.int64)
    y, _, factors = encode(x)
    low = threshold - margins(factors[right], x.shape[1], threshold)
    norm = np.sqrt((x * x).sum(1))
    band = int(np.flatnonzero(keys[0] == key)[0])
    signs = np.where(y[right] >= 0, 1.0, -1.0)
    root, count = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    for a in range(0, len(left), 256):
        rows = left[a:a + 256]
        maybe = estimates(y[rows], signs, factors[right]) >= low - 1e-6
        for k, i in enumerate(rows):
            js = right[maybe[k]]
            if side[i] == 2:
                js = js[js > i]
            js = js[~(keys[js, :band] == keys[i, :band]).any(1)]  # handled in an earlier band
            js = js[(x[js] @ x[i]) / (norm[js] * norm[i]) >= threshold]
            if len(js):
                count[i] += n[js].sum()
                count[js] += n[i]
                for r in set(root[js].tolist()):
                    root[root == r] = root[i]
    hit = np.flatnonzero(count)
    return {"rep": ids[hit], "links": count[hit], "root": ids[root[hit]]} if len(hit) else None


def class_links(sketches: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``rep, links, root`` by bucket: weighted links found there, and a class it is connected to."""
    pairs = sketches.select("rep", F.explode("keys").alias("key"))
    sizes = (pairs.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
             .select("key", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("blocks")))
    rows = pairs.join(sizes, "key").join(sketches.select("rep", "n", "embedding", "keys"), "rep")
    keys = ["key", "bi", "bj"]
    dealt = (in_block_pairs(rows, "rep", "blocks").select(*keys, "side", "rep", "n", "embedding", "keys")
             .repartition(*keys).sortWithinPartitions(*keys, "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, _, _), t in keyed_runs(batches, keys):
            if out := _links(key, t, threshold):
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return dealt.mapInArrow(run, "rep bigint, links bigint, root bigint")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``."""
    v = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    ok = v.filter(_usable(F.col("embedding"), F.col("label")) & F.col("vec_id").isNotNull())
    classes = cut(sketch(ok.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))))
    found = cut(class_links(classes, threshold))
    groups = connected_components(found, "rep", "root").select(F.col("node").alias("rep"), "component")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    owner = (classes.select("label", "embedding", "rep", "n").join(counts, "rep", "left").join(groups, "rep", "left")
             .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                     F.coalesce("component", "rep").alias("component"))
             .withColumn("_ok", F.lit(True)))
    got = (v.withColumn("_ok", _usable(F.col("embedding"), F.col("label")) & F.col("vec_id").isNotNull())
           .join(owner, ["label", "embedding", "_ok"], "left"))
    comp = F.coalesce("component", "vec_id")
    return got.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), comp.alias("component_id"),
                      F.col("vec_id").eqNullSafe(comp).alias("kept"))
