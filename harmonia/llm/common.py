"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harmonia.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Letters, numbers and white space up to U+00FF, as in the Unicode classes.
LATIN_L = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
LATIN_N = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
LATIN_S = "\\t-\\r\\x20\u0085\u00a0"


def is_latin(text: str) -> bool:
    """All characters are below U+0100."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sql_type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def tidy(work):
    """``work`` of a task; at its end, memory that is no longer used goes back to
    the system, as Python workers are kept for later stages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)

    return run


def keyed_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Split the batches of one partition, sorted by ``keys``, into one table per key.

    Only the rows of the current key are held.
    """
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*cols))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[start]:
                if current is not None and rows[start] != current:
                    yield current, pa.Table.from_batches(held)
                    held = []
                current = rows[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield current, pa.Table.from_batches(held)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Label every node of ``edges`` with the smallest node it can reach.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): the
    edge list never grows, and the number of rounds is logarithmic in
    practice.  A round has three exchanges, as every exchange leaves files for
    each of its tasks until the driver collects its garbage; equal edges are
    dropped where the next round meets them.  Every round is cut by a reliable
    checkpoint, the last is the one that moves nothing.  Returns ``node``,
    ``component`` for nodes that are not their own component's smallest node;
    null ends are ignored.
    """
    cur = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
              .filter("u > v").distinct())
    by_u = Window.partitionBy("u").orderBy("v")
    while True:
        # large star: neighbours above v move to the smallest neighbour of v
        low = cur.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        large = (cur.join(low, F.col("v") == F.col("w"), "left")
                 .select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved")))
        # small star: u's other neighbours below it move to the smallest of them
        small = (large.withColumns({"m": F.first("v").over(by_u), "last": F.lag("v").over(by_u)})
                 .filter("last is null or last < v")
                 .select(F.when(F.col("last").isNull(), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("m").alias("v"), (F.col("moved") | F.col("last").isNotNull()).alias("moved")))
        cur = cut(small)
        if cur.filter("moved").isEmpty():  # every node has one edge, to a node without any: a star each
            break
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))


def in_block_pairs(rows: DataFrame, id_col: str, blocks: str) -> DataFrame:
    """Deal the rows of a group into all pairs of its blocks.

    ``blocks`` holds the group's number of blocks; a row goes to one block by
    its id's hash and is copied once per other block.  Adds ``bi``, ``bj``
    and ``side``: 0 and 1 for the rows of the lower and the higher block, 2
    where a block meets itself.
    """
    rows = rows.withColumn("_b", F.pmod(F.xxhash64(id_col, F.lit("block")), F.col(blocks)).cast("int"))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    return rows.withColumns({
        "bi": F.least("_b", "_o"), "bj": F.greatest("_b", "_o"),
        "side": F.when(F.col("_b") == F.col("_o"), 2).when(F.col("_b") < F.col("_o"), 0).otherwise(1)}).drop("_b", "_o")
