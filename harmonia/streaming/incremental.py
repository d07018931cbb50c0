"""Incremental ingest of newly delivered files (Structured Streaming).

The reference processes uploads in batches and skips files it has already
seen (S8).  Spark's file source does exactly that, durably: its checkpoint
records every file consumed, so each run with ``availableNow`` processes
only new files and survives driver / executor loss.  Only row-local
operators are applied on the stream (they are pure column expressions);
group-level steps (combine, outliers, synonyms) run in batch on the sink.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmonia.functions import timefn as TF
from harmonia.operators import filters as FL
from harmonia.operators import project as P
from harmonia.operators import taxonomy as X


def clean_rows(df: DataFrame, mapping: dict[str, str] | None = None, comment_col: str | None = None,
               time_col: str | None = "Time", std_sp: bool = True, std_suffix: bool = True) -> DataFrame:
    """Row-local standardisation usable on a batch OR a streaming frame:
    column mapping (P1), drop measurement columns (P6) and empty rows (P8),
    growth-form codes (F8), clock text (T4), comment codes (X1, X2) and
    unknown-name rules (X4)."""
    d = P.standardize_columns(df, mapping or {})
    d = P.drop_cols_matching(d)
    d = P.drop_empty_rows(d)
    if "PhytoForm" in d.columns:
        d = FL.clean_phytoform(d)
    if time_col and time_col in d.columns:
        d = d.withColumn(time_col, TF.clean_time_text(F.col(time_col)))
    cc = comment_col if comment_col in d.columns else None
    d = X.add_qc_col(d, cc)
    d = X.add_debris_col(d, cc)
    if "Taxon" in d.columns:
        d = d.withColumn("Taxon", X.clean_unknowns_expr(F.col("Taxon"), std_sp, std_suffix))
    return d.withColumn("_source_file", F.col("_metadata.file_name"))


def ingest_new_files(spark: SparkSession, src_dir: str, schema: T.StructType, out_dir: str,
                     checkpoint: str | None = None, fmt: str = "csv", **clean_opts) -> int:
    """Process every file in ``src_dir`` not processed before, append the
    cleaned rows to ``out_dir`` (Parquet) and return the number of new rows.
    The checkpoint defaults to a folder under the cluster's shared
    ``spark.checkpoint.dir``."""
    from harmonia.session import checkpoint_dir
    if checkpoint is None:
        place = os.path.normpath(out_dir)  # the whole path: outputs of one name are different outputs
        checkpoint = os.path.join(checkpoint_dir(spark), "ingest",
                                  f"{os.path.basename(place)}-{hashlib.sha256(place.encode()).hexdigest()[:16]}")
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(src_dir)
    cleaned = clean_rows(stream, **clean_opts)
    q = (cleaned.writeStream.format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = sum(p.get("numInputRows", 0) for p in q.recentProgress)
    return int(rows)
