"""CSV / Parquet sinks and the transposed matrix export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmonia.frame import null_safe_join
from harmonia.operators.grids import number_rows


def write_csv(df: DataFrame, path: str, na: str = "", mode: str = "overwrite") -> None:
    """CSV with a header; NULL written as ``na`` (empty by default)."""
    df.write.mode(mode).option("header", True).option("nullValue", na).option("emptyValue", "").csv(path)


def write_log(log: DataFrame | None, path: str) -> bool:
    """Write an audit table only if it exists and has at least one row."""
    if log is None or log.isEmpty():
        return False
    write_csv(log, path)
    return True


def write_by_key(df: DataFrame, path: str, key: str = "Survey", keep_key: bool = True,
                 fmt: str = "csv") -> None:
    """One folder per key value (``partitionBy``).  With ``keep_key`` the
    key is also kept inside the files, as the per-program CSVs do.  Rows are
    gathered by key, and a large key is split over several tasks and files."""
    out = df.withColumn(f"__part_{key}", F.col(key)) if keep_key else df
    part = f"__part_{key}" if keep_key else key
    w = out.hint("rebalance", F.col(part)).write.mode("overwrite").partitionBy(part)
    if fmt == "csv":
        w.option("header", True).option("nullValue", "").csv(path)
    else:
        w.parquet(path)


def write_program(df: DataFrame, path: str) -> None:
    """Persist one program's harmonised frame (Parquet)."""
    df.write.mode("overwrite").parquet(path)


def _numbered_samples(meta: DataFrame, com_long: DataFrame, sample_cols: list[str]) -> tuple[DataFrame, int]:
    """The distinct samples with their number ``__sid`` from 1, and how many there are."""
    samples = meta.select(*sample_cols).distinct()
    numbered = number_rows(samples, sample_cols, "__sid")
    found = com_long.select(*sample_cols).distinct()
    n = samples.count()
    if n != found.count() or n != null_safe_join(found, samples, sample_cols, "left_semi").count():
        raise ValueError("metadata and community matrix must have the same samples")
    return numbered, n


def _matrix_cells(meta: DataFrame, com_long: DataFrame, numbered: DataFrame, sample_cols: list[str], taxa_var: str,
                  value: str, meta_as_factors: bool) -> DataFrame:
    """The filled cells: block (2 taxa, 4 metadata), Variable, sample number, text."""
    body = null_safe_join(com_long, numbered, sample_cols).select(
        F.lit(2).alias("block"), F.col(taxa_var).cast("string").alias("Variable"), "__sid",
        F.col(value).cast("string").alias("v"))
    mcols = [c for c in meta.columns if c not in sample_cols]
    if meta_as_factors and mcols:
        m = null_safe_join(meta, numbered, sample_cols).select("__sid", *[F.col(c).cast("string").alias(c) for c in mcols])
        body = body.unionByName(m.unpivot(["__sid"], mcols, "Variable", "v")
                                 .select(F.lit(4).alias("block"), "Variable", "__sid", "v"))
    return body


def matrix_export(meta: DataFrame, com_long: DataFrame, sample_cols: list[str], taxa_var: str = "Taxon",
                  value: str = "value", title: str = "Environmental variables",
                  meta_as_factors: bool = True) -> DataFrame:
    """S13 as a table: samples as columns (``R1..Rn`` in sample order): a title
    row, the sample-id row, one row per taxon, a blank row, then one row per
    metadata variable.  One column per sample, so for a few thousand samples at
    most; ``matrix_lines`` has no such bound.  Samples match on their
    columns, NULLs included.  Errors when metadata and matrix disagree on them."""
    numbered, n = _numbered_samples(meta, com_long, sample_cols)
    numbered = numbered.withColumn("__sid", F.concat(F.lit("R"), F.col("__sid").cast("string")))
    ids = [f"R{i + 1}" for i in range(n)]
    body = _matrix_cells(meta, com_long, numbered, sample_cols, taxa_var, value, meta_as_factors)
    wide = body.groupBy("block", "Variable").pivot("__sid", ids).agg(F.first("v"))
    heads = meta.sparkSession.createDataFrame([(0, title), (1, None), (3, "")], "block int, Variable string")
    heads = heads.select("block", "Variable", *[F.when(F.col("block") == 1, i).otherwise("").alias(i) for i in ids])
    return heads.unionByName(wide).orderBy("block", "Variable")


def _csv_cell(c: Column) -> Column:
    return F.when(c.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def matrix_lines(meta: DataFrame, com_long: DataFrame, sample_cols: list[str], taxa_var: str = "Taxon",
                 value: str = "value", title: str = "Environmental variables",
                 meta_as_factors: bool = True) -> DataFrame:
    """S13 as text lines (``block, Variable, line``): the rows of
    ``matrix_export`` as CSV, for any number of samples.

    Samples are numbered by range offsets; a line is put together from the
    filled cells of its variable, with as many commas before a cell as sample
    numbers lie between it and the one before, so that no plan or row has a
    column per sample and empty cells are never made."""
    numbered, n = _numbered_samples(meta, com_long, sample_cols)
    body = _matrix_cells(meta, com_long, numbered, sample_cols, taxa_var, value, meta_as_factors)
    body = body.where(F.col("v").isNotNull()).groupBy("block", "Variable", "__sid").agg(F.first("v").alias("v"))
    lines = body.groupBy("block", "Variable").agg(F.array_sort(F.collect_list(F.struct("__sid", "v"))).alias("cells"))
    gaps = F.transform("cells", lambda c, i: F.concat(
        F.repeat(F.lit(","), (c["__sid"] - F.when(i > 0, F.get(F.col("cells"), i - 1)["__sid"]).otherwise(0)).cast("int")),
        _csv_cell(c["v"])))
    last = F.element_at("cells", -1)["__sid"]
    text = F.concat(_csv_cell(F.coalesce("Variable", F.lit(""))), F.array_join(gaps, ""),
                    F.repeat(F.lit(","), (F.lit(n) - last).cast("int")))
    lines = lines.select("block", "Variable", text.alias("line"))
    ids = F.concat(F.lit(","), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(
        F.lit("R"), i.cast("string"))), ",")) if n else F.lit("")
    blank = F.repeat(F.lit(","), F.lit(n))
    heads = meta.sparkSession.createDataFrame([(0, title), (1, None), (3, "")], "block int, Variable string")
    heads = heads.select("block", "Variable", F.when(F.col("block") == 1, ids).otherwise(
        F.concat(_csv_cell(F.coalesce("Variable", F.lit(""))), blank)).alias("line"))
    return heads.unionByName(lines)


def write_matrix(lines: DataFrame, path: str) -> None:
    """Writes ``matrix_lines`` as text files whose names sort in the order of the lines."""
    (lines.repartitionByRange(F.col("block"), F.col("Variable")).sortWithinPartitions("block", "Variable")
     .select(F.col("line").alias("value")).write.mode("overwrite").text(path))
