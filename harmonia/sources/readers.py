"""Scans.

``read_table`` is the one place that decides scan parallelism: a scan that
yields fewer partitions than the session's default parallelism (a small
single-row-group file) is spread round-robin so the per-row work after it
uses every core.  Real inputs (many files / row groups) already have more
splits than cores and are left as they are -- no extra shuffle at scale.
"""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD_MIN_BYTES = 512 * 1024


def _size(path: str) -> int:
    try:
        if os.path.isdir(path):
            return sum(os.path.getsize(os.path.join(r, f)) for r, _, fs in os.walk(path) for f in fs)
        return os.path.getsize(path)
    except OSError:
        return 0


def spread(df: DataFrame, nbytes: int | None = None) -> DataFrame:
    """Round-robin repartition a scan that has fewer splits than cores."""
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    if nbytes is not None and nbytes < SPREAD_MIN_BYTES:
        return df
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", row_id: str | None = None,
               **options) -> DataFrame:
    """Scan a table.  With ``row_id`` the row's scan position is attached
    BEFORE any spreading, so "first row" semantics follow the file order."""
    df = spark.read.format(fmt).options(**options).load(path)
    if row_id:
        df = df.withColumn(row_id, F.monotonically_increasing_id())
    return spread(df, _size(path))


# --- S1-S3 CSV scans -----------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             date_formats: dict[str, str] | None = None, **options) -> DataFrame:
    """CSV with a header; explicit schema (no inference pass) when given;
    ``date_formats`` parses named columns with ``try_to_date``."""
    r = spark.read.option("header", True)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)
    for c, fmt in (date_formats or {}).items():
        df = df.withColumn(c, F.try_to_date(F.col(c).cast("string"), fmt))
    return spread(df, _size(path))


def read_all_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every file read as text columns, columns unioned by name (absent
    ones NULL), rows appended in file order (``_file_index`` keeps it)."""
    frames = []
    for i, p in enumerate(paths):
        df = spark.read.option("header", True).option("inferSchema", False).csv(p)
        frames.append(df.withColumn("_file_index", F.lit(i)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_typed_by_name(spark: SparkSession, path: str, date_pattern: str = r"Date|Time",
                           date_format: str = "M/d/yyyy") -> DataFrame:
    """S3: read as text; columns whose name matches the pattern become dates,
    others numbers where every value they have is one (one aggregate tells)."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    rx = re.compile(date_pattern)
    out = {c: F.try_to_date(F.col(c), date_format) for c in df.columns if rx.search(c)}
    others = [c for c in df.columns if c not in out]
    if others:
        number = [F.col(c).try_cast("double") for c in others]
        seen = df.agg(*[((F.count(F.col(c)) > 0) & (F.count(F.col(c)) == F.count(n))).alias(f"c{i}")
                        for i, (c, n) in enumerate(zip(others, number))]).first()
        out.update({c: n for i, (c, n) in enumerate(zip(others, number)) if seen[f"c{i}"]})
    return df.withColumns(out) if out else df


# --- S4-S6 metadata / taxonomy ----------------------------------------------------------

def read_meta(meta: DataFrame, program: str, survey_col: str = "Survey", end: str = "Ending Date",
              today: str = "2100-01-01") -> DataFrame:
    """A survey's metadata rows; open end -> ``today`` (a parameter)."""
    return meta.where(F.col(survey_col) == program).withColumn(
        end, F.coalesce(F.col(end), F.lit(today).cast("date")))


TAXA_COLUMNS = ["Kingdom", "Phylum", "Class", "AlgalGroup", "Genus", "Species", "Taxon", "CurrentTaxon"]


def read_taxa(taxa: DataFrame) -> DataFrame:
    """The taxonomy reference, 8 columns."""
    return taxa.select(*TAXA_COLUMNS)


def parse_mixed_date(c):
    """A date given as a date, a spreadsheet serial, or ``M/d/yyyy`` text."""
    from harmonia.functions.timefn import excel_serial_to_date
    s = c.cast("string")
    return F.coalesce(F.try_to_date(s, "yyyy-MM-dd"),
                      F.when(s.rlike(r"^\d+(\.\d+)?$"), excel_serial_to_date(s)),
                      F.try_to_date(s, "M/d/yyyy"))


def build_metadata(sheet: DataFrame, fill_cols: list[str], order_col: str,
                   start: str = "Starting Date", end: str = "Ending Date",
                   today: str = "2100-01-01") -> DataFrame:
    """Ragged sheet -> metadata table: carry the last non-NULL value down
    for ``fill_cols`` (distributed scan, see grids.fill_down), parse the
    mixed date cells, open end -> ``today``."""
    from harmonia.operators.grids import fill_down
    filled = fill_down(sheet, fill_cols, [order_col])
    return filled.withColumn(start, parse_mixed_date(F.col(start))).withColumn(
        end, F.coalesce(parse_mixed_date(F.col(end)), F.lit(today).cast("date")))


# --- S8 ingest manifest ---------------------------------------------------------------

def _csv_cells(line: Column) -> Column:
    """The cells of one CSV line: quoted ones without their quotes, empty ones NULL."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))

    def cell(c: Column) -> Column:
        bare = F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(c.startswith('"'), bare).otherwise(F.trim(c)), F.lit(""))

    return F.transform(raw, cell)


def read_uploads(spark: SparkSession, files: list[str] | str, root: str | None = None) -> DataFrame:
    """Every line of the uploaded CSV files in one scan, with the file it is from
    (``name``: the file name, or the path below folder ``root``), its cells and
    the file's ``header`` cells.  Files may have different columns in any
    order; a cell cannot hold a line break.

    The first line of every block of a file is found by counting alone (no
    sort of lines, no text in the aggregate); one line a file is then read as
    its header."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    below = "[^/]*$" if root is None else f"(?<=/{re.escape(os.path.basename(os.path.normpath(root)))}/).*$"
    lines = spark.read.text(files).select(
        F.regexp_extract(path, below, 0).alias("name"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")).alias("at"),
        F.regexp_replace("value", "^\ufeff|\r$", "").alias("line"))
    lines = lines.where(F.trim("line") != "")
    firsts = lines.groupBy("name", F.col("at.block").alias("block")).agg(F.min("at.id").alias("id"))
    firsts = firsts.groupBy("name").agg(F.min(F.struct("block", "id")).alias("head_at"))
    heads = (lines.select(F.col("name").alias("__name"), "at", "line")
             .join(F.broadcast(firsts), (F.col("__name") == F.col("name")) & (F.col("at.id") == F.col("head_at.id"))
                   & (F.col("at.block") == F.col("head_at.block")))
             .select("name", "head_at", _csv_cells(F.col("line")).alias("header")))
    # one row a file, as many as the caller listed: sent to the lines, which would
    # otherwise all be sorted by file, a whole file in one task
    return lines.withColumn("cells", _csv_cells(F.col("line"))).join(F.broadcast(heads), "name")


def _named(name: str) -> Column:
    """A line's cell in the column of that name; NULL where the file has none."""
    return F.get("cells", F.array_position("header", name).cast("int") - 1)


def _upload_findings(columns: dict) -> list[tuple[str, Column]]:
    """Per declared column and rule: the error text and whether the lines of a file break the
    rule.  Flags only are aggregated: Spark hashes those, where texts would make it sort every line."""
    data, out = ~F.col("is_head"), []

    def found(name: str, hit: Column, text: str) -> None:
        out.append((f"{name}: {text}", F.coalesce(F.max(F.when(hit, F.lit(1))), F.lit(0)) == 1))

    for name, spec in columns.items():
        v, num = _named(name), _named(name).try_cast("double")
        if spec.get("required"):
            found(name, F.coalesce(F.array_position("header", name), F.lit(0)) == 0, "missing required column")
        if spec.get("type") == "integer":
            found(name, data & v.isNotNull() & num.isNull(), "not numeric")
        if spec.get("type") == "character":
            plain = num.isNotNull() | F.lower(v).isin("true", "false") | F.try_to_date(v, "yyyy-MM-dd").isNotNull()
            some = F.max(F.when(data & v.isNotNull(), plain.cast("int")))
            every = F.min(F.when(data & v.isNotNull(), plain.cast("int")))
            out.append((f"{name}: not character", F.coalesce((some == 1) & (every == 1), F.lit(False))))
        if "min" in spec:
            found(name, data & (num < spec["min"]), "below min")
        if "max" in spec:
            found(name, data & (num > spec["max"]), "above max")
        if spec.get("allowed_values"):
            found(name, data & v.isNotNull() & ~v.isin(*spec["allowed_values"]), "not allowed")
    found("line", data & (F.size("cells") != F.size("header")), "number of cells is not that of the header")
    return out


def ingest_manifest(spark: SparkSession, files: list[str], schema: dict, seen: list[str] | DataFrame | None = None,
                    manifest_path: str | None = None, root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The new files read in one scan and validated in one grouped
    aggregate.  Returns (manifest: name, status, errors, n_rows; rows of the
    valid files, ``_source_file`` and the declared columns, numbers as
    doubles, other columns as a map ``_other``).

    Names (of the files, or their paths below ``root``) seen before (a list, or a
    manifest's ``name`` column) are skipped, as are repeated names.  A file without a header line, or that cannot be
    found, is a manifest entry and no crash.  With ``manifest_path`` the
    manifest is appended there in one atomic Parquet commit, from which
    ``seen`` is read as well.
    """
    from harmonia.session import checkpoint_dir
    checkpoint_dir(spark)
    under = f"/{os.path.basename(os.path.normpath(root))}/" if root else "/"
    names = [(p.split(under, 1)[1] if root else p.rsplit("/", 1)[-1], p) for p in files]
    listed = spark.createDataFrame(names, "name string, path string")
    listed = listed.groupBy("name").agg(F.min("path").alias("path"))
    known = [seen] if isinstance(seen, DataFrame) else [spark.createDataFrame([(s,) for s in seen], "name string")] if seen else []
    if manifest_path and _exists(spark, manifest_path):
        known.append(spark.read.parquet(manifest_path))
    for k in known:
        listed = listed.join(k.select("name"), "name", "left_anti")
    listed = listed.checkpoint()
    new = [r["path"] for r in listed.collect()]  # names given by the caller, as a list
    there = [p for p in new if _exists(spark, p)]
    columns = schema.get("columns", {})
    if there:
        rows = read_uploads(spark, there, root).withColumn("is_head", F.col("at") == F.col("head_at"))
        rules = _upload_findings(columns)
        found = F.array(*[F.when(broken, F.lit(text)) for text, broken in rules])
        checked = rows.groupBy("name").agg(
            F.array_compact(found).alias("errors"), F.count(F.when(~F.col("is_head"), 1)).alias("n_rows"))
    else:
        rows = None
        checked = spark.createDataFrame([], "name string, errors array<string>, n_rows long")
    absent = F.when(F.col("path").isin(there) if there else F.lit(False), "No header line").otherwise("Could not read file")
    manifest = (listed.join(checked, "name", "left")
                .select("name", F.coalesce("errors", F.array(absent)).alias("errors"), F.coalesce("n_rows", F.lit(0)).alias("n_rows")))
    manifest = manifest.select("name", F.when(F.size("errors") == 0, "valid").otherwise("invalid").alias("status"),
                               "errors", "n_rows").checkpoint()
    if manifest_path:
        manifest.write.mode("append").parquet(manifest_path)
    kinds = {n: "double" if s.get("type") == "integer" else "string" for n, s in columns.items()}
    if rows is None:
        return manifest, spark.createDataFrame([], ", ".join(
            ["_source_file string", *[f"`{n}` {k}" for n, k in kinds.items()], "_other map<string,string>"]))
    valid = rows.where(~F.col("is_head")).join(F.broadcast(manifest.where("status = 'valid'").select("name")), "name", "left_semi")
    pairs = F.arrays_zip(F.col("header").alias("k"), F.col("cells").alias("v"))
    other = F.map_from_entries(F.filter(pairs, lambda x, i: (F.array_position("header", x["k"]) == i + 1)
                                        & ~x["k"].isin(*kinds, "")))
    return manifest, valid.select(F.col("name").alias("_source_file"),
                                  *[_named(n).try_cast(k).alias(n) for n, k in kinds.items()], other.alias("_other"))


def list_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """The files below a folder, on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found, out = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True), []
    while found.hasNext():
        path = found.next().getPath().toString()
        if path.endswith(suffix):
            out.append(path)
    return sorted(out)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# --- S11 persisted programs ------------------------------------------------------------

def read_programs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every persisted program (Parquet) unioned by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [spark.read.parquet(p) for p in paths])
