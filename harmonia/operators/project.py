"""Schema and projection operators (rename, subset, pad, coalesce,
drop by pattern, drop empty rows, per-survey dispatch)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmonia.frame import ROW_ID, Result, null_safe_join, require_columns
from harmonia.functions.exprs import all_of, r_paste_value

# The 33 standard output columns in order.
STANDARD_COLUMNS = [
    "Event_ID", "Survey", "Date", "Time", "SampleScheme", "Location", "Station", "Latitude",
    "Longitude", "SampleMethod", "SampleDepth", "DepthType", "TowNetRadius", "Lab",
    "CountMethodSample", "CountMethodTaxa", "Magnification", "OrigTaxon", "Taxon", "Kingdom",
    "Phylum", "Class", "AlgalGroup", "Genus", "Species", "Cells_per_mL", "Units_per_mL",
    "Biovolume_per_mL", "GALD", "PhytoForm", "QualityCheck", "Debris", "Notes",
]

# Default raw -> standard renames of a lab count sheet (standard: raw).
DEFAULT_RENAMES = {
    "Date": "SampleDate",
    "Time": "SampleTime",
    "Station": "StationCode",
    "SampleDepth": "Depth (m)",
    "GALD": "GALD 1",
    "PhytoForm": "Colony/Filament/Individual Group Code",
}

# Taxonomy columns removed before re-deriving them.
TAXA_INFO_COLUMNS = ["kingdom", "phylum", "class", "algalgroup", "genus", "species"]

# Default pairs of equivalent columns (new: [first, second]).
DEFAULT_COALESCE = {
    "Unit Abundance": ["Unit Abundance (# of Natural Units)", "Unit Abundance"],
    "Total Number of Cells": ["Total Number of Cells", "Number of cells per unit"],
}


def standardize_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename raw -> standard where the raw column is present."""
    ren = {raw: std for std, raw in mapping.items() if raw in df.columns and raw != std}
    return df.withColumnsRenamed(ren) if ren else df


def rename_cols(df: DataFrame, rename_map: dict[str, str] | None = None) -> Result:
    """Rename standard <- raw; every raw column must exist."""
    rename_map = rename_map or DEFAULT_RENAMES
    require_columns(df, list(rename_map.values()))
    out = df.withColumnsRenamed({raw: std for std, raw in rename_map.items()})
    spark = df.sparkSession
    log = spark.createDataFrame([(raw, std) for std, raw in rename_map.items()],
                                "from_col string, to_col string")
    return Result(out, {"renamed_columns": log})


def subset_cols(df: DataFrame, subset: list[str] | None = None,
                remove_cols: list[str] | None = None) -> Result:
    """Project to a fixed ordered list (error if one is missing); the
    dropped columns are reported."""
    cols = [c for c in (subset or STANDARD_COLUMNS) if c not in set(remove_cols or [])]
    require_columns(df, cols)
    dropped = [c for c in df.columns if c not in cols and c != ROW_ID]
    spark = df.sparkSession
    log = spark.createDataFrame([(c,) for c in dropped], "dropped_column string")
    return Result(df.select(*cols), {"dropped_columns": log})


def pad_subset(df: DataFrame, cols: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """keep/reorder ``cols``; absent ones are added as NULL."""
    types = types or {}
    return df.select(*[F.col(c) if c in df.columns
                       else F.lit(None).cast(types.get(c, "string")).alias(c) for c in cols])


def coalesce_cols(df: DataFrame, combine_map: dict[str, list[str]] | None = None) -> DataFrame:
    """P5: merge pairs of equivalent columns into one; the redundant ones go."""
    for new, (a, b) in (combine_map or DEFAULT_COALESCE).items():
        df = df.withColumn(new, F.coalesce(F.col(a), F.col(b)))
        drop = [b] if new == a else [a] if new == b else [a, b]
        df = df.drop(*drop)
    return df


def drop_cols_matching(df: DataFrame, pattern: str = r"^(Dimension|Measure)") -> DataFrame:
    """Drop every column whose name matches ``pattern``."""
    rx = re.compile(pattern)
    return df.drop(*[c for c in df.columns if rx.search(c)])


def remove_taxa_info(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Drop taxonomy columns, names compared case-insensitively."""
    names = set(names or TAXA_INFO_COLUMNS)
    return df.drop(*[c for c in df.columns if c.lower() in names])


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every value is NULL (continuation rows)."""
    cols = [c for c in df.columns if c != ROW_ID]
    return df.where(~all_of(F.col(c).isNull() for c in cols))


def extract_program_taxa(df: DataFrame, orig: str = "OrigTaxon", taxon: str = "Taxon") -> DataFrame:
    """Taxon := original name when it is a single name, then P7."""
    o = F.col(orig)
    df = df.withColumn(taxon, F.when(o.isNotNull() & ~o.contains(";"), o).otherwise(F.col(taxon)))
    return remove_taxa_info(df)


def cast_all_but(df: DataFrame, keep: tuple[str, ...] = ("Date",), to: str = "string") -> DataFrame:
    """P10: cast every column except ``keep`` to one type (schema alignment)."""
    return df.select(*[F.col(c) if c in keep else F.col(c).cast(to).alias(c) for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def relocate(df: DataFrame, cols: list[str], before: str | None = None) -> DataFrame:
    """Move ``cols`` to the front (or before ``before``)."""
    rest = [c for c in df.columns if c not in cols]
    if before is None:
        return df.select(*cols, *rest)
    i = rest.index(before)
    return df.select(*rest[:i], *cols, *rest[i:])


def add_constants(df: DataFrame, values: dict) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def overwrite_from(df: DataFrame, other: DataFrame, on: list[str], fields: dict[str, str],
                   how: str = "left") -> DataFrame:
    """Join ``other`` and overwrite ``fields`` (target: source) with the
    joined value where it is present."""
    o = other.select(*on, *[F.col(src).alias(f"__o_{tgt}") for tgt, src in fields.items()])
    j = null_safe_join(df, o, on, how)
    return j.withColumns({t: F.coalesce(F.col(f"__o_{t}"), F.col(t)) for t in fields}) \
            .drop(*[f"__o_{t}" for t in fields])


def taxonomy_path(cols=("Kingdom", "Phylum", "Class", "Genus", "Species"), sep: str = "/"):
    """``paste(..., sep='/')``: NULL prints as ``NA``."""
    return F.concat_ws(sep, *[r_paste_value(c) for c in cols])


def dispatch(df: DataFrame, key: str, formatters: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Choose a transform chain by group name; identity by default."""
    fn = formatters.get(key)
    return fn(df) if fn else df


def by_group_formula(group_col: str, formulas: dict[str, object], default=None):
    """One CASE over the group column instead of a per-group map."""
    expr = None
    for k, f in formulas.items():
        expr = (F.when(F.col(group_col) == k, f) if expr is None
                else expr.when(F.col(group_col) == k, f))
    return expr.otherwise(default) if default is not None else expr
