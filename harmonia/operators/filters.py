"""Row filters and value recodes, each with its audit table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmonia.frame import Result, null_safe_join, require_columns
from harmonia.functions.exprs import all_of, any_of

DENSITY_COLUMNS = ["Cells_per_mL", "Units_per_mL", "Biovolume_per_mL"]
# Fixed value: taxon text that marks an empty sample that must be kept.
NO_ORGANISMS = "No organisms observed"
# Junk growth-form codes that mean "missing".
PHYTOFORM_JUNK = ["n/p", "na", "#n/a", "0", "1"]


def remove_nodata(df: DataFrame, density_cols=tuple(DENSITY_COLUMNS), taxon: str = "Taxon") -> Result:
    """zero densities become NULL; rows whose densities are then all NULL
    are dropped unless the taxon says no organisms were observed.

    Logs ``zeros_to_na`` (the rows as they were before the change) and
    ``nodata`` (removed rows).  A NULL taxon with no data is dropped but not
    logged (three-valued filter, as in the source).  ``zero_count`` holds the
    number of zero cells converted."""
    cols = list(density_cols)
    require_columns(df, cols)
    is_zero = [F.col(c).isNotNull() & (F.col(c) == 0) for c in cols]
    zeros = df.where(any_of(is_zero))
    n_zero = df.select(sum(F.sum(z.cast("long")) for z in is_zero).alias("zero_count"))
    out = df.withColumns({c: F.when(F.col(c) == 0, F.lit(None).cast("double"))
                          .otherwise(F.col(c).cast("double")) for c in cols})
    all_na = all_of(F.col(c).isNull() for c in cols)
    keep_taxon = F.col(taxon) != NO_ORGANISMS
    removed = out.where(all_na & keep_taxon)
    kept = out.where(~(all_na & keep_taxon))
    return Result(kept, {"zeros_to_na": zeros, "nodata": removed, "zero_count": n_zero})


def check_nodata(df: DataFrame, cols=("Station", "Date"), taxon: str = "Taxon") -> DataFrame:
    """sampling events reported as containing no organisms."""
    return df.where(F.col(taxon) == NO_ORGANISMS).select(*cols).distinct()


def rename_values(df: DataFrame, column: str, rename_map: dict[str, str]) -> Result:
    """recode values (new: old, several olds may map to one new)."""
    pairs = []
    for new, olds in rename_map.items():
        for old in ([olds] if isinstance(olds, str) else olds):
            pairs += [F.lit(old), F.lit(new)]
    m = F.create_map(*pairs)
    c = F.col(column)
    out = df.withColumn(column, F.coalesce(m[c], c))
    olds = [pairs[i]for i in range(0, len(pairs), 2)]
    stats = df.select(F.sum(c.isin(*olds).cast("long")).alias("changed"),
                      F.count(F.lit(1)).alias("total"))
    return Result(out, {f"renamed_{column}": stats})


def filter_methods(df: DataFrame, corrections: DataFrame, key_cols: list[str],
                   method_col: str = "sampler") -> Result:
    """a correction table names which method to keep for a key; rows
    without a correction are kept; others are logged (distinct)."""
    corr = corrections.select(*key_cols, F.col(method_col).alias("__corr"))
    j = null_safe_join(df, corr, key_cols, "left")
    keep = F.col("__corr").isNull() | (F.col(method_col) == F.col("__corr"))
    kept = j.where(keep).drop("__corr")
    removed = j.where(~keep).select(*key_cols, method_col).distinct()
    return Result(kept, {"removed_method_rows": removed})


def append_code_before(df: DataFrame, cutoff: str, code: str = "DifDilution",
                       date_col: str = "Date", qc_col: str = "QualityCheck") -> DataFrame:
    """on or before ``cutoff`` append ``code`` (replacing NoCode)."""
    d, q = F.col(date_col), F.col(qc_col)
    before = d <= F.lit(cutoff).cast("date")
    return df.withColumn(qc_col, F.when(before & (q == "NoCode"), F.lit(code))
                         .when(before, F.concat(q, F.lit(" " + code)))
                         .otherwise(q))


def clean_phytoform(df: DataFrame, col: str = "PhytoForm") -> DataFrame:
    """F8: lower-case growth-form codes; junk codes become NULL."""
    v = F.lower(F.col(col))
    return df.withColumn(col, F.when(v.isin(*PHYTOFORM_JUNK), None).otherwise(v))


def na_text_to_null(df: DataFrame, token: str = "NA") -> DataFrame:
    """the text 'NA' becomes NULL in every string column."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(token))
                           for c, t in df.dtypes if t == "string"})


def recode_lab_qc(df: DataFrame, qc_col: str = "QualityCheck", notes_col: str = "Notes",
                  debris_col: str = "Debris") -> DataFrame:
    """a lab's QC vocabulary to standard codes (good/fragmented/degraded),
    debris level case, NULL debris -> None."""
    q = F.col(qc_col)
    d = F.col(debris_col)
    return df.withColumns({
        notes_col: F.when(q == "fragmented", "FragmentedDiatoms").otherwise("Unknown"),
        qc_col: F.when(q.isin("good", "fragmented"), "NoCode").when(q == "degraded", "Degraded")
                 .otherwise(q),
        debris_col: F.when(d == "high", "High").when(d == "moderate", "Moderate")
                     .when(d == "low", "Low").when(d.isNull(), "None").otherwise(d),
    })


def exclude_values(df: DataFrame, col: str, values) -> DataFrame:
    """drop rows whose ``col`` is in ``values`` (NULL kept, as SQL NOT IN
    would not)."""
    c = F.col(col)
    return df.where(c.isNull() | ~c.isin(*values))


def keep_where(df: DataFrame, cond) -> Result:
    """generic filter with the complement as a log."""
    return Result(df.where(cond), {"filtered_out": df.where(~F.coalesce(cond, F.lit(False)))})


def derive_columns(df: DataFrame, exprs: dict) -> DataFrame:
    """conditional derived columns (taxon from two columns, scheme by
    station pattern, depth type by bound, year group, key concatenation),
    each a column expression."""
    return df.withColumns(exprs)


def recode_keep(col, mapping: dict):
    """value recode that keeps unmapped values (never NULLs them)."""
    expr = None
    c = F.col(col) if isinstance(col, str) else col
    for old, new in mapping.items():
        expr = F.when(c == old, F.lit(new)) if expr is None else expr.when(c == old, F.lit(new))
    return expr.otherwise(c) if expr is not None else c


def strip_unit_number(col):
    """'10x' / '1 meter' style text -> its leading number (NULL if none)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract(c.cast("string"), r"^\s*([0-9]+(\.[0-9]+)?)", 1).try_cast("double")


def recode_by_date(df: DataFrame, target: str, rules: list[tuple], date_col: str = "Date", default=None) -> DataFrame:
    """``target`` from other columns and date bounds.  A rule is (value,
    {column: value it must have}, first date or None, last date or None), dates
    inclusive; the first rule that fits wins, a NULL date fits no bound, and
    ``default`` (a value or column) stands where no rule fits."""
    day, out = F.col(date_col).cast("date"), None
    for value, where, first, last in rules:
        fits = F.lit(True)
        for c, v in where.items():
            fits = fits & (F.col(c) == v)
        if first is not None:
            fits = fits & (day >= F.lit(first).cast("date"))
        if last is not None:
            fits = fits & (day <= F.lit(last).cast("date"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return df.withColumn(target, default if out is None else out.otherwise(default))
