"""Validation and QC checks.  Each returns a DataFrame of findings
(or a Result whose ``df`` is the data and whose logs hold the findings).

Duplicate checks never use a window over whole rows: groups are counted with
a partial hash aggregate and the offending rows are recovered with a
null-safe semi join, which AQE can split when one group is very large.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harmonia.frame import ROW_ID, Result, null_safe_join
from harmonia.functions.exprs import squish
from harmonia.functions.timefn import VALID_TIME, time_hour, time_minutes_text
from harmonia.operators.grids import number_rows
from harmonia.operators.reshape import distinct_keep_first

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def _semi_ns(left: DataFrame, keys: DataFrame, cols: list[str], how: str = "left_semi") -> DataFrame:
    r = keys.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(cols)])
    cond = [F.col(c).eqNullSafe(F.col(f"__k_{i}")) for i, c in enumerate(cols)]
    return left.join(r, cond, how)


# --- C1 ------------------------------------------------------------------------

def validate_file(df: DataFrame, schema: dict) -> DataFrame:
    """Findings (column, error) for a declared schema
    ``{col: {type, required, min, max, allowed_values}}``: missing required
    columns, non-numeric values in columns declared integer (fractions pass, as
    only numbers are asked for), non-text columns declared character, values below min / above max, values outside allowed_values.
    All value checks run in ONE aggregation pass."""
    spark = df.sparkSession
    found = []
    aggs = []
    for name, spec in schema.items():
        if name not in df.columns:
            if spec.get("required"):
                found.append((name, "missing required column"))
            continue
        c = F.col(name)
        typ = spec.get("type")
        dtype = dict(df.dtypes)[name]
        num = c.cast("string").try_cast("double")
        if typ == "integer":
            aggs.append(F.max(c.isNotNull() & num.isNull()).alias(f"{name}\x00not numeric"))
        if typ == "character" and dtype != "string":
            found.append((name, "not character"))
        if "min" in spec:
            aggs.append(F.max(num < spec["min"]).alias(f"{name}\x00below min"))
        if "max" in spec:
            aggs.append(F.max(num > spec["max"]).alias(f"{name}\x00above max"))
        if spec.get("allowed_values"):
            ok = c.isin(*spec["allowed_values"])
            aggs.append(F.max(c.isNotNull() & ~ok).alias(f"{name}\x00not allowed"))
    static = spark.createDataFrame(found, "column string, error string")
    if not aggs:
        return static
    row = df.agg(*aggs)
    pairs = [F.struct(F.lit(a.split("\x00")[0]).alias("column"), F.lit(a.split("\x00")[1]).alias("error"),
                      F.col(f"`{a}`").alias("hit")) for a in row.columns]
    dyn = (row.select(F.explode(F.array(*pairs)).alias("p"))
              .where(F.col("p.hit")).select("p.column", "p.error"))
    return static.unionByName(dyn)


# --- C2-C4 time text ------------------------------------------------------------

def check_datetime(df: DataFrame, date_col: str = "Date", time_col: str = "Time") -> DataFrame:
    """Rows with a missing/unparseable ``yyyy-MM-dd`` date, then rows
    with a missing/invalid ``H:MM`` time; a row can appear in both."""
    parts = []
    if date_col in df.columns:
        d = F.col(date_col).cast("string")
        bad = d.isNull() | F.try_to_date(d, "yyyy-MM-dd").isNull()
        parts.append(df.where(bad).withColumn("issue", F.lit("Bad/missing Date")))
    if time_col in df.columns:
        t = F.col(time_col)
        parts.append(df.where(t.isNull() | ~t.rlike(VALID_TIME))
                     .withColumn("issue", F.lit("Bad/missing Time")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def check_extreme_times(df: DataFrame, time_col: str = "Time") -> DataFrame:
    """Valid times before 05:00 or from 20:00 on."""
    t = F.col(time_col)
    h = time_hour(t)
    return df.where(t.isNotNull() & t.rlike(VALID_TIME) & ((h < 5) | (h >= 20)))


def convert_to_military(df: DataFrame, time_col: str = "Time") -> Result:
    """C4: hour 0 -> NULL (unknown), hours 1-4 -> +12 (afternoon written on a
    12 h clock).  Log: rows that changed."""
    t = F.col(time_col)
    h = time_hour(t)
    new = (F.when(h.isNotNull() & (h == 0), F.lit(None).cast("string"))
           .when(h.isNotNull() & (h > 0) & (h < 5),
                 F.format_string("%02d:%s", h + 12, time_minutes_text(t)))
           .otherwise(t))
    out = df.withColumn("__old", t).withColumn(time_col, new)
    changed = out.where(~F.col("__old").eqNullSafe(F.col(time_col))).withColumnRenamed("__old", "OldTime")
    return Result(out.drop("__old"), {"military_converted": changed})


# --- C5-C9 duplicates --------------------------------------------------------------

def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Every row that belongs to a duplicate set over ``cols`` (all
    columns by default); both members of each set are returned."""
    cols = cols or [c for c in df.columns if c != ROW_ID]
    keys = df.groupBy(*cols).count().where(F.col("count") > 1).drop("count")
    return _semi_ns(df, keys, cols)


def count_duplicates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Number of rows that repeat an earlier one (R ``sum(duplicated)``)."""
    cols = cols or [c for c in df.columns if c != ROW_ID]
    return (df.groupBy(*cols).count()
              .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("n_duplicated")))


def remove_duplicates(df: DataFrame, cols: list[str] | None = None,
                      order_cols: list[str] | None = None) -> DataFrame:
    """Drop exact repeats; C6: keep the first row per key."""
    if cols is None:
        return df.dropDuplicates()
    return distinct_keep_first(df, cols, order_cols)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if t in NUMERIC else F.col(c)
                       for c, t in df.dtypes])


def check_distinct(df: DataFrame, type: str = "full", key_cols=("Station", "Date"),
                   taxa_cols=("Taxon",), measurement_cols=("Biovolume_per_mL", "Cells_per_mL",
                                                            "Units_per_mL"), digits: int = 6) -> DataFrame:
    """Rows not distinct after rounding numbers to 6 decimals, over
    all columns (``full``), keys + taxa + measurements, or keys + taxa.
    Returned rows are the original (unrounded) ones; matching uses the
    rounded values on both sides."""
    if type == "full":
        cols = [c for c in df.columns if c != ROW_ID]
    elif type == "key_measure_cols":
        cols = list(key_cols) + list(taxa_cols) + list(measurement_cols)
    else:
        cols = list(key_cols) + list(taxa_cols)
    num = {c for c, t in df.dtypes if t in NUMERIC}
    tmp = df.withColumns({f"__r_{c}": (F.round(F.col(c), digits) if c in num else F.col(c)) for c in cols})
    rcols = [f"__r_{c}" for c in cols]
    keys = tmp.groupBy(*rcols).count().where(F.col("count") > 1).drop("count")
    return _semi_ns(tmp, keys, rcols).drop(*rcols)


# --- C10-C14 -------------------------------------------------------------------------

def check_nas(df: DataFrame, exclude_cols=("OrigTaxon",)) -> DataFrame:
    """One pass; rows (column, n_missing, all_missing) for every column
    with a NULL (excluded columns only count when entirely NULL)."""
    cols = [c for c in df.columns if c != ROW_ID]
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = agg.unpivot(["__n"], cols, "column", "n_missing")
    ex = set(exclude_cols or [])
    long = long.withColumn("all_missing", F.col("n_missing") == F.col("__n"))
    keep = (F.col("n_missing") > 0) & (~F.col("column").isin(*ex) | F.col("all_missing")) if ex else \
        (F.col("n_missing") > 0)
    return long.where(keep).select("column", "n_missing", "all_missing")


def check_units_cells(df: DataFrame, cells: str = "Cells_per_mL", units: str = "Units_per_mL") -> DataFrame:
    """C11: rows whose cell count is below the unit count."""
    return df.where(F.col(cells) < F.col(units))


def check_count_issue(df: DataFrame, cell_col: str, unit_col: str) -> DataFrame:
    """Diff = cells - units, rows with Diff < 0 (distinct)."""
    return df.withColumn("Diff", F.col(cell_col) - F.col(unit_col)).where(F.col("Diff") < 0).distinct()


def check_non_numeric(df: DataFrame, col: str, order_cols: list[str], first: int = 10) -> DataFrame:
    """Distinct values that do not read as a number, each with the numbers
    of the ``first`` rows that hold it (``row_numbers``, from 1 in the order of
    ``order_cols``).  Per value only that many rows leave a task."""
    c = F.col(col)
    numbered = number_rows(df.select(col, *[x for x in order_cols if x != col]), order_cols, "__row")
    bad = numbered.where(c.isNotNull() & c.cast("string").try_cast("double").isNull()).select(col, "__row")
    nth = F.row_number().over(Window.partitionBy(col).orderBy("__row"))
    return (bad.withColumn("__nth", nth).where(F.col("__nth") <= first)
            .groupBy(col).agg(F.array_sort(F.collect_list("__row")).alias("row_numbers")))


def unique_values(df: DataFrame, col: str) -> DataFrame:
    """C14: distinct values, sorted."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_last())


# --- C15-C17 taxonomy and comments ---------------------------------------------

def check_higher_taxa(df: DataFrame, taxon: str = "Taxon",
                      levels=("Kingdom", "Phylum", "Class", "AlgalGroup", "Genus", "Species")) -> DataFrame:
    """Distinct taxonomy rows missing any level; ``cf. `` and
    `` var...`` stripped from the name; sorted by name."""
    miss = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in levels])
    t = F.regexp_replace(F.regexp_replace(F.col(taxon), r"cf\. ", ""), r" var\..*", "")
    cols = [taxon] + [c for c in levels]
    return (df.where(miss).select(*[t.alias(taxon) if c == taxon else F.col(c) for c in cols])
              .distinct().orderBy(F.col(taxon).asc_nulls_last()))


def check_synonyms(df: DataFrame, ref: DataFrame, taxon: str = "Taxon", current: str = "CurrentTaxon",
                   cols=("Taxon", "Kingdom", "Phylum", "Class", "AlgalGroup", "Genus", "Species")) -> DataFrame:
    """Names that were changed AND are someone's current name
    (multi-generation synonyms, Type ``multigen``) plus distinct data rows
    with a missing or ``Unknown`` taxon (Type ``missing syn``)."""
    changed = ref.where(F.col(current) != "None").select(F.col(taxon).alias("multigen")).distinct()
    currents = ref.select(F.col(current).alias("multigen")).distinct()
    multigen = changed.join(currents, "multigen", "left_semi").withColumn("Type", F.lit("multigen"))
    miss = (df.where(F.col(taxon).isNull() | (F.col(taxon) == "Unknown")).select(*cols).distinct()
              .withColumn("Type", F.lit("missing syn")))
    return multigen.unionByName(miss, allowMissingColumns=True)


# Comment phrases already captured by QualityCheck / Debris /
# Notes codes, removed before listing leftover comment fragments.
KNOWN_PHRASES = [
    "delete", "cross contamination", "did not reach", "cannot meet tally",
    "cannot meet natural unit",
    "CNMT>5", "CNMT >5", "CNMT > 5",
    "CMT>5", "CMT >5", "CMT > 5",
    "CMNT<5", "CMNT <5", "CMNT < 5",
    "CMT<5", "CMT <5", "CMT < 5",
    "CMT", "CMNT", "LessThan400cells",
    "degraded",
    "poor preservation", "poorly preserved", "PoorlyPreserved",
    "weak preservation", "weakly preserved",
    "fungus", "fungal growth", "mycelial growth", "obscured",
    "girdle", "girdle view", "cyst", "mucilaginous detritus",
    "ciliates", "ciliates observed",
    "many broken diatoms", "broken diatoms", "BrokenDiatoms",
    "high detritus", "high sediment",
    "moderate detritus", "moderate sediment", "moderat sediment",
    "low detritus", "low sediment", "light detritus", "light sediment",
    "heavy detritus", "heavy sediment", "high amount of debris",
    "high amounts of debris", "lots of debris", "High sedimnet", "High sedimen",
    "fragment.", "fragmented diatoms", "diatom fragments", "diatom fragment",
    "Good", "and",
]

# Shorthand delimiters and the regex each stands for.
DELIMITERS = {". ": r"\.\s*", ".": r"\.", ", ": r",\s*", ",": ",", "; ": r";\s*", ";": ";",
              " - ": r"\s+-\s*"}


def known_phrase_pattern(phrases=None) -> str:
    """Case-insensitive alternation of the phrases, every non-word character
    escaped; alternation order is list order (first match wins)."""
    esc = [re.sub(r"(\W)", r"\\\1", p) for p in (phrases or KNOWN_PHRASES)]
    return "(?i)(" + "|".join(esc) + ")"


def unstandardized_comments(df: DataFrame, comment_col: str, delimiter: str | None = " ",
                            phrases=None) -> DataFrame:
    """C17: distinct comment fragments not covered by a known phrase."""
    pat = known_phrase_pattern(phrases)
    cleaned = (df.select(F.col(comment_col).alias("c")).where(F.col("c").isNotNull()).distinct()
                 .select(F.regexp_replace("c", pat, "").alias("c")))
    if delimiter:
        d = DELIMITERS.get(delimiter, delimiter)
        frag = cleaned.select(F.explode(F.split("c", d)).alias("u"))
    else:
        frag = cleaned.select(F.col("c").alias("u"))
    frag = frag.select(F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace("u", r"^\s+|\s+$", "")),
                                                         r"\.$", ""), r";$", "").alias("Unmatched"))
    return frag.where(F.col("Unmatched") != "").distinct()


# --- C18-C29 reports ---------------------------------------------------------------

def coordinate_bounds(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude",
                      box=(37.0, 39.0, -123.0, -121.0)) -> DataFrame:
    """All coordinates NULL or on the globe; then inside a study box."""
    la, lo = F.col(lat), F.col(lon)
    on_globe = la.isNull() | lo.isNull() | ((la.between(-90, 90)) & (lo.between(-180, 180)))
    in_box = la.isNull() | lo.isNull() | (la.between(box[0], box[1]) & lo.between(box[2], box[3]))
    return df.agg(F.bool_and(on_globe).alias("on_globe"), F.bool_and(in_box).alias("in_box"))


def multi_location_stations(df: DataFrame, station: str = "Station", location: str = "Location") -> DataFrame:
    """Stations recorded under more than one location."""
    pairs = df.select(station, location).distinct()
    return (pairs.groupBy(station)
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.array_join(F.array_sort(F.collect_list(F.col(location).cast("string"))), ", ")
                      .alias("locations"))
                 .where(F.col("n") > 1))


def code_crosstab(df: DataFrame, code_col: str, by: str = "Survey", strip: str | None = None,
                  surveys: list | None = None) -> DataFrame:
    """C20: space-separated codes exploded; per (by, code) the count and the
    percent of that group's rows (2 dp); pivoted so each group is a column,
    missing combinations 0."""
    c = F.col(code_col)
    if strip:
        c = F.regexp_replace(c, strip, "")
    totals = df.groupBy(by).agg(F.count(F.lit(1)).alias("__tot"))
    codes = df.select(by, F.explode(F.split(c, " ")).alias("code")).where(F.col("code") != "")
    counts = codes.groupBy(by, "code").agg(F.count(F.lit(1)).alias("n"))
    pct = null_safe_join(counts, totals, [by]).select(by, "code", F.round(F.col("n") * 100.0 / F.col("__tot"), 2).alias("pct"))
    wide = pct.groupBy("code").pivot(by, surveys).agg(F.first("pct"))
    return wide.fillna(0.0, subset=[x for x in wide.columns if x != "code"])


def group_size_filter(df: DataFrame, cols: list[str], min_n: int = 2) -> DataFrame:
    """Rows of groups with at least ``min_n`` rows (``filter(n()>1)``)."""
    keys = df.groupBy(*cols).count().where(F.col("count") >= min_n).drop("count")
    return _semi_ns(df, keys, cols)


def distinct_count_filter(df: DataFrame, cols: list[str], of: list[str], min_distinct: int = 2) -> DataFrame:
    """Rows of groups in which the tuple ``of`` takes more than one
    distinct value (count(distinct) over a window is not supported; a
    two-level aggregate plus semi join is)."""
    keys = (df.select(*cols, *of).distinct().groupBy(*cols).count()
              .where(F.col("count") >= min_distinct).drop("count"))
    return _semi_ns(df, keys, cols)


def code_list_conflicts(df: DataFrame, id_col: str, taxon: str, syn: str) -> DataFrame:
    """(id, taxon, synonym) counted; ids with more than one combination."""
    cnt = df.groupBy(id_col, taxon, syn).count()
    return group_size_filter(cnt, [id_col])


def taxonomy_mismatch(df: DataFrame, ref: DataFrame, on=("Genus", "Species"),
                      levels=("Kingdom", "Phylum", "Class")) -> DataFrame:
    """Rows whose Genus+Species match the reference but a higher level
    differs (null-safe)."""
    r = ref.select(*on, *[F.col(c).alias(f"ref_{c}") for c in levels])
    j = null_safe_join(df, r, on)
    diff = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"ref_{c}")) for c in levels])
    return j.where(diff)


def time_mismatch(df: DataFrame, other: DataFrame, on=("Station", "Date"), time_col: str = "Time") -> DataFrame:
    """Left join another table's times; keep rows whose other time is
    missing or differs in the first 5 characters; rows without a time of
    their own are left out."""
    o = other.select(*on, F.col(time_col).alias("OtherTime")).distinct()
    j = null_safe_join(df.where(F.col(time_col).isNotNull()), o, on, "left")
    same = F.substring(F.col(time_col), 1, 5) == F.substring(F.col("OtherTime"), 1, 5)
    return j.where(F.col("OtherTime").isNull() | ~F.coalesce(same, F.lit(False))).distinct()


def row_count_conserved(parts: list[DataFrame], union: DataFrame) -> DataFrame:
    """One row comparing the union's size to the sum of the parts (one
    pass over tagged rows; no join)."""
    tagged = reduce(lambda a, b: a.unionByName(b),
                    [p.select(F.lit(True).alias("__part")) for p in parts]
                    + [union.select(F.lit(False).alias("__part"))])
    agg = tagged.agg(F.sum(F.col("__part").cast("long")).alias("n_parts"),
                     F.sum((~F.col("__part")).cast("long")).alias("n_union"))
    return agg.withColumn("conserved", F.col("n_parts") == F.col("n_union"))


def program_logs(df: DataFrame, id_col: str = "Sortable_ID", lat: str = "Latitude", lon: str = "Longitude",
                 date_col: str = "Date", time_col: str = "Time") -> dict[str, DataFrame]:
    """A program's small logs: ids that occur more than once with their
    count ``n``, and the distinct samples without coordinates or time."""
    return {
        "sortable_check": df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1),
        "missing_latlon": (df.where(F.col(lat).isNull() | F.col(lon).isNull())
                           .select(date_col, time_col, id_col, lat, lon).distinct()),
        "missing_time": df.where(F.col(time_col).isNull()).select(date_col, time_col, id_col).distinct(),
    }


def taxonomy_unmatched(df: DataFrame, ref: DataFrame,
                       levels=("Kingdom", "Phylum", "Class", "Genus", "Species")) -> DataFrame:
    """Distinct classifications with no identical reference row
    (NULL matches NULL)."""
    d = df.select(*levels).distinct()
    return _semi_ns(d, ref.select(*levels).distinct(), list(levels), "left_anti")


def needing_synonym(df: DataFrame, ref: DataFrame, taxon: str = "Taxon", current: str = "CurrentTaxon") -> DataFrame:
    """C25d: data rows whose name the reference maps to a newer name."""
    changed = ref.where(F.col(current).isNotNull() & (F.col(current) != "None")).select(
        F.lower(F.trim(F.col(taxon))).alias("__k")).distinct()
    return df.join(changed, F.lower(F.trim(F.col(taxon))) == F.col("__k"), "left_semi")
