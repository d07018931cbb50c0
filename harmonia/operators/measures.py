"""Densities, rounding, depth parsing and robust outlier flags."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harmonia.frame import Result
from harmonia.functions.exprs import row_mean, squish

# Fixed values for the robust z-score: 0.6745 (normal quantile) and R's mad
# consistency constant 1.4826.  Both scalings are kept, as in the source.
Z_CONST = 0.6745
MAD_CONST = 1.4826
FEET_TO_M = 0.3048


def _factor_col(df: DataFrame, name: str = "Factor") -> str:
    hits = [c for c in df.columns if c.lower() == name.lower()]
    if not hits:
        raise ValueError(f"no {name} column (case-insensitive)")
    return hits[0]


def calc_density_factor(df: DataFrame, unit_col: str, cell_col: str,
                        calc=("Units", "Cells", "Biovolume"), biovolume_pattern: str = "(?i)biovolume",
                        out_biovolume: str = "Biovolume_per_mL") -> DataFrame:
    """Units = round(unit x Factor, 2); Cells = round(cell x Factor, 2);
    Biovolume = round(mean(non-NULL biovolume measurements) x Factor x cell, 2).
    The output biovolume column itself is never averaged in."""
    f = F.col(_factor_col(df))
    bio_cols = [c for c in df.columns if re.search(biovolume_pattern, c) and c != out_biovolume]
    out = {}
    if "Units" in calc:
        out["Units_per_mL"] = F.round(F.col(unit_col) * f, 2)
    if "Cells" in calc:
        out["Cells_per_mL"] = F.round(F.col(cell_col) * f, 2)
    if "Biovolume" in calc:
        out[out_biovolume] = F.round(row_mean(bio_cols) * f * F.col(cell_col), 2)
    return df.withColumns(out)


def calc_density_direct(df: DataFrame, unit_col: str, cells_per_unit_col: str,
                        biovolume_cols: list[str] | None = None) -> DataFrame:
    """Units = round(unit, 2); Cells = round(unit x cells per unit, 2);
    Biovolume only when a Factor column exists."""
    out = {"Units_per_mL": F.round(F.col(unit_col), 2),
           "Cells_per_mL": F.round(F.col(unit_col) * F.col(cells_per_unit_col), 2)}
    if any(c.lower() == "factor" for c in df.columns) and biovolume_cols:
        f = F.col(_factor_col(df))
        out["Biovolume_per_mL"] = F.round(row_mean(biovolume_cols) * f * F.col(unit_col), 2)
    return df.withColumns(out)


def half_chamber(fov, slide_area):
    """Count method is a half chamber when round(FoV) == round(area / 2)."""
    return F.when(F.round(F.col(fov)) == F.round(F.col(slide_area) / 2), F.lit("HalfChamber"))


def parse_depth(x):
    """D9: '1 meter' / '2 m' -> metres, '3 ft' / 'feet' -> x 0.3048, a bare
    number as is, anything else NULL."""
    s = F.col(x).cast("string") if isinstance(x, str) else x.cast("string")
    num = F.regexp_extract(s, r"[0-9.]+", 0).try_cast("double")
    return (F.when(s.rlike(r"(?i)m(eter)?s?$"), num)
            .when(s.rlike(r"(?i)f(eet|t)$"), num * FEET_TO_M)
            .when(s.rlike(r"^[0-9.]+$"), s.try_cast("double")))


# --- exact median -----------------------------------------------------------

def exact_medians(long: DataFrame, measure: str, col: str) -> dict:
    """Exact median (mean of the two middle values) of the non-NULL ``col`` of
    every ``measure``, all in the same passes; measures without a value are absent.

    Values are counted (partially aggregated), the distinct ones are dealt by
    measure and value range, and one sum per range says which range holds the
    middle ranks; running counts inside those ranges give the values.  Only
    one count per range and measure and two values per measure reach the driver."""
    from harmonia.session import stage
    x = F.col(col).cast("double")
    counts = stage(long.where(x.isNotNull() & ~F.isnan(x)).groupBy(F.col(measure).alias("m"), x.alias("x"))
                   .agg(F.count(F.lit(1)).alias("n"))
                   .repartitionByRange("m", "x").withColumn("range", F.spark_partition_id()))
    sizes = counts.groupBy("m", "range").agg(F.sum("n").alias("n")).orderBy("m", "range").collect()
    targets = []  # (measure, range, rank within the range)
    for m in dict.fromkeys(r["m"] for r in sizes):
        own = [r for r in sizes if r["m"] == m]
        total = sum(r["n"] for r in own)
        for rank in ((total - 1) // 2, total // 2):
            for r in own:
                if rank < r["n"]:
                    targets.append((m, r["range"], rank))
                    break
                rank -= r["n"]
    if not targets:
        return {}
    running = F.sum("n").over(Window.partitionBy("m", "range").orderBy("x"))
    upto = counts.where(F.col("range").isin(*{t[1] for t in targets})).select("m", "range", "x", running.alias("upto"))
    found = upto.agg(*[F.min(F.when(F.col("m").eqNullSafe(m) & (F.col("range") == r) & (F.col("upto") > rank), F.col("x")))
                       .alias(f"t{i}") for i, (m, r, rank) in enumerate(targets)]).first()
    return {m: (found[i] + found[i + 1]) / 2 for i, (m, _, _) in enumerate(targets) if i % 2 == 0}


def exact_median(df: DataFrame, col: str):
    """Exact median of the non-NULL ``col``; None for no data."""
    return exact_medians(df.select(F.lit("").alias("m"), F.col(col).alias("x")), "m", "x").get("")


def _log_value(c: str) -> Column:
    return F.when(F.col(c) > 0, F.log10(F.col(c)))


def robust_scales(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Median and scaled MAD of log10 of the positive values of each column, for
    all columns in the same passes; columns without positive values are absent."""
    from harmonia.session import stage
    pairs = F.array(*[F.struct(F.lit(c).alias("m"), _log_value(c).alias("x")) for c in cols])
    # the passes below iterate on the driver: run the upstream plan once
    vals = stage(df.select(F.explode(pairs).alias("p")).select("p.m", "p.x").where(F.col("x").isNotNull()))
    medians = exact_medians(vals, "m", "x")
    if not medians:
        return {}
    of = F.coalesce(*[F.when(F.col("m") == c, F.lit(v)) for c, v in medians.items()])
    mads = exact_medians(vals.select("m", F.abs(F.col("x") - of).alias("x")), "m", "x")
    return {c: (v, MAD_CONST * mads[c]) for c, v in medians.items()}


def _robust_z(c: str, scale: tuple[float, float] | None) -> Column:
    """z of log10(c); a MAD of 0 puts values beside the median at infinity."""
    if scale is None or scale[0] is None:
        return F.lit(None).cast("double")
    diff = _log_value(c) - F.lit(scale[0])
    if scale[1] == 0:
        return F.when(diff > 0, F.lit(float("inf"))).when(diff < 0, F.lit(float("-inf")))
    return F.lit(Z_CONST) * diff / F.lit(scale[1])


def outlier_stats(df: DataFrame, cutoffs: dict[str, float]) -> DataFrame:
    """D10 statistics of several measures from one pass over ``df``: per
    measure the cutoff, median, MAD, rows above the cutoff and their share of
    the rows that have a z."""
    scales = robust_scales(df, list(cutoffs))
    aggs = []
    for i, (c, cut) in enumerate(cutoffs.items()):
        z = _robust_z(c, scales.get(c))
        aggs += [F.count(F.when(z > cut, 1)).alias(f"n{i}"), F.avg(F.when(z.isNotNull(), (z > cut).cast("double"))).alias(f"s{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("measure"), F.lit(float(cut)).alias("cutoff"),
                     *[F.lit(v).cast("double").alias(n) for n, v in zip(("median", "mad"), scales.get(c, (None, None)))],
                     F.col(f"n{i}").alias("n_flagged"), F.col(f"s{i}").alias("share_above")) for i, (c, cut) in enumerate(cutoffs.items())]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _label(col_name: str) -> str:
    low = col_name.lower()
    for key, lab in (("cells", "Cells"), ("units", "Units"), ("biovol", "Biovol")):
        if key in low:
            return lab
    raise ValueError('column name must contain one of: "cells", "units", or "biovolume"')


def flag_outliers(df: DataFrame, col: str, station_col: str = "Station", cutoff: float = 3.0,
                  add_flag: bool = False, qc_col: str = "QualityCheck", taxon: str = "Taxon",
                  date_col: str = "Date", notes_col: str = "Notes", scale: tuple | None = None) -> Result:
    """Upper-side robust z-score on log10 of the positive values.

    z = 0.6745 (x - median) / (1.4826 MAD); rows with z > cutoff are
    outliers.  With ``add_flag`` the code ``Outlier<Cells|Units|Biovol>`` is
    appended to QualityCheck with ``; `` after any old copy is removed.  If
    MAD is 0, values above the median flag (+Inf) and the rest do not.
    ``scale`` gives (median, MAD) where ``robust_scales`` found them before.
    Logs: ``outlier_<label>`` (rows whose QualityCheck carries the code) and
    ``outlier_stats`` (median, mad, n flagged, share above)."""
    lab = _label(col)
    code = f"Outlier{lab}"
    scale = scale or robust_scales(df, [col]).get(col)
    med, mad = scale or (None, None)
    flagged = df.withColumn("__z", _robust_z(col, scale))
    flagged = flagged.withColumn(
        "__out", F.coalesce(F.col("__z") > cutoff, F.lit(False)))
    out = flagged
    if add_flag:
        q = squish(F.regexp_replace(F.col(qc_col), rf"\s*;?\s*{code}", ""))
        q = F.coalesce(F.when(q != "", q), F.lit("NoCode"))
        new = (F.when(F.col("__out") & (q == "NoCode"), F.lit(code))
               .when(F.col("__out"), F.concat(q, F.lit("; " + code)))
               .otherwise(q))
        new = F.regexp_replace(new, r"^;\s*|NA;\s*", "")
        out = out.withColumn(qc_col, new)
    stats = flagged.agg(F.lit(med).cast("double").alias("median"), F.lit(mad).cast("double").alias("mad"),
                        F.sum(F.col("__out").cast("long")).alias("n_flagged"),
                        F.avg(F.when(F.col("__z").isNotNull(), (F.col("__z") > cutoff).cast("double")))
                        .alias("share_above"))
    out = out.drop("__z", "__out")
    log_cols = [c for c in (date_col, station_col, taxon, col, qc_col, notes_col) if c in out.columns]
    log = out.where(F.col(qc_col).contains(code)).select(*log_cols) if qc_col in out.columns else None
    logs = {"outlier_stats": stats}
    if log is not None:
        logs[f"outlier_{lab.lower()}"] = log
    return Result(out, logs)


def flag_all_outliers(df: DataFrame, cutoffs: dict[str, float], **kwargs) -> Result:
    """D10 for several measures with codes: medians and MADs of all of them in the same passes."""
    scales, res = robust_scales(df, list(cutoffs)), Result(df)
    for c, cut in cutoffs.items():
        got = flag_outliers(res.df, c, cutoff=cut, add_flag=True, scale=scales.get(c, (None, None)), **kwargs)
        res = Result(got.df, {**res.logs, f"outlier_stats_{c}": got.logs["outlier_stats"],
                              **{k: v for k, v in got.logs.items() if k != "outlier_stats"}})
    return res
