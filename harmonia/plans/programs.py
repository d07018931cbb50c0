"""Named pipelines composed from the operators.

Every pipeline is a chain of lazy DataFrame operators; audit tables are
accumulated in the returned :class:`Result`.  Nothing is collected except
the few scalars some operators need (medians, date span).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from harmonia.frame import ROW_ID, Result, deals_evenly, null_safe_join, untouched, with_row_id
from harmonia.functions import timefn as T
from harmonia.operators import checks as CK
from harmonia.operators import combine as CB
from harmonia.operators import community as CM
from harmonia.operators import filters as FL
from harmonia.operators import joins as J
from harmonia.operators import measures as M
from harmonia.operators import project as P
from harmonia.operators import reshape as R
from harmonia.operators import taxonomy as X
from harmonia.operators.grids import add_event_id, sampling_freq_grid, station_count_grid
from harmonia.session import stage
from harmonia.sources.config import applies, step
from harmonia.sources.readers import ingest_manifest

DENSITIES = ["Cells_per_mL", "Units_per_mL", "Biovolume_per_mL"]
# Synthesis-level outlier cutoffs (cells, units, biovolume).
SYNTH_CUTOFFS = {"Cells_per_mL": 3.0, "Units_per_mL": 3.0, "Biovolume_per_mL": 3.5}


def _merge(res: Result, out) -> Result:
    if isinstance(out, DataFrame):
        return Result(out, res.logs)
    logs = dict(res.logs)
    logs.update(out.logs)
    return Result(out.df, logs)


def on_names(df: DataFrame, steps: dict, taxa: DataFrame | None = None, onto: DataFrame | None = None) -> Result:
    """Run taxon steps (name -> operator) over the distinct names of ``df`` and join what they give.

    A step depends on the name alone (and on the old name where none is about to
    be looked up), so its rules run once a name, and the data meets the names
    in one join, whatever the number of steps: a broadcast where Spark sees
    that the names are few, else one that it can split at a frequent name.
    ``onto``: the rows of ``df`` as they are dealt over tasks where they are
    joined, if otherwise than in ``df``, of which only the names are read."""
    onto = df if onto is None else onto
    if not steps:
        return Result(onto)
    keys, cols = ["Taxon"], list(df.columns)
    if "update_synonyms" in steps:
        cols = [c for c in cols if c != "OrigTaxon"]
        cols.insert(cols.index("Taxon"), "OrigTaxon")
    elif "higher_lvl_taxa" in steps and "OrigTaxon" in cols:
        keys.append("OrigTaxon")
    if "higher_lvl_taxa" in steps:
        ref_cols = [c for c in taxa.columns if c != "Taxon"]
        cols = cols if "OrigTaxon" in cols else [*cols, "OrigTaxon"]
        cols = [c for c in cols if c not in ref_cols] + [c for c in ref_cols if c != "CurrentTaxon"]
    names = stage(df.select(*keys).distinct())
    res = Result(names.withColumns({f"__was_{k}": F.col(k) for k in keys}))
    for operator in steps.values():
        res = _merge(res, operator(res.df))
    got = stage(res.df)
    new = [c for c in got.columns if not c.startswith("__was_")]
    got = got.select(*[F.col(f"__was_{k}").alias(k) for k in keys], *[F.col(c).alias(f"__new_{c}") for c in new])
    out = null_safe_join(onto, got, keys, "left")
    return Result(out.select(*[F.col(f"__new_{c}").alias(c) if c in new else F.col(c) for c in cols]), res.logs)


def taxon_chain(df: DataFrame, typos: DataFrame | None, taxa: DataFrame | None, std_type: str = "program",
                std_sp: bool = True, std_suffix: bool = True, *, typo_order: str | list[str] | None = None,
                taxa_order: str | list[str] | None = None, onto: DataFrame | None = None) -> Result:
    """X5 -> X4 -> X6 -> X7: typos, unknowns, synonyms, higher taxonomy.  A
    table that is given needs the column(s) that order its rows.  ``onto``: see ``on_names``."""
    steps = {}
    if typos is not None:
        steps["correct_taxon_typos"] = lambda d: X.correct_taxon_typos(d, typos, order=typo_order)
    steps["clean_unknowns"] = lambda d: X.clean_unknowns(d, std_sp, std_suffix)
    if taxa is not None:
        steps["update_synonyms"] = lambda d: X.update_synonyms(d, taxa, order=taxa_order)
        steps["higher_lvl_taxa"] = lambda d: X.higher_lvl_taxa(d, taxa, std_type)
    return on_names(df, steps, taxa, onto)


def _raw_to_names(rows: DataFrame, cfg: dict, meta: DataFrame | None, stations: DataFrame | None) -> Result:
    """The steps of L1 on distinct rows that come before the names."""
    res = Result(rows)
    if cfg.get("renames"):
        res = _merge(res, P.rename_cols(res.df, cfg["renames"]))
    res = _merge(res, P.remove_taxa_info(res.df))
    if cfg.get("density"):
        d = cfg["density"]
        res = _merge(res, M.calc_density_factor(res.df, d["unit"], d["cell"]))
    if "PhytoForm" in res.df.columns:
        res = _merge(res, FL.clean_phytoform(res.df))
    if stations is not None:
        res = _merge(res, J.add_lookup(res.df, stations, ["Station"], log_name="missing_stations"))
    if "Time" in res.df.columns:
        res = _merge(res, res.df.withColumn("Time", T.clean_time_text(F.col("Time"))))
    if meta is not None:
        for c in cfg.get("meta_cols", []):
            res = _merge(res, J.add_meta_col(res.df, meta, c, cfg.get("match_cols"),
                                             start=cfg.get("meta_start", "start_date"),
                                             end=cfg.get("meta_end", "end_date")))
    comment = cfg.get("comment_col")
    if comment and comment not in res.df.columns:
        comment = None
    res = _merge(res, X.add_qc_col(res.df, comment))
    res = _merge(res, X.add_debris_col(res.df, comment))
    return _merge(res, X.add_notes_col(res.df, comment))


def format_program(df: DataFrame, cfg: dict, typos: DataFrame | None = None, taxa: DataFrame | None = None,
                   meta: DataFrame | None = None, stations: DataFrame | None = None, *,
                   typo_order: str | list[str] | None = None, taxa_order: str | list[str] | None = None) -> Result:
    """L1: one program's raw counts to the standard table.

    distinct -> rename -> drop old taxonomy -> densities -> phytoform ->
    coordinates -> time text -> metadata -> typos / comments -> unknowns ->
    synonyms -> taxonomy -> duplicate checks -> subset -> combine -> no-data
    -> outliers.  ``cfg`` keys: renames, density ({unit, cell}), comment_col,
    meta_cols, match_cols, key_cols, subset, outlier_cutoff, order_cols (unless
    ``df`` has a row id).

    The distinct rows are dealt by key once, and combined where they then are;
    if a key has so many that one task would get them, combine deals their
    states instead."""
    keys, order = cfg.get("key_cols", ["Date", "Station"]), cfg.get("order_cols")
    with_row_id(df, order)  # raises for rows without an order
    # the distinct rows are read more than once; an id made of columns is put on where they are read, equal rows have the same
    rows = stage(R.distinct_rows_keep_id(df) if ROW_ID in df.columns else df.distinct())
    res, onto = _raw_to_names(with_row_id(rows, order), cfg, meta, stations), None
    if deals_evenly(res.df, keys):
        # where neither keys nor rows come from the steps, the rows move before these widen them
        early = meta is None and untouched(res.df, rows, keys)
        onto = _raw_to_names(with_row_id(rows.repartition(*keys), order), cfg, meta, stations).df if early else res.df.repartition(*keys)
    res = _merge(res, taxon_chain(res.df, typos, taxa, cfg.get("std_type", "program"),
                                  typo_order=typo_order, taxa_order=taxa_order, onto=onto))
    res.logs["nondistinct_keyrows"] = CK.check_distinct(res.df, "key_cols", key_cols=keys)
    if cfg.get("subset"):
        res = _merge(res, P.pad_subset(res.df, cfg["subset"]))
    res = _merge(res, CB.combine_taxa(res.df, keys, [c for c in DENSITIES if c in res.df.columns]))
    res = _merge(res, FL.remove_nodata(res.df, [c for c in DENSITIES if c in res.df.columns]))
    if cfg.get("outlier_cutoff") and "Cells_per_mL" in res.df.columns:
        res = Result(stage(res.df), res.logs)
        res = _merge(res, M.flag_outliers(res.df, "Cells_per_mL", cutoff=cfg["outlier_cutoff"]))
    return res


def prep_for_synthesis(df: DataFrame, cfg: dict, meta: DataFrame | None = None, typos: DataFrame | None = None,
                       taxa: DataFrame | None = None, *, typo_order: str | list[str] | None = None,
                       taxa_order: str | list[str] | None = None) -> Result:
    """L2: a formatted program to the synthesis form: fixed UTC-8 clock,
    metadata columns, constants, original taxa kept, taxon chain in
    ``unified`` mode, Event_ID, subset, combine, no-data, outliers.

    ``cfg``: from_zone, meta_cols, match_cols, constants, loc_col, subset,
    key_cols, order_cols (unless ``df`` has a row id) and outlier_cutoffs
    (densities to flag and their cutoffs; 3 for each that is present).  Codes
    go to QualityCheck; a program without it gets ``outlier_stats`` only."""
    res = Result(with_row_id(df, cfg.get("order_cols")))
    if "Time" in df.columns and cfg.get("from_zone"):
        nd, nt = T.local_to_fixed_offset("Date", "Time", cfg["from_zone"])
        # the clock is converted once, not in every pass over dates and names below
        res = Result(stage(res.df.withColumns({"Date": nd, "Time": nt})), res.logs)
    if meta is not None:
        for c in cfg.get("meta_cols", []):
            res = _merge(res, J.add_meta_col(res.df, meta, c, cfg.get("match_cols"),
                                             start=cfg.get("meta_start", "start_date"),
                                             end=cfg.get("meta_end", "end_date")))
    if cfg.get("constants"):
        res = _merge(res, P.add_constants(res.df, cfg["constants"]))
    if "OrigTaxon" in res.df.columns:
        res = _merge(res, P.extract_program_taxa(res.df))
    res = _merge(res, taxon_chain(res.df, typos, taxa, "unified", typo_order=typo_order, taxa_order=taxa_order))
    res = Result(stage(res.df), res.logs)
    if {"Survey", "Date", "DepthType", "SampleDepth"} <= set(res.df.columns):
        res = _merge(res, add_event_id(res.df, cfg.get("loc_col", "Station")))
    if cfg.get("subset"):
        res = _merge(res, P.pad_subset(res.df, cfg["subset"]))
    keys = cfg.get("key_cols", ["Event_ID"] if "Event_ID" in res.df.columns else ["Date", "Station"])
    res = _merge(res, CB.combine_taxa(res.df, keys, [c for c in DENSITIES if c in res.df.columns]))
    dens = [c for c in DENSITIES if c in res.df.columns]
    res = _merge(res, FL.remove_nodata(res.df, dens))
    cutoffs = cfg.get("outlier_cutoffs", {c: 3.0 for c in dens})
    if not cutoffs:
        return res
    res = Result(stage(res.df), res.logs)
    if "QualityCheck" not in res.df.columns:  # no column for the codes: the statistics alone
        return Result(res.df, {**res.logs, "outlier_stats": M.outlier_stats(res.df, cutoffs)})
    return _merge(res, M.flag_all_outliers(res.df, cutoffs))


def synthesize(programs: list[DataFrame], recodes: dict[str, dict] | None = None,
               drop: list[str] | None = None, sort_cols=("Survey", "Date", "Station")) -> Result:
    """L3: all programs -> one table: cast to text (dates kept), union by
    name, value recodes, drop columns, no-data removal, densities back to
    numbers, outlier statistics with the synthesis cutoffs (flags are not
    written, as in the source), row-count conservation check."""
    texts = [P.cast_all_but(p, ("Date",)) for p in programs]
    union = R.union_by_name(texts)
    res = Result(union, {"row_count": CK.row_count_conserved(texts, union)})
    for col, mapping in (recodes or {}).items():
        if col in res.df.columns:
            res = _merge(res, FL.rename_values(res.df, col, mapping))
    if drop:
        res = Result(res.df.drop(*drop), res.logs)
    dens = [c for c in DENSITIES if c in res.df.columns]
    res = Result(res.df.withColumns({c: F.col(c).try_cast("double") for c in dens}), res.logs)
    res = _merge(res, FL.remove_nodata(res.df, dens))
    res = Result(stage(res.df), res.logs)  # the union is run once for the table and all statistics
    stats = M.outlier_stats(res.df, {c: SYNTH_CUTOFFS[c] for c in dens})
    res.logs["outlier_stats"] = stats
    for c in dens:
        res.logs[f"outlier_stats_{c}"] = stats.where(F.col("measure") == c).drop("measure", "cutoff")
    res = Result(R.sort_r(res.df, [c for c in sort_cols if c in res.df.columns]), res.logs)
    return res


def write_synthesis(programs: list[DataFrame], path: str, recodes: dict[str, dict] | None = None,
                    drop: list[str] | None = None) -> dict[str, int]:
    """L3's table written to ``path`` (Parquet), with the counts that C29, F1 and F3
    report taken in the pass that writes: ``n_parts``, ``n_union``,
    ``n_recoded`` (values changed) and ``n_removed`` (rows without data)."""
    n, seen = F.count(F.lit(1)).alias("n"), []

    def observed(df: DataFrame, *metrics) -> DataFrame:
        seen.append(Observation())
        return df.observe(seen[-1], *metrics)

    union = R.union_by_name([observed(P.cast_all_but(p, ("Date",)), n) for p in programs])
    parts, changes = list(seen), []
    for col, mapping in (recodes or {}).items():
        if col in union.columns:
            # new name: old value; a value that keeps its name does not count
            olds = [(new, o) for new, old in mapping.items() for o in ([old] if isinstance(old, str) else old)]
            changes += [F.count(F.when(F.col(col) == old, 1)) for new, old in olds if new != old]
    changed = sum(changes, F.lit(0)) if changes else F.sum(F.lit(0))
    union = observed(union, n, changed.alias("changed"))
    whole = seen[-1]
    for col, mapping in (recodes or {}).items():
        if col in union.columns:
            union = FL.rename_values(union, col, mapping).df
    union = union.drop(*(drop or []))
    dens = [c for c in DENSITIES if c in union.columns]
    union = union.withColumns({c: F.col(c).try_cast("double") for c in dens})
    kept = observed(FL.remove_nodata(union, dens).df, n)
    last = seen[-1]
    kept.write.mode("overwrite").parquet(path)
    return {"n_parts": sum(o.get["n"] for o in parts), "n_union": whole.get["n"], "n_recoded": whole.get["changed"],
            "n_removed": whole.get["n"] - last.get["n"]}


def metadata_report(df: DataFrame, surveys: list[str] | None = None) -> dict[str, DataFrame]:
    """L4: the metadata QA tables over the synthesized data."""
    rep = {
        "surveys": CK.unique_values(df, "Survey"),
        "coordinates": CK.coordinate_bounds(df),
        "multi_location_stations": CK.multi_location_stations(df),
        "units_exceed_cells": CK.check_units_cells(df),
        "taxonomy": df.select("Phylum", "Class", "AlgalGroup").distinct(),
        "event_taxon_duplicates": CK.group_size_filter(df, ["Event_ID", "Taxon"]) if "Event_ID" in df.columns
        else None,
    }
    for col in ("QualityCheck", "Notes", "Debris"):
        if col in df.columns:
            strip = r"[^A-Za-z0-9 ]" if col == "Debris" else None
            rep[f"crosstab_{col}"] = CK.code_crosstab(df, col, "Survey", strip, surveys)
    return {k: v for k, v in rep.items() if v is not None}


def group_comparability(df: DataFrame, polygons: DataFrame, group: str, measure: str,
                        event_cols: list[str], unit_cols: list[str], method: str = "bray") -> Result:
    """Sum a measure per event x group, assign regions (J14), keep
    regions sampled by more than one survey, build the community matrix
    per unit and the pairwise dissimilarity between units."""
    ev = df.groupBy(*event_cols, "Survey", "Latitude", "Longitude", group) \
        .agg(F.coalesce(F.sum(measure), F.lit(0.0)).alias("value"))
    reg = J.assign_region(ev, polygons)
    multi = CK.distinct_count_filter(reg, ["Region"], ["Survey"])
    unit = F.concat_ws("|", *[F.col(c).cast("string") for c in unit_cols])
    long = multi.withColumn("unit", unit).groupBy("unit", group).agg(F.sum("value").alias("value"))
    dist = CM.dissimilarity(long, "unit", group, "value", method)
    return Result(dist, {"community": long})


def community_checks(df: DataFrame, unit_cols: list[str], taxa_cols=("Taxon", "Genus"),
                     measures=tuple(DENSITIES)) -> dict[str, DataFrame]:
    """Presence flag and genus sums, long matrices for every measure x
    taxon level, and the two completeness grids."""
    d = df.withColumn("Binary", F.lit(1.0))
    out = {"genus_sums": CM.group_sums(d, list(unit_cols) + ["Genus"], [m for m in measures if m in d.columns])}
    for lvl in taxa_cols:
        for m in [x for x in measures if x in d.columns] + ["Binary"]:
            out[f"matrix_{lvl}_{m}"] = CM.community_long(d, list(unit_cols), m, lvl)
    out["station_grid"] = station_count_grid(d)
    out["frequency_grid"] = sampling_freq_grid(d)
    return out


def format_serial_dates(df: DataFrame) -> DataFrame:
    """Uploads whose dates are spreadsheet serials and times time stamps."""
    if "Date" in df.columns:
        df = df.withColumn("Date", T.excel_serial_to_date("Date"))
    if "Time" in df.columns:
        df = df.withColumn("Time", T.time_from_stamp("Time"))
    return P.remove_taxa_info(P.drop_empty_rows(P.drop_cols_matching(df)))


def format_day_first_dates(df: DataFrame) -> DataFrame:
    """Uploads whose dates are written day, month, year."""
    if "Date" in df.columns:
        df = df.withColumn("Date", F.try_to_date(F.col("Date").cast("string"), "d/M/yyyy"))
    return P.remove_taxa_info(P.drop_empty_rows(df))


#: Transform chains that a schema's ``format`` may name; others leave an upload as it is.
FORMATTERS = {"serial dates": format_serial_dates, "day first dates": format_day_first_dates}

#: Columns that a formatter step reads, and those that it adds for later ones.
STEP_READS = {
    "missing_datetime_checks": {"Date", "Time"}, "extreme_time_checks": {"Time"}, "convert_timezone": {"Date", "Time"},
    "station_checks": {"Station"}, "add_metadata": {"Date"}, "add_comment_cols": {"Taxon"}, "correct_taxon_typos": {"Taxon"},
    "standardize_unknowns": {"Taxon"}, "update_synonyms": {"Taxon"}, "higher_lvl_taxa": {"Taxon"}, "combine_taxa": {"Taxon"},
}
STEP_ADDS = {
    "calc_densities": {"Units_per_mL", "Cells_per_mL", "Biovolume_per_mL"}, "add_comment_cols": {"QualityCheck", "Debris", "Notes"},
    "update_synonyms": {"OrigTaxon"}, "higher_lvl_taxa": {"Kingdom", "Phylum", "Class", "AlgalGroup", "Genus", "Species"},
}
STEP_ORDER = ["duplicate_checks", "missing_datetime_checks", "extreme_time_checks", "station_checks", "convert_timezone",
              "na_checks", "add_metadata", "calc_densities", "add_comment_cols", "correct_taxon_typos",
              "standardize_unknowns", "update_synonyms", "higher_lvl_taxa", "combine_taxa", "subset_cols"]


def compile_preset(schema: dict, preset: str, columns: list[str], tables: dict) -> list[tuple[str, str]]:
    """What a preset comes to on uploads with ``columns``: (step, "run" or why
    it is left out), in the order of the steps.

    A step that applies but whose columns neither the uploads nor an earlier
    step provide is an error here, before any data is read, as is a step that
    no formatter has; a step whose reference table is not given is left out."""
    unknown = set(schema.get("steps", {})) - set(STEP_ORDER)
    if unknown:
        raise ValueError(f"unknown step(s): {', '.join(sorted(unknown))}")
    have, plan, short = set(columns), [], []
    for name in STEP_ORDER:
        reads, adds = set(STEP_READS.get(name, ())), set(STEP_ADDS.get(name, ()))
        needs = {"add_metadata": "meta", "correct_taxon_typos": "typos", "update_synonyms": "taxa", "higher_lvl_taxa": "taxa"}.get(name)
        if name == "calc_densities" and schema.get("density"):
            reads |= {schema["density"]["unit"], schema["density"]["cell"]}
        if name == "combine_taxa":
            reads |= set(schema.get("combine_key_cols", ["Date", "Station"]))
        if name == "add_metadata":
            adds |= set(schema.get("metadata_columns", {}).get(preset, []))
        if not applies(schema, name, preset):
            plan.append((name, "does not apply"))
        elif needs and tables.get(needs) is None:
            plan.append((name, f"no {needs} table"))
        elif name == "calc_densities" and not schema.get("density"):
            plan.append((name, "no density columns named"))
        elif name == "subset_cols" and not schema.get("subset_cols", {}).get(preset):
            plan.append((name, "no columns named"))
        elif name in ("missing_datetime_checks", "extreme_time_checks", "convert_timezone", "station_checks") and not reads <= have:
            plan.append((name, "no such columns"))
        elif not reads <= have:
            short.append(f"{name}: {', '.join(sorted(reads - have))}")
        else:
            plan.append((name, "run"))
            have |= adds
    if short:
        raise ValueError(f"preset {preset!r} lacks columns for " + "; ".join(short))
    return plan


def formatter_batch(frames: list[DataFrame], schema: dict, preset: str, meta: DataFrame | None = None,
                    typos: DataFrame | None = None, taxa: DataFrame | None = None, *, order_cols: list[str] | None = None,
                    stations: list[str] | None = None, typo_order: str | list[str] | None = None,
                    taxa_order: str | list[str] | None = None) -> Result:
    """The interactive formatter as one batch job, driven by a survey
    schema: standardise columns, union uploads, the survey's own formatter,
    checks, timezone, metadata, comment codes, densities, taxon chain,
    combine, subset.  ``compile_preset`` decides the steps and is kept in the
    log ``steps``.  Densities run before the comment codes so UnitsExceedCells
    can fire.  Rows need an order: ``order_cols`` or a row id column."""
    std = [P.standardize_columns(f, schema.get("mapping", {})) for f in frames]
    df = P.dispatch(R.union_by_name(std), schema.get("format", ""), FORMATTERS)
    plan = compile_preset(schema, preset, df.columns, {"meta": meta, "typos": typos, "taxa": taxa})
    run = {name for name, what in plan if what == "run"}
    res = Result(with_row_id(df, order_cols))
    res.logs["steps"] = df.sparkSession.createDataFrame(plan, "step string, status string")
    keys = schema.get("combine_key_cols", ["Date", "Station"])
    if "duplicate_checks" in run:
        res.logs["duplicate_rows"] = CK.duplicate_rows(res.df.drop(ROW_ID))
        res = Result(stage(R.distinct_rows_keep_id(res.df)), res.logs)
        if set(keys) | {"Taxon"} <= set(df.columns):
            res.logs["duplicate_keys"] = CK.duplicate_rows(res.df.drop(ROW_ID), [*keys, "Taxon"])
    if "missing_datetime_checks" in run:
        res.logs["datetime_issues"] = CK.check_datetime(res.df)
    if "extreme_time_checks" in run:
        if step(schema, "extreme_time_checks", preset).get("military"):
            res = _merge(res, CK.convert_to_military(res.df))
        res.logs["extreme_times"] = CK.check_extreme_times(res.df)
    if "station_checks" in run and stations is not None:
        known = df.sparkSession.createDataFrame([(s,) for s in stations], "Station string")
        res.logs["unknown_stations"] = res.df.select("Station").distinct().join(known, "Station", "left_anti")
    if "convert_timezone" in run:
        tz = step(schema, "convert_timezone", preset).get("from_tz", "PST/PDT")
        res.logs["timezone_preview"] = T.timezone_preview(res.df, tz)
        res = Result(res.df.withColumn("Time", T.shift_clock("Date", "Time", tz)), res.logs)
    if "na_checks" in run:
        res.logs["na_check"] = CK.check_nas(res.df)
    if "add_metadata" in run:
        cols = schema.get("metadata_columns", {}).get(preset, [])
        res = _merge(res, J.add_metadata_first(res.df, meta, cols, start="start_date", end="end_date"))
    if "calc_densities" in run:
        d = schema["density"]
        res = _merge(res, M.calc_density_factor(res.df, d["unit"], d["cell"]))
    if "add_comment_cols" in run:
        cc = schema.get("comment_col")
        cc = cc if cc in res.df.columns else None
        res = _merge(res, X.add_qc_col(res.df, cc))
        res = _merge(res, X.add_debris_col(res.df, cc))
        res = _merge(res, X.add_notes_col(res.df, cc))
    o = step(schema, "standardize_unknowns", preset)
    mode = step(schema, "higher_lvl_taxa", preset).get("std_type", "program")
    steps = {
        "correct_taxon_typos": lambda d: X.correct_taxon_typos(d, typos, order=typo_order),
        "standardize_unknowns": lambda d: X.clean_unknowns(d, o.get("std_sp", True), o.get("std_suffix", True)),
        "update_synonyms": lambda d: X.update_synonyms(d, taxa, order=taxa_order),
        "higher_lvl_taxa": lambda d: X.higher_lvl_taxa(d, taxa, "unified" if mode != "program" else "program"),
    }
    res = _merge(res, on_names(res.df, {k: f for k, f in steps.items() if k in run}, taxa))
    measures = [c for c in schema.get("combine_measurement_cols", DENSITIES) if c in res.df.columns]
    if set(keys) | {"Taxon"} <= set(res.df.columns):
        # C7-C9 over what is about to be combined
        rows = res.df.drop(ROW_ID)
        res.logs["nondistinct_rows"] = CK.check_distinct(rows)
        res.logs["nondistinct_measures"] = CK.check_distinct(rows, "key_measure_cols", key_cols=keys, measurement_cols=measures)
        res.logs["nondistinct_keys"] = CK.check_distinct(rows, "key_cols", key_cols=keys)
    if "combine_taxa" in run:
        res = _merge(res, CB.combine_taxa(res.df, keys, measures))
    if "subset_cols" in run:
        res = _merge(res, P.pad_subset(res.df, schema["subset_cols"][preset]))
    return res


def format_uploads(spark: SparkSession, files: list[str], schema: dict, preset: str, *, seen=None,
                   manifest_path: str | None = None, **kwargs) -> tuple[DataFrame, Result]:
    """L7 from files: ingest (S8), then ``formatter_batch`` over the rows of the valid ones.
    Returns the manifest and the formatted table."""
    manifest, rows = ingest_manifest(spark, files, schema, seen, manifest_path)
    return manifest, formatter_batch([rows.drop("_other")], schema, preset, **kwargs)


def standardize_lab_columns(df: DataFrame, rename_map: dict[str, str], keep: list[str],
                            density: dict | None = None, meta: DataFrame | None = None,
                            method_col: str = "SampleMethod", date_cols: tuple[str, ...] = (), **meta_range) -> DataFrame:
    """Fixed column standardisers: drop measurement/dimension
    columns and empty rows, rename, dates from mixed text (T3, ``date_cols``),
    optional densities, growth form, the sampling method by date range (J1,
    from ``meta``; ``meta_range``: start, end, today), fixed select (absent
    columns padded)."""
    d = P.drop_empty_rows(P.drop_cols_matching(df, r"^(Dimension|Measure)"))
    d = P.rename_cols(d, rename_map).df
    if date_cols:
        d = d.withColumns({c: T.parse_date_multi(c) for c in date_cols})
    if density:
        d = M.calc_density_factor(d, density["unit"], density["cell"])
    if "PhytoForm" in d.columns:
        d = FL.clean_phytoform(d)
    if meta is not None:
        d = J.from_meta(d.drop(method_col), meta, [method_col], **meta_range)
    return P.pad_subset(d, keep)
