"""Operators against brute force where their way of computing was made for size:
synonym walks, date ranges, regions, exact medians, ingest, matrix lines, the formatter's plan."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harmonia.operators import checks as CK
from harmonia.operators import combine as CB
from harmonia.operators import filters as FL
from harmonia.operators import grids as G
from harmonia.operators import joins as J
from harmonia.operators import measures as M
from harmonia.operators import taxonomy as X
from harmonia.plans import programs as PG
from harmonia.sources import readers as RD
from harmonia.sources import sinks as SK
from harmonia.sources.config import complete_schema


# ---------------------------------------------------------------- X6

def _walk_by_hand(succ, k):
    seen, cur = [], k
    while cur in succ:
        nxt = succ[cur]
        if nxt is None or nxt in seen:
            break
        seen.append(cur)
        cur = nxt
    return cur


@pytest.mark.parametrize("rounds", [1, 4])
def test_synonym_walk_on_chains_loops_and_cycles(spark, monkeypatch, rounds):
    monkeypatch.setattr(X, "WALK_ROUNDS", rounds)  # with one round, long chains go to the full contraction
    succ = {f"c{i}": f"c{i + 1}" for i in range(45)}                       # a chain of 45
    succ |= {"self": "self", "to_self": "self", "end": None, "to_end": "end"}
    succ |= {"x": "y", "y": "z", "z": "x", "tail1": "tail2", "tail2": "y"}  # a cycle and a tail into it
    succ |= {f"r{i}": f"r{(i + 1) % 30}" for i in range(30)} | {"into": "r7"}  # a cycle longer than a round
    succ |= {"a": "b", "b": "a"}
    edges = spark.createDataFrame(list(succ.items()), "k string, v string")
    starts = [*succ, "stranger", "c45"]
    got = dict(X.walk_chains(spark.createDataFrame([(s,) for s in starts], "k string"), edges).collect())
    assert got == {s: _walk_by_hand(succ, s) for s in starts}


def test_synonym_walk_on_random_maps(spark):
    rng = random.Random(3)
    names = [f"n{i}" for i in range(300)]
    succ = {n: rng.choice([None, *names]) if rng.random() < 0.2 else rng.choice(names) for n in names if rng.random() < 0.9}
    edges = spark.createDataFrame(list(succ.items()), "k string, v string")
    got = dict(X.walk_chains(spark.createDataFrame([(n,) for n in names], "k string"), edges).collect())
    assert got == {n: _walk_by_hand(succ, n) for n in names}


def test_unknown_names_word_by_word(spark):
    given = {"unknown": "Unknown sp.", "Unidentified  diatom sp.": "Unknown diatom", "cf. undetermined": "Unknown sp.",
             "cf. Unknown Big": "Unknown big", "CF. unknown x y": "Unknown x y", "Genus spp": "Genus sp.", "Genus spp. 1 (a b) c": "Genus sp.",
             "Genus sp (odd)": "Genus sp.", "unknown sp": "Unknown sp.", "Unknown A b sp.": "Unknown A b", "Genus cf. unknown": "Genus cf. Unknown",
             "Genus species": "Genus species", "": "", "x-sp more": "x-sp.", "Unknown (small) Cell": "Unknown cell", "cf. Unknown x sp.": "Unknown x sp.",
             "species sp.": "species sp.", "Unknown-like thing sp.": "Unknown-like thing"}
    df = spark.createDataFrame([(k,) for k in given] + [(None,)], "Taxon string")
    got = {r.old: r.Taxon for r in X.clean_unknowns(df.withColumn("old", F.col("Taxon"))).df.collect()}
    assert got == {**given, None: None}
    kept = X.clean_unknowns(spark.createDataFrame([("Genus spp 1 (a)",)], "Taxon string"), False, False).df.first()[0]
    assert kept == "Genus spp 1 (a)"


# ---------------------------------------------------------------- J1-J3, J7

def test_date_ranges_of_any_length(spark):
    rng = random.Random(5)
    day = lambda n: dt.date(1969, 6, 1) + dt.timedelta(days=n)  # noqa: E731  both sides of day 0
    ranges = [(i, day(a), day(a + rng.choice([0, 1, 2, 7, 64, 65, 400, 5000]))) for i in range(60) for a in [rng.randrange(-300, 900)]]
    ranges += [(90, day(5), None), (91, None, day(9)), (92, day(30), day(3)), (93, dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    dates = [day(rng.randrange(-400, 1500)) for _ in range(300)] + [None]
    meta = spark.createDataFrame(ranges, "i int, s date, e date")
    data = spark.createDataFrame([(d,) for d in dates], "Date date")
    got = {(r["__date"], r.i) for r in J.covering(data, meta, "s", "e").collect()}
    assert got == {(d, i) for d in dates if d for i, s, e in ranges if s and e and s <= d <= e}
    made = meta.where("i < 90 or i = 93").count()
    cut = J.covering(data, meta, "s", "e")
    assert cut.select("i").distinct().count() <= made


def test_range_rows_do_not_grow_with_length(spark):
    meta = spark.createDataFrame([(1, dt.date(1, 1, 1), dt.date(9999, 12, 31))], "i int, s date, e date")
    plan = J.covering(spark.createDataFrame([(dt.date(2000, 1, 1),)], "Date date"), meta, "s", "e")
    assert plan.count() == 1
    levels = meta.selectExpr("datediff(e, s) as n").first()[0]
    assert levels < 1 << (J.LEVELS - 1)


def test_alias_matches_where_no_site_is_given(spark):
    st = spark.createDataFrame([("New", None, "old, older"), ("Other", "7", "old")], "Station string, site_no string, field_id_alias string")
    df = spark.createDataFrame([("old", None), ("older", None), ("old", "7"), ("old", "8")], "Station string, site_no string")
    assert sorted(r.Station for r in J.rename_by_alias(df, st).df.collect()) == ["New", "New", "Other", "old"]


# ---------------------------------------------------------------- J14

def _inside_by_hand(px, py, xs, ys):
    hit = False
    for x1, y1, x2, y2 in zip(xs, ys, xs[1:], ys[1:]):
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def test_regions_of_every_shape_and_size(spark):
    rng = random.Random(11)
    shapes = []
    for i in range(40):
        cx, cy, r = rng.uniform(-20, 20), rng.uniform(-20, 20), rng.choice([0.3, 1, 3])
        turn = sorted(rng.uniform(0, 6.28) for _ in range(rng.randrange(3, 12)))
        pts = [(cx + r * rng.uniform(0.2, 1) * np.cos(t), cy + r * rng.uniform(0.2, 1) * np.sin(t)) for t in turn]
        shapes.append([(float(x), float(y)) for x, y in pts + pts[:1]])
    shapes.append([(-30.0, -30.0), (30.0, -30.0), (30.0, 30.0), (-30.0, 30.0), (-30.0, -30.0)])          # covers all
    shapes.append([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 2.0), (0.0, 10.0), (0.0, 0.0)])           # a notch, round corners
    shapes[-2], shapes[-1] = shapes[-1], shapes[-2]
    polys = spark.createDataFrame([(i, f"R{i}", f"S{i}", [p[0] for p in s], [p[1] for p in s]) for i, s in enumerate(shapes)],
                                  "poly_idx int, Region string, SubRegion string, xs array<double>, ys array<double>")
    pts = [(rng.uniform(-35, 35), rng.uniform(-35, 35)) for _ in range(1500)] + [(float(x), float(y)) for x in range(-2, 12) for y in range(-2, 12)]
    pts += [p for s in shapes for p in s] + [(0.001, 0.001)] * 500  # corners and a hot spot
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)] + [(-1, None, 1.0)], "id int, Longitude double, Latitude double")
    got = {r.id: r.Region for r in J.assign_region(df, polys).collect()}
    want = {}
    for i, (x, y) in enumerate(pts):
        for k, s in enumerate(shapes):
            if _inside_by_hand(x, y, [p[0] for p in s], [p[1] for p in s]):
                want[i] = f"R{k}"
                break
    assert got == want


def test_a_large_region_is_stored_by_its_outline(spark):
    side = 1000.0
    polys = spark.createDataFrame([(0, [0.0, side, side, 0.0, 0.0], [0.0, 0.0, side, side, 0.0])], "o int, xs array<double>, ys array<double>")
    rows = J._polygon_rows(polys, "o", 1.0, 1.0)
    n = rows.selectExpr("sum(size(edges)) e", "sum(size(edge_runs)) r", "sum(size(full_runs)) f").first()
    assert n.e + n.r + n.f < 10 * side  # a million tiles are covered


# ---------------------------------------------------------------- D10, C13, counts

def test_medians_of_several_measures_at_once(spark):
    rng = np.random.default_rng(2)
    rows = [("a", float(v)) for v in rng.integers(0, 9, 401)] + [("b", float(v)) for v in rng.standard_normal(500)]
    rows += [("one", 7.0), (None, 1.0), (None, 4.0), ("none", None), ("nan", float("nan"))]
    rng.shuffle(rows)
    long = spark.createDataFrame([(m, None if v is None else float(v)) for m, v in rows], "m string, x double").repartition(7)
    got = M.exact_medians(long, "m", "x")
    want = {k: float(np.median([v for m, v in rows if m == k])) for k in ("a", "b", "one", None)}
    assert got == pytest.approx(want)


def test_outlier_statistics_equal_flags(spark):
    rng = random.Random(1)
    rows = [(i, 10 ** rng.gauss(2, 0.3) if i % 9 else 0.0, 5.0 if i % 50 else 5000.0) for i in range(500)] + [(900, 1e9, None)]
    df = spark.createDataFrame(rows, "id int, Cells_per_mL double, Units_per_mL double").withColumn("QualityCheck", F.lit("NoCode"))
    stats = {r.measure: r for r in M.outlier_stats(df, {"Cells_per_mL": 3.0, "Units_per_mL": 3.0}).collect()}
    both = M.flag_all_outliers(df, {"Cells_per_mL": 3.0, "Units_per_mL": 3.0}).df
    for c, code in (("Cells_per_mL", "OutlierCells"), ("Units_per_mL", "OutlierUnits")):
        alone = M.flag_outliers(df, c, cutoff=3.0, add_flag=True)
        assert stats[c].n_flagged == alone.logs["outlier_stats"].first().n_flagged > 0
        assert {r.id for r in alone.df.where(F.col("QualityCheck").contains(code)).collect()} == \
               {r.id for r in both.where(F.col("QualityCheck").contains(code)).collect()}
    assert stats["Units_per_mL"].mad == 0.0  # values above a median of no spread are flagged all the same


def test_row_numbers_and_first_bad_rows(spark):
    rows = [(i, "bad" if i % 3 == 0 else "7.5" if i % 3 == 1 else None) for i in range(600)] + [(1000, "x1")]
    df = spark.createDataFrame(rows, "id int, v string").repartition(9)
    assert [r.n for r in G.number_rows(df, ["id"], "n").orderBy("id").collect()] == list(range(1, 602))
    got = {r.v: r.row_numbers for r in CK.check_non_numeric(df, "v", ["id"]).collect()}
    assert got == {"bad": [1 + 3 * i for i in range(10)], "x1": [601]}


def test_recode_by_date_bounds(spark):
    df = spark.createDataFrame([("p", dt.date(2020, 3, 17)), ("p", dt.date(2020, 3, 18)), ("p", None), ("q", dt.date(2020, 3, 1))], "s string, Date date")
    out = FL.recode_by_date(df, "m", [("early", {"s": "p"}, None, "2020-03-17"), ("late", {"s": "p"}, "2020-03-18", None)], default="?")
    assert [r.m for r in out.collect()] == ["early", "late", "?", "?"]


# ---------------------------------------------------------------- A1, A3

def test_combining_needs_an_order(spark):
    df = spark.createDataFrame([("d", "s", "t", 1.0)], "Date string, Station string, Taxon string, Cells_per_mL double")
    for call in (lambda: CB.combine_taxa(df), lambda: CB.combine_taxa_lts(df), lambda: PG.prep_for_synthesis(df, {}),
                 lambda: PG.formatter_batch([df], complete_schema({"survey": "s"}), "standard")):
        with pytest.raises(ValueError, match="order"):
            call()


def _combine_by_hand(rows):
    """A1 on (id, key, taxon, class, notes, orig, value) rows, one level deciding."""
    named, out = [], {}
    for r in rows:
        classes = {x[3] for x in rows if (x[1], x[2]) == (r[1], r[2]) and x[3] is not None}
        named.append((r, f"Unknown {r[3].lower() if r[3] else 'NA'}" if len(classes) > 1 else r[2]))
    for key in {(r[1], t) for r, t in named}:
        own = sorted(r for r, t in named if (r[1], t) == key)
        notes = [w for r in own for w in (r[4] or "").split() if r[4] != "NoNote"]
        names = list(dict.fromkeys(" ".join(r[5].split()) for r in own if r[5] and r[5].strip()))
        text = " ".join(dict.fromkeys(notes))
        if len(own) > 1 and "MultipleEntries" not in notes:
            text = f"{text} MultipleEntries".strip()
        if names and any(not (r[5] or "").strip() for r in own) and key[1] not in names:
            names.append(key[1])
        values = [r[6] for r in own if r[6] is not None]
        out[key] = (text or "NoNote", "; ".join(names) or None, sum(values) if values else None, own[0][0], own[0][3])
    return out


def test_combine_equals_brute_force_on_any_partitions(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice("kl"), rng.choice(["A a", "B b", "Unknown x", None]), rng.choice(["X", "Y", None, "X"]),
             rng.choice(["NoNote", "Cyst", "Cyst  Filament", None, "", "MultipleEntries Cyst"]), rng.choice([None, "", "old  name", "A a", "other"]),
             rng.choice([None, 1.0, 2.5])) for i in range(120)]
    df = spark.createDataFrame([(*r, "P", "K") for r in rows], "id int, key string, Taxon string, Class string, Notes string, OrigTaxon string, "
                                                               "Cells_per_mL double, Phylum string, Kingdom string")
    want = _combine_by_hand(rows)
    for parts in (1, 7):
        got = CB.combine_taxa(df.repartition(parts), ["key"], ["Cells_per_mL"], order_cols=["id"]).df.collect()
        assert {(r.key, r.Taxon): (r.Notes, r.OrigTaxon, r.Cells_per_mL, r.id, r.Class) for r in got} == want and len(got) == len(want)


def test_combine_states_are_as_many_as_texts_not_rows(spark):
    df = spark.range(50_000).selectExpr("id", "'k' key", "'T' Taxon", "concat('n', id % 5) Notes", "1.0D Cells_per_mL")
    got = CB.combine_taxa(df, ["key"], ["Cells_per_mL"], order_cols=["id"]).df.first()
    assert got.Notes == "n0 n1 n2 n3 n4 MultipleEntries" and got.Cells_per_mL == 50_000.0


def test_lts_merge_by_hand(spark):
    rows = [(1, "d", "T", None, 1.0), (2, "d", "T", "b", 2.0), (3, "d", "T", "b", 3.0), (4, "d", "U", "x", 1.0), (5, "d", "U", "x", 1.0),
            (6, "d", "V", None, 1.0), (7, "d", "T", "T", 1.0)]
    df = spark.createDataFrame(rows, "id int, Date string, Taxon string, OrigTaxon string, Cells_per_mL double")
    res = CB.combine_taxa_lts(df.withColumnRenamed("id", "_row_id"), sort_cols=("Date", "Taxon"))
    got = sorted((r.Taxon, r.OrigTaxon or "", r.Cells_per_mL) for r in res.df.collect())
    assert got == [("T", "T; b", 7.0), ("U", "x", 1.0), ("U", "x", 1.0), ("V", "", 1.0)]
    assert [(r.OrigTaxons, r.OldValue, r.NewValue) for r in res.logs["combine_taxa_lts"].collect()] == [("T; b", "1.0; 2.0; 3.0; 1.0", 7.0)]


# ---------------------------------------------------------------- S3, S8, S13

SCHEMA = {"columns": {"Station": {"type": "character", "required": True}, "Count": {"type": "integer", "required": True, "min": 0}}}


def test_ingest_of_files_of_every_kind(spark, tmp_path):
    texts = {"good.csv": 'Station,Count,Note\nA,3,"x, ""y"""\r\nB,4.5,\n\n', "other order.csv": "Count,Extra,Station\n7,e,C+D\n",
             "missing.csv": "Station,Note\nA,n\n", "below.csv": "Station,Count\nA,-1\n", "text.csv": "Station,Count\nA,many\n",
             "numbers.csv": "Station,Count\n1,1\n2,2\n", "ragged.csv": "Station,Count\nA,1,2\n", "empty.csv": "", "header.csv": "Station,Count\n",
             "seen.csv": "Station,Count\nA,1\n", "bom.csv": "﻿Station,Count\nZ,9\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    files = [str(tmp_path / n) for n in texts] + [str(tmp_path / "good.csv"), str(tmp_path / "absent.csv")]
    where = str(tmp_path / "manifest")
    manifest, rows = RD.ingest_manifest(spark, files, SCHEMA, ["seen.csv"], where)
    got = {r.name: (r.status, r.errors, r.n_rows) for r in manifest.collect()}
    assert got == {
        "good.csv": ("valid", [], 2), "other order.csv": ("valid", [], 1), "header.csv": ("valid", [], 0), "bom.csv": ("valid", [], 1),
        "missing.csv": ("invalid", ["Count: missing required column"], 1), "below.csv": ("invalid", ["Count: below min"], 1),
        "text.csv": ("invalid", ["Count: not numeric"], 1), "numbers.csv": ("invalid", ["Station: not character"], 2),
        "ragged.csv": ("invalid", ["line: number of cells is not that of the header"], 1),
        "empty.csv": ("invalid", ["No header line"], 0), "absent.csv": ("invalid", ["Could not read file"], 0)}
    assert sorted((r._source_file, r.Station, r.Count, r._other.get("Note"), r._other.get("Extra")) for r in rows.collect()) == [
        ("bom.csv", "Z", 9.0, None, None), ("good.csv", "A", 3.0, 'x, "y"', None), ("good.csv", "B", 4.5, None, None),
        ("other order.csv", "C+D", 7.0, None, "e")]
    again, rows = RD.ingest_manifest(spark, files, SCHEMA, ["seen.csv"], where)
    assert again.count() == 0 and rows.count() == 0 and rows.columns == ["_source_file", "Station", "Count", "_other"]


def test_ingest_of_a_thousand_files_is_a_few_jobs(spark, tmp_path):
    for i in range(1000):
        (tmp_path / f"f{i}.csv").write_text(f"Station,Count\nS{i},{i}\n")
    spark.sparkContext.setJobGroup("ingest", "ingest")
    manifest, rows = RD.ingest_manifest(spark, [str(tmp_path / f"f{i}.csv") for i in range(1000)], SCHEMA)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("ingest"))
    spark.sparkContext.setJobGroup("", "")
    assert manifest.where("status = 'valid'").count() == 1000 and rows.count() == 1000
    assert jobs <= 12


def test_typing_by_name_finds_numbers_and_dates(spark, tmp_path):
    (tmp_path / "t.csv").write_text("SampleDate,n,mixed,blank\n1/2/2020,3,4,\n13/45/2020,,x,\n")
    df = RD.read_csv_typed_by_name(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"SampleDate": "date", "n": "double", "mixed": "string", "blank": "string"}
    assert [r.SampleDate for r in df.collect()] == [dt.date(2020, 1, 2), None]


def test_matrix_lines_equal_the_table(spark):
    meta = spark.createDataFrame([("s1", "wet", None), (None, "dr,y", "a"), ("s3", 'q"t', "b")], "sample string, Season string, Lab string")
    com = spark.createDataFrame([("s1", "A", 1.0), (None, "A", 2.0), ("s3", "B, b", 3.0)], "sample string, Taxon string, value double")
    wide = SK.matrix_export(meta, com, ["sample"]).collect()
    lines = {(r.block, r.Variable): r.line for r in SK.matrix_lines(meta, com, ["sample"]).collect()}

    def cell(v):
        return '"' + v.replace('"', '""') + '"' if v and any(c in v for c in '",') else v or ""

    assert len(lines) == len(wide)
    for r in wide:
        assert lines[r.block, r.Variable] == ",".join(cell(r[c]) for c in ("Variable", "R1", "R2", "R3"))


def test_matrix_of_fifty_thousand_samples(spark, tmp_path):
    n = 50_000
    meta = spark.range(n).selectExpr("id", "concat('L', id % 7) Lab")
    com = spark.range(n).selectExpr("id", "concat('t', id % 20) Taxon", "id value")
    SK.write_matrix(SK.matrix_lines(meta, com, ["id"]), str(tmp_path / "m"))
    lines = [x for f in sorted(os.listdir(tmp_path / "m")) if f.endswith(".txt") for x in (tmp_path / "m" / f).read_text().split("\n")[:-1]]
    assert len(lines) == 3 + 20 + 1 and all(x.count(",") == n for x in lines)
    assert lines[0].startswith("Environmental variables,") and lines[1].startswith(",R1,R2,") and lines[-1].startswith("Lab,L0,L1,")
    t3 = next(x for x in lines if x.startswith("t3,")).split(",")
    assert [i - 1 for i, v in enumerate(t3) if i and v] == list(range(3, n, 20)) and t3[4] == "3"


# ---------------------------------------------------------------- L7

def test_a_preset_is_checked_before_anything_runs():
    schema = complete_schema({"survey": "s", "presets": ["p"], "combine_key_cols": ["Date", "Station"], "subset_cols": {"p": ["Taxon"]},
                              "density": {"unit": "units", "cell": "cells"}})
    plan = dict(PG.compile_preset(schema, "p", ["Date", "Station", "Taxon", "units", "cells"], {}))
    assert list(plan) == PG.STEP_ORDER
    assert plan["combine_taxa"] == plan["calc_densities"] == plan["subset_cols"] == "run"
    assert plan["add_metadata"] == "no meta table" and plan["convert_timezone"] == "no such columns"
    with pytest.raises(ValueError, match="calc_densities: cells"):
        PG.compile_preset(schema, "p", ["Date", "Station", "Taxon", "units"], {})
    with pytest.raises(ValueError, match="unknown step"):
        PG.compile_preset(complete_schema({"survey": "s", "steps": {"polish": {}}}), "standard", ["Taxon"], {})
    assert dict(PG.compile_preset(schema, "nobody", [], {}))["combine_taxa"] == "does not apply"


def test_uploads_are_formatted_from_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Day,Site,Name,Cells,Comments,Dimension 1\n3/1/2024,A,unknown diatom,5,cyst,1\n3/1/2024,A,unknown diatom,7,,2\n")
    (tmp_path / "b.csv").write_text("Day,Site\n1/1/2024,B\n")
    schema = complete_schema({"survey": "s", "presets": ["p"], "format": "day first dates", "comment_col": "Comments",
                              "mapping": {"Date": "Day", "Station": "Site", "Taxon": "Name", "Cells_per_mL": "Cells"},
                              "columns": {"Day": {"required": True}, "Site": {"required": True}, "Name": {"required": True},
                                          "Cells": {"type": "integer", "required": True}, "Comments": {}},
                              "subset_cols": {"p": ["Date", "Station", "Taxon", "Cells_per_mL", "Notes"]}})
    manifest, res = PG.format_uploads(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema, "p",
                                      order_cols=["_source_file", "Cells_per_mL"], stations=["B"])
    assert {r.name: r.status for r in manifest.collect()} == {"a.csv": "valid", "b.csv": "invalid"}
    assert [tuple(r) for r in res.df.collect()] == [(dt.date(2024, 1, 3), "A", "Unknown diatom", 12.0, "Cyst MultipleEntries")]
    assert [r.Station for r in res.logs["unknown_stations"].collect()] == ["A"]
    assert res.logs["nondistinct_keys"].count() == 2 and res.logs["steps"].where("status = 'run'").count() >= 5
