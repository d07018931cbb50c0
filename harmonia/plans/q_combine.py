"""A1-A3 queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmonia.operators.combine import combine_taxa, combine_taxa_lts
from harmonia.plans.catalog import query, rounded, sq
from harmonia.plans.fixtures import FIXTURES, LI_ORDER, fixture, with_fixtures

A1_COLS = ["Event", "Taxon", "Class", "Phylum", "Kingdom", "Cells_per_mL", "Units_per_mL",
           "Biovolume_per_mL", "GALD", "Notes", "QualityCheck", "Debris", "PhytoForm",
           "OrigTaxon", "Station", "Date"]
A1_MEASURES = ["Cells_per_mL", "Units_per_mL", "Biovolume_per_mL"]


def a1_result(spark, sf_dir):
    # the order that line_pos numbers, as an id: the window is not needed then;
    # rows dealt by event once need no other exchange while they are combined
    src = fixture(spark, sf_dir, "li_taxa")
    src = src.withColumn("_row_id", F.struct(*LI_ORDER)).drop(*LI_ORDER, "line_pos").repartition("Event")
    return combine_taxa(src, key_cols=["Event"], measurement_cols=A1_MEASURES)


def _rid(p=""):
    return "(" + ", ".join(f"{p}{c}" for c in LI_ORDER) + ")"


A1_SQL = with_fixtures(f"""
WITH fl AS (
  SELECT Event, Taxon, min(Class) <> max(Class) AS mc, min(Phylum) <> max(Phylum) AS mp,
         min(Kingdom) <> max(Kingdom) AS mk
  FROM li_taxa GROUP BY Event, Taxon),
t AS (
  SELECT b.* REPLACE (
           CASE WHEN coalesce(fl.mc, false) THEN 'Unknown ' || coalesce(lower(b.Class), 'NA')
                WHEN coalesce(fl.mp, false) THEN 'Unknown ' || coalesce(lower(b.Phylum), 'NA')
                WHEN coalesce(fl.mk, false) THEN 'Unknown ' || coalesce(lower(b.Kingdom), 'NA')
                ELSE b.Taxon END AS Taxon),
         {_rid('b.')} AS rid
  FROM li_taxa b JOIN fl ON b.Event IS NOT DISTINCT FROM fl.Event
                         AND b.Taxon IS NOT DISTINCT FROM fl.Taxon),
m AS (
  SELECT Event, Taxon, count(*) AS n, max(GALD) AS GALD,
         sum(Cells_per_mL) AS Cells_per_mL, sum(Units_per_mL) AS Units_per_mL,
         sum(Biovolume_per_mL) AS Biovolume_per_mL,
         bool_or(OrigTaxon IS NULL OR {sq('OrigTaxon')} = '') AS orig_na,
         arg_min_null(Class, rid) AS Class, arg_min_null(Phylum, rid) AS Phylum,
         arg_min_null(Kingdom, rid) AS Kingdom, arg_min_null(Station, rid) AS Station,
         arg_min_null(Date, rid) AS Date
  FROM t GROUP BY Event, Taxon),
tok AS (
  SELECT Event, Taxon, 'Notes' AS col, unnest(string_split({sq('Notes')}, ' ')) AS val,
         generate_subscripts(string_split({sq('Notes')}, ' '), 1) AS pos, rid, 0 AS rnk, '' AS sval
  FROM t WHERE {sq('Notes')} <> 'NoNote' AND {sq('Notes')} <> ''
  UNION ALL
  SELECT Event, Taxon, 'QualityCheck', unnest(string_split({sq('QualityCheck')}, ' ')),
         generate_subscripts(string_split({sq('QualityCheck')}, ' '), 1), rid, 0, ''
  FROM t WHERE {sq('QualityCheck')} <> 'NoCode' AND {sq('QualityCheck')} <> ''
  UNION ALL
  SELECT Event, Taxon, 'Debris', {sq('Debris')}, 0, rid,
         coalesce(list_position(['High', 'Moderate', 'Low', 'None', 'Unknown'], {sq('Debris')}), 6), ''
  FROM t WHERE Debris IS NOT NULL
  UNION ALL
  SELECT Event, Taxon, 'PhytoForm', {sq('PhytoForm')}, 0, rid, 0, {sq('PhytoForm')}
  FROM t WHERE PhytoForm IS NOT NULL
  UNION ALL
  SELECT Event, Taxon, 'OrigTaxon', {sq('OrigTaxon')}, 0, rid, 0, ''
  FROM t WHERE {sq('OrigTaxon')} <> ''),
f AS (SELECT Event, Taxon, col, val, min((rnk, sval, rid, pos)) AS o
      FROM tok WHERE val <> '' GROUP BY Event, Taxon, col, val),
tx AS (
  SELECT Event, Taxon,
         string_agg(val, ' ' ORDER BY o) FILTER (WHERE col = 'Notes') AS t_notes,
         string_agg(val, ' ' ORDER BY o) FILTER (WHERE col = 'QualityCheck') AS t_qc,
         string_agg(val, ', ' ORDER BY o) FILTER (WHERE col = 'Debris') AS t_debris,
         string_agg(val, ', ' ORDER BY o) FILTER (WHERE col = 'PhytoForm') AS t_pf,
         string_agg(val, '; ' ORDER BY o) FILTER (WHERE col = 'OrigTaxon') AS t_orig,
         bool_or(col = 'OrigTaxon' AND val = Taxon) AS has_tax
  FROM f GROUP BY Event, Taxon)
SELECT m.Event, m.Taxon, m.Class, m.Phylum, m.Kingdom,
       round(m.Cells_per_mL, 4) AS Cells_per_mL, round(m.Units_per_mL, 4) AS Units_per_mL,
       round(m.Biovolume_per_mL, 4) AS Biovolume_per_mL, m.GALD,
       CASE WHEN m.n > 1 AND coalesce(tx.t_notes, 'NoNote') = 'NoNote' THEN 'MultipleEntries'
            WHEN m.n > 1 AND NOT regexp_matches(coalesce(tx.t_notes, 'NoNote'), '\\bMultipleEntries\\b')
                 THEN coalesce(tx.t_notes, 'NoNote') || ' MultipleEntries'
            ELSE coalesce(tx.t_notes, 'NoNote') END AS Notes,
       coalesce(tx.t_qc, 'NoCode') AS QualityCheck,
       tx.t_debris AS Debris,
       coalesce(tx.t_pf, '') AS PhytoForm,
       CASE WHEN tx.t_orig IS NOT NULL AND m.orig_na AND NOT coalesce(tx.has_tax, false)
            THEN tx.t_orig || '; ' || m.Taxon ELSE tx.t_orig END AS OrigTaxon,
       m.Station, m.Date
FROM m LEFT JOIN tx ON m.Event IS NOT DISTINCT FROM tx.Event AND m.Taxon IS NOT DISTINCT FROM tx.Taxon
""", "li_taxa")


@query("a1_combine_taxa", A1_SQL)
def a1_combine_taxa(spark, sf_dir):
    return rounded(a1_result(spark, sf_dir).df.select(*A1_COLS), A1_MEASURES)


@query("a1_combined_taxa_log", with_fixtures("""
WITH fl AS (
  SELECT Event, Taxon, min(Class) <> max(Class) AS mc, min(Phylum) <> max(Phylum) AS mp,
         min(Kingdom) <> max(Kingdom) AS mk FROM li_taxa GROUP BY Event, Taxon),
t AS (
  SELECT b.Event, CASE WHEN coalesce(fl.mc, false) THEN 'Unknown ' || coalesce(lower(b.Class), 'NA')
                WHEN coalesce(fl.mp, false) THEN 'Unknown ' || coalesce(lower(b.Phylum), 'NA')
                WHEN coalesce(fl.mk, false) THEN 'Unknown ' || coalesce(lower(b.Kingdom), 'NA')
                ELSE b.Taxon END AS Taxon
  FROM li_taxa b JOIN fl ON b.Event IS NOT DISTINCT FROM fl.Event
                         AND b.Taxon IS NOT DISTINCT FROM fl.Taxon)
SELECT Event, Taxon, count(*) AS N FROM t GROUP BY Event, Taxon HAVING count(*) > 1
""", "li_taxa"))
def a1_combined_taxa_log(spark, sf_dir):
    return a1_result(spark, sf_dir).logs["combined_taxa"]


FIXTURES["ev_lts"] = """
SELECT CAST(ts AS DATE) AS Date, 'U' || CAST(user_id AS STRING) AS Station,
       event_type AS Taxon,
       CASE WHEN value < 100 THEN NULL WHEN value < 300 THEN 'small ' || event_type
            ELSE 'big ' || event_type END AS OrigTaxon,
       value AS Cells_per_mL, event_id AS _row_id
FROM {events}
"""

_SIGNIF_SUM = ("CASE WHEN s = 0 THEN 0.0 WHEN floor(log10(abs(s))) - 3 < 0 "
               "THEN round(s * pow(10, -(floor(log10(abs(s))) - 3))) / pow(10, -(floor(log10(abs(s))) - 3)) "
               "ELSE round(s / pow(10, floor(log10(abs(s))) - 3)) * pow(10, floor(log10(abs(s))) - 3) END")

A3_SQL = with_fixtures(f"""
WITH g AS (
  SELECT Date, Station, Taxon, count(*) AS n,
         count(DISTINCT OrigTaxon) + max(CASE WHEN OrigTaxon IS NULL THEN 1 ELSE 0 END) AS nd,
         round(coalesce(sum(Cells_per_mL), 0.0), 9) AS s
  FROM ev_lts GROUP BY Date, Station, Taxon),
dup AS (SELECT * FROM g WHERE n > 1 AND nd > 1),
nm AS (SELECT d.Date, d.Station, d.Taxon, coalesce(d.OrigTaxon, d.Taxon) AS nm, min(d._row_id) AS o
       FROM ev_lts d JOIN dup ON d.Date = dup.Date AND d.Station = dup.Station AND d.Taxon = dup.Taxon
       GROUP BY ALL),
j AS (SELECT Date, Station, Taxon, string_agg(nm, '; ' ORDER BY o) AS OrigTaxon FROM nm GROUP BY ALL)
SELECT d.Date, d.Station, d.Taxon, d.OrigTaxon, d.Cells_per_mL
FROM ev_lts d ANTI JOIN dup ON d.Date = dup.Date AND d.Station = dup.Station AND d.Taxon = dup.Taxon
UNION ALL
SELECT dup.Date, dup.Station, dup.Taxon, j.OrigTaxon, {_SIGNIF_SUM} AS Cells_per_mL
FROM dup JOIN j ON dup.Date = j.Date AND dup.Station = j.Station AND dup.Taxon = j.Taxon
""", "ev_lts")


@query("a3_combine_taxa_lts", A3_SQL)
def a3_combine_taxa_lts(spark, sf_dir):
    src = fixture(spark, sf_dir, "ev_lts")
    return combine_taxa_lts(src, sort_cols=("Date", "Taxon")).df
