"""Pipeline queries over varied programs: L2 and L7 with names of every kind, metadata
by date and several densities, the statistics of L3, the reports of L4 and L6, L8's
sampling method and L9's mixed dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harmonia.plans import programs as PG
from harmonia.plans import q_checks, q_joins, q_programs, q_taxa  # noqa: F401  (fixtures)
from harmonia.plans.catalog import query, rounded, sq
from harmonia.plans.fixtures import FIXTURES, fixture, load, with_fixtures
from harmonia.plans.q_joins import _DEPTH
from harmonia.plans.q_project import rnd

# Names as programs deliver them and what they stand for: as in the reference, a
# typo, an older name, a name nobody knows.
NAMES = [("Ring small", "Ring small", None), ("rinx  smal", "Ring small", None), ("Old ring", "Ring small", "Old ring"),
         ("undetermined RING", "Unknown ring", None)]
TYPOS = [(1, "rinx smal", "Ring small"), (2, "rinx smal", "Wrong fix")]
TAXA = [("Ring small", "Chromista", "Ochrophyta", "Bacillario", "Pennate Diatoms", "Ring", "small", "None"),
        ("Old ring", "Plantae", "Old", "Old", "Green Algae", "Old", "ring", "ring  SMALL"),
        ("Unknown ring", "Chromista", "Unknown", "Unknown", "Unknown", "Unknown", "ring", "None")]
META = [(1, "2000-01-01", "2024-06-30", "LabA"), (2, "2024-03-01", None, "LabB")]


def _given(key: str) -> str:
    return f"CASE {key} % 4 " + " ".join(f"WHEN {i} THEN '{n[0]}'" for i, n in enumerate(NAMES)) + " END"


def _means(key: str, column: int) -> str:
    return f"CASE {key} % 4 " + " ".join(f"WHEN {i} THEN " + (f"'{n[column]}'" if n[column] else "NULL")
                                        for i, n in enumerate(NAMES)) + " END"


FIXTURES["ev_varied"] = f"""
SELECT e.event_id AS ev_id, 'REG-' || upper(event_type) AS Survey, 'U' || CAST(user_id % 40 AS STRING) AS Station,
       CAST(ts AS DATE) AS Date,
       CASE WHEN value < 30 THEN NULL ELSE lpad(CAST(hour(ts) % 3 + 8 AS STRING), 2, '0') || ':00' END AS Time,
       CASE WHEN value < 250 THEN '1 meter' ELSE '3 ft' END AS SampleDepth, 'surface' AS DepthType,
       {_given('event_id')} AS Taxon, CASE WHEN value < 100 THEN 0.0 ELSE value END AS Cells_per_mL,
       CASE WHEN event_type = 'view' THEN value * value END AS Units_per_mL
FROM {{events}} e
"""


def _tables(spark, sf):
    """Typos and the taxonomy: the names above beside all those of the parts."""
    typos = spark.createDataFrame(TYPOS, "o int, Taxon string, TaxonCorrected string")
    ref = fixture(spark, sf, "taxa_ref")
    own = spark.createDataFrame(TAXA, ref.schema)
    return typos, ref.join(own.select("Taxon"), "Taxon", "left_anti").select(*ref.columns).unionByName(own)


def _meta(spark):
    rows = [(i, dt.date.fromisoformat(s), dt.date.fromisoformat(e) if e else None, lab) for i, s, e, lab in META]
    return spark.createDataFrame(rows, "meta_idx int, start_date date, end_date date, Lab string")


_REF = "(VALUES " + ", ".join(str(r) for r in TAXA) + ") AS ref(name, Kingdom, Phylum, Class, AlgalGroup, Genus, Species, cur)"


def _flag(col: str, code: str) -> str:
    return (f"CASE WHEN 0.6745 * (log10(CASE WHEN {col} > 0 THEN {col} END) - (SELECT median(log10({col})) FROM g WHERE {col} > 0)) / "
            f"(1.4826 * (SELECT median(abs(log10({col}) - (SELECT median(log10({col})) FROM g WHERE {col} > 0))) FROM g WHERE {col} > 0)) "
            f"> 1.2 THEN '{code}' END")


@query("l2_prep_varied", with_fixtures(f"""
WITH s AS (
  SELECT *, timezone('Etc/GMT+8', timezone('America/Los_Angeles', CAST(Date AS TIMESTAMP)
              + to_minutes(CAST(coalesce(split_part(Time, ':', 1), '0') AS INTEGER) * 60))) AS t FROM ev_varied),
b AS (
  SELECT ev_id, Survey, Station, CAST(t AS DATE) AS Date, CASE WHEN Time IS NOT NULL THEN strftime(t, '%H:%M:%S') END AS Time,
         {_DEPTH} AS SampleDepth, DepthType, {_means('ev_id', 1)} AS Taxon, {_means('ev_id', 2)} AS OrigTaxon, Cells_per_mL,
         Units_per_mL, trim(regexp_replace(Survey, '^.*-', '')) AS sv,
         CASE WHEN CAST(t AS DATE) >= DATE '2024-03-01' THEN 'LabB' ELSE 'LabA' END AS Lab FROM s),
e AS (SELECT *, dense_rank() OVER (PARTITION BY sv, Station, Date ORDER BY coalesce(Time, '23:59:59')) AS T,
             dense_rank() OVER (PARTITION BY sv, Station, Date, Time ORDER BY SampleDepth) AS D FROM b),
x AS (SELECT sv || '-' || Station || '-' || strftime(Date, '%Y%m%d') || '-S-T' || CAST(T AS VARCHAR) || 'D' || CAST(D AS VARCHAR) AS Event_ID, * FROM e),
g0 AS (SELECT Event_ID, Taxon, min(ev_id) AS ev_id, arg_min(Survey, ev_id) AS Survey, arg_min(Station, ev_id) AS Station,
              arg_min_null(Date, ev_id) AS Date, arg_min_null(Time, ev_id) AS Time, arg_min_null(SampleDepth, ev_id) AS SampleDepth,
              arg_min_null(Lab, ev_id) AS Lab, sum(Cells_per_mL) AS Cells_per_mL, sum(Units_per_mL) AS Units_per_mL,
              string_agg(DISTINCT OrigTaxon, '; ') || CASE WHEN count(OrigTaxon) < count(*) THEN '; ' || Taxon ELSE '' END AS OrigTaxon
       FROM x GROUP BY Event_ID, Taxon),
g AS (SELECT * REPLACE (nullif(Cells_per_mL, 0) AS Cells_per_mL, nullif(Units_per_mL, 0) AS Units_per_mL) FROM g0
      WHERE coalesce(Cells_per_mL, 0) <> 0 OR coalesce(Units_per_mL, 0) <> 0)
SELECT g.Event_ID, g.ev_id, g.Survey, g.Station, g.Date, g.Time, g.SampleDepth, g.Lab, g.OrigTaxon, g.Taxon,
       round(g.Cells_per_mL, 4) AS Cells_per_mL, round(g.Units_per_mL, 4) AS Units_per_mL, ref.Kingdom, ref.Genus, ref.AlgalGroup,
       coalesce(nullif(concat_ws('; ', {_flag('Cells_per_mL', 'OutlierCells')}, {_flag('Units_per_mL', 'OutlierUnits')}), ''),
                'NoCode') AS QualityCheck
FROM g LEFT JOIN {_REF} ON ref.name = g.Taxon
""", "ev_varied"))
def l2_prep_varied(spark, sf):
    ev = fixture(spark, sf, "ev_varied").withColumns({"OrigTaxon": F.lit(None).cast("string"), "QualityCheck": F.lit("NoCode")})
    typos, taxa = _tables(spark, sf)
    cfg = {"from_zone": "America/Los_Angeles", "loc_col": "Station", "meta_cols": ["Lab"], "order_cols": ["ev_id"],
           "outlier_cutoffs": {"Cells_per_mL": 1.2, "Units_per_mL": 1.2}}
    got = PG.prep_for_synthesis(ev, cfg, meta=_meta(spark), typos=typos, taxa=taxa, typo_order="o",
                                taxa_order=q_programs.TAXA_ORDER).df
    return rounded(got.select("Event_ID", "ev_id", "Survey", "Station", "Date", "Time", "SampleDepth", "Lab", "OrigTaxon", "Taxon",
                              "Cells_per_mL", "Units_per_mL", "Kingdom", "Genus", "AlgalGroup", "QualityCheck"),
                   ["Cells_per_mL", "Units_per_mL"])


FIXTURES["ev_forms"] = f"""
SELECT event_id, CAST(ts AS DATE) AS Date, lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') AS Time,
       'S' || CAST(user_id % 25 AS STRING) AS Station, {_given('event_id')} AS Taxon, value AS Cells_per_mL,
       CASE WHEN value > 400 THEN value * 2 ELSE value / 2 END AS Units_per_mL,
       CASE WHEN value < 40 THEN 'Delete this sample; CMT > 5' WHEN value < 80 THEN 'High sediment. fungus present'
            WHEN value < 120 THEN 'light sediment; many broken diatoms; cyst' WHEN value < 160 THEN NULL ELSE 'ok' END AS Comments
FROM {{events}}
"""


def _l7_sql():
    from harmonia.plans.q_taxa import _debris_sql, _notes_sql, _qc_sql
    notes, _, _ = _notes_sql()
    tok = lambda c, none: (
        f"SELECT Date, Station, Taxon, '{c}' AS col, unnest(string_split({sq(c)}, ' ')) AS val, "
        f"generate_subscripts(string_split({sq(c)}, ' '), 1) AS pos, event_id AS rid, 0 AS rnk FROM b "
        f"WHERE {sq(c)} <> '{none}' AND {sq(c)} <> ''")
    return with_fixtures(f"""
WITH b AS (SELECT event_id, Date, Station, Cells_per_mL, Units_per_mL, Comments,
                  lpad(CAST((CAST(split_part(Time, ':', 1) AS INTEGER) + 1) % 24 AS VARCHAR), 2, '0') || ':' || split_part(Time, ':', 2) AS Time,
                  {_means('event_id', 1)} AS Taxon, {_means('event_id', 2)} AS OrigTaxon,
                  CASE WHEN Date <= DATE '2024-06-30' THEN 'LabA' END AS Lab,
                  {_qc_sql('Comments', True)} AS QualityCheck, {_debris_sql('Comments')} AS Debris, {notes} AS Notes
           FROM ev_forms),
m AS (SELECT Date, Station, Taxon, count(*) AS n, sum(Cells_per_mL) AS Cells_per_mL, sum(Units_per_mL) AS Units_per_mL,
             min(event_id) AS event_id, arg_min_null(Comments, event_id) AS Comments, arg_min_null(Time, event_id) AS Time,
             any_value(Lab) AS Lab,
             string_agg(DISTINCT OrigTaxon, '; ') || CASE WHEN count(OrigTaxon) < count(*) THEN '; ' || Taxon ELSE '' END AS OrigTaxon
      FROM b GROUP BY Date, Station, Taxon),
t AS ({tok('Notes', 'NoNote')} UNION ALL {tok('QualityCheck', 'NoCode')}
      UNION ALL SELECT Date, Station, Taxon, 'Debris', {sq('Debris')}, 0, event_id,
             coalesce(list_position(['High', 'Moderate', 'Low', 'None', 'Unknown'], {sq('Debris')}), 6)
      FROM b WHERE Debris IS NOT NULL),
f AS (SELECT Date, Station, Taxon, col, val, min((rnk, rid, pos)) AS o FROM t WHERE val <> '' GROUP BY ALL),
x AS (SELECT Date, Station, Taxon,
             string_agg(val, ' ' ORDER BY o) FILTER (WHERE col = 'Notes') AS tn,
             string_agg(val, ' ' ORDER BY o) FILTER (WHERE col = 'QualityCheck') AS tq,
             string_agg(val, ', ' ORDER BY o) FILTER (WHERE col = 'Debris') AS td
      FROM f GROUP BY ALL)
SELECT m.event_id, round(m.Cells_per_mL, 4) AS Cells_per_mL, round(m.Units_per_mL, 4) AS Units_per_mL, m.Comments,
       m.Date, m.Time, m.Station, m.Lab, m.OrigTaxon, m.Taxon, ref.Kingdom, ref.Genus, coalesce(x.tq, 'NoCode') AS QualityCheck,
       x.td AS Debris,
       CASE WHEN m.n > 1 AND coalesce(x.tn, 'NoNote') = 'NoNote' THEN 'MultipleEntries'
            WHEN m.n > 1 AND NOT regexp_matches(coalesce(x.tn, 'NoNote'), '\\bMultipleEntries\\b')
                 THEN coalesce(x.tn, 'NoNote') || ' MultipleEntries'
            ELSE coalesce(x.tn, 'NoNote') END AS Notes
FROM m LEFT JOIN x USING (Date, Station, Taxon) LEFT JOIN {_REF} ON ref.name = m.Taxon
""", "ev_forms")


@query("l7_formatter_varied", _l7_sql())
def l7_formatter_varied(spark, sf):
    from harmonia.sources.config import complete_schema
    df = fixture(spark, sf, "ev_forms")
    typos, taxa = _tables(spark, sf)
    schema = complete_schema({"survey": "events", "presets": ["standard"], "combine_key_cols": ["Date", "Station"],
                              "comment_col": "Comments", "metadata_columns": {"standard": ["Lab"]},
                              "mapping": {"Cells_per_mL": "count"},
                              "steps": {"convert_timezone": {"standard": {"applies": True, "from_tz": "PST"}}}})
    halves = [df.where("event_id % 2 = 0"), df.where("event_id % 2 = 1").withColumnRenamed("Cells_per_mL", "count")]
    got = PG.formatter_batch(halves, schema, "standard", meta=_meta(spark), typos=typos, taxa=taxa, order_cols=["event_id"],
                             typo_order="o", taxa_order=q_programs.TAXA_ORDER).df
    return rounded(got.select("event_id", "Cells_per_mL", "Units_per_mL", "Comments", "Date", "Time", "Station", "Lab", "OrigTaxon",
                              "Taxon", "Kingdom", "Genus", "QualityCheck", "Debris", "Notes"), ["Cells_per_mL", "Units_per_mL"])


@query("l3_outlier_stats", f"""
WITH r AS ({q_programs._L3_SQL}),
v AS (SELECT 'Cells_per_mL' AS measure, 3.0 AS cutoff, log10(Cells_per_mL) AS x FROM r WHERE Cells_per_mL > 0
      UNION ALL SELECT 'Units_per_mL', 3.0, log10(Units_per_mL) FROM r WHERE Units_per_mL > 0
      UNION ALL SELECT 'Biovolume_per_mL', 3.5, log10(Biovolume_per_mL) FROM r WHERE Biovolume_per_mL > 0),
m AS (SELECT measure, median(x) AS med FROM v GROUP BY measure),
k AS (SELECT measure, any_value(med) AS med, 1.4826 * median(abs(x - med)) AS mad FROM v JOIN m USING (measure) GROUP BY measure)
SELECT measure, CAST(cutoff AS DOUBLE) AS cutoff, round(any_value(med), 9) AS median, round(any_value(mad), 9) AS mad,
       count(*) FILTER (0.6745 * (x - med) / mad > cutoff) AS n_flagged,
       round(avg(CASE WHEN 0.6745 * (x - med) / mad > cutoff THEN 1.0 ELSE 0.0 END), 9) AS share_above
FROM v JOIN k USING (measure) GROUP BY measure, cutoff
""")
def l3_outlier_stats(spark, sf):
    a, b = q_programs._programs(spark, sf)
    stats = PG.synthesize([a, b], q_programs.L3_RECODES, drop=["TowNetRadius"]).logs["outlier_stats"]
    return rounded(stats, ["median", "mad", "share_above"], 9)


@query("l3_written_counts", with_fixtures("""
SELECT CAST((SELECT count(*) FROM prog_a) + (SELECT count(*) FROM prog_b) AS BIGINT) AS n_parts,
       CAST((SELECT count(*) FROM prog_a) + (SELECT count(*) FROM prog_b) AS BIGINT) AS n_union,
       CAST((SELECT count(*) FILTER (SampleMethod = 'unspecified grab sample') + count(*) FILTER (Survey = 'TN')
                    + count(*) FILTER (SampleDepth = '1') FROM prog_b)
            + (SELECT count(*) FILTER (SampleMethod = 'unspecified grab sample') FROM prog_a) AS BIGINT) AS n_recoded,
       CAST((SELECT count(*) FROM prog_a WHERE coalesce(Cells_per_mL, 0) = 0 AND coalesce(Units_per_mL, 0) = 0
               AND coalesce(Biovolume_per_mL, 0) = 0 AND coalesce(Taxon <> 'No organisms observed', true))
            + (SELECT count(*) FROM prog_b WHERE coalesce(Cells_per_mL, 0) = 0 AND coalesce(Units_per_mL, 0) = 0
               AND Taxon <> 'No organisms observed') AS BIGINT) AS n_removed
""", "prog_a", "prog_b"))
def l3_written_counts(spark, sf):
    """The counts of the pass that writes, beside the rows that are read back."""
    from harmonia.plans.q_sources import _round_trip

    def work(path):
        counts = PG.write_synthesis(list(q_programs._programs(spark, sf)), path, q_programs.L3_RECODES, drop=["TowNetRadius"])
        written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
        kept = counts["n_union"] - counts["n_removed"]
        return written.where(F.col("n") == kept).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()])
    return _round_trip(spark, work)


def _report(spark, sf):
    df = fixture(spark, sf, "ev_survey").withColumnRenamed("event_id", "row_no").withColumns({
        "Survey": F.col("Taxon"), "Location": F.substring("Time", 1, 2), "Event_ID": F.concat_ws("|", "Station", "Date"),
        "Phylum": F.col("Taxon"), "Class": F.substring("Station", 1, 2), "AlgalGroup": F.lit(None).cast("string")})
    return PG.metadata_report(df)


_L4 = {
    "surveys": "SELECT DISTINCT Taxon AS Survey FROM ev_survey",
    "coordinates": "SELECT bool_and(Latitude BETWEEN -90 AND 90 AND Longitude BETWEEN -180 AND 180) AS on_globe, "
                   "bool_and(Latitude BETWEEN 37.0 AND 39.0 AND Longitude BETWEEN -123.0 AND -121.0) AS in_box FROM ev_survey",
    "multi_location_stations": "SELECT Station, count(*) AS n, string_agg(l, ', ' ORDER BY l) AS locations FROM "
                               "(SELECT DISTINCT Station, substr(Time, 1, 2) AS l FROM ev_survey) GROUP BY Station HAVING count(*) > 1",
    "units_exceed_cells": "SELECT event_id AS row_no, Cells_per_mL, Units_per_mL FROM ev_survey WHERE Cells_per_mL < Units_per_mL",
    "taxonomy": "SELECT DISTINCT Taxon AS Phylum, substr(Station, 1, 2) AS Class, NULL::VARCHAR AS AlgalGroup FROM ev_survey",
    "event_taxon_duplicates": "SELECT event_id AS row_no, Station, Date, Taxon FROM ev_survey WHERE (Station, Date, Taxon) IN "
                              "(SELECT (Station, Date, Taxon) FROM ev_survey GROUP BY Station, Date, Taxon HAVING count(*) > 1)",
}


def _report_query(name: str, sql: str) -> None:
    @query(f"l4_{name}", with_fixtures(sql, "ev_survey"))
    def report(spark, sf):
        keep = {"units_exceed_cells": ["row_no", "Cells_per_mL", "Units_per_mL"],
                "event_taxon_duplicates": ["row_no", "Station", "Date", "Taxon"]}
        got = _report(spark, sf)[name]
        return got.select(*keep.get(name, got.columns))


for _name, _sql in _L4.items():
    _report_query(_name, _sql)


@query("l6_community_matrix", with_fixtures("""
SELECT Station, split_part(Taxon, '#', 1) AS Genus, round(coalesce(sum(Cells_per_mL), 0), 4) AS value FROM li_taxa GROUP BY ALL
""", "li_taxa"))
def l6_community_matrix(spark, sf):
    df = fixture(spark, sf, "li_taxa").withColumn("Genus", F.split("Taxon", "#").getItem(0))
    out = PG.community_checks(df.select("Station", "Date", "Taxon", "Genus", "Cells_per_mL"), ["Station"], measures=("Cells_per_mL",))
    return rounded(out["matrix_Genus_Cells_per_mL"], ["value"])


@query("l6_community_presence", with_fixtures(
    "SELECT Station, Taxon, CAST(count(*) AS DOUBLE) AS value FROM li_taxa GROUP BY ALL", "li_taxa"))
def l6_community_presence(spark, sf):
    df = fixture(spark, sf, "li_taxa").withColumn("Genus", F.split("Taxon", "#").getItem(0))
    out = PG.community_checks(df.select("Station", "Date", "Taxon", "Genus", "Cells_per_mL"), ["Station"], measures=("Cells_per_mL",))
    return out["matrix_Taxon_Binary"]


@query("l8_sampling_method", """
SELECT o.o_orderkey AS SampleEvent, CAST(o.o_orderdate AS DATE) AS Date, o.o_totalprice AS Cells_per_mL, m.SampleMethod,
       NULL::VARCHAR AS Comments
FROM orders o LEFT JOIN (VALUES (DATE '1994-06-01', DATE '1996-12-31', 'Net'), (DATE '1996-06-01', DATE '1998-03-31', 'Grab'),
  (DATE '1998-06-01', DATE '1999-12-31', 'Pump'), (DATE '1999-06-01', DATE '2001-12-31', 'Net'), (DATE '2003-01-01', DATE '2004-01-01', 'X'))
  AS m(s, e, SampleMethod) ON CAST(o.o_orderdate AS DATE) BETWEEN m.s AND m.e
""")
def l8_sampling_method(spark, sf):
    df = load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("Date"), F.col("o_totalprice").alias("Cells_per_mL"),
                                          F.lit(1).alias("Measure 1"))
    return PG.standardize_lab_columns(df, {"SampleEvent": "o_orderkey"}, ["SampleEvent", "Date", "Cells_per_mL", "SampleMethod", "Comments"],
                                      meta=q_joins.meta_df(spark), start="start_date", end="end_date", today="2001-12-31")


@query("l9_mixed_dates", """
SELECT o_orderkey AS SampleEvent, CAST(o_orderdate AS DATE) AS Date, o_orderstatus AS Station, NULL::VARCHAR AS Notes FROM orders
""")
def l9_mixed_dates(spark, sf):
    day = F.to_date("o_orderdate")
    text = (F.when((F.col("o_orderkey") % 2 == 0) | (F.dayofmonth(day) <= 12), F.date_format(day, "M/d/yyyy"))
            .when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "d/M/yyyy")).otherwise(F.date_format(day, "yyyy-M-d")))
    df = load(spark, sf, "orders").select("o_orderkey", text.alias("Sampled"), F.col("o_orderstatus").alias("Station"))
    return PG.standardize_lab_columns(df, {"SampleEvent": "o_orderkey", "Date": "Sampled"}, ["SampleEvent", "Date", "Station", "Notes"],
                                      date_cols=("Date",))


FIXTURES["li_raw"] = f"""
SELECT l_orderkey AS Event, l_linenumber AS Line, {_given('l_linenumber')} AS Taxon, 1 + l_tax * 10 AS Factor, l_quantity AS unit,
       l_quantity * l_linenumber AS cells, CASE WHEN l_discount > 0.05 THEN l_extendedprice / 1000 END AS Biovolume_1,
       CASE WHEN l_discount < 0.09 THEN l_extendedprice / 2000 END AS Biovolume_2, CAST(l_shipdate AS DATE) AS Date,
       'E' || CAST(l_suppkey % 2 AS STRING) AS Station,
       CASE WHEN l_linenumber = 1 THEN 'CMT > 5; high sediment' ELSE 'cyst seen' END AS Comments
FROM {{lineitem}}
"""
_RAW_ORDER = ["Line", "unit", "Factor", "Date", "Biovolume_1", "Biovolume_2", "cells"]
_MEAN = ("CASE WHEN Biovolume_1 IS NULL THEN Biovolume_2 WHEN Biovolume_2 IS NULL THEN Biovolume_1 "
         "ELSE (Biovolume_1 + Biovolume_2) / 2 END")


@query("l1_format_varied", with_fixtures(f"""
WITH d AS (SELECT DISTINCT * FROM li_raw),
v AS (SELECT *, {rnd('unit * Factor', 2)} AS u, {rnd('cells * Factor', 2)} AS c, {rnd(f'({_MEAN}) * Factor * cells', 2)} AS bio,
             {_means('Line', 1)} AS name, {_means('Line', 2)} AS old FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY Event, Station, name ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _RAW_ORDER)}) AS nth FROM v),
g AS (SELECT Event, Station, name, count(*) AS n, sum(u) AS u, sum(c) AS c, sum(bio) AS bio, max(Line) FILTER (nth = 1) AS Line,
             max(Date) FILTER (nth = 1) AS Date, max(Comments) FILTER (nth = 1) AS Comments, bool_or(Line = 1) AS first_line,
             bool_or(Line <> 1) AS other_line,
             string_agg(DISTINCT old, '; ') || CASE WHEN count(old) < count(*) THEN '; ' || name ELSE '' END AS OrigTaxon
      FROM r GROUP BY Event, Station, name)
SELECT Event, Station, g.name AS Taxon, OrigTaxon, Line, Date, Comments, round(nullif(u, 0), 4) AS Units_per_mL,
       round(nullif(c, 0), 4) AS Cells_per_mL, round(nullif(bio, 0), 4) AS Biovolume_per_mL,
       CASE WHEN first_line THEN 'TallyNotMet_Over5 TallyNotMet' ELSE 'NoCode' END AS QualityCheck,
       concat_ws(', ', CASE WHEN first_line THEN 'High' END, CASE WHEN other_line THEN 'None' END) AS Debris,
       CASE WHEN other_line AND n > 1 THEN 'Cyst MultipleEntries' WHEN other_line THEN 'Cyst' WHEN n > 1 THEN 'MultipleEntries'
            ELSE 'NoNote' END AS Notes, ref.Kingdom, ref.Genus, ref.Species
FROM g LEFT JOIN {_REF} ON ref.name = g.name
WHERE coalesce(u, 0) <> 0 OR coalesce(c, 0) <> 0 OR coalesce(bio, 0) <> 0
""", "li_raw"))
def l1_format_varied(spark, sf):
    """A program from raw counts to the standard table, with repeated typo keys and names of every kind."""
    typos, taxa = _tables(spark, sf)
    cfg = {"density": {"unit": "unit", "cell": "cells"}, "comment_col": "Comments", "key_cols": ["Event", "Station"],
           "outlier_cutoff": 3.0, "order_cols": _RAW_ORDER}
    got = PG.format_program(fixture(spark, sf, "li_raw"), cfg, typos=typos.repartition(3), taxa=taxa.repartition(5), typo_order="o",
                            taxa_order=q_programs.TAXA_ORDER).df
    measures = ["Units_per_mL", "Cells_per_mL", "Biovolume_per_mL"]
    return rounded(got.select("Event", "Station", "Taxon", "OrigTaxon", "Line", "Date", "Comments", *measures, "QualityCheck", "Debris",
                              "Notes", "Kingdom", "Genus", "Species"), measures)
