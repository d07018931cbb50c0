"""Queries for the C* checks and the T* time functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmonia.functions import timefn as T
from harmonia.operators import checks as CK
from harmonia.operators import reshape as RS
from harmonia.plans.catalog import query
from harmonia.plans.fixtures import FIXTURES, fixture, load, with_fixtures
from harmonia.plans.q_project import rnd

# Events as a sampling table: dates as text (some broken), clock times as
# text in several spellings (H:MM, HH:MM, 25:00, NULL).
FIXTURES["ev_survey"] = """
SELECT event_id, 'U' || CAST(user_id AS STRING) AS Station, event_type AS Taxon,
       CASE WHEN value < 1 THEN '2024-13-45' WHEN value < 2 THEN NULL
            ELSE CAST(CAST(ts AS DATE) AS STRING) END AS DateText,
       CAST(ts AS DATE) AS Date,
       CASE WHEN event_type = 'error' AND value < 50 THEN NULL
            WHEN event_type = 'signup' THEN CAST(hour(ts) AS STRING) || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')
            WHEN event_type = 'view' AND value > 400 THEN '25:00'
            ELSE lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0') END AS Time,
       value AS Cells_per_mL,
       CASE WHEN value > 100 THEN value / 2 ELSE value * 2 END AS Units_per_mL,
       CASE WHEN value > 450 THEN 'n/a' WHEN value > 300 THEN CAST(value AS STRING) || 'x'
            ELSE CAST(value AS STRING) END AS ValueText,
       36.5 + CAST(user_id AS DOUBLE) / 50 AS Latitude,
       CASE WHEN event_type = 'click' AND value > 250 THEN -121.9 ELSE -122.4 END AS Longitude
FROM {events}
"""

# A compact duplicate-rich projection of events.
FIXTURES["ev_dup"] = """
SELECT 'U' || CAST(user_id AS STRING) AS Station, CAST(ts AS DATE) AS Date, event_type AS Taxon,
       CASE WHEN hour(ts) < 12 THEN round(value / 50, 0) ELSE round(value / 50, 0) + 0.0000000004 END
         AS Cells_per_mL,
       CASE WHEN value > 250 THEN 1.0 ELSE 2.0 END AS Units_per_mL
FROM {events}
"""

# Part names as a taxonomy: "<noun> <adjective>" -> Genus + species.
FIXTURES["part_taxa"] = """
SELECT p_partkey,
       CASE WHEN p_size > 45 THEN 'cf. ' ELSE '' END
         || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2)
         || ' ' || split_part(p_name, ' ', 1)
         || CASE WHEN p_size < 3 THEN ' var. minor' ELSE '' END AS Taxon,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE 'Chromista' END AS Kingdom,
       p_type AS Phylum, p_brand AS Class,
       CASE WHEN p_size < 5 THEN NULL ELSE 'Diatoms' END AS AlgalGroup,
       upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS Genus,
       split_part(p_name, ' ', 1) AS Species
FROM {part}
"""


# ---------------------------------------------------------------- C1-C4

C1_SCHEMA = {
    "l_quantity": {"type": "integer", "required": True, "min": 1, "max": 45},
    "l_discount": {"type": "numeric", "required": True, "min": 0.0, "max": 0.1},
    "l_tax": {"type": "integer", "required": True},
    "l_linestatus": {"type": "integer", "required": True},
    "l_returnflag": {"type": "character", "required": True, "allowed_values": ["A", "N"]},
    "l_linenumber": {"type": "character", "required": True},
    "l_comment": {"type": "character", "required": True},
    "l_optional": {"type": "character", "required": False},
}


@query("c1_validate_file", """
SELECT 'l_comment' AS "column", 'missing required column' AS error
UNION ALL SELECT 'l_linenumber', 'not character'
UNION ALL SELECT 'l_quantity', 'below min' FROM lineitem HAVING bool_or(l_quantity < 1)
UNION ALL SELECT 'l_quantity', 'above max' FROM lineitem HAVING bool_or(l_quantity > 45)
UNION ALL SELECT 'l_discount', 'below min' FROM lineitem HAVING bool_or(l_discount < 0)
UNION ALL SELECT 'l_discount', 'above max' FROM lineitem HAVING bool_or(l_discount > 0.1)
UNION ALL SELECT 'l_linestatus', 'not numeric' FROM lineitem HAVING bool_or(l_linestatus IS NOT NULL AND TRY_CAST(l_linestatus AS DOUBLE) IS NULL)
UNION ALL SELECT 'l_returnflag', 'not allowed' FROM lineitem HAVING bool_or(l_returnflag NOT IN ('A', 'N'))
""")
def c1_validate_file(spark, sf):
    return CK.validate_file(load(spark, sf, "lineitem"), C1_SCHEMA)


_VALID = "'^([01]?[0-9]|2[0-3]):[0-5][0-9]$'"


@query("c2_check_datetime", with_fixtures(f"""
SELECT event_id, DateText, Time, 'Bad/missing Date' AS issue FROM ev_survey
WHERE DateText IS NULL OR TRY_STRPTIME(DateText, '%Y-%m-%d') IS NULL
UNION ALL
SELECT event_id, DateText, Time, 'Bad/missing Time' FROM ev_survey
WHERE Time IS NULL OR NOT regexp_matches(Time, {_VALID})
""", "ev_survey"))
def c2_check_datetime(spark, sf):
    df = fixture(spark, sf, "ev_survey").select("event_id", "DateText", "Time")
    return CK.check_datetime(df, "DateText", "Time")


@query("c3_check_extreme_times", with_fixtures(f"""
SELECT event_id, Time FROM ev_survey
WHERE Time IS NOT NULL AND regexp_matches(Time, {_VALID})
  AND (TRY_CAST(split_part(Time, ':', 1) AS INTEGER) < 5 OR TRY_CAST(split_part(Time, ':', 1) AS INTEGER) >= 20)
""", "ev_survey"))
def c3_check_extreme_times(spark, sf):
    return CK.check_extreme_times(fixture(spark, sf, "ev_survey").select("event_id", "Time"))


_HOUR = "TRY_CAST(split_part(Time, ':', 1) AS INTEGER)"
_MIL = (f"CASE WHEN {_HOUR} = 0 THEN NULL WHEN {_HOUR} > 0 AND {_HOUR} < 5 "
        f"THEN format('{{:02d}}:{{}}', {_HOUR} + 12, regexp_replace(Time, '^.*:', '')) ELSE Time END")


@query("c4_convert_to_military", with_fixtures(
    f"SELECT event_id, {_MIL} AS Time FROM ev_survey", "ev_survey"))
def c4_convert_to_military(spark, sf):
    return CK.convert_to_military(fixture(spark, sf, "ev_survey").select("event_id", "Time")).df


@query("c4_military_log", with_fixtures(
    f"SELECT event_id, {_MIL} AS Time, Time AS OldTime FROM ev_survey "
    f"WHERE Time IS DISTINCT FROM ({_MIL})", "ev_survey"))
def c4_military_log(spark, sf):
    return CK.convert_to_military(fixture(spark, sf, "ev_survey").select("event_id", "Time")) \
        .logs["military_converted"]


# ---------------------------------------------------------------- C5-C9

@query("c5_duplicate_rows", with_fixtures("""
SELECT d.* FROM ev_dup d SEMI JOIN (
  SELECT Station, Date, Taxon, Cells_per_mL, Units_per_mL FROM ev_dup GROUP BY ALL HAVING count(*) > 1) k
ON d.Station = k.Station AND d.Date = k.Date AND d.Taxon = k.Taxon
   AND d.Cells_per_mL = k.Cells_per_mL AND d.Units_per_mL = k.Units_per_mL
""", "ev_dup"))
def c5_duplicate_rows(spark, sf):
    return CK.duplicate_rows(fixture(spark, sf, "ev_dup"))


@query("c5_count_duplicates", with_fixtures(
    "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ev_dup)) AS BIGINT) AS n_duplicated "
    "FROM ev_dup", "ev_dup"))
def c5_count_duplicates(spark, sf):
    return CK.count_duplicates(fixture(spark, sf, "ev_dup"))


@query("c5_remove_duplicates", with_fixtures("SELECT DISTINCT * FROM ev_dup", "ev_dup"))
def c5_remove_duplicates(spark, sf):
    return CK.remove_duplicates(fixture(spark, sf, "ev_dup"))


@query("c6_key_duplicates", with_fixtures("""
SELECT d.event_id, d.Station, d.Date FROM ev_survey d SEMI JOIN (
  SELECT Station, Date, Time FROM ev_survey GROUP BY ALL HAVING count(*) > 1) k
ON d.Station = k.Station AND d.Date = k.Date AND d.Time IS NOT DISTINCT FROM k.Time
""", "ev_survey"))
def c6_key_duplicates(spark, sf):
    df = fixture(spark, sf, "ev_survey")
    return CK.duplicate_rows(df, ["Station", "Date", "Time"]).select("event_id", "Station", "Date")


@query("c6_remove_key_duplicates", with_fixtures("""
SELECT Station, Date, Time, min(event_id) AS event_id FROM ev_survey GROUP BY Station, Date, Time
""", "ev_survey"))
def c6_remove_key_duplicates(spark, sf):
    df = fixture(spark, sf, "ev_survey").select("Station", "Date", "Time", "event_id")
    return CK.remove_duplicates(df, ["Station", "Date", "Time"], ["event_id"])


def _r6(x):
    return rnd(x, 6)


@query("c7_check_distinct_full", with_fixtures(f"""
WITH r AS (SELECT *, {_r6('Cells_per_mL')} AS rc, {_r6('Units_per_mL')} AS ru FROM ev_dup)
SELECT r.Station, r.Date, r.Taxon, r.Cells_per_mL, r.Units_per_mL FROM r SEMI JOIN (
  SELECT Station, Date, Taxon, rc, ru FROM r GROUP BY ALL HAVING count(*) > 1) k
ON r.Station = k.Station AND r.Date = k.Date AND r.Taxon = k.Taxon AND r.rc = k.rc AND r.ru = k.ru
""", "ev_dup"))
def c7_check_distinct_full(spark, sf):
    return CK.check_distinct(fixture(spark, sf, "ev_dup"), "full")


@query("c8_check_distinct_key_measure", with_fixtures(f"""
WITH r AS (SELECT *, {_r6('Cells_per_mL')} AS rc FROM ev_dup)
SELECT r.Station, r.Date, r.Taxon, r.Cells_per_mL, r.Units_per_mL FROM r SEMI JOIN (
  SELECT Station, Date, Taxon, rc FROM r GROUP BY ALL HAVING count(*) > 1) k
ON r.Station = k.Station AND r.Date = k.Date AND r.Taxon = k.Taxon AND r.rc = k.rc
""", "ev_dup"))
def c8_check_distinct_key_measure(spark, sf):
    return CK.check_distinct(fixture(spark, sf, "ev_dup"), "key_measure_cols",
                             measurement_cols=("Cells_per_mL",))


@query("c9_check_distinct_key", with_fixtures("""
SELECT r.* FROM ev_dup r SEMI JOIN (
  SELECT Station, Date, Taxon FROM ev_dup GROUP BY ALL HAVING count(*) > 1) k
ON r.Station = k.Station AND r.Date = k.Date AND r.Taxon = k.Taxon
""", "ev_dup"))
def c9_check_distinct_key(spark, sf):
    return CK.check_distinct(fixture(spark, sf, "ev_dup"), "key_cols")


# ---------------------------------------------------------------- C10-C17

_C10_COLS = ["Event", "Taxon", "Class", "Phylum", "Kingdom", "Cells_per_mL", "Units_per_mL",
             "Biovolume_per_mL", "GALD", "Notes", "QualityCheck", "Debris", "PhytoForm", "OrigTaxon",
             "Station", "Date"]
_C10_SQL = with_fixtures(
    "WITH s AS (SELECT count(*) AS n, " + ", ".join(
        f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in _C10_COLS) + " FROM li_taxa),\n"
    "u AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS n_missing, {c} = n AS all_missing FROM s" for c in _C10_COLS)
    + ")\nSELECT * FROM u WHERE n_missing > 0 AND (\"column\" <> 'OrigTaxon' OR all_missing)", "li_taxa")


@query("c10_check_nas", _C10_SQL)
def c10_check_nas(spark, sf):
    return CK.check_nas(fixture(spark, sf, "li_taxa").select(*_C10_COLS))


@query("c11_check_units_cells", with_fixtures(
    "SELECT event_id, Cells_per_mL, Units_per_mL FROM ev_survey WHERE Cells_per_mL < Units_per_mL",
    "ev_survey"))
def c11_check_units_cells(spark, sf):
    return CK.check_units_cells(fixture(spark, sf, "ev_survey").select("event_id", "Cells_per_mL",
                                                                       "Units_per_mL"))


@query("c12_check_count_issue", with_fixtures(
    "SELECT DISTINCT Taxon, Cells_per_mL, Units_per_mL, Cells_per_mL - Units_per_mL AS Diff FROM ev_survey "
    "WHERE Cells_per_mL - Units_per_mL < 0", "ev_survey"))
def c12_check_count_issue(spark, sf):
    df = fixture(spark, sf, "ev_survey").select("Taxon", "Cells_per_mL", "Units_per_mL")
    return CK.check_count_issue(df, "Cells_per_mL", "Units_per_mL")


@query("c13_check_non_numeric", with_fixtures("""
WITH n AS (SELECT ValueText, row_number() OVER (ORDER BY event_id) AS row FROM ev_survey),
bad AS (SELECT ValueText, row, row_number() OVER (PARTITION BY ValueText ORDER BY row) AS nth FROM n
        WHERE ValueText IS NOT NULL AND TRY_CAST(ValueText AS DOUBLE) IS NULL)
SELECT ValueText, list(row ORDER BY row) FILTER (nth <= 10) AS row_numbers FROM bad GROUP BY ValueText
""", "ev_survey"))
def c13_check_non_numeric(spark, sf):
    return CK.check_non_numeric(fixture(spark, sf, "ev_survey"), "ValueText", ["event_id"])


@query("c14_unique_values", "SELECT DISTINCT c_mktsegment FROM customer")
def c14_unique_values(spark, sf):
    return CK.unique_values(load(spark, sf, "customer"), "c_mktsegment")


@query("c15_check_higher_taxa", with_fixtures(r"""
SELECT DISTINCT regexp_replace(regexp_replace(Taxon, 'cf\. ', '', 'g'), ' var\..*', '', 'g') AS Taxon,
       Kingdom, Phylum, Class, AlgalGroup, Genus, Species
FROM part_taxa
WHERE Kingdom IS NULL OR Phylum IS NULL OR Class IS NULL OR AlgalGroup IS NULL OR Genus IS NULL
   OR Species IS NULL
""", "part_taxa"))
def c15_check_higher_taxa(spark, sf):
    return CK.check_higher_taxa(fixture(spark, sf, "part_taxa"))


# Synonym reference derived from part: P<k> -> P<k/2> (chains, terminal "None").
FIXTURES["part_syn"] = """
SELECT 'P' || CAST(p_partkey AS STRING) AS Taxon,
       CASE WHEN p_size > 10 THEN 'P' || CAST(CAST(floor(p_partkey / 2) AS BIGINT) AS STRING) ELSE 'None' END
         AS CurrentTaxon,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE 'Chromista' END AS Kingdom,
       p_type AS Phylum, p_brand AS Class, 'Diatoms' AS AlgalGroup,
       upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS Genus,
       split_part(p_name, ' ', 1) AS Species
FROM {part}
"""


@query("c16_check_synonyms", with_fixtures("""
SELECT DISTINCT s.Taxon AS multigen, 'multigen' AS Type, NULL::VARCHAR AS Taxon, NULL::VARCHAR AS Kingdom,
       NULL::VARCHAR AS Phylum, NULL::VARCHAR AS Class, NULL::VARCHAR AS AlgalGroup, NULL::VARCHAR AS Genus,
       NULL::VARCHAR AS Species
FROM part_syn s WHERE s.CurrentTaxon <> 'None' AND s.Taxon IN (SELECT CurrentTaxon FROM part_syn)
UNION ALL
SELECT DISTINCT NULL, 'missing syn', Taxon, Kingdom, Phylum, Class, AlgalGroup, Genus, Species
FROM (SELECT CASE WHEN Phylum = 'SMALL' THEN 'Unknown' WHEN Phylum = 'LARGE' AND Class = 'Brand#1' THEN NULL
                  ELSE Taxon END AS Taxon, Kingdom, Phylum, Class, AlgalGroup, Genus, Species FROM part_syn) t
WHERE Taxon IS NULL OR Taxon = 'Unknown'
""", "part_syn"))
def c16_check_synonyms(spark, sf):
    ref = fixture(spark, sf, "part_syn")
    data = ref.withColumn("Taxon", F.when(F.col("Phylum") == "SMALL", "Unknown")
                          .when((F.col("Phylum") == "LARGE") & (F.col("Class") == "Brand#1"), None)
                          .otherwise(F.col("Taxon")))
    return CK.check_synonyms(data, ref)


def _c17_sql():
    pat = CK.known_phrase_pattern().replace("'", "''")
    return f"""
WITH c AS (SELECT DISTINCT text FROM conversations WHERE text IS NOT NULL),
cl AS (SELECT regexp_replace(text, '{pat}', '', 'g') AS c FROM c),
fr AS (SELECT unnest(string_split_regex(c, ' ')) AS u FROM cl)
SELECT DISTINCT regexp_replace(regexp_replace(regexp_replace(u, '^\\s+|\\s+$', '', 'g'), '\\.$', ''), ';$', '')
       AS Unmatched
FROM fr
WHERE regexp_replace(regexp_replace(regexp_replace(u, '^\\s+|\\s+$', '', 'g'), '\\.$', ''), ';$', '') <> ''
"""


@query("c17_unstandardized_comments", _c17_sql())
def c17_unstandardized_comments(spark, sf):
    return CK.unstandardized_comments(load(spark, sf, "conversations"), "text", " ")


# ---------------------------------------------------------------- C18-C29

@query("c18_coordinate_bounds", with_fixtures("""
SELECT bool_and(Latitude BETWEEN -90 AND 90 AND Longitude BETWEEN -180 AND 180) AS on_globe,
       bool_and(Latitude BETWEEN 37.0 AND 39.0 AND Longitude BETWEEN -123.0 AND -121.0) AS in_box
FROM ev_survey""", "ev_survey"))
def c18_coordinate_bounds(spark, sf):
    return CK.coordinate_bounds(fixture(spark, sf, "ev_survey"))


@query("c19_multi_location_stations", """
SELECT Station, count(*) AS n, string_agg(Location, ', ' ORDER BY Location) AS locations
FROM (SELECT DISTINCT 'N' || CAST(c_nationkey AS VARCHAR) AS Station, c_mktsegment AS Location FROM customer) t
GROUP BY Station HAVING count(*) > 1
""")
def c19_multi_location_stations(spark, sf):
    c = load(spark, sf, "customer").select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("Station"),
                                           F.col("c_mktsegment").alias("Location"))
    return CK.multi_location_stations(c)


_SURVEYS = ["AF", "AO", "NF", "NO", "RF", "RO"]


@query("c20_code_crosstab", with_fixtures(f"""
WITH d AS (SELECT l_returnflag || l_linestatus AS Survey, QualityCheck FROM li_taxa),
tot AS (SELECT Survey, count(*) AS t FROM d GROUP BY Survey),
codes AS (SELECT Survey, unnest(string_split(QualityCheck, ' ')) AS code FROM d),
cnt AS (SELECT Survey, code, count(*) AS n FROM codes WHERE code <> '' GROUP BY ALL),
pct AS (SELECT c.Survey, c.code, {rnd('CAST(c.n AS DOUBLE) * 100.0 / tot.t', 2)} AS pct FROM cnt c JOIN tot USING (Survey))
SELECT code, """ + ", ".join(f"coalesce(max(pct) FILTER (WHERE Survey = '{s}'), 0.0) AS \"{s}\"" for s in _SURVEYS)
    + " FROM pct GROUP BY code", "li_taxa"))
def c20_code_crosstab(spark, sf):
    df = fixture(spark, sf, "li_taxa").withColumn("Survey", F.concat("l_returnflag", "l_linestatus"))
    return CK.code_crosstab(df, "QualityCheck", "Survey", surveys=_SURVEYS)


@query("c21_group_size_filter", with_fixtures("""
SELECT t.Event, t.Taxon, t.Cells_per_mL FROM li_taxa t SEMI JOIN (
  SELECT Event, Taxon FROM li_taxa GROUP BY ALL HAVING count(*) > 1) k
ON t.Event = k.Event AND t.Taxon = k.Taxon
""", "li_taxa"))
def c21_group_size_filter(spark, sf):
    df = fixture(spark, sf, "li_taxa").select("Event", "Taxon", "Cells_per_mL")
    return CK.group_size_filter(df, ["Event", "Taxon"])


@query("c22_distinct_taxonomy", with_fixtures(
    "SELECT DISTINCT Phylum, Class, AlgalGroup FROM part_taxa", "part_taxa"))
def c22_distinct_taxonomy(spark, sf):
    return fixture(spark, sf, "part_taxa").select("Phylum", "Class", "AlgalGroup").distinct() \
        .orderBy("Phylum", "Class", "AlgalGroup")


@query("c23_code_list_conflicts", """
WITH c AS (SELECT p_brand, p_type, p_size, count(*) AS "count" FROM part GROUP BY ALL)
SELECT c.* FROM c SEMI JOIN (SELECT p_brand FROM c GROUP BY p_brand HAVING count(*) > 1) k
ON c.p_brand = k.p_brand
""")
def c23_code_list_conflicts(spark, sf):
    return CK.code_list_conflicts(load(spark, sf, "part"), "p_brand", "p_type", "p_size")


@query("c24_multi_coordinate_visits", with_fixtures("""
SELECT d.event_id, d.Station, d.Date FROM ev_survey d SEMI JOIN (
  SELECT Station, Date FROM (SELECT DISTINCT Station, Date, Latitude, Longitude FROM ev_survey) t
  GROUP BY ALL HAVING count(*) > 1) k ON d.Station = k.Station AND d.Date = k.Date
""", "ev_survey"))
def c24_multi_coordinate_visits(spark, sf):
    df = fixture(spark, sf, "ev_survey")
    return CK.distinct_count_filter(df, ["Station", "Date"], ["Latitude", "Longitude"]) \
        .select("event_id", "Station", "Date")


@query("c25_taxonomy_mismatch", with_fixtures("""
SELECT d.Genus, d.Species, d.Kingdom, d.Phylum, d.Class, r.Kingdom AS ref_Kingdom,
       r.Phylum AS ref_Phylum, r.Class AS ref_Class
FROM (SELECT DISTINCT Genus, Species, Kingdom, Phylum, Class FROM part_taxa) d
JOIN (SELECT Genus, Species, min(Kingdom) AS Kingdom, min(Phylum) AS Phylum, min(Class) AS Class
      FROM part_taxa GROUP BY Genus, Species) r ON d.Genus = r.Genus AND d.Species = r.Species
WHERE d.Kingdom IS DISTINCT FROM r.Kingdom OR d.Phylum IS DISTINCT FROM r.Phylum
   OR d.Class IS DISTINCT FROM r.Class
""", "part_taxa"))
def c25_taxonomy_mismatch(spark, sf):
    pt = fixture(spark, sf, "part_taxa")
    d = pt.select("Genus", "Species", "Kingdom", "Phylum", "Class").distinct()
    ref = pt.groupBy("Genus", "Species").agg(F.min("Kingdom").alias("Kingdom"), F.min("Phylum").alias("Phylum"),
                                             F.min("Class").alias("Class"))
    return CK.taxonomy_mismatch(d, ref)


@query("c26_time_mismatch", with_fixtures("""
WITH o AS (SELECT DISTINCT Station, Date, Time AS OtherTime FROM ev_survey WHERE Taxon = 'purchase')
SELECT DISTINCT d.Station, d.Date, d.Time, o.OtherTime FROM ev_survey d
LEFT JOIN o ON d.Station = o.Station AND d.Date = o.Date
WHERE d.Taxon = 'click' AND (o.OtherTime IS NULL OR NOT coalesce(substr(d.Time, 1, 5) = substr(o.OtherTime, 1, 5), false))
""", "ev_survey"))
def c26_time_mismatch(spark, sf):
    df = fixture(spark, sf, "ev_survey")
    a = df.where(F.col("Taxon") == "click").select("Station", "Date", "Time")
    b = df.where(F.col("Taxon") == "purchase").select("Station", "Date", "Time")
    return CK.time_mismatch(a, b)


def _c27(spark, sf):
    df = fixture(spark, sf, "ev_survey").withColumn("Sortable_ID", F.col("Station"))
    return CK.program_logs(df.withColumn("Latitude", F.when(F.col("Cells_per_mL") > 20, F.col("Latitude"))))


@query("c27_duplicate_ids", """
SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY o_custkey HAVING count(*) > 1
""")
def c27_duplicate_ids(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", *[F.lit(None).alias(c) for c in ("Latitude", "Longitude", "Date", "Time")])
    return CK.program_logs(o, "o_custkey")["sortable_check"].withColumnRenamed("n", "count")


@query("c27_missing_latlon", with_fixtures("""
SELECT DISTINCT Date, Time, Station AS Sortable_ID, CASE WHEN Cells_per_mL > 20 THEN Latitude END AS Latitude, Longitude
FROM ev_survey WHERE Cells_per_mL <= 20 OR Cells_per_mL IS NULL OR Latitude IS NULL OR Longitude IS NULL
""", "ev_survey"))
def c27_missing_latlon(spark, sf):
    return _c27(spark, sf)["missing_latlon"]


@query("c27_missing_time", with_fixtures(
    "SELECT DISTINCT Date, Time, Station AS Sortable_ID FROM ev_survey WHERE Time IS NULL", "ev_survey"))
def c27_missing_time(spark, sf):
    return _c27(spark, sf)["missing_time"]


@query("c28_station_set_difference", """
SELECT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'
EXCEPT SELECT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag <> 'R' OR l_returnflag IS NULL
""")
def c28_station_set_difference(spark, sf):
    """Stations (supplier and part) of one survey that no other survey visits."""
    li = load(spark, sf, "lineitem")
    own = F.col("l_returnflag").eqNullSafe("R")
    return RS.set_difference(li.where(own).select("l_suppkey", "l_partkey"), li.where(~own).select("l_suppkey", "l_partkey"))


@query("c29_row_count_conserved", """
SELECT CAST((SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS BIGINT) AS n_parts,
       CAST((SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) AS BIGINT) AS n_union,
       true AS conserved
""")
def c29_row_count_conserved(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))
    return CK.row_count_conserved([c, s], c.unionByName(s))


# ---------------------------------------------------------------- T1-T10

FIXTURES["ord_time"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS Date,
       36000.0 + CAST(o_orderkey AS DOUBLE) / 7 AS serial,
       CAST(o_totalprice AS DOUBLE) / 600000.0 AS frac,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 24 AS STRING), 2, '0') || ':'
                 || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 60 AS STRING), 2, '0') END AS Time,
       CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/'
         || CAST(year(o_orderdate) AS STRING) AS mdy
FROM {orders}
"""


@query("t1_excel_serial_to_date", with_fixtures(
    "SELECT o_orderkey, CAST(DATE '1899-12-30' + CAST(floor(serial) AS INTEGER) AS DATE) AS d FROM ord_time",
    "ord_time"))
def t1_excel_serial_to_date(spark, sf):
    return fixture(spark, sf, "ord_time").select("o_orderkey", T.excel_serial_to_date("serial").alias("d"))


@query("t2_day_fraction_to_hhmm", with_fixtures(
    "SELECT o_orderkey, format('{:02d}:{:02d}', CAST(floor(floor(round(frac * 86400.0, 6)) / 3600) % 24 AS INTEGER), "
    "CAST(floor((CAST(floor(round(frac * 86400.0, 6)) AS BIGINT) % 3600) / 60) AS INTEGER)) AS t FROM ord_time",
    "ord_time"))
def t2_day_fraction_to_hhmm(spark, sf):
    return fixture(spark, sf, "ord_time").select("o_orderkey", T.day_fraction_to_hhmm("frac").alias("t"))


@query("t3_parse_date_multi", with_fixtures(
    "SELECT o_orderkey, coalesce(TRY_CAST(TRY_STRPTIME(mdy, '%m/%d/%Y') AS DATE), "
    "TRY_CAST(TRY_STRPTIME(mdy, '%d/%m/%Y') AS DATE)) AS d FROM ord_time", "ord_time"))
def t3_parse_date_multi(spark, sf):
    return fixture(spark, sf, "ord_time").select(
        "o_orderkey", T.parse_date_multi("mdy", ("M/d/yyyy", "d/M/yyyy")).alias("d"))


@query("t4_clean_time_text", with_fixtures(
    "SELECT o_orderkey, CASE WHEN regexp_replace(Time || ':00', '^(\\d{1,2}:\\d{2}):00$', '\\1') = '00:00' THEN NULL "
    "ELSE regexp_replace(Time || ':00', '^(\\d{1,2}:\\d{2}):00$', '\\1') END AS t FROM ord_time", "ord_time"))
def t4_clean_time_text(spark, sf):
    df = fixture(spark, sf, "ord_time")
    return df.select("o_orderkey", T.clean_time_text(F.concat(F.col("Time"), F.lit(":00"))).alias("t"))


@query("t5_split_stamp", with_fixtures(
    "SELECT o_orderkey, TRY_CAST(TRY_STRPTIME(mdy, '%m/%d/%Y') AS DATE) AS d, "
    "regexp_replace(concat_ws(' ', mdy, Time), '^\\d{1,2}/\\d{1,2}/\\d{4}\\s+(\\d{1,2}:\\d{2}).*$', '\\1') AS t, "
    "CASE WHEN o_orderstatus = 'F' THEN 'y' WHEN o_orderstatus = 'O' THEN 'n' ELSE 'maybe' END AS replicate_raw, "
    "CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS Replicate "
    "FROM ord_time JOIN orders USING (o_orderkey)", "ord_time"))
def t5_split_stamp(spark, sf):
    df = fixture(spark, sf, "ord_time").join(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"),
                                             "o_orderkey")
    stamp = F.concat_ws(" ", "mdy", "Time")
    raw = F.when(F.col("o_orderstatus") == "F", "y").when(F.col("o_orderstatus") == "O", "n").otherwise("maybe")
    return df.select("o_orderkey", T.date_from_stamp(stamp).alias("d"), T.time_from_stamp(stamp).alias("t"),
                     raw.alias("replicate_raw"), T.flag_to_bool(raw).alias("Replicate"))


_DST = ("(Date >= (make_date(year(Date), 3, 8) + CAST((7 - isodow(make_date(year(Date), 3, 8))) % 7 AS INTEGER)) "
        "AND Date < (make_date(year(Date), 11, 1) + CAST((7 - isodow(make_date(year(Date), 11, 1))) % 7 AS INTEGER)))")


def _t6_sql(tz):
    off = {"PDT": "0", "PST": "1"}.get(tz, f"CASE WHEN {_DST} THEN 0 ELSE 1 END")
    return with_fixtures(
        f"SELECT o_orderkey, Date, CASE WHEN Time IS NOT NULL AND regexp_matches(Time, {_VALID}) THEN "
        f"format('{{:02d}}:{{}}', (TRY_CAST(split_part(Time, ':', 1) AS INTEGER) + {off}) % 24, "
        f"regexp_replace(Time, '^.*:', '')) ELSE Time END AS Time FROM ord_time", "ord_time")


@query("t6_convert_timezone_mixed", _t6_sql("mixed"))
def t6_convert_timezone_mixed(spark, sf):
    df = fixture(spark, sf, "ord_time")
    return df.select("o_orderkey", "Date", T.shift_clock("Date", "Time", "PST/PDT").alias("Time"))


@query("t6_convert_timezone_pst", _t6_sql("PST"))
def t6_convert_timezone_pst(spark, sf):
    df = fixture(spark, sf, "ord_time")
    return df.select("o_orderkey", "Date", T.shift_clock("Date", "Time", "PST").alias("Time"))


@query("t7_timezone_preview", with_fixtures(
    f"SELECT DISTINCT Date, Time FROM ord_time WHERE Time IS NOT NULL AND regexp_matches(Time, {_VALID}) "
    f"AND NOT {_DST}", "ord_time"))
def t7_timezone_preview(spark, sf):
    return T.timezone_preview(fixture(spark, sf, "ord_time"), "PST/PDT")


@query("t7_timezone_preview_pst", with_fixtures(
    f"SELECT DISTINCT Date, Time FROM ord_time WHERE Time IS NOT NULL AND regexp_matches(Time, {_VALID})", "ord_time"))
def t7_timezone_preview_pst(spark, sf):
    return T.timezone_preview(fixture(spark, sf, "ord_time"), "PST")


@query("t10_month_keys", with_fixtures(
    "SELECT o_orderkey, CAST(date_trunc('month', Date) AS DATE) AS m, CAST(year(Date) AS VARCHAR) || '-' || "
    "CAST(month(Date) AS VARCHAR) AS ym, strftime(Date, '%b') AS mon FROM ord_time", "ord_time"))
def t10_month_keys(spark, sf):
    df = fixture(spark, sf, "ord_time")
    return df.select("o_orderkey", T.month_floor("Date").alias("m"), T.year_month_key("Date").alias("ym"),
                     T.month_label("Date").alias("mon"))


@query("c25b_taxonomy_unmatched", with_fixtures("""
WITH r AS (SELECT Genus, Species, min(Kingdom) AS Kingdom, min(Phylum) AS Phylum, min(Class) AS Class
           FROM part_taxa GROUP BY Genus, Species),
d AS (SELECT DISTINCT Kingdom, Phylum, Class, Genus, Species FROM part_taxa)
SELECT * FROM d WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.Kingdom IS NOT DISTINCT FROM d.Kingdom AND r.Phylum IS NOT DISTINCT FROM d.Phylum
    AND r.Class IS NOT DISTINCT FROM d.Class AND r.Genus IS NOT DISTINCT FROM d.Genus
    AND r.Species IS NOT DISTINCT FROM d.Species)
""", "part_taxa"))
def c25b_taxonomy_unmatched(spark, sf):
    pt = fixture(spark, sf, "part_taxa")
    ref = pt.groupBy("Genus", "Species").agg(F.min("Kingdom").alias("Kingdom"), F.min("Phylum").alias("Phylum"),
                                             F.min("Class").alias("Class"))
    return CK.taxonomy_unmatched(pt, ref)


@query("c25d_needing_synonym", with_fixtures("""
SELECT d.p_partkey, d.Taxon FROM part_taxa d
SEMI JOIN (SELECT DISTINCT lower(trim('P' || CAST(p.p_partkey AS VARCHAR))) AS k FROM part p WHERE p.p_size > 10) c
ON lower(trim(d.Taxon)) = c.k
""".replace("part_taxa d", "(SELECT p_partkey, 'p' || CAST(p_partkey AS VARCHAR) AS Taxon FROM part) d"),
    "part_taxa"))
def c25d_needing_synonym(spark, sf):
    data = load(spark, sf, "part").select("p_partkey", F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
                                          .alias("Taxon"))
    ref = fixture(spark, sf, "part_syn")
    return CK.needing_synonym(data, ref)


@query("c23b_code_list_conflicts_by_taxon", """
WITH c AS (SELECT p_type, p_brand, p_size, count(*) AS "count" FROM part GROUP BY ALL)
SELECT c.* FROM c SEMI JOIN (SELECT p_type FROM c GROUP BY p_type HAVING count(*) > 1) k ON c.p_type = k.p_type
""")
def c23b_code_list_conflicts_by_taxon(spark, sf):
    return CK.code_list_conflicts(load(spark, sf, "part"), "p_type", "p_brand", "p_size")
