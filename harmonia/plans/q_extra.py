"""Queries for the remaining inventory rows (P1, P2, P7, P14, F11, F12, R7,
T9, X8, W2, S4, S5, L4, L6, L8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmonia.functions.exprs import ascii_fold, squish
from harmonia.functions import timefn as T
from harmonia.operators import checks as CK
from harmonia.operators import filters as FL
from harmonia.operators import project as P
from harmonia.operators import reshape as R
from harmonia.plans import programs as PG
from harmonia.plans import q_checks, q_taxa  # noqa: F401  (fixtures)
from harmonia.plans.catalog import query
from harmonia.plans.fixtures import fixture, load, with_fixtures
from harmonia.sources import readers as RD


@query("p1_standardize_columns", "SELECT o_orderkey AS Event, o_orderdate AS SampleDate, o_custkey AS Station, "
                                 "o_orderstatus FROM orders")
def p1_standardize_columns(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_orderstatus")
    return P.standardize_columns(o, {"Event": "o_orderkey", "SampleDate": "o_orderdate",
                                     "Station": "o_custkey", "Missing": "not_there"})


@query("p2_rename_cols", "SELECT l_orderkey, l_shipdate AS Date, l_suppkey AS Station, l_quantity AS GALD "
                         "FROM lineitem")
def p2_rename_cols(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_suppkey", "l_quantity")
    return P.rename_cols(li, {"Date": "l_shipdate", "Station": "l_suppkey", "GALD": "l_quantity"}).df


@query("p7_remove_taxa_info", with_fixtures("SELECT p_partkey, Taxon FROM part_taxa", "part_taxa"))
def p7_remove_taxa_info(spark, sf):
    df = fixture(spark, sf, "part_taxa").toDF("p_partkey", "Taxon", "KINGDOM", "phylum", "Class", "AlgalGroup",
                                               "genus", "Species")
    return P.remove_taxa_info(df)


@query("p14_dispatch_formatter", """
SELECT CAST(DATE '1899-12-30' + CAST(floor(36000.0 + CAST(o_orderkey AS DOUBLE) / 7) AS INTEGER) AS DATE) AS Date,
       o_orderkey, o_custkey FROM orders
""")
def p14_dispatch_formatter(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                          (F.lit(36000.0) + F.col("o_orderkey") / 7).alias("Date"),
                                          F.lit(None).cast("string").alias("Dimension"),
                                          F.lit(None).cast("string").alias("Genus"))
    fmts = {"lab-serial": lambda d: P.remove_taxa_info(P.drop_empty_rows(P.drop_cols_matching(
        d.withColumn("Date", T.excel_serial_to_date("Date")))))}
    return P.dispatch(o, "lab-serial", fmts).select("Date", "o_orderkey", "o_custkey")


@query("f11_derived_columns", r"""
SELECT o_orderkey,
       CASE WHEN regexp_matches(o_orderpriority, '^[12]-') THEN 'Priority' ELSE 'Routine' END AS SampleScheme,
       CASE WHEN o_totalprice > 250000 THEN 'Bottom' ELSE 'Surface' END AS DepthType,
       CASE WHEN year(o_orderdate) <= 1997 THEN '1995-1997' ELSE '1998-2001' END AS YearGroup,
       CAST(o_custkey AS VARCHAR) || '_' || strftime(o_orderdate, '%Y%m%d') AS ForID
FROM orders
""")
def f11_derived_columns(spark, sf):
    o = load(spark, sf, "orders")
    return FL.derive_columns(o, {
        "SampleScheme": F.when(F.col("o_orderpriority").rlike("^[12]-"), "Priority").otherwise("Routine"),
        "DepthType": F.when(F.col("o_totalprice") > 250000, "Bottom").otherwise("Surface"),
        "YearGroup": F.when(F.year("o_orderdate") <= 1997, "1995-1997").otherwise("1998-2001"),
        "ForID": F.concat_ws("_", F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyyMMdd")),
    }).select("o_orderkey", "SampleScheme", "DepthType", "YearGroup", "ForID")


@query("f12_station_recode", r"""
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'BLDG' WHEN c_mktsegment = 'MACHINERY' THEN 'MACH'
            ELSE c_mktsegment END AS Station,
       coalesce(CASE WHEN c_nationkey < 5 THEN CAST(c_nationkey * 100 AS DOUBLE) END, 400.0) AS Magnification,
       TRY_CAST(nullif(regexp_extract(CAST(c_nationkey AS VARCHAR) || 'x', '^\s*([0-9]+(\.[0-9]+)?)', 1), '') AS DOUBLE)
         AS n
FROM customer
""")
def f12_station_recode(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey",
                    FL.recode_keep("c_mktsegment", {"BUILDING": "BLDG", "MACHINERY": "MACH"}).alias("Station"),
                    F.coalesce(F.when(F.col("c_nationkey") < 5, (F.col("c_nationkey") * 100).cast("double")),
                               F.lit(400.0)).alias("Magnification"),
                    FL.strip_unit_number(F.concat(F.col("c_nationkey").cast("string"), F.lit("x"))).alias("n"))


@query("r7_sort_nulls_last", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def r7_sort_nulls_last(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return R.sort_r(o, ["o_orderpriority", "o_totalprice"], descending=["o_totalprice"])


@query("t9_utc_to_fixed_offset", with_fixtures("""
WITH s AS (SELECT o_orderkey, Time, timezone('Etc/GMT+8', timezone('UTC',
           CAST(Date AS TIMESTAMP) + to_minutes(CAST(coalesce(split_part(Time, ':', 1), '0') AS INTEGER) * 60
                                             + CAST(coalesce(split_part(Time, ':', 2), '0') AS INTEGER)))) AS t
           FROM ord_time)
SELECT o_orderkey, CAST(t AS DATE) AS Date, CASE WHEN Time IS NULL THEN NULL ELSE strftime(t, '%H:%M:%S') END AS Time
FROM s""", "ord_time"))
def t9_utc_to_fixed_offset(spark, sf):
    df = fixture(spark, sf, "ord_time")
    d, t = T.local_to_fixed_offset("Date", "Time", "UTC")
    return df.select("o_orderkey", d.alias("Date"), t.alias("Time"))


def _fold_sql(x):
    from harmonia.functions.exprs import FOLD_FROM, FOLD_TO
    return f"translate({x}, '{FOLD_FROM}', '{FOLD_TO}')"


@query("x8_text_utilities", f"""
SELECT conv_id, turn,
       regexp_replace(regexp_replace({_fold_sql('text')}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g') AS folded
FROM conversations
""")
def x8_text_utilities(spark, sf):
    c = load(spark, sf, "conversations")
    return c.select("conv_id", "turn", squish(ascii_fold(F.col("text"))).alias("folded"))


@query("w2_distinct_group_filter", """
SELECT o.o_orderkey, o.o_custkey FROM orders o SEMI JOIN (
  SELECT o_custkey FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) t GROUP BY o_custkey HAVING count(*) > 2
) k ON o.o_custkey = k.o_custkey
""")
def w2_distinct_group_filter(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return CK.distinct_count_filter(o, ["o_custkey"], ["o_orderstatus"], min_distinct=3).select("o_orderkey",
                                                                                               "o_custkey")


@query("s4_read_meta", "SELECT r_regionkey AS Survey, r_name AS Contact, CAST(NULL AS DATE) AS x, "
                       "DATE '2100-01-01' AS \"Ending Date\" FROM region WHERE r_regionkey = 2")
def s4_read_meta(spark, sf):
    r = load(spark, sf, "region").select(F.col("r_regionkey").alias("Survey"), F.col("r_name").alias("Contact"),
                                          F.lit(None).cast("date").alias("x"),
                                          F.lit(None).cast("date").alias("Ending Date"))
    return RD.read_meta(r, 2)


@query("s5_read_taxa", with_fixtures("SELECT Kingdom, Phylum, Class, AlgalGroup, Genus, Species, Taxon, CurrentTaxon "
                                     "FROM taxa_ref", "taxa_ref"))
def s5_read_taxa(spark, sf):
    return RD.read_taxa(fixture(spark, sf, "taxa_ref"))


@query("l4_metadata_report_debris", with_fixtures("""
WITH d AS (SELECT l_returnflag AS Survey, regexp_replace(coalesce(Debris, 'None'), '[^A-Za-z0-9 ]', '', 'g') AS c
           FROM li_taxa),
tot AS (SELECT Survey, count(*) AS t FROM d GROUP BY Survey),
cnt AS (SELECT Survey, unnest(string_split(c, ' ')) AS code FROM d),
g AS (SELECT Survey, code, count(*) AS n FROM cnt WHERE code <> '' GROUP BY ALL),
p AS (SELECT g.Survey, g.code,
             CAST(round(CAST(CAST((CAST(g.n AS DOUBLE) * 100.0 / tot.t) AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)
               AS pct FROM g JOIN tot USING (Survey))
SELECT code, coalesce(max(pct) FILTER (WHERE Survey = 'A'), 0.0) AS "A",
       coalesce(max(pct) FILTER (WHERE Survey = 'N'), 0.0) AS "N",
       coalesce(max(pct) FILTER (WHERE Survey = 'R'), 0.0) AS "R"
FROM p GROUP BY code
""", "li_taxa"))
def l4_metadata_report_debris(spark, sf):
    df = fixture(spark, sf, "li_taxa").withColumn("Survey", F.col("l_returnflag")) \
        .withColumn("Debris", F.coalesce("Debris", F.lit("None"))) \
        .withColumn("Phylum", F.col("Phylum")).withColumn("AlgalGroup", F.lit("Diatoms")) \
        .withColumn("Latitude", F.lit(38.0)).withColumn("Longitude", F.lit(-122.0)).withColumn("Location", F.lit("x"))
    return PG.metadata_report(df, ["A", "N", "R"])["crosstab_Debris"]


@query("l6_community_genus_sums", with_fixtures("""
SELECT Station, Genus,
       CASE WHEN count(Cells_per_mL) = count(*) THEN round(sum(Cells_per_mL), 4) END AS Cells_per_mL,
       CAST(1.0 AS DOUBLE) AS Binary_sum
FROM (SELECT Station, split_part(Taxon, '#', 1) AS Genus, Cells_per_mL FROM li_taxa) t GROUP BY ALL
""", "li_taxa"))
def l6_community_genus_sums(spark, sf):
    df = fixture(spark, sf, "li_taxa").withColumn("Genus", F.split("Taxon", "#").getItem(0))
    out = PG.community_checks(df.select("Station", "Date", "Taxon", "Genus", "Cells_per_mL"), ["Station"],
                              measures=("Cells_per_mL",))["genus_sums"]
    return out.select("Station", "Genus", F.round("Cells_per_mL", 4).alias("Cells_per_mL"),
                      F.col("Binary").cast("double").alias("Binary_sum"))


@query("l8_standardize_lab_columns", with_fixtures("""
SELECT Event AS SampleEvent, Taxon, CAST(round(CAST(CAST(unit * Factor AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)
       AS Units_per_mL, CAST(round(CAST(CAST(cells * Factor AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)
       AS Cells_per_mL, CAST(NULL AS VARCHAR) AS Comments
FROM li_bsa
""", "li_bsa"))
def l8_standardize_lab_columns(spark, sf):
    df = fixture(spark, sf, "li_bsa").select("Event", "Taxon", "Factor", "unit", "cells",
                                              F.col("Biovolume_1").alias("Measurement 1"))
    return PG.standardize_lab_columns(df, {"SampleEvent": "Event"},
                                      ["SampleEvent", "Taxon", "Units_per_mL", "Cells_per_mL", "Comments"],
                                      density={"unit": "unit", "cell": "cells"})
