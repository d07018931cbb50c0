"""Queries for P*, F*, D5-D10 and R* operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmonia.functions.exprs import signif
from harmonia.operators import filters as FL
from harmonia.operators import measures as M
from harmonia.operators import project as P
from harmonia.operators import reshape as R
from harmonia.plans.catalog import query
from harmonia.plans.fixtures import FIXTURES, fixture, load, with_fixtures


def rnd(x: str, d: int = 2) -> str:
    """Oracle text for Spark's HALF_UP rounding of a double's decimal value."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {d}) AS DOUBLE)"


def signif_sql(x: str, digits: int = 4) -> str:
    k = f"(CAST(floor(log10(abs({x}))) AS INTEGER) - {digits - 1})"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 THEN 0.0 "
            f"WHEN {k} < 0 THEN round({x} * pow(10.0, -{k})) / pow(10.0, -{k}) "
            f"ELSE round({x} / pow(10.0, {k})) * pow(10.0, {k}) END")


# ---------------------------------------------------------------- fixtures

FIXTURES["li_counts"] = """
SELECT l.l_orderkey AS Event, l.l_linenumber AS Line, 'S' || CAST(l.l_suppkey AS STRING) AS Station,
       CAST(l.l_shipdate AS DATE) AS Date,
       CASE WHEN l.l_linenumber = 1 AND l.l_quantity < 3 THEN 'No organisms observed'
            WHEN l.l_linenumber = 7 AND l.l_quantity > 45 THEN NULL ELSE p.p_brand END AS Taxon,
       CASE WHEN l.l_quantity < 8 THEN 0.0 ELSE l.l_quantity END AS Cells_per_mL,
       CASE WHEN l.l_discount = 0 THEN 0.0 WHEN l.l_discount > 0.06 THEN NULL
            ELSE l.l_extendedprice END AS Units_per_mL,
       CASE WHEN l.l_tax = 0 THEN NULL ELSE l.l_tax * 1000 END AS Biovolume_per_mL
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""

FIXTURES["li_bsa"] = """
SELECT l.l_orderkey AS Event, l.l_linenumber AS Line, p.p_brand AS Taxon,
       CASE l.l_returnflag WHEN 'A' THEN 'LabA' WHEN 'R' THEN 'LabB' ELSE 'Other' END AS Lab,
       1 + l.l_tax * 10 AS Factor, l.l_quantity AS unit, l.l_quantity * l.l_linenumber AS cells,
       CAST(p.p_size AS DOUBLE) / 4 AS cells_per_unit,
       CASE WHEN l.l_discount > 0.05 THEN l.l_extendedprice / 1000 END AS Biovolume_1,
       CASE WHEN l.l_discount < 0.09 THEN l.l_extendedprice / 2000 END AS Biovolume_2,
       CASE WHEN l.l_linenumber > 3 THEN p.p_retailprice / 100 END AS Biovolume_3,
       CAST(p.p_size AS DOUBLE) * 2 + 0.5 AS FoV, CAST(p.p_size AS DOUBLE) * 4 + l.l_linenumber AS SlideArea,
       CASE l.l_linenumber WHEN 1 THEN CAST(l.l_linenumber AS STRING) || ' meter'
            WHEN 2 THEN CAST(p.p_size AS STRING) || ' ft' WHEN 3 THEN '0.5'
            WHEN 4 THEN 'near surface' WHEN 5 THEN CAST(p.p_size AS STRING) || ' m'
            WHEN 6 THEN CAST(p.p_size AS STRING) || ' feet' ELSE NULL END AS SampleDepth
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""


# ---------------------------------------------------------------- P*

@query("p3_subset_cols", with_fixtures(
    "SELECT Date, Station, Taxon, Class, Cells_per_mL, Notes FROM li_taxa", "li_taxa"))
def p3_subset_cols(spark, sf):
    return P.subset_cols(fixture(spark, sf, "li_taxa"),
                         ["Date", "Station", "Taxon", "Class", "Cells_per_mL", "Notes"]).df


@query("p4_pad_subset", with_fixtures(
    "SELECT Event AS Event_ID, CAST(NULL AS VARCHAR) AS Survey, Date, Station, Taxon, "
    "CAST(NULL AS DOUBLE) AS TowNetRadius, Cells_per_mL FROM li_taxa", "li_taxa"))
def p4_pad_subset(spark, sf):
    df = fixture(spark, sf, "li_taxa").withColumnRenamed("Event", "Event_ID")
    return P.pad_subset(df, ["Event_ID", "Survey", "Date", "Station", "Taxon", "TowNetRadius",
                             "Cells_per_mL"], {"TowNetRadius": "double"})


@query("p5_coalesce_cols", with_fixtures(
    "SELECT Event, Taxon, coalesce(Units_per_mL, GALD) AS Units, Biovolume_per_mL FROM li_taxa",
    "li_taxa"))
def p5_coalesce_cols(spark, sf):
    df = fixture(spark, sf, "li_taxa").select("Event", "Taxon", "Units_per_mL", "GALD",
                                                  "Biovolume_per_mL")
    return P.coalesce_cols(df, {"Units": ["Units_per_mL", "GALD"]})


@query("p6_drop_cols_matching", with_fixtures(
    "SELECT Event, Line, Taxon, Lab, Factor, unit, cells, cells_per_unit, FoV, SlideArea, SampleDepth "
    "FROM li_bsa", "li_bsa"))
def p6_drop_cols_matching(spark, sf):
    return P.drop_cols_matching(fixture(spark, sf, "li_bsa"), r"^(Biovolume|Measure)")


@query("p8_drop_empty_rows", """
SELECT * FROM (
  SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS a,
         CASE WHEN l_linenumber <> 7 THEN l_quantity END AS b,
         CASE WHEN l_linenumber <> 7 OR l_quantity > 49 THEN l_returnflag END AS c
  FROM lineitem) t
WHERE a IS NOT NULL OR b IS NOT NULL OR c IS NOT NULL
""")
def p8_drop_empty_rows(spark, sf):
    li = load(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    df = li.select(F.when(ln != 7, F.col("l_orderkey")).alias("a"),
                   F.when(ln != 7, F.col("l_quantity")).alias("b"),
                   F.when((ln != 7) | (F.col("l_quantity") > 49), F.col("l_returnflag")).alias("c"))
    return P.drop_empty_rows(df)


@query("p9_extract_program_taxa", with_fixtures("""
SELECT Event, CASE WHEN OrigTaxon IS NOT NULL AND NOT contains(OrigTaxon, ';') THEN OrigTaxon
                   ELSE Taxon END AS Taxon, OrigTaxon, Cells_per_mL
FROM (SELECT Event, Taxon, CASE WHEN Station LIKE '%7' THEN OrigTaxon || '; x' ELSE OrigTaxon END
             AS OrigTaxon, Cells_per_mL, Kingdom, Phylum, Class FROM li_taxa) t
""", "li_taxa"))
def p9_extract_program_taxa(spark, sf):
    df = fixture(spark, sf, "li_taxa")
    df = df.select("Event", "Taxon",
                   F.when(F.col("Station").endswith("7"), F.concat(F.col("OrigTaxon"), F.lit("; x")))
                   .otherwise(F.col("OrigTaxon")).alias("OrigTaxon"),
                   "Cells_per_mL", "Kingdom", "Phylum", "Class")
    return P.extract_program_taxa(df)


@query("p10_cast_all_but", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(o_orderdate AS DATE) AS Date, o_orderpriority
FROM orders
""")
def p10_cast_all_but(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                          F.to_date("o_orderdate").alias("Date"), "o_orderpriority")
    return P.cast_all_but(o, ("Date",))


@query("p11_lower_relocate_constants", """
SELECT 'P11' AS survey, c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
""")
def p11_lower_relocate_constants(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    c = c.toDF("C_CUSTKEY", "C_NAME", "C_NATIONKEY", "C_MKTSEGMENT")
    c = P.add_constants(P.lower_names(c), {"survey": "P11"})
    return P.relocate(c, ["survey"])


@query("p12_overwrite_from", """
SELECT p.p_partkey, coalesce(t.p_brand2, p.p_brand) AS p_brand, coalesce(t.p_type2, p.p_type) AS p_type
FROM part p LEFT JOIN (SELECT p_partkey, CASE WHEN p_size > 25 THEN upper(p_name) END AS p_brand2,
                              CASE WHEN p_size > 40 THEN 'TYPO' END AS p_type2 FROM part) t
ON p.p_partkey = t.p_partkey
""")
def p12_overwrite_from(spark, sf):
    p = load(spark, sf, "part")
    typo = p.select("p_partkey", F.when(F.col("p_size") > 25, F.upper("p_name")).alias("b2"),
                    F.when(F.col("p_size") > 40, F.lit("TYPO")).alias("t2"))
    return P.overwrite_from(p.select("p_partkey", "p_brand", "p_type"), typo, ["p_partkey"],
                            {"p_brand": "b2", "p_type": "t2"})


@query("p13_taxonomy_path", with_fixtures(
    "SELECT Event, Taxon, coalesce(Kingdom, 'NA') || '/' || coalesce(Phylum, 'NA') || '/' || "
    "coalesce(Class, 'NA') || '/' || coalesce(Taxon, 'NA') || '/' || coalesce(OrigTaxon, 'NA') AS path "
    "FROM li_taxa", "li_taxa"))
def p13_taxonomy_path(spark, sf):
    df = fixture(spark, sf, "li_taxa")
    return df.select("Event", "Taxon",
                     P.taxonomy_path(("Kingdom", "Phylum", "Class", "Taxon", "OrigTaxon")).alias("path"))


@query("p15_density_by_lab", with_fixtures(f"""
SELECT Event, Line, Lab,
       CASE WHEN Lab = 'LabA' THEN {rnd('cells * Factor')}
            WHEN Lab = 'LabB' THEN {rnd('unit * cells_per_unit')} END AS Cells_per_mL
FROM li_bsa""", "li_bsa"))
def p15_density_by_lab(spark, sf):
    df = fixture(spark, sf, "li_bsa")
    f = P.by_group_formula("Lab", {"LabA": F.round(F.col("cells") * F.col("Factor"), 2),
                                   "LabB": F.round(F.col("unit") * F.col("cells_per_unit"), 2)})
    return df.select("Event", "Line", "Lab", f.alias("Cells_per_mL"))


# ---------------------------------------------------------------- F*

_F1_ALLNA = ("CASE WHEN Cells_per_mL = 0 THEN NULL ELSE Cells_per_mL END IS NULL AND "
             "CASE WHEN Units_per_mL = 0 THEN NULL ELSE Units_per_mL END IS NULL AND "
             "CASE WHEN Biovolume_per_mL = 0 THEN NULL ELSE Biovolume_per_mL END IS NULL")
_F1_SEL = ("Event, Line, Station, Date, Taxon, "
           "CASE WHEN Cells_per_mL = 0 THEN NULL ELSE Cells_per_mL END AS Cells_per_mL, "
           "CASE WHEN Units_per_mL = 0 THEN NULL ELSE Units_per_mL END AS Units_per_mL, "
           "CASE WHEN Biovolume_per_mL = 0 THEN NULL ELSE Biovolume_per_mL END AS Biovolume_per_mL")


def _f1(spark, sf):
    return FL.remove_nodata(fixture(spark, sf, "li_counts"))


@query("f1_remove_nodata", with_fixtures(
    f"SELECT {_F1_SEL} FROM li_counts WHERE NOT ({_F1_ALLNA} AND Taxon <> 'No organisms observed')",
    "li_counts"))
def f1_remove_nodata(spark, sf):
    return _f1(spark, sf).df


@query("f1_nodata_log", with_fixtures(
    f"SELECT {_F1_SEL} FROM li_counts WHERE {_F1_ALLNA} AND Taxon <> 'No organisms observed'",
    "li_counts"))
def f1_nodata_log(spark, sf):
    return _f1(spark, sf).logs["nodata"]


@query("f1_zeros_log", with_fixtures(
    "SELECT * FROM li_counts WHERE Cells_per_mL = 0 OR Units_per_mL = 0 OR Biovolume_per_mL = 0",
    "li_counts"))
def f1_zeros_log(spark, sf):
    return _f1(spark, sf).logs["zeros_to_na"]


@query("f1_zero_count", with_fixtures(
    "SELECT CAST(sum(CASE WHEN Cells_per_mL = 0 THEN 1 ELSE 0 END) + sum(CASE WHEN Units_per_mL = 0 "
    "THEN 1 ELSE 0 END) + sum(CASE WHEN Biovolume_per_mL = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_count "
    "FROM li_counts", "li_counts"))
def f1_zero_count(spark, sf):
    return _f1(spark, sf).logs["zero_count"]


@query("f2_check_nodata", with_fixtures(
    "SELECT DISTINCT Station, Date FROM li_counts WHERE Taxon = 'No organisms observed'", "li_counts"))
def f2_check_nodata(spark, sf):
    return FL.check_nodata(fixture(spark, sf, "li_counts"))


@query("f3_rename_values", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High'
                        WHEN o_orderpriority = '5-LOW' THEN 'Low' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def f3_rename_values(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return FL.rename_values(o, "o_orderpriority", {"High": ["1-URGENT", "2-HIGH"], "Low": "5-LOW"}).df


@query("f3_rename_values_log", """
SELECT CAST(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') THEN 1 ELSE 0 END) AS BIGINT)
       AS changed, count(*) AS total FROM orders
""")
def f3_rename_values_log(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return FL.rename_values(o, "o_orderpriority",
                            {"High": ["1-URGENT", "2-HIGH"], "Low": "5-LOW"}).logs["renamed_o_orderpriority"]


@query("f4_row_filters", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_nationkey IN (1, 3, 5, 7) AND NOT regexp_matches(c_name, '0{5}') AND c_mktsegment <> 'AUTOMOBILE'
""")
def f4_row_filters(spark, sf):
    c = load(spark, sf, "customer")
    cond = (F.col("c_nationkey").isin(1, 3, 5, 7) & ~F.col("c_name").rlike("0{5}")
            & (F.col("c_mktsegment") != "AUTOMOBILE"))
    return FL.keep_where(c, cond).df.select("c_custkey", "c_name", "c_mktsegment")


@query("f5_date_recode", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) < DATE '1998-01-01' THEN 'Net'
            WHEN o_orderstatus = 'F' THEN 'Grab' ELSE 'Pump' END AS SampleMethod,
       CASE WHEN o_orderpriority = '1-URGENT' AND CAST(o_orderdate AS DATE) >= DATE '2000-06-01'
            THEN 'Bottom' ELSE 'Surface' END AS DepthType
FROM orders
""")
def f5_date_recode(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    o = FL.recode_by_date(o, "SampleMethod", [("Net", {"o_orderstatus": "F"}, None, "1997-12-31"),
                                              ("Grab", {"o_orderstatus": "F"}, None, None)], "o_orderdate", "Pump")
    o = FL.recode_by_date(o, "DepthType", [("Bottom", {"o_orderpriority": "1-URGENT"}, "2000-06-01", None)],
                          "o_orderdate", "Surface")
    return o.select("o_orderkey", "SampleMethod", "DepthType")


_F6_CORR = ("SELECT o.o_custkey, min(o.o_orderstatus) AS sampler FROM orders o JOIN customer c "
            "ON o.o_custkey = c.c_custkey WHERE c.c_mktsegment = 'BUILDING' GROUP BY o.o_custkey")


def _f6(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                          F.col("o_orderstatus").alias("sampler"))
    c = load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    corr = (load(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("o_custkey").agg(F.min("o_orderstatus").alias("sampler")))
    return FL.filter_methods(o, corr, ["o_custkey"], "sampler")


@query("f6_filter_methods", f"""
WITH corr AS ({_F6_CORR})
SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus AS sampler FROM orders o LEFT JOIN corr
ON o.o_custkey = corr.o_custkey WHERE corr.sampler IS NULL OR o.o_orderstatus = corr.sampler
""")
def f6_filter_methods(spark, sf):
    return _f6(spark, sf).df


@query("f6_removed_method_rows", f"""
WITH corr AS ({_F6_CORR})
SELECT DISTINCT o.o_custkey, o.o_orderstatus AS sampler FROM orders o JOIN corr
ON o.o_custkey = corr.o_custkey WHERE o.o_orderstatus <> corr.sampler
""")
def f6_removed_method_rows(spark, sf):
    return _f6(spark, sf).logs["removed_method_rows"]


@query("f7_append_code_before", with_fixtures("""
SELECT Event, Taxon, Date,
       CASE WHEN Date <= DATE '1998-06-25' AND QualityCheck = 'NoCode' THEN 'DifDilution'
            WHEN Date <= DATE '1998-06-25' THEN QualityCheck || ' DifDilution'
            ELSE QualityCheck END AS QualityCheck
FROM li_taxa""", "li_taxa"))
def f7_append_code_before(spark, sf):
    df = fixture(spark, sf, "li_taxa").select("Event", "Taxon", "Date", "QualityCheck")
    return FL.append_code_before(df, "1998-06-25")


@query("f8_clean_phytoform", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN lower(f) IN ('n/p', 'na', '#n/a', '0', '1') THEN NULL ELSE lower(f) END AS PhytoForm
FROM (SELECT l_orderkey, l_linenumber,
             CASE l_linenumber WHEN 1 THEN 'C' WHEN 2 THEN 'NA' WHEN 3 THEN 'n/p' WHEN 4 THEN '#N/A'
                  WHEN 5 THEN '0' WHEN 6 THEN 'I' ELSE l_linestatus END AS f FROM lineitem) t
""")
def f8_clean_phytoform(spark, sf):
    li = load(spark, sf, "lineitem")
    ln = F.col("l_linenumber")
    f = (F.when(ln == 1, "C").when(ln == 2, "NA").when(ln == 3, "n/p").when(ln == 4, "#N/A")
         .when(ln == 5, "0").when(ln == 6, "I").otherwise(F.col("l_linestatus")))
    return FL.clean_phytoform(li.select("l_orderkey", "l_linenumber", f.alias("PhytoForm")))


@query("f9_na_text_to_null", """
SELECT c_custkey, nullif(CASE WHEN c_acctbal < 0 THEN 'NA' ELSE c_mktsegment END, 'NA') AS seg,
       nullif(CASE WHEN c_nationkey = 3 THEN 'NA' ELSE c_name END, 'NA') AS c_name
FROM customer
""")
def f9_na_text_to_null(spark, sf):
    c = load(spark, sf, "customer")
    df = c.select("c_custkey",
                  F.when(F.col("c_acctbal") < 0, "NA").otherwise(F.col("c_mktsegment")).alias("seg"),
                  F.when(F.col("c_nationkey") == 3, "NA").otherwise(F.col("c_name")).alias("c_name"))
    return FL.na_text_to_null(df)


_F10_IN = ("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'good' WHEN 'O' THEN 'fragmented' "
           "ELSE 'degraded' END AS QualityCheck, CASE WHEN o_orderpriority = '1-URGENT' THEN 'high' "
           "WHEN o_orderpriority = '2-HIGH' THEN 'moderate' WHEN o_orderpriority = '3-MEDIUM' THEN 'low' "
           "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'Trace' END AS Debris FROM {orders}")
FIXTURES["ord_lab_qc"] = _F10_IN


@query("f10_recode_lab_qc", with_fixtures("""
SELECT o_orderkey,
       CASE WHEN QualityCheck IN ('good', 'fragmented') THEN 'NoCode'
            WHEN QualityCheck = 'degraded' THEN 'Degraded' ELSE QualityCheck END AS QualityCheck,
       CASE Debris WHEN 'high' THEN 'High' WHEN 'moderate' THEN 'Moderate' WHEN 'low' THEN 'Low'
            ELSE coalesce(Debris, 'None') END AS Debris,
       CASE WHEN QualityCheck = 'fragmented' THEN 'FragmentedDiatoms' ELSE 'Unknown' END AS Notes
FROM ord_lab_qc""", "ord_lab_qc"))
def f10_recode_lab_qc(spark, sf):
    return FL.recode_lab_qc(fixture(spark, sf, "ord_lab_qc"))


@query("f13_exclude_values", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)
""")
def f13_exclude_values(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return FL.exclude_values(o, "o_custkey", [1, 2, 3, 5, 8, 13, 21, 34, 55, 89])


# ---------------------------------------------------------------- D*

_ROWMEAN = ("(coalesce(Biovolume_1, 0) + coalesce(Biovolume_2, 0) + coalesce(Biovolume_3, 0)) / "
            "nullif((CASE WHEN Biovolume_1 IS NULL THEN 0 ELSE 1 END + CASE WHEN Biovolume_2 IS NULL "
            "THEN 0 ELSE 1 END + CASE WHEN Biovolume_3 IS NULL THEN 0 ELSE 1 END), 0)")


@query("d5_density_factor", with_fixtures(f"""
SELECT Event, Line, {rnd('unit * Factor')} AS Units_per_mL, {rnd('cells * Factor')} AS Cells_per_mL,
       {rnd(f'({_ROWMEAN}) * Factor * cells')} AS Biovolume_per_mL
FROM li_bsa""", "li_bsa"))
def d5_density_factor(spark, sf):
    df = fixture(spark, sf, "li_bsa")
    out = M.calc_density_factor(df, "unit", "cells")
    return out.select("Event", "Line", "Units_per_mL", "Cells_per_mL", "Biovolume_per_mL")


@query("d6_density_direct", with_fixtures(f"""
SELECT Event, Line, {rnd('unit')} AS Units_per_mL, {rnd('unit * cells_per_unit')} AS Cells_per_mL,
       {rnd(f'({_ROWMEAN}) * Factor * unit')} AS Biovolume_per_mL
FROM li_bsa""", "li_bsa"))
def d6_density_direct(spark, sf):
    df = fixture(spark, sf, "li_bsa")
    out = M.calc_density_direct(df, "unit", "cells_per_unit", ["Biovolume_1", "Biovolume_2", "Biovolume_3"])
    return out.select("Event", "Line", "Units_per_mL", "Cells_per_mL", "Biovolume_per_mL")


@query("d7_round_signif", f"""
SELECT l_orderkey, l_linenumber, {rnd('l_extendedprice * (1 - l_discount)')} AS net,
       {signif_sql('l_extendedprice * (1 - l_discount) * (1 + l_tax)')} AS gross4
FROM lineitem
""")
def d7_round_signif(spark, sf):
    li = load(spark, sf, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", F.round(net, 2).alias("net"),
                     signif(net * (1 + F.col("l_tax")), 4).alias("gross4"))


@query("d8_half_chamber", with_fixtures("""
SELECT Event, Line, CASE WHEN round(FoV) = round(SlideArea / 2) THEN 'HalfChamber' END AS CountMethodSample
FROM li_bsa""", "li_bsa"))
def d8_half_chamber(spark, sf):
    df = fixture(spark, sf, "li_bsa")
    return df.select("Event", "Line", M.half_chamber("FoV", "SlideArea").alias("CountMethodSample"))


@query("d9_parse_depth", with_fixtures(r"""
SELECT Event, Line, SampleDepth,
       CASE WHEN regexp_matches(SampleDepth, '(?i)m(eter)?s?$')
              THEN TRY_CAST(regexp_extract(SampleDepth, '[0-9.]+', 0) AS DOUBLE)
            WHEN regexp_matches(SampleDepth, '(?i)f(eet|t)$')
              THEN TRY_CAST(regexp_extract(SampleDepth, '[0-9.]+', 0) AS DOUBLE) * 0.3048
            WHEN regexp_matches(SampleDepth, '^[0-9.]+$') THEN TRY_CAST(SampleDepth AS DOUBLE) END AS depth_m
FROM li_bsa""", "li_bsa"))
def d9_parse_depth(spark, sf):
    df = fixture(spark, sf, "li_bsa")
    return df.select("Event", "Line", "SampleDepth", M.parse_depth("SampleDepth").alias("depth_m"))


FIXTURES["ev_counts"] = """
SELECT event_id, CAST(ts AS DATE) AS Date, 'U' || CAST(user_id AS STRING) AS Station,
       event_type AS Taxon, value AS Cells_per_mL,
       CASE WHEN event_type = 'error' THEN 'Degraded'
            WHEN event_type = 'view' THEN 'NoCode; OutlierCells' ELSE 'NoCode' END AS QualityCheck,
       'NoNote' AS Notes
FROM {events}
"""

_D10_SQL = """
WITH b AS (SELECT *, CASE WHEN Cells_per_mL > 0 THEN log10(Cells_per_mL) END AS lv FROM ev_counts),
m AS (SELECT median(lv) AS med FROM b),
d AS (SELECT 1.4826 * median(abs(b.lv - m.med)) AS mad FROM b, m),
z AS (SELECT b.*, CASE WHEN b.lv IS NULL THEN NULL
                       WHEN d.mad = 0 THEN CASE WHEN b.lv > m.med THEN 'Infinity'::DOUBLE
                                                WHEN b.lv < m.med THEN '-Infinity'::DOUBLE END
                       ELSE 0.6745 * (b.lv - m.med) / d.mad END AS zr
      FROM b, m, d),
q AS (SELECT *, coalesce(zr > {cut}, false) AS outl,
             coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(
                 QualityCheck, '\\s*;?\\s*OutlierCells', '', 'g'), '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g'), ''),
                 'NoCode') AS qc
      FROM z)
SELECT event_id, Date, Station, Taxon, Cells_per_mL, Notes,
       regexp_replace(CASE WHEN outl AND qc = 'NoCode' THEN 'OutlierCells'
                           WHEN outl THEN qc || '; OutlierCells' ELSE qc END, '^;\\s*|NA;\\s*', '', 'g')
       AS QualityCheck
FROM q
"""


def _d10(spark, sf, cutoff):
    return M.flag_outliers(fixture(spark, sf, "ev_counts"), "Cells_per_mL", cutoff=cutoff, add_flag=True)


@query("d10_flag_outliers", with_fixtures(_D10_SQL.replace("{cut}", "3"), "ev_counts"))
def d10_flag_outliers(spark, sf):
    return _d10(spark, sf, 3.0).df


@query("d10_flag_outliers_low_cutoff", with_fixtures(_D10_SQL.replace("{cut}", "1.5"), "ev_counts"))
def d10_flag_outliers_low_cutoff(spark, sf):
    return _d10(spark, sf, 1.5).df


@query("d10_outlier_log", with_fixtures(
    "SELECT Date, Station, Taxon, Cells_per_mL, QualityCheck, Notes FROM ("
    + _D10_SQL.replace("{cut}", "1.5") + ") t WHERE contains(QualityCheck, 'OutlierCells')", "ev_counts"))
def d10_outlier_log(spark, sf):
    return _d10(spark, sf, 1.5).logs["outlier_cells"]


# ---------------------------------------------------------------- R*

FIXTURES["wide_taxa"] = """
SELECT c.c_custkey AS SiteID, c.c_mktsegment AS Habitat,
       CASE WHEN c.c_acctbal > 5000 THEN c.c_acctbal / 100 ELSE 0.0 END AS Aulacoseira,
       CASE WHEN c.c_nationkey % 3 = 0 THEN 0.0 ELSE CAST(c.c_nationkey AS DOUBLE) * 1.2345 END AS Cyclotella,
       CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal * 3.3333 END AS Nitzschia_unid
FROM {customer} c
"""


@query("r1_wide_to_long", with_fixtures(f"""
SELECT SiteID, Habitat,
       CASE WHEN Genus LIKE '%\\_unid' ESCAPE '\\' THEN 'cf. ' || regexp_replace(Genus, '_unid$', '') ELSE Genus END
         AS Genus,
       CASE WHEN Genus LIKE '%\\_unid' ESCAPE '\\' THEN 'cf. ' || regexp_replace(Genus, '_unid$', '') ELSE Genus END
         || ' sp.' AS Taxon,
       {signif_sql('Cells_per_mL')} AS Cells_per_mL
FROM (UNPIVOT wide_taxa ON Aulacoseira, Cyclotella, Nitzschia_unid INTO NAME Genus VALUE Cells_per_mL) u
WHERE Cells_per_mL <> 0
""", "wide_taxa"))
def r1_wide_to_long(spark, sf):
    return R.wide_to_long_taxa(fixture(spark, sf, "wide_taxa"), ["SiteID", "Habitat"])


@query("r2_long_to_wide", """
SELECT l_returnflag,
       coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0) AS "O",
       coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS "F",
       coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'X'), 0) AS "X"
FROM lineitem GROUP BY l_returnflag
""")
def r2_long_to_wide(spark, sf):
    li = load(spark, sf, "lineitem")
    agg = li.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("q"))
    return R.long_to_wide(agg, ["l_returnflag"], "l_linestatus", "q", ["O", "F", "X"])


@query("r3_melt", """
SELECT p_partkey, variable, value FROM (
  UNPIVOT (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part)
  ON p_size, p_retailprice INTO NAME variable VALUE value) u
""")
def r3_melt(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                        "p_retailprice")
    return R.melt(p, ["p_partkey"], ["p_size", "p_retailprice"])


@query("r4_separate", """
SELECT page_id, path,
       CASE WHEN len(string_split(path, '/')) >= 1 THEN string_split(path, '/')[1] END AS scheme,
       CASE WHEN len(string_split(path, '/')) >= 2 THEN string_split(path, '/')[2] END AS blank,
       CASE WHEN len(string_split(path, '/')) >= 3 THEN string_split(path, '/')[3] END AS host,
       CASE WHEN len(string_split(path, '/')) >= 4 THEN string_split(path, '/')[4] END AS lang,
       CASE WHEN len(string_split(path, '/')) >= 5 THEN string_split(path, '/')[5] END AS rest
FROM (SELECT page_id, url AS path FROM pages) t
""")
def r4_separate(spark, sf):
    p = load(spark, sf, "pages").select("page_id", F.col("url").alias("path"))
    return R.separate(p, "path", ["scheme", "blank", "host", "lang", "rest"], "/")


@query("r5_separate_rows", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS p_name FROM part
""")
def r5_separate_rows(spark, sf):
    return R.separate_rows(load(spark, sf, "part").select("p_partkey", "p_name"), "p_name", " ")


@query("r6_transpose", """
SELECT variable,
       max(CASE WHEN r_name = 'AFRICA' THEN value END) AS "AFRICA",
       max(CASE WHEN r_name = 'AMERICA' THEN value END) AS "AMERICA",
       max(CASE WHEN r_name = 'ASIA' THEN value END) AS "ASIA",
       max(CASE WHEN r_name = 'EUROPE' THEN value END) AS "EUROPE",
       max(CASE WHEN r_name = 'MIDDLE EAST' THEN value END) AS "MIDDLE EAST"
FROM (UNPIVOT (SELECT r.r_name, CAST(count(*) AS DOUBLE) AS n_nations,
                      CAST(sum(n.n_nationkey) AS DOUBLE) AS key_sum
               FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name)
      ON n_nations, key_sum INTO NAME variable VALUE value) u
GROUP BY variable
""")
def r6_transpose(spark, sf):
    r = load(spark, sf, "region")
    n = load(spark, sf, "nation")
    agg = (r.join(n, F.col("n_regionkey") == F.col("r_regionkey"))
           .groupBy("r_name").agg(F.count(F.lit(1)).cast("double").alias("n_nations"),
                                  F.sum("n_nationkey").cast("double").alias("key_sum")))
    return R.transpose(agg, "r_name", ["n_nations", "key_sum"],
                       ids=["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])


@query("r8_top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10
""")
def r8_top_k(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.top_k(o, ["o_totalprice", "o_orderkey"], 10, descending=["o_totalprice"])


@query("r9_distinct_keep_first", """
SELECT o_custkey, arg_min_null(o_orderkey, o_orderkey) AS o_orderkey,
       arg_min_null(o_orderstatus, o_orderkey) AS o_orderstatus,
       arg_min_null(o_totalprice, o_orderkey) AS o_totalprice
FROM orders GROUP BY o_custkey
""")
def r9_distinct_keep_first(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return R.distinct_keep_first(o, ["o_custkey"], ["o_orderkey"])


@query("r10_union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, NULL::VARCHAR AS segment2, c_mktsegment AS segment
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, 'SUPPLIER', NULL FROM supplier
""")
def r10_union_by_name(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                           F.col("c_acctbal").alias("acctbal"),
                                           F.col("c_mktsegment").alias("segment"))
    s = load(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"),
                                           F.lit("SUPPLIER").alias("segment2"),
                                           F.col("s_acctbal").alias("acctbal"))
    return R.union_by_name([c, s])


@query("r11_setdiff", """
SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier
""")
def r11_setdiff(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return R.set_difference(c, s)


@query("r11_intersect", """
SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'P'
INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def r11_intersect(spark, sf):
    o = load(spark, sf, "orders")
    a = o.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("custkey"))
    b = o.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("custkey"))
    return R.set_intersection(a, b)
