"""Queries for A4-A10 community operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from harmonia.operators import community as CM
from harmonia.plans.catalog import query, rounded
from harmonia.plans.fixtures import FIXTURES, fixture, load, with_fixtures
from harmonia.plans.q_project import rnd

# Nations as sampling units, brands as taxa, quantities as counts.
FIXTURES["nation_brand"] = """
SELECT s.s_nationkey AS nation, n.n_regionkey AS region, p.p_brand AS Taxon, l.l_orderkey AS visit,
       l.l_quantity AS qty, CAST(year(l.l_shipdate) AS INT) AS Year, l.l_extendedprice AS price
FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {nation} n ON s.s_nationkey = n.n_nationkey
"""

BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query("a4_group_sums", with_fixtures("""
SELECT Station, CAST(year(Date) AS INTEGER) AS Year, Taxon,
       round(CASE WHEN count(Units_per_mL) = count(*) THEN sum(Units_per_mL) END, 4) AS Units_per_mL,
       round(CASE WHEN count(Cells_per_mL) = count(*) THEN sum(Cells_per_mL) END, 4) AS Cells_per_mL,
       1 AS Binary
FROM li_taxa GROUP BY Station, year(Date), Taxon
""", "li_taxa"))
def a4_group_sums(spark, sf):
    df = fixture(spark, sf, "li_taxa").withColumn("Year", F.year("Date"))
    out = CM.group_sums(df, ["Station", "Year", "Taxon"], ["Units_per_mL", "Cells_per_mL"])
    return rounded(out, ["Units_per_mL", "Cells_per_mL"])


_A5_LONG = """
WITH s AS (SELECT nation, Taxon, coalesce(sum(qty), 0.0) AS total FROM nation_brand GROUP BY ALL),
e AS (SELECT nation, count(*) AS n FROM (SELECT DISTINCT nation, visit FROM nation_brand) t GROUP BY nation),
lg AS (SELECT s.nation, s.Taxon, s.total / e.n AS value FROM s JOIN e USING (nation))
"""


def _a5(spark, sf):
    return CM.community_long(fixture(spark, sf, "nation_brand"), ["nation"], "qty", "Taxon", avg_var=["visit"])


@query("a5_community_long", with_fixtures(_A5_LONG + "SELECT nation, Taxon, round(value, 6) AS value FROM lg",
                                           "nation_brand"))
def a5_community_long(spark, sf):
    return rounded(_a5(spark, sf), ["value"], 6)


@query("a5_community_wide", with_fixtures(
    _A5_LONG + "SELECT nation, " + ", ".join(
        f"round(coalesce(max(value) FILTER (WHERE Taxon = '{b}'), 0.0), 6) AS \"{b}\"" for b in BRANDS)
    + " FROM lg GROUP BY nation", "nation_brand"))
def a5_community_wide(spark, sf):
    return rounded(CM.community_wide(_a5(spark, sf), ["nation"], "Taxon", BRANDS), BRANDS, 6)


def _a6_sql(method: str) -> str:
    bray = "1.0 - 2.0 * coalesce(sh.smin, 0.0) / (ta.tot + tb.tot)"
    dist = bray if method == "bray" else f"2.0 * ({bray}) / (1.0 + ({bray}))"
    return with_fixtures(f"""
WITH x AS (SELECT nation AS u, Taxon AS t, sum(qty) AS v FROM nation_brand GROUP BY ALL HAVING sum(qty) > 0),
tot AS (SELECT u, sum(v) AS tot FROM x GROUP BY u),
sh AS (SELECT a.u AS ua, b.u AS ub, sum(least(a.v, b.v)) AS smin FROM x a JOIN x b ON a.t = b.t AND a.u < b.u
       GROUP BY ALL)
SELECT ta.u AS nation_a, tb.u AS nation_b, {rnd(dist, 9)} AS dissimilarity
FROM tot ta JOIN tot tb ON ta.u < tb.u LEFT JOIN sh ON ta.u = sh.ua AND tb.u = sh.ub
""", "nation_brand")


def _nb_long(spark, sf):
    return CM.community_long(fixture(spark, sf, "nation_brand"), ["nation"], "qty", "Taxon")


@query("a6_bray_curtis", _a6_sql("bray"))
def a6_bray_curtis(spark, sf):
    return rounded(CM.dissimilarity(_nb_long(spark, sf), "nation", method="bray"), ["dissimilarity"], 9)


@query("a6_jaccard", _a6_sql("jaccard"))
def a6_jaccard(spark, sf):
    return rounded(CM.dissimilarity(_nb_long(spark, sf), "nation", method="jaccard"), ["dissimilarity"], 9)


_A7_SQL = with_fixtures(f"""
WITH x AS (SELECT CAST(nation AS VARCHAR) AS unit, CAST(region AS VARCHAR) AS grp, Taxon AS taxon,
                  CAST(coalesce(sum(qty), 0.0) AS DOUBLE) AS v FROM nation_brand GROUP BY ALL),
units AS (SELECT DISTINCT unit, grp FROM x),
pairs AS (SELECT DISTINCT a.grp AS ga, b.grp AS gb FROM units a, units b WHERE a.grp < b.grp),
pt AS (SELECT DISTINCT p.ga, p.gb, x.taxon FROM pairs p JOIN x ON x.grp IN (p.ga, p.gb)),
grid AS (SELECT pt.ga, pt.gb, u.unit, u.grp, pt.taxon, coalesce(x.v, 0.0) AS v
         FROM pt JOIN units u ON u.grp IN (pt.ga, pt.gb) LEFT JOIN x ON x.unit = u.unit AND x.taxon = pt.taxon),
tots AS (SELECT ga, gb, unit, sum(v) AS t FROM grid GROUP BY ALL),
c AS (SELECT a.ga, a.gb, a.taxon, abs(a.v - b.v) / (ta.t + tb.t) AS contrib
      FROM grid a JOIN grid b ON a.ga = b.ga AND a.gb = b.gb AND a.taxon = b.taxon AND a.grp = a.ga AND b.grp = a.gb
      JOIN tots ta ON ta.ga = a.ga AND ta.gb = a.gb AND ta.unit = a.unit
      JOIN tots tb ON tb.ga = a.ga AND tb.gb = a.gb AND tb.unit = b.unit),
s AS (SELECT ga, gb, taxon, avg(contrib) AS average, stddev_samp(contrib) AS sd FROM c GROUP BY ALL),
av AS (SELECT ga, gb, taxon, avg(v) FILTER (WHERE grp = ga) AS ava, avg(v) FILTER (WHERE grp = gb) AS avb
       FROM grid GROUP BY ALL),
r AS (SELECT s.*, av.ava, av.avb,
             sum(s.average) OVER (PARTITION BY s.ga, s.gb ORDER BY round(s.average, 12) DESC, s.taxon
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / sum(s.average) OVER (PARTITION BY s.ga, s.gb) AS cs
      FROM s JOIN av USING (ga, gb, taxon))
SELECT ga AS group_a, gb AS group_b, taxon, {rnd('average', 9)} AS average, {rnd('sd', 9)} AS sd,
       {rnd('average / sd', 9)} AS ratio, {rnd('ava', 9)} AS ava, {rnd('avb', 9)} AS avb, {rnd('cs', 9)} AS cumsum
FROM r
""", "nation_brand")


@query("a7_simper", _A7_SQL)
def a7_simper(spark, sf):
    lng = CM.community_long(fixture(spark, sf, "nation_brand"), ["nation", "region"], "qty", "Taxon")
    out = CM.simper(lng, "nation", "region")
    return rounded(out, ["average", "sd", "ratio", "ava", "avb", "cumsum"], 9)


_A7_P_SQL = with_fixtures(f"""
WITH x AS (SELECT CAST(nation AS VARCHAR) AS unit, CAST(region AS VARCHAR) AS grp, Taxon AS taxon,
                  CAST(coalesce(sum(qty), 0.0) AS DOUBLE) AS v FROM nation_brand GROUP BY ALL),
units AS (SELECT unit, grp, sum(v) AS tot FROM x GROUP BY ALL),
sizes AS (SELECT grp, count(*) AS n FROM units GROUP BY grp),
pools AS (SELECT a.grp AS ga, b.grp AS gb, a.n AS na FROM sizes a, sizes b WHERE a.grp < b.grp),
members AS (SELECT p.ga, p.gb, p.na, u.* FROM pools p JOIN units u ON u.grp IN (p.ga, p.gb)),
ranked AS (SELECT m.*, r, row_number() OVER (PARTITION BY ga, gb, r ORDER BY
             md5('42|' || r || '|' || ga || '|' || gb || '|' || grp || '|' || unit)) AS place
           FROM members m, (SELECT unnest(range(1, 101)) AS r)),
sides AS (SELECT ga, gb, unit, tot, r, place > na AS far FROM ranked
          UNION ALL SELECT ga, gb, unit, tot, 0, grp = gb FROM members),
taxa AS (SELECT DISTINCT p.ga, p.gb, x.taxon FROM pools p JOIN x ON x.grp IN (p.ga, p.gb)),
c AS (SELECT a.ga, a.gb, a.r, t.taxon,
             avg(abs(coalesce(xa.v, 0.0) - coalesce(xb.v, 0.0)) / (a.tot + b.tot)) AS average
      FROM sides a JOIN sides b ON a.ga = b.ga AND a.gb = b.gb AND a.r = b.r AND NOT a.far AND b.far
      JOIN taxa t ON t.ga = a.ga AND t.gb = a.gb
      LEFT JOIN x xa ON xa.unit = a.unit AND xa.taxon = t.taxon
      LEFT JOIN x xb ON xb.unit = b.unit AND xb.taxon = t.taxon
      GROUP BY ALL)
SELECT o.ga AS group_a, o.gb AS group_b, o.taxon, {rnd('o.average', 9)} AS average,
       round((count(*) FILTER (c.average >= o.average - 1e-12) + 1) / 101.0, 9) AS p
FROM c o JOIN c ON c.ga = o.ga AND c.gb = o.gb AND c.taxon = o.taxon AND c.r > 0
WHERE o.r = 0 GROUP BY o.ga, o.gb, o.taxon, o.average
""", "nation_brand")


@query("a7_simper_permutation_p", _A7_P_SQL)
def a7_simper_permutation_p(spark, sf):
    """Permutation p-values over 100 seeded permutations; the oracle draws the same labels."""
    lng = CM.community_long(fixture(spark, sf, "nation_brand"), ["nation", "region"], "qty", "Taxon")
    out = CM.simper(lng, "nation", "region", permutations=100).select("group_a", "group_b", "taxon", "average", "p")
    return rounded(out, ["average", "p"], 9)


@query("a8_top_taxa_summary", with_fixtures("""
WITH top AS (SELECT Taxon FROM (SELECT Taxon, sum(qty) AS total FROM nation_brand GROUP BY Taxon)
             ORDER BY total DESC NULLS LAST, Taxon LIMIT 6)
SELECT Taxon, Year, round(sum(price), 4) AS Value FROM nation_brand SEMI JOIN top USING (Taxon) GROUP BY ALL
""", "nation_brand"))
def a8_top_taxa_summary(spark, sf):
    nb = fixture(spark, sf, "nation_brand")
    ranking = nb.groupBy("Taxon").agg(F.sum("qty").alias("total"))
    return rounded(CM.top_taxa_summary(nb, ranking, "Taxon", "total", "Year", "price", k=6), ["Value"])


@query("a9_year_group_share", f"""
WITH t AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS Year, o_orderpriority, coalesce(sum(o_totalprice), 0.0) AS total
           FROM orders GROUP BY ALL)
SELECT Year, o_orderpriority, round(total, 4) AS total,
       {rnd('total / sum(total) OVER (PARTITION BY Year)', 9)} AS share
FROM t
""")
def a9_year_group_share(spark, sf):
    o = load(spark, sf, "orders").withColumn("Year", F.year("o_orderdate"))
    out = CM.year_group_share(o, "Year", "o_orderpriority", "o_totalprice")
    return rounded(rounded(out, ["total"], 4), ["share"], 9)


@query("a10_extreme_values", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 95000")
def a10_extreme_values(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return CM.extreme_values(li, "l_extendedprice", 95000)
