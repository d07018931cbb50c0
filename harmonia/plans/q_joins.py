"""Queries for J* joins, W1 Event_ID, G1/G2 grids, S6 fill-down, W3 and T8."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harmonia.functions import timefn as T
from harmonia.operators import grids as G
from harmonia.operators import joins as J
from harmonia.plans import q_checks  # noqa: F401  (defines the ev_survey and ord_time fixtures)
from harmonia.plans.catalog import query
from harmonia.plans.fixtures import FIXTURES, fixture, load, with_fixtures

# Survey metadata ranges (a small configuration table): overlapping ranges,
# a gap, an open end, a NULL (wildcard) match column, a range outside the data.
META_ROWS = [
    (1, "1994-06-01", "1996-12-31", "LabA", "Net", None),
    (2, "1996-06-01", "1998-03-31", "LabB", "Grab", "F"),
    (3, "1998-06-01", "1999-12-31", "LabC", "Pump", None),
    (4, "1999-06-01", None, "Lab4", "Net", "O"),
    (5, "2003-01-01", "2004-01-01", "Future", "X", None),
]
META_SQL = "(VALUES " + ", ".join(
    f"({i}, DATE '{s}', {('DATE ' + repr(e)) if e else 'CAST(NULL AS DATE)'}, '{lab}', '{sm}', "
    f"{repr(st) if st else 'CAST(NULL AS VARCHAR)'})" for i, s, e, lab, sm, st in META_ROWS
) + ") AS meta(meta_idx, start_date, end_date, Lab, SampleMethod, o_orderstatus)"


def meta_df(spark):
    rows = [(i, dt.date.fromisoformat(s), dt.date.fromisoformat(e) if e else None, lab, sm, st)
            for i, s, e, lab, sm, st in META_ROWS]
    return spark.createDataFrame(rows, "meta_idx int, start_date date, end_date date, Lab string, "
                                       "SampleMethod string, o_orderstatus string")


def _orders(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderstatus",
                                             F.to_date("o_orderdate").alias("Date"))


KW = dict(start="start_date", end="end_date")


@query("j1_from_meta", f"""
SELECT o.o_orderkey, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS Date, m.Lab
FROM orders o LEFT JOIN {META_SQL}
ON CAST(o.o_orderdate AS DATE) BETWEEN m.start_date AND coalesce(m.end_date, DATE '2001-12-31')
""".replace("AS meta(", "AS m("))
def j1_from_meta(spark, sf):
    return J.from_meta(_orders(spark, sf), meta_df(spark), ["Lab"], today="2001-12-31", **KW)


@query("j2_meta_first_match", f"""
SELECT o.o_orderkey, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS Date,
       arg_min(m.Lab, m.meta_idx) AS Lab, arg_min(m.SampleMethod, m.meta_idx) AS SampleMethod
FROM orders o LEFT JOIN {META_SQL}
ON CAST(o.o_orderdate AS DATE) BETWEEN m.start_date AND m.end_date
GROUP BY ALL
""".replace("AS meta(", "AS m("))
def j2_meta_first_match(spark, sf):
    return J.add_metadata_first(_orders(spark, sf), meta_df(spark), ["Lab", "SampleMethod"], **KW)


_J3_SQL = f"""
WITH d AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS Date FROM orders),
span AS (SELECT min(Date) AS dmin, max(Date) AS dmax FROM d),
m0 AS (SELECT m.* FROM {META_SQL}, span
       WHERE (m.end_date IS NULL OR m.end_date >= span.dmin) AND m.start_date <= span.dmax),
pk AS (SELECT arg_min(meta_idx, (start_date, meta_idx)) AS f,
              arg_max(meta_idx, (coalesce(end_date, (SELECT dmax FROM span)), -meta_idx)) AS l FROM m0),
m1 AS (SELECT meta_idx, CASE WHEN meta_idx = pk.f THEN span.dmin ELSE start_date END AS start_date,
              CASE WHEN meta_idx = pk.l THEN span.dmax ELSE end_date END AS end_date, Lab, o_orderstatus
       FROM m0, pk, span),
hit AS (SELECT d.o_orderkey, max(m1.meta_idx) AS w FROM d JOIN m1
        ON m1.end_date IS NOT NULL AND d.Date BETWEEN m1.start_date AND m1.end_date
       AND (m1.o_orderstatus IS NULL OR m1.o_orderstatus = d.o_orderstatus) GROUP BY d.o_orderkey)
SELECT d.o_orderkey, d.o_orderstatus, d.Date, m1.Lab
FROM d LEFT JOIN hit ON d.o_orderkey = hit.o_orderkey LEFT JOIN m1 ON m1.meta_idx = hit.w
""".replace("AS meta(", "AS m(")


@query("j3_meta_last_match", _J3_SQL)
def j3_meta_last_match(spark, sf):
    return J.add_meta_col(_orders(spark, sf), meta_df(spark), "Lab", ["o_orderstatus"], **KW)


@query("j4_metadata_preview", f"""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS dmin, max(CAST(o_orderdate AS DATE)) AS dmax FROM orders)
SELECT m.meta_idx, greatest(m.start_date, span.dmin) AS start_date,
       least(coalesce(m.end_date, span.dmax), span.dmax) AS end_date, m.Lab, m.SampleMethod, m.o_orderstatus
FROM {META_SQL}, span
WHERE greatest(m.start_date, span.dmin) <= least(coalesce(m.end_date, span.dmax), span.dmax)
""".replace("AS meta(", "AS m("))
def j4_metadata_preview(spark, sf):
    return J.metadata_preview(_orders(spark, sf), meta_df(spark), **KW)


def _j5(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf, "nation").where(F.col("n_nationkey") < 20) \
        .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    return J.add_lookup(c, n, ["c_nationkey"])


@query("j5_add_lookup", """
SELECT c.c_custkey, c.c_nationkey, n.n_name, n.n_regionkey FROM customer c
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON c.c_nationkey = n.n_nationkey
""")
def j5_add_lookup(spark, sf):
    return _j5(spark, sf).df


@query("j5_missing_lookup_log", """
SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 20)
""")
def j5_missing_lookup_log(spark, sf):
    return _j5(spark, sf).logs["missing_lookup"]


@query("j6_location_lookup", """
SELECT s.s_suppkey, s.s_nationkey, r.r_name FROM supplier s
LEFT JOIN (SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
           WHERE r.r_name <> 'ASIA') r ON s.s_nationkey = r.n_nationkey
""")
def j6_location_lookup(spark, sf):
    s = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = load(spark, sf, "nation")
    r = load(spark, sf, "region").where(F.col("r_name") != "ASIA")
    lk = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("n_nationkey").alias("s_nationkey"), "r_name")
    return J.add_lookup(s, lk, ["s_nationkey"]).df


FIXTURES["cust_alias"] = """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'N' ELSE 'n' END || CAST(c_nationkey AS STRING) AS Station,
       CAST(c_nationkey % 5 AS STRING) AS site_no
FROM {customer}
"""
FIXTURES["nation_alias"] = """
SELECT n_name AS Station, n_regionkey AS site_no,
       CASE WHEN n_nationkey = 7 THEN NULL
            ELSE 'N' || CAST(n_nationkey AS STRING) || ', n' || CAST(n_nationkey AS STRING) END AS field_id_alias
FROM {nation}
"""


def _j7(spark, sf):
    return J.rename_by_alias(fixture(spark, sf, "cust_alias"), fixture(spark, sf, "nation_alias"))


_J7_ALIASES = """
WITH a AS (SELECT trim(unnest(string_split(field_id_alias, ','))) AS alias, CAST(site_no AS VARCHAR) AS site,
                  Station AS station FROM nation_alias WHERE field_id_alias IS NOT NULL AND field_id_alias <> ''),
j AS (SELECT d.c_custkey, d.site_no, d.Station AS orig,
             CASE WHEN a.station IS NOT NULL AND a.station <> d.Station THEN a.station ELSE d.Station END AS Station
      FROM cust_alias d LEFT JOIN a ON d.Station = a.alias AND d.site_no = a.site)
"""


@query("j7_rename_by_alias", with_fixtures(_J7_ALIASES + "SELECT c_custkey, trim(Station) AS Station, site_no FROM j",
                                            "cust_alias", "nation_alias"))
def j7_rename_by_alias(spark, sf):
    return _j7(spark, sf).df


@query("j7_station_renames_log", with_fixtures(
    _J7_ALIASES + "SELECT DISTINCT orig AS original, Station AS updated FROM j WHERE orig <> Station",
    "cust_alias", "nation_alias"))
def j7_station_renames_log(spark, sf):
    return _j7(spark, sf).logs["station_renames"]


def _j8(spark, sf):
    li = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber",
                                             F.to_date("l_shipdate").alias("Date"))
    fx = load(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_orderkey").alias("key"), F.to_date("o_orderdate").alias("WQDate"))
    return J.replace_from_lookup(li, fx, ["key"], "Date", "WQDate")


_J8_BASE = """
WITH li AS (SELECT l_orderkey AS key, l_linenumber, CAST(l_shipdate AS DATE) AS Date FROM lineitem),
fx AS (SELECT o_orderkey AS key, CAST(o_orderdate AS DATE) AS WQDate FROM orders WHERE o_orderpriority = '1-URGENT')
"""


@query("j8_replace_dates", _J8_BASE + """
SELECT li.key, li.l_linenumber, coalesce(fx.WQDate, li.Date) AS Date FROM li LEFT JOIN fx ON li.key = fx.key
""")
def j8_replace_dates(spark, sf):
    return _j8(spark, sf).df


@query("j8_replaced_log", _J8_BASE + """
SELECT DISTINCT li.key, li.Date AS old, fx.WQDate AS new FROM li JOIN fx ON li.key = fx.key
WHERE li.Date IS DISTINCT FROM fx.WQDate
""")
def j8_replaced_log(spark, sf):
    return _j8(spark, sf).logs["replaced"]


FIXTURES["ev_wq"] = """
SELECT 'U' || CAST(user_id AS STRING) AS Station, CAST(ts AS DATE) AS Date,
       min(36.5 + CAST(user_id AS DOUBLE) / 50) AS Latitude, max(-122.0 - value / 1000) AS Longitude,
       min(lpad(CAST(hour(ts) AS STRING), 2, '0') || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')) AS Time
FROM {events} WHERE event_type = 'purchase'
GROUP BY user_id, CAST(ts AS DATE)
"""


def _j9(spark, sf):
    d = fixture(spark, sf, "ev_survey").select("event_id", "Station", "Date")
    return J.add_lookup(d, fixture(spark, sf, "ev_wq"), ["Station", "Date"], log_name="missing_wq")


@query("j9_add_wq", with_fixtures("""
SELECT d.Station, d.Date, d.event_id, w.Latitude, w.Longitude, w.Time
FROM ev_survey d LEFT JOIN ev_wq w ON d.Station = w.Station AND d.Date = w.Date
""", "ev_survey", "ev_wq"))
def j9_add_wq(spark, sf):
    return _j9(spark, sf).df


@query("j9_missing_wq_log", with_fixtures("""
SELECT DISTINCT d.Station, d.Date FROM ev_survey d ANTI JOIN ev_wq w ON d.Station = w.Station AND d.Date = w.Date
""", "ev_survey", "ev_wq"))
def j9_missing_wq_log(spark, sf):
    return _j9(spark, sf).logs["missing_wq"]


@query("j10_coalesce_after_join", with_fixtures("""
SELECT d.event_id, coalesce(w.Latitude, d.Latitude) AS Latitude, coalesce(w.Longitude, d.Longitude) AS Longitude
FROM ev_survey d LEFT JOIN ev_wq w ON d.Station = w.Station AND d.Date = w.Date
""", "ev_survey", "ev_wq"))
def j10_coalesce_after_join(spark, sf):
    d = fixture(spark, sf, "ev_survey").select("event_id", "Station", "Date", "Latitude", "Longitude")
    w = fixture(spark, sf, "ev_wq").select("Station", "Date", F.col("Latitude").alias("Latitude_y"),
                                            F.col("Longitude").alias("Longitude_y"))
    j = d.join(w, ["Station", "Date"], "left")
    return j.select("event_id", F.coalesce("Latitude_y", "Latitude").alias("Latitude"),
                    F.coalesce("Longitude_y", "Longitude").alias("Longitude"))


@query("j11_natural_left_join", """
SELECT c.c_custkey, c.c_name, c.n_nationkey, n.n_name, n.n_regionkey
FROM (SELECT c_custkey, c_name, c_nationkey AS n_nationkey FROM customer) c
LEFT JOIN nation n ON c.n_nationkey = n.n_nationkey
""")
def j11_natural_left_join(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    return J.natural_join(c, load(spark, sf, "nation"), "left").df


@query("j12_natural_full_join", """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F')
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
       coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, a.o_totalprice, b.o_orderpriority
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey AND a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus
""")
def j12_natural_full_join(spark, sf):
    o = load(spark, sf, "orders")
    a = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    b = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return J.natural_join(a, b, "full").df


@query("j13_semi_join", """
SELECT c_custkey, c_name FROM customer SEMI JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') o
ON c_custkey = o.o_custkey
""")
def j13_semi_join(spark, sf):
    o = load(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return load(spark, sf, "customer").select("c_custkey", "c_name").join(o, "c_custkey", "left_semi")


@query("j13_anti_join", """
SELECT p_partkey, p_name FROM part ANTI JOIN lineitem ON p_partkey = l_partkey
""")
def j13_anti_join(spark, sf):
    li = load(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return load(spark, sf, "part").select("p_partkey", "p_name").join(li, "p_partkey", "left_anti")


# Polygons (closed vertex rings) for the spatial join; the second overlaps the
# first, so first-polygon-wins is exercised.
POLYGONS = [
    (1, "North", "N1", [-122.5, -122.1, -122.1, -122.5, -122.5], [37.9, 37.9, 38.6, 38.6, 37.9]),
    (2, "North", "N2", [-122.2, -121.7, -121.8, -122.2], [38.0, 38.2, 38.7, 38.0]),
    (3, "South", "S1", [-122.5, -121.6, -121.9, -122.5], [37.5, 37.5, 37.95, 37.5]),
]


def _poly_df(spark):
    return spark.createDataFrame(POLYGONS, "poly_idx int, Region string, SubRegion string, "
                                           "xs array<double>, ys array<double>")


FIXTURES["cust_points"] = """
SELECT c_custkey, -122.5 + (c_acctbal + 1000.0) / 11000.0 AS Longitude,
       37.5 + CAST(c_nationkey AS DOUBLE) / 24.0 AS Latitude
FROM {customer}
"""


def edges_sql():
    """The polygons as an edge table (oracle side)."""
    edges = []
    for idx, reg, sub, xs, ys in POLYGONS:
        for i in range(len(xs) - 1):
            edges.append(f"({idx}, '{reg}', '{sub}', {xs[i]}, {ys[i]}, {xs[i + 1]}, {ys[i + 1]})")
    return "(VALUES " + ", ".join(edges) + ") AS e(poly_idx, Region, SubRegion, x1, y1, x2, y2)"


def _j14_sql():
    e = edges_sql()
    return with_fixtures(f"""
WITH cr AS (
  SELECT p.c_custkey, e.poly_idx, e.Region, e.SubRegion,
         sum(CASE WHEN ((e.y1 > p.Latitude) <> (e.y2 > p.Latitude))
                   AND p.Longitude < (e.x2 - e.x1) * (p.Latitude - e.y1) / (e.y2 - e.y1) + e.x1
                  THEN 1 ELSE 0 END) AS n
  FROM cust_points p, {e} GROUP BY ALL),
ins AS (SELECT c_custkey, arg_min(Region, poly_idx) AS Region, arg_min(SubRegion, poly_idx) AS SubRegion
        FROM cr WHERE n % 2 = 1 GROUP BY c_custkey)
SELECT p.c_custkey, p.Longitude, p.Latitude, ins.Region, ins.SubRegion FROM cust_points p JOIN ins USING (c_custkey)
""", "cust_points")


@query("j14_point_in_polygon", _j14_sql())
def j14_point_in_polygon(spark, sf):
    return J.assign_region(fixture(spark, sf, "cust_points"), _poly_df(spark))


# ---------------------------------------------------------------- W1, G1, G2, S6, W3, T8

FIXTURES["ev_event"] = """
SELECT event_id AS ev_id, 'REG-' || upper(event_type) AS Survey, 'U' || CAST(user_id AS STRING) AS Station,
       CAST(ts AS DATE) AS Date,
       CASE WHEN value < 30 THEN NULL
            ELSE lpad(CAST(hour(ts) % 3 + 8 AS STRING), 2, '0') || ':' || CASE WHEN value < 250 THEN '00' ELSE '30' END
       END AS Time,
       CASE WHEN value < 100 THEN '1 meter' WHEN value < 200 THEN '3 ft' WHEN value < 300 THEN '0.5'
            WHEN value < 400 THEN 'near surface' ELSE NULL END AS SampleDepth,
       CASE WHEN value < 150 THEN 'surface' WHEN value < 350 THEN 'bottom' WHEN value < 450 THEN 'near surface'
            ELSE NULL END AS DepthType
FROM {events}
"""

_DEPTH = ("CASE WHEN regexp_matches(SampleDepth, '(?i)m(eter)?s?$') THEN TRY_CAST(regexp_extract(SampleDepth, '[0-9.]+', 0) AS DOUBLE) "
          "WHEN regexp_matches(SampleDepth, '(?i)f(eet|t)$') THEN TRY_CAST(regexp_extract(SampleDepth, '[0-9.]+', 0) AS DOUBLE) * 0.3048 "
          "WHEN regexp_matches(SampleDepth, '^[0-9.]+$') THEN TRY_CAST(SampleDepth AS DOUBLE) END")


@query("w1_add_event_id", with_fixtures(f"""
WITH b AS (
  SELECT ev_id, Survey, Station, Date, Time, {_DEPTH} AS SampleDepth, DepthType,
         trim(regexp_replace(Survey, '^.*-', '')) AS sv,
         CASE DepthType WHEN 'near surface' THEN 'NS' WHEN 'surface' THEN 'S' WHEN 'bottom' THEN 'B'
              WHEN 'epiphytic' THEN 'E' ELSE DepthType END AS dep,
         CAST(split_part(Time, ':', 1) AS INTEGER) * 3600 + CAST(split_part(Time, ':', 2) AS INTEGER) * 60 AS tsec
  FROM ev_event),
r AS (SELECT *, dense_rank() OVER (PARTITION BY sv, Station, Date ORDER BY coalesce(tsec, 86399)) AS T,
             dense_rank() OVER (PARTITION BY sv, Station, Date, tsec, dep
                                ORDER BY coalesce(SampleDepth, 'Infinity'::DOUBLE)) AS D FROM b)
SELECT coalesce(sv, 'NA') || '-' || coalesce(Station, 'NA') || '-' || coalesce(strftime(Date, '%Y%m%d'), 'NA')
       || '-' || coalesce(dep, 'NA') || '-T' || CAST(T AS VARCHAR) || 'D' || CAST(D AS VARCHAR) AS Event_ID,
       ev_id, Survey, Station, Date, Time, SampleDepth, DepthType
FROM r
""", "ev_event"))
def w1_add_event_id(spark, sf):
    return G.add_event_id(fixture(spark, sf, "ev_event"), "Station")


@query("g1_station_count_grid", """
WITH d AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS st, CAST(date_trunc('month', l_shipdate) AS DATE) AS m
           FROM lineitem),
c AS (SELECT year(m) AS Year, month(m) AS MonthNum, count(*) AS NumStations FROM d GROUP BY ALL),
y AS (SELECT unnest(range(min(Year), max(Year) + 1)) AS Year FROM c),
g AS (SELECT y.Year, CAST(mn.m AS INTEGER) AS MonthNum FROM y, (SELECT unnest(range(1, 13)) AS m) mn)
SELECT CAST(g.Year AS INTEGER) AS Year, g.MonthNum, strftime(make_date(2000, g.MonthNum, 1), '%b') AS Month,
       c.NumStations
FROM g LEFT JOIN c ON g.Year = c.Year AND g.MonthNum = c.MonthNum
""")
def g1_station_count_grid(spark, sf):
    li = load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("Station"), F.col("l_shipdate").alias("Date"))
    return G.station_count_grid(li)


@query("g2_sampling_freq_grid", """
WITH d AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS Station, CAST(date_trunc('month', l_shipdate) AS DATE) AS m
           FROM lineitem),
f AS (SELECT Station, year(m) AS Year, count(*) AS TimesPerYear FROM d GROUP BY ALL),
y AS (SELECT unnest(range(min(Year), max(Year) + 1)) AS Year FROM f),
s AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS Station FROM lineitem)
SELECT s.Station, CAST(y.Year AS INTEGER) AS Year, f.TimesPerYear FROM s CROSS JOIN y
LEFT JOIN f ON f.Station = s.Station AND f.Year = y.Year
""")
def g2_sampling_freq_grid(spark, sf):
    li = load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("Station"), F.col("l_shipdate").alias("Date"))
    return G.sampling_freq_grid(li)


FIXTURES["ord_sheet"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS Contact,
       CASE WHEN o_totalprice > 300000 THEN CAST(o_orderdate AS DATE) END AS StartDate
FROM {orders}
"""


@query("s6_fill_down", with_fixtures("""
SELECT o_orderkey,
       last_value(Contact IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Contact,
       last_value(StartDate IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS StartDate
FROM ord_sheet""", "ord_sheet"))
def s6_fill_down(spark, sf):
    return G.fill_down(fixture(spark, sf, "ord_sheet"), ["Contact", "StartDate"], ["o_orderkey"])


@query("w3_running_count", with_fixtures("""
SELECT o_orderkey, Contact, StartDate,
       CAST(sum(CASE WHEN StartDate IS NOT NULL THEN 1 ELSE 0 END) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS x_index
FROM ord_sheet""", "ord_sheet"))
def w3_running_count(spark, sf):
    return G.running_count(fixture(spark, sf, "ord_sheet"), "StartDate", ["o_orderkey"])


@query("t8_to_fixed_offset", with_fixtures("""
WITH s AS (SELECT o_orderkey, Date, Time,
                  timezone('Etc/GMT+8', timezone('America/Los_Angeles',
                           CAST(Date AS TIMESTAMP) + to_minutes(CAST(coalesce(split_part(Time, ':', 1), '0') AS INTEGER) * 60
                                                   + CAST(coalesce(split_part(Time, ':', 2), '0') AS INTEGER)))) AS t
           FROM ord_time)
SELECT o_orderkey, CAST(t AS DATE) AS Date, CASE WHEN Time IS NULL THEN NULL ELSE strftime(t, '%H:%M:%S') END AS Time
FROM s""", "ord_time"))
def t8_to_fixed_offset(spark, sf):
    df = fixture(spark, sf, "ord_time")
    d, t = T.local_to_fixed_offset("Date", "Time")
    return df.select("o_orderkey", d.alias("Date"), t.alias("Time"))
