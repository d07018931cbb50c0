"""Round trips of the sources and sinks (S1-S4, S8-S13): each query writes rows of the
given tables in the session's shared folder, reads them back and removes them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harmonia.plans import q_community  # noqa: F401  (defines nation_brand)
from harmonia.plans.catalog import query
from harmonia.plans.fixtures import fixture, load, with_fixtures
from harmonia.session import checkpoint_dir
from harmonia.sources import readers as RD
from harmonia.sources import sinks as SK


def _round_trip(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """What ``work`` reads back from a folder of its own, which is gone afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}")
    try:
        return work(path.toString()).checkpoint()
    finally:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _dated_orders(spark, sf, pattern):
    return load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus",
                                            F.date_format("o_orderdate", pattern).alias("SampleDate"))


@query("s1_csv_scan", "SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS SampleDate FROM orders")
def s1_csv_scan(spark, sf):
    def work(path):
        SK.write_csv(_dated_orders(spark, sf, "dd.MM.yyyy"), path)
        return RD.read_csv(spark, path, "o_orderkey long, o_totalprice double, o_orderstatus string, SampleDate string",
                           {"SampleDate": "dd.MM.yyyy"})
    return _round_trip(spark, work)


@query("s2_all_text_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment, NULL::VARCHAR AS nation, 0 AS _file_index
FROM customer UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, CAST(s_nationkey AS VARCHAR), 1 FROM supplier
""")
def s2_all_text_scan(spark, sf):
    def work(path):
        c = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                               F.col("c_mktsegment").alias("segment"))
        s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"),
                                               F.col("s_suppkey").alias("id"))
        SK.write_csv(c, f"{path}/a")
        SK.write_csv(s, f"{path}/b")
        return RD.read_all_text(spark, [f"{path}/a", f"{path}/b"])
    return _round_trip(spark, work)


@query("s3_typed_by_name", """
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_totalprice, o_orderstatus, CAST(o_orderdate AS DATE) AS SampleDate FROM orders
""")
def s3_typed_by_name(spark, sf):
    def work(path):
        SK.write_csv(_dated_orders(spark, sf, "M/d/yyyy"), path)
        return RD.read_csv_typed_by_name(spark, path)
    return _round_trip(spark, work)


@query("s4_read_meta_ranges", """
SELECT o_orderpriority AS Survey, CAST(o_orderdate AS DATE) AS "Starting Date",
       CASE WHEN o_orderstatus = 'O' THEN DATE '2005-01-01' ELSE CAST(o_orderdate AS DATE) + 30 END AS "Ending Date", o_orderkey
FROM orders WHERE o_orderpriority = '2-HIGH'
""")
def s4_read_meta_ranges(spark, sf):
    day = F.to_date("o_orderdate")
    meta = load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("Survey"), day.alias("Starting Date"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(day, 30)).alias("Ending Date"), "o_orderkey")
    return RD.read_meta(meta, "2-HIGH", today="2005-01-01")


# Uploads: one file per kind of event; the kinds differ in columns and in what is wrong with them.
UPLOAD_SCHEMA = {"columns": {
    "event_type": {"type": "character", "required": True, "allowed_values": ["view", "click", "purchase", "error"]},
    "value": {"type": "integer", "required": True, "min": 0, "max": 1000},
    "amount": {"type": "integer"},
    "user_id": {"type": "integer", "required": True},
}}
_UPLOADS = """
SELECT event_type, CAST(value AS DOUBLE) AS value, CAST(user_id AS DOUBLE) AS user_id, CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS amount
FROM events
"""


def _uploads(spark, sf, path):
    e = load(spark, sf, "events").withColumn("amount", F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.floor("value").cast("string")))
    first = e.where("event_type <> 'purchase'").select("event_id", "event_type", "value", "user_id", "amount")
    second = e.where("event_type = 'purchase'").select("amount", "value", "event_type", "event_id")  # no user_id
    for i, part in enumerate((first, second)):
        SK.write_by_key(part, f"{path}/{i}", "event_type")
    return RD.ingest_manifest(spark, RD.list_files(spark, path), UPLOAD_SCHEMA, root=path)


@query("s8_ingest_manifest", f"""
WITH u AS ({_UPLOADS}), f AS (SELECT event_type, count(*) AS n_rows FROM u GROUP BY event_type),
e AS (SELECT n_rows, list_filter([CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'error') THEN 'event_type: not allowed' END,
                                  CASE WHEN event_type = 'error' THEN 'amount: not numeric' END,
                                  CASE WHEN event_type = 'purchase' THEN 'user_id: missing required column' END],
                                 lambda x: x IS NOT NULL) AS errors FROM f)
SELECT CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'invalid' END AS status, errors, n_rows FROM e
""")
def s8_ingest_manifest(spark, sf):
    return _round_trip(spark, lambda path: _uploads(spark, sf, path)[0].drop("name"))


@query("s8_ingest_rows", f"""
SELECT event_type, value, CAST(amount AS DOUBLE) AS amount, user_id, event_id FROM ({_UPLOADS})
WHERE event_type IN ('view', 'click')
""")
def s8_ingest_rows(spark, sf):
    def work(path):
        rows = _uploads(spark, sf, path)[1]
        return rows.select("event_type", "value", "amount", "user_id", F.col("_other")["event_id"].alias("event_id"))
    return _round_trip(spark, work)


@query("s9_csv_with_na", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN value < 100 THEN 'NA' ELSE event_type END AS kind FROM events
""")
def s9_csv_with_na(spark, sf):
    """A NULL is written as the token asked for, read here as text."""
    def work(path):
        e = load(spark, sf, "events").select("event_id", F.when(~(F.col("value") < 100) | F.col("value").isNull(), F.col("event_type")).alias("kind"))
        SK.write_csv(e, path, na="NA")
        return RD.read_all_text(spark, [path]).drop("_file_index")
    return _round_trip(spark, work)


@query("s10_conditional_log", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, true AS written, false AS empty_written "
                              "FROM customer WHERE c_acctbal < 0")
def s10_conditional_log(spark, sf):
    def work(path):
        c = load(spark, sf, "customer")
        written = SK.write_log(c.where("c_acctbal < 0").select("c_custkey"), f"{path}/log")
        empty = SK.write_log(c.where("c_custkey < 0").select("c_custkey"), f"{path}/none")
        got = RD.read_all_text(spark, [f"{path}/log"]).drop("_file_index")
        return got.withColumns({"written": F.lit(written), "empty_written": F.lit(empty)})
    return _round_trip(spark, work)


@query("s11_persisted_programs", """
SELECT c_custkey AS id, c_nationkey AS nation, c_acctbal AS balance, NULL::VARCHAR AS name FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, NULL, s_name FROM supplier
""")
def s11_persisted_programs(spark, sf):
    def work(path):
        SK.write_program(load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"),
                                                            F.col("c_acctbal").alias("balance")), f"{path}/a")
        SK.write_program(load(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                                            F.col("s_nationkey").alias("nation")), f"{path}/b")
        return RD.read_programs(spark, [f"{path}/a", f"{path}/b"])
    return _round_trip(spark, work)


@query("s12_split_by_key", "SELECT o_orderpriority AS Survey, o_orderkey, o_orderpriority AS folder FROM orders")
def s12_split_by_key(spark, sf):
    """Every row is in its key's folder, with the key kept inside."""
    def work(path):
        SK.write_by_key(load(spark, sf, "orders").select(F.col("o_orderpriority").alias("Survey"), "o_orderkey"), path, fmt="parquet")
        return spark.read.parquet(path).withColumnRenamed("__part_Survey", "folder")
    return _round_trip(spark, work)


@query("s13_matrix_lines", with_fixtures("""
WITH c AS (SELECT nation, region, Taxon, count(*) AS v FROM nation_brand GROUP BY ALL),
n AS (SELECT nation, region, row_number() OVER (ORDER BY nation) AS i FROM (SELECT DISTINCT nation, region FROM c)),
t AS (SELECT DISTINCT Taxon FROM c)
SELECT 2 AS block, t.Taxon AS Variable,
       t.Taxon || string_agg(',' || coalesce(CAST(c.v AS VARCHAR), ''), '' ORDER BY n.i) AS line
FROM t CROSS JOIN n LEFT JOIN c ON c.Taxon = t.Taxon AND c.nation = n.nation GROUP BY t.Taxon
UNION ALL SELECT 4, 'region', 'region' || string_agg(',' || CAST(region AS VARCHAR), '' ORDER BY i) FROM n
UNION ALL SELECT 0, 'Environmental variables', 'Environmental variables' || repeat(',', CAST(count(*) AS BIGINT)) FROM n
UNION ALL SELECT 1, NULL, string_agg(',R' || CAST(i AS VARCHAR), '' ORDER BY i) FROM n
UNION ALL SELECT 3, '', repeat(',', CAST(count(*) AS BIGINT)) FROM n
""", "nation_brand"))
def s13_matrix_lines(spark, sf):
    nb = fixture(spark, sf, "nation_brand")
    com = nb.groupBy("nation", "Taxon").agg(F.count(F.lit(1)).alias("value"))
    return SK.matrix_lines(nb.select("nation", "region").distinct(), com, ["nation"])
