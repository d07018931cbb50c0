"""Survey-shaped inputs derived from the given tables.

Each fixture is ONE SQL text with ``{table}`` placeholders.  Spark runs it
with DataFrame substitution (``spark.sql(sql, lineitem=df)``, no global
views); the DuckDB oracle runs the same text with plain table names.  The
SQL only uses syntax both dialects share (CASE, ||, %, CAST AS STRING/DATE).
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Ordering columns that make a stable "first row" for lineitem-derived rows:
# every derived column is a function of these, so rows tied on all of them
# are identical.  ``line_pos`` (row_number within the order by these
# columns) is the compact form: the row's position in its sampling event,
# as a file position would be.
LI_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

FIXTURES: dict[str, str] = {}

# A lineitem x part "count table": event = order, taxon = brand.
FIXTURES["li_taxa"] = """
SELECT l.l_orderkey AS Event,
       p.p_brand AS Taxon,
       CASE WHEN p.p_size <= 40 THEN
            CASE WHEN p.p_partkey % 4 = 0 THEN p.p_type ELSE 'Bacillariophyceae' END END AS Class,
       CASE WHEN p.p_size <= 45 THEN
            CASE WHEN p.p_size % 5 = 0 THEN 'Ochrophyta' ELSE 'Bacillariophyta' END END AS Phylum,
       CASE WHEN p.p_partkey % 7 = 0 THEN 'Plantae' ELSE 'Chromista' END AS Kingdom,
       l.l_quantity AS Cells_per_mL,
       CASE WHEN l.l_discount > 0.02 THEN l.l_extendedprice END AS Units_per_mL,
       CASE WHEN l.l_tax > 0 THEN l.l_tax * 100 END AS Biovolume_per_mL,
       CASE WHEN l.l_linenumber % 2 = 0 THEN p.p_retailprice END AS GALD,
       CASE l.l_returnflag WHEN 'A' THEN 'NoNote' WHEN 'R' THEN 'Cyst  Filament'
            ELSE 'Filament Coccoid' END AS Notes,
       CASE WHEN l.l_linestatus = 'O' THEN 'NoCode'
            WHEN l.l_returnflag = 'N' THEN 'Degraded Obscured'
            ELSE 'BadData Degraded' END AS QualityCheck,
       CASE l.l_returnflag WHEN 'A' THEN 'Low' WHEN 'R' THEN 'High'
            ELSE CASE WHEN l.l_linestatus = 'F' THEN 'Moderate' END END AS Debris,
       CASE WHEN l.l_quantity < 10 THEN 'c' WHEN l.l_quantity < 30 THEN 'i'
            WHEN l.l_quantity < 40 THEN NULL ELSE 'f' END AS PhytoForm,
       CASE WHEN l.l_suppkey % 3 = 0 THEN NULL ELSE p.p_name END AS OrigTaxon,
       'S' || CAST(l.l_suppkey AS STRING) AS Station,
       CAST(l.l_shipdate AS DATE) AS Date,
       l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
       l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate,
       row_number() OVER (PARTITION BY l.l_orderkey
                          ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
                                   l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate) AS line_pos
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def tables_in(sql: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(sql)))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from harmonia.sources.readers import read_table
    return read_table(spark, os.path.join(sf_dir, f"{name}.parquet"))


def run_sql(spark: SparkSession, sf_dir: str, sql: str, **extra: DataFrame) -> DataFrame:
    """Run a ``{table}`` SQL text on Spark with DataFrame substitution."""
    dfs = {t: (extra[t] if t in extra else load(spark, sf_dir, t)) for t in tables_in(sql)}
    return spark.sql(sql, **dfs)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return run_sql(spark, sf_dir, FIXTURES[name])


def plain(sql: str) -> str:
    """The same SQL for DuckDB, where the tables are registered views."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), sql)


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture CTEs it reads."""
    ctes = ",\n".join(f"{n} AS ({plain(FIXTURES[n])})" for n in names)
    body = sql.lstrip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:]}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:]}"
    return f"WITH {ctes}\n{body}"
