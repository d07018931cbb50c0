"""Registry of named queries over the given tables.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
A query without oracle SQL is one that plain SQL cannot express; its tests
compare against a brute-force computation on a small fixture instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, oracle)
        return fn
    return deco


def rounded(df: DataFrame, cols, digits: int = 4) -> DataFrame:
    """Round summed doubles so engines with different summation order agree."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def sq(x: str) -> str:
    """SQL text for str_squish (both dialects)."""
    return (f"regexp_replace(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')")


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # importing the modules registers their queries
    import importlib
    for m in MODULES:
        importlib.import_module(f"harmonia.plans.{m}")
    return QUERIES


MODULES = ["q_combine", "q_project", "q_checks", "q_joins", "q_taxa", "q_community", "q_programs", "q_extra", "q_sources", "q_pipelines"]
