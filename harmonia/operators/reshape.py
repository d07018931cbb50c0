"""Reshape, sort, distinct, union and set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harmonia.frame import ROW_ID, with_row_id
from harmonia.functions.exprs import signif


def wide_to_long_taxa(df: DataFrame, id_cols: list[str], value_cols: list[str] | None = None,
                      name_col: str = "Genus", value_col: str = "Cells_per_mL",
                      unid_suffix: str = "_unid", digits: int = 4) -> DataFrame:
    """One column per taxon -> rows; zero (and NULL) counts dropped;
    ``X_unid`` becomes ``cf. X``; Taxon = ``<Genus> sp.``; values to 4
    significant digits."""
    value_cols = value_cols or [c for c in df.columns if c not in id_cols]
    long = df.unpivot(id_cols, value_cols, name_col, value_col)
    g = F.col(name_col)
    return (long.where(F.col(value_col) != 0)
                .withColumn(name_col, F.when(g.endswith(unid_suffix),
                                             F.concat(F.lit("cf. "), F.regexp_replace(g, f"{unid_suffix}$", "")))
                            .otherwise(g))
                .withColumn("Taxon", F.concat(F.col(name_col), F.lit(" sp.")))
                .withColumn(value_col, signif(F.col(value_col).cast("double"), digits)))


def long_to_wide(df: DataFrame, id_cols: list[str], names_from: str, values_from: str,
                 values: list | None = None, fill=0) -> DataFrame:
    """R2: pivot, missing cells filled.  Pass ``values`` to skip the extra
    distinct job that discovers the pivot columns."""
    g = df.groupBy(*id_cols).pivot(names_from, values).agg(F.first(values_from))
    value_cols = [c for c in g.columns if c not in id_cols]
    return g.fillna(fill, subset=value_cols) if fill is not None else g


def melt(df: DataFrame, id_cols: list[str], value_cols: list[str], var: str = "variable",
         value: str = "value") -> DataFrame:
    """Data.table ``melt`` (values must share a type)."""
    return df.unpivot(id_cols, value_cols, var, value)


def separate(df: DataFrame, col: str, into: list[str], sep: str = "/", remove: bool = False) -> DataFrame:
    """Split one column into ``into`` by a literal separator; missing
    pieces are NULL on the right."""
    parts = F.split(F.col(col), _re_escape(sep))
    out = df.withColumns({name: F.try_element_at(parts, F.lit(i + 1)) for i, name in enumerate(into)})
    return out.drop(col) if remove else out


def separate_rows(df: DataFrame, col: str, sep: str = " ") -> DataFrame:
    """One row per piece of a delimited column (NULL stays one row)."""
    return df.withColumn(col, F.explode_outer(F.split(F.col(col), _re_escape(sep))))


def transpose(df: DataFrame, id_col: str, value_cols: list[str] | None = None,
              name: str = "variable", ids: list | None = None) -> DataFrame:
    """Rows become columns: long (id, variable, value) then pivot on id."""
    value_cols = value_cols or [c for c in df.columns if c != id_col]
    long = df.unpivot([id_col], value_cols, name, "__v")
    return long.groupBy(name).pivot(id_col, ids).agg(F.first("__v"))


def sort_r(df: DataFrame, cols: list[str], descending: list[str] | None = None) -> DataFrame:
    """``arrange``: NULLs last in both directions."""
    desc = set(descending or [])
    return df.orderBy(*[F.col(c).desc_nulls_last() if c in desc else F.col(c).asc_nulls_last()
                        for c in cols])


def top_k(df: DataFrame, cols: list[str], k: int, descending: list[str] | None = None) -> DataFrame:
    """Sort then ``head(k)`` (Spark plans TakeOrderedAndProject: a
    per-partition top-k, no full sort)."""
    return sort_r(df, cols, descending).limit(k)


def distinct_keep_first(df: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """``distinct(keys, .keep_all=TRUE)``: the first row per key.

    A group-wise ``min_by`` (partial aggregation before the shuffle) instead
    of a window, so a hot key is reduced on every executor first."""
    d = with_row_id(df, order_cols)
    others = [c for c in df.columns if c not in keys and c != ROW_ID]
    if not others:
        return df.select(*keys).distinct()
    g = d.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(ROW_ID)).alias("__f"))
    return g.select(*[F.col(k) if k in keys else F.col("__f")[k].alias(k)
                      for k in df.columns if k != ROW_ID])


def distinct_rows_keep_id(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """C5 remove on a frame that carries a row id: identical rows collapse
    to one that keeps the EARLIEST id (first occurrence), so later "first
    row" rules still follow the input order."""
    cols = [c for c in df.columns if c != name]
    return df.groupBy(*cols).agg(F.min(name).alias(name)).select(*df.columns)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """``bind_rows``: union by column name, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` not in ``b`` (R ``setdiff``)."""
    return a.subtract(b)


def set_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in both (R ``intersect``)."""
    return a.intersect(b)


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)
