"""Result/log convention and stable row identity.

The reference mutates a data frame and hangs audit tables off it.  Here each
operator returns ``Result(df, logs)``: ``df`` is the transformed DataFrame
and ``logs`` maps a log name to a (lazy) DataFrame.  Row order matters to
several operators ("first match wins", "keep first duplicate"), so a stable
``_row_id`` is attached at ingest and carried; it is either a struct of
caller-given ordering columns (a natural key) or a file-position id that the
reader attached.  No operator guesses an order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_ID = "_row_id"


@dataclass
class Result:
    df: DataFrame
    logs: dict[str, DataFrame] = field(default_factory=dict)

    def then(self, fn, *args, **kwargs) -> "Result":
        """Chain an operator; its logs are merged (later names overwrite)."""
        out = fn(self.df, *args, **kwargs)
        if isinstance(out, DataFrame):
            out = Result(out)
        merged = dict(self.logs)
        merged.update(out.logs)
        return Result(out.df, merged)

    def log(self, name: str) -> DataFrame | None:
        return self.logs.get(name)


def with_row_id(df: DataFrame, order_cols: list[str] | None = None,
                name: str = ROW_ID) -> DataFrame:
    """Attach a stable, comparable row identity.

    The id is ``struct(order_cols)``: comparable, computed per row with no
    global sort (a global ``row_number`` would funnel every row through one
    task).  A frame that has the id keeps it (``read_table(..., row_id=ROW_ID)``
    attaches the scan position, before any repartition).  Without either
    there is no first row to speak of, and this raises."""
    if name in df.columns:
        return df
    if not order_cols:
        raise ValueError(f"give order_cols or a {name} column: which row is the first depends on the order of rows")
    return df.withColumn(name, F.struct(*[F.col(c) for c in order_cols]))


def require_columns(df: DataFrame, cols, what: str = "column") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing {what}(s): {', '.join(missing)}")


def untouched(df: DataFrame, source: DataFrame, cols) -> bool:
    """Whether ``cols`` of ``df`` are the very columns of ``source`` it was made of:
    handed on, never computed anew (also where the new values are the same)."""
    def ids(d: DataFrame) -> dict:
        out = d._jdf.queryExecution().analyzed().output()
        return {out.apply(i).name(): out.apply(i).exprId().id() for i in range(out.size())}

    new, old = ids(df), ids(source)
    return all(c in old and new.get(c) == old[c] for c in cols)


#: Rows that are no burden to a task, however few the others have.
TASK_ROWS = 200_000


def deals_evenly(df: DataFrame, keys) -> bool:
    """Whether ``df.repartition(*keys)`` gives no task more than four times its share:
    counts the rows of every task before any moves."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    task = F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(n))
    sizes = df.groupBy(task.alias("task")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    return (sizes["most"] or 0) <= max(TASK_ROWS, 4 * (sizes["all"] or 0) / n)


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the keys of ``left`` are kept."""
    keys = list(keys)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    out = left.join(r, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys], how)
    return out.drop(*[f"__r_{k}" for k in keys])
