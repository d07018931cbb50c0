"""W1-W4 (window-style operators) and G1-G2 (completeness grids).

No operator here sorts the whole table inside one task.  Ranks are computed
on the distinct keys they depend on (bounded per group) and joined back;
ordered scans (fill-down, running index) run per range partition and carry
a per-partition summary (one row per partition) across partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harmonia.frame import null_safe_join
from harmonia.functions.exprs import r_paste_value
from harmonia.operators.measures import parse_depth

# Depth-type abbreviations used inside Event_ID.
DEPTH_CODES = {"near surface": "NS", "surface": "S", "bottom": "B", "epiphytic": "E"}


def _recode(c, mapping: dict):
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(c)


def _time_seconds(t):
    """``H:MM`` or ``H:MM:SS`` -> seconds since midnight (NULL if neither)."""
    p = F.split(t, ":")
    ok = t.rlike(r"^\d{1,2}:\d{2}(:\d{2})?$")
    secs = (p.getItem(0).try_cast("int") * 3600 + p.getItem(1).try_cast("int") * 60
            + F.coalesce(F.try_element_at(p, F.lit(3)).try_cast("int"), F.lit(0)))
    return F.when(ok, secs)


def add_event_id(df: DataFrame, loc_col: str, survey: str = "Survey", date_col: str = "Date",
                 time_col: str = "Time", depth_col: str = "SampleDepth",
                 depth_type: str = "DepthType") -> DataFrame:
    """``Event_ID = <survey tail>-<loc>-<yyyyMMdd>-<depth type>-T<i>D<j>``.

    T = dense rank of the time within (survey tail, location, date), a NULL
    time ranking as 23:59:59; D = dense rank of the depth within (survey
    tail, location, date, time, depth type), NULL depth last.  SampleDepth
    is replaced by its numeric value in metres (D9)."""
    d = df.withColumns({
        "__sv": F.trim(F.regexp_replace(F.col(survey), r"^.*-", "")),
        "__dep": _recode(F.col(depth_type), DEPTH_CODES),
        depth_col: parse_depth(depth_col),
        "__t": _time_seconds(F.col(time_col)),
    })
    g1 = ["__sv", loc_col, date_col]
    # T#: dense rank over the distinct times of each (survey, location, date)
    times = d.select(*g1, F.coalesce(F.col("__t"), F.lit(86399)).alias("__tk")).distinct()
    times = times.withColumn("__trank", F.dense_rank().over(Window.partitionBy(*g1).orderBy("__tk")))
    # D#: dense rank over the distinct depths of each (…, time, depth type)
    g2 = g1 + ["__t", "__dep"]
    depths = d.select(*g2, F.coalesce(F.col(depth_col), F.lit(float("inf"))).alias("__dk")).distinct()
    depths = depths.withColumn("__drank", F.dense_rank().over(Window.partitionBy(*g2).orderBy("__dk")))

    d = d.withColumn("__tk", F.coalesce(F.col("__t"), F.lit(86399)))
    d = d.withColumn("__dk", F.coalesce(F.col(depth_col), F.lit(float("inf"))))

    def on(a, b, keys):
        return " AND ".join(f"{a}.`{k}` <=> {b}.`{k}`" for k in keys)

    # SQL aliases keep the two self-joins on one lineage unambiguous
    d = d.sparkSession.sql(
        f"SELECT d.*, t.__trank, p.__drank FROM {{d}} d "
        f"LEFT JOIN {{t}} t ON {on('d', 't', g1 + ['__tk'])} "
        f"LEFT JOIN {{p}} p ON {on('d', 'p', g2 + ['__dk'])}", d=d, t=times, p=depths)
    eid = F.concat_ws("-", r_paste_value("__sv"), r_paste_value(loc_col),
                      r_paste_value(F.date_format(F.col(date_col), "yyyyMMdd")), r_paste_value("__dep"),
                      F.concat(F.lit("T"), F.col("__trank").cast("string"), F.lit("D"), F.col("__drank").cast("string")))
    d = d.withColumn("Event_ID", eid)
    keep = [c for c in df.columns if c != "Event_ID"]
    return d.select("Event_ID", *keep)


# --- ordered scans -------------------------------------------------------------------

def _range_parts(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """Range-partition by the order and freeze the partition number with a
    reliable checkpoint (shared checkpoint folder), so both passes below see
    the same assignment."""
    from harmonia.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    d = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order_cols])
    return d.withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)


def fill_down(df: DataFrame, cols: list[str], order_cols: list[str]) -> DataFrame:
    """Carry the last non-NULL value down (in ``order_cols`` order)."""
    d = _range_parts(df, order_cols)
    order = F.struct(*[F.col(c) for c in order_cols])
    w = Window.partitionBy("__pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumns({f"__l_{c}": F.last(c, ignorenulls=True).over(w) for c in cols})
    tails = d.groupBy("__pid").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"__e_{c}")
                                    for c in cols])
    prev = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select("__pid", *[F.last(f"__e_{c}", ignorenulls=True).over(prev).alias(f"__c_{c}")
                                   for c in cols])
    out = local.join(F.broadcast(carry), "__pid", "left")
    out = out.withColumns({c: F.coalesce(F.col(f"__l_{c}"), F.col(f"__c_{c}")) for c in cols})
    return out.select(*df.columns)


def running_count(df: DataFrame, col: str, order_cols: list[str], name: str = "x_index") -> DataFrame:
    """``cumsum(!is.na(col))`` in row order, computed per range partition
    plus the counts of all earlier partitions."""
    d = _range_parts(df, order_cols)
    nn = F.col(col).isNotNull().cast("long")
    w = Window.partitionBy("__pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumn("__local", F.sum(nn).over(w))
    tot = d.groupBy("__pid").agg(F.sum(nn).alias("__tot"))
    prev = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("__pid", F.coalesce(F.sum("__tot").over(prev), F.lit(0)).alias("__off"))
    out = local.join(F.broadcast(off), "__pid").withColumn(name, F.col("__off") + F.col("__local"))
    return out.select(*df.columns, name)


def number_rows(df: DataFrame, order_cols: list[str], name: str = "row_number") -> DataFrame:
    """Adds each row's number from 1 in the order of ``order_cols`` (NULLs
    first): its number within its range partition plus the rows of all earlier
    partitions.  Only one count per partition is gathered."""
    d = _range_parts(df, order_cols)
    w = Window.partitionBy("__pid").orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    counts = d.groupBy("__pid").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    out = d.withColumn("__local", F.row_number().over(w)).join(offsets, "__pid")
    return out.withColumn(name, F.col("__before") + F.col("__local")).select(*df.columns, name)


# --- G1-G2 completeness grids ----------------------------------------------------------

def station_count_grid(df: DataFrame, station: str = "Station", date_col: str = "Date") -> DataFrame:
    """G1: stations sampled per month on a complete year x 12-month grid
    (months with no sampling are NULL)."""
    d = df.select(F.col(station).cast("string").alias("Station"),
                  F.trunc(F.col(date_col), "MM").alias("MonthYear")).distinct()
    counts = d.groupBy("MonthYear").agg(F.count(F.lit(1)).alias("NumStations")) \
        .select(F.year("MonthYear").alias("Year"), F.month("MonthYear").alias("MonthNum"), "NumStations")
    span = counts.agg(F.min("Year").alias("y0"), F.max("Year").alias("y1"))
    grid = span.select(F.explode(F.sequence("y0", "y1")).alias("Year")) \
        .withColumn("MonthNum", F.explode(F.sequence(F.lit(1), F.lit(12))))
    out = grid.join(counts, ["Year", "MonthNum"], "left")
    label = F.date_format(F.make_date(F.lit(2000), F.col("MonthNum"), F.lit(1)), "MMM")
    return out.select("Year", "MonthNum", label.alias("Month"), "NumStations")


def sampling_freq_grid(df: DataFrame, station: str = "Station", date_col: str = "Date") -> DataFrame:
    """Months sampled per station per year on a complete year x station
    grid (missing combinations NULL).  The year span is one aggregate; each
    station row is expanded over it (no cross join)."""
    d = df.select(F.col(station).cast("string").alias("Station"),
                  F.trunc(F.col(date_col), "MM").alias("MonthYear")).distinct()
    freq = d.groupBy("Station", F.year("MonthYear").alias("Year")).agg(F.count(F.lit(1)).alias("TimesPerYear"))
    span = freq.agg(F.min("Year").alias("y0"), F.max("Year").alias("y1")).first()
    stations = df.select(F.col(station).cast("string").alias("Station")).distinct()
    if span["y0"] is None:
        return freq.limit(0)
    grid = stations.withColumn("Year", F.explode(F.sequence(F.lit(span["y0"]), F.lit(span["y1"]))))
    return null_safe_join(grid, freq, ["Station", "Year"], "left")
