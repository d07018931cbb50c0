"""Metadata by date range, lookup joins, natural joins, spatial join.

Metadata and lookup tables are small but not assumed to be: no side is
hinted, so Spark broadcasts one only below its size threshold.  NULL keys
match.  Date ranges meet the distinct dates of the data in buckets
(``covering``), so the join against the (large) data is an equi-join on the
date, never a nested loop over data x ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmonia.frame import Result, null_safe_join, require_columns

TILES_PER_SIDE = 1024


# --- J1-J4 date-range metadata ---------------------------------------------------

#: Levels of range lengths (a range of level n has at most 2^n days); dates to year 9999 need no more.
LEVELS = 23


def _days(c: Column) -> Column:
    return F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date"))


def covering(dates: DataFrame, meta: DataFrame, start: str, end: str, date_col: str = "Date") -> DataFrame:
    """Every distinct date of ``dates`` with each metadata row that covers it.

    A range is cut at the edges of buckets about as long as itself, so that it
    touches one or two of them whatever its length; a date lies in one bucket
    per level; an equi-join on level and bucket finds the pairs and the exact
    test follows.  A NULL start or end, or an end before the start, covers nothing."""
    m = meta.withColumns({"__s": _days(F.col(start)), "__e": _days(F.col(end))}).where(F.col("__s") <= F.col("__e"))
    m = m.withColumn("__level", F.when(F.col("__s") == F.col("__e"), 0)
                     .otherwise(F.length(F.bin((F.col("__e") - F.col("__s")).cast("bigint")))))
    m = m.withColumn("__bucket", F.explode(F.array_distinct(F.array(F.expr("shiftright(__s, __level)"),
                                                                    F.expr("shiftright(__e, __level)")))))
    d = (dates.select(F.col(date_col).cast("date").alias("__date")).where(F.col("__date").isNotNull()).distinct()
         .withColumns({"__day": _days(F.col("__date")), "__level": F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1)))})
         .withColumn("__bucket", F.expr("shiftright(__day, __level)")))
    met = d.join(m, ["__level", "__bucket"]).where((F.col("__day") >= F.col("__s")) & (F.col("__day") <= F.col("__e")))
    return met.drop("__level", "__bucket", "__day", "__s", "__e")


def from_meta(df: DataFrame, meta: DataFrame, columns: list[str], start: str = "Starting Date",
              end: str = "Ending Date", today: str = "2100-01-01", date_col: str = "Date") -> DataFrame:
    """Left-join the metadata rows that cover each row's date; a date
    covered by several ranges fans out (as in the source).  An open end runs
    to ``today`` (a parameter, so results are reproducible)."""
    closed = meta.withColumn(end, F.coalesce(F.col(end).cast("date"), F.lit(today).cast("date")))
    hits = covering(df, closed, start, end, date_col).select("__date", *columns)
    return df.join(hits, F.col(date_col).cast("date") == F.col("__date"), "left").drop("__date")


def _candidates(df: DataFrame, meta: DataFrame, start: str, end: str, value_cols: list[str], match_cols: list[str],
                order: str, descending: bool, date_col: str) -> DataFrame:
    """Per date of the data the metadata rows covering it, as one array sorted
    so that the winning row comes first."""
    key = F.col(order) * (-1 if descending else 1)
    cand = F.struct(key.alias("__k"), *[F.col(c).alias(f"m_{c}") for c in match_cols],
                    *[F.col(c).alias(f"v_{c}") for c in value_cols])
    return (covering(df, meta, start, end, date_col).groupBy(F.col("__date").alias("Date"))
            .agg(F.array_sort(F.collect_list(cand)).alias("__cand")))


def _pick(df: DataFrame, cands: DataFrame, date_col: str, value_cols: list[str],
          match_cols: list[str]) -> DataFrame:
    c = cands.withColumnRenamed("Date", "__d")
    j = df.join(c, df[date_col].cast("date") == F.col("__d"), "left").drop("__d")
    arr = F.col("__cand")
    if match_cols:
        # NULL in a metadata match column is a wildcard
        def ok(x):
            return reduce(lambda a, b: a & b,
                          [x[f"m_{m}"].isNull() | (x[f"m_{m}"] == F.col(m)) for m in match_cols])
        arr = F.filter(arr, lambda x: F.coalesce(ok(x), F.lit(False)))
    win = F.try_element_at(arr, F.lit(1))
    return j.withColumns({v: win[f"v_{v}"] for v in value_cols}).drop("__cand")


def add_metadata_first(df: DataFrame, meta: DataFrame, cols: list[str], start: str = "Starting Date",
                       end: str = "Ending Date", order: str = "meta_idx", date_col: str = "Date") -> DataFrame:
    """Per row the FIRST metadata row (in ``order``) with start <= date <= end;
    NULL when none covers it (a NULL start or end covers nothing)."""
    cands = _candidates(df, meta, start, end, cols, [], order, False, date_col)
    return _pick(df.drop(*[c for c in cols if c in df.columns]), cands, date_col, cols, [])


def clamp_meta_to_data(df: DataFrame, meta: DataFrame, start: str = "Starting Date",
                       end: str = "Ending Date", order: str = "meta_idx", date_col: str = "Date") -> DataFrame:
    """J3 step 1: keep ranges overlapping the data's date span; the earliest
    start moves to the first data date and the range ending last (open end
    counts as the last data date) ends at the last data date."""
    span = df.agg(F.min(date_col).cast("date").alias("dmin"), F.max(date_col).cast("date").alias("dmax")).first()
    dmin, dmax = span["dmin"], span["dmax"]
    if dmin is None:
        return meta.limit(0)
    lo, hi = F.lit(dmin), F.lit(dmax)
    m = meta.where((F.col(end).isNull() | (F.col(end) >= lo)) & (F.col(start) <= hi))
    pick = m.agg(F.min_by(order, F.struct(F.col(start), F.col(order))).alias("__first"),
                 F.max_by(order, F.struct(F.coalesce(F.col(end), hi), -F.col(order))).alias("__last")).first()
    return (m.withColumn(start, F.when(F.col(order) == pick["__first"], lo).otherwise(F.col(start)))
             .withColumn(end, F.when(F.col(order) == pick["__last"], hi).otherwise(F.col(end))))


def add_meta_col(df: DataFrame, meta: DataFrame, col: str, match_cols: list[str] | None = None,
                 start: str = "Starting Date", end: str = "Ending Date", order: str = "meta_idx",
                 date_col: str = "Date") -> DataFrame:
    """Library version.  After clamping, ranges are applied in order and
    the LAST one that covers the date (and whose non-NULL match columns equal
    the row's) wins; NULL if none."""
    match_cols = list(match_cols or [])
    require_columns(meta, [col] + match_cols, "metadata column")
    require_columns(df, match_cols, "data column")
    m = clamp_meta_to_data(df, meta, start, end, order, date_col)
    cands = _candidates(df, m, start, end, [col], match_cols, order, True, date_col)
    return _pick(df.drop(col) if col in df.columns else df, cands, date_col, [col], match_cols)


def metadata_preview(df: DataFrame, meta: DataFrame, start: str = "Starting Date",
                     end: str = "Ending Date", date_col: str = "Date") -> DataFrame:
    """Ranges clipped to the data span; ranges that fall outside dropped."""
    span = df.agg(F.min(date_col).cast("date").alias("dmin"), F.max(date_col).cast("date").alias("dmax")).first()
    lo, hi = F.lit(span["dmin"]), F.lit(span["dmax"])
    out = meta.withColumn(start, F.greatest(F.col(start), lo)).withColumn(
        end, F.least(F.coalesce(F.col(end), hi), hi))
    return out.where(F.col(start) <= F.col(end))


# --- J5-J13 lookups -------------------------------------------------------------------

def add_lookup(df: DataFrame, lookup: DataFrame, on: list[str], cols: list[str] | None = None,
               log_name: str = "missing_lookup") -> Result:
    """Left join a lookup; log the distinct keys with no match."""
    cols = cols or [c for c in lookup.columns if c not in on]
    lk = lookup.select(*on, *cols)
    out = df.drop(*[c for c in cols if c in df.columns])
    out = null_safe_join(out, lk, on, "left")
    missing = null_safe_join(df.select(*on).distinct(), lk.select(*on), on, "left_anti")
    return Result(out, {log_name: missing})


def rename_by_alias(df: DataFrame, stations: DataFrame, col: str = "Station", site: str = "site_no",
                    alias_list: str = "field_id_alias", target: str = "Station") -> Result:
    """Comma-separated alias lists become one row per alias; a data row
    whose (name, site) matches an alias takes the station's name."""
    aliases = (stations.where(F.col(alias_list).isNotNull() & (F.col(alias_list) != ""))
               .select(F.explode(F.split(alias_list, ",")).alias("__alias"),
                       F.col(site).cast("string").alias("__site"), F.col(target).alias("__station"))
               .withColumn("__alias", F.trim("__alias")))
    d = df.withColumn(site, F.col(site).cast("string")).withColumn("__orig", F.col(col))
    j = d.join(aliases,
               (F.col(col) == F.col("__alias")) & F.col(site).eqNullSafe(F.col("__site")), "left")
    new = F.when(F.col("__station").isNotNull() & (F.col("__station") != F.col(col)), F.col("__station")) \
        .otherwise(F.col(col))
    j = j.withColumn(col, new)
    log = j.where(F.col("__orig") != F.col(col)).select(F.col("__orig").alias("original"),
                                                         F.col(col).alias("updated")).distinct()
    out = j.drop("__alias", "__site", "__station", "__orig").withColumn(col, F.trim(F.col(col)))
    return Result(out, {"station_renames": log})


def replace_from_lookup(df: DataFrame, fixes: DataFrame, on: list[str], target: str,
                        source: str) -> Result:
    """Left join, ``target := coalesce(fix, target)``; log changes."""
    fx = fixes.select(*on, F.col(source).alias("__fix"))
    j = null_safe_join(df, fx, on, "left")
    log = j.where(F.col("__fix").isNotNull() & ~F.col("__fix").eqNullSafe(F.col(target))) \
        .select(*on, F.col(target).alias("old"), F.col("__fix").alias("new")).distinct()
    return Result(j.withColumn(target, F.coalesce(F.col("__fix"), F.col(target))).drop("__fix"),
                  {"replaced": log})


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> Result:
    """Join on every shared column name (NULL matches NULL);
    the report lists distinct left keys without a match."""
    on = [c for c in left.columns if c in right.columns]
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]
    j = left.join(r, cond, how)
    if how in ("full", "outer", "full_outer"):
        j = j.withColumns({c: F.coalesce(F.col(c), F.col(f"__r_{c}")) for c in on})
    out = j.drop(*[f"__r_{c}" for c in on])
    unmatched = left.select(*on).distinct().join(r.select(*[f"__r_{c}" for c in on]), cond, "left_anti")
    return Result(out, {"unmatched": unmatched})


# --- J14 point in polygon ---------------------------------------------------------------

#: Share of a tile by which edges are widened when tiles are marked, against rounding.
MARGIN = 1e-6


def _tile(v: Column, side: float) -> Column:
    return F.floor(v / F.lit(side)).cast("bigint")


def _crosses(e: Column, px: Column, py: Column) -> Column:
    """Whether the ray from (px, py) to the right meets edge ``e`` (even-odd rule)."""
    straddles = (e["y1"] > py) != (e["y2"] > py)
    return straddles & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])


def _odd(edges: Column, px: Column, py: Column) -> Column:
    return F.aggregate(edges, F.lit(False), lambda s, e: s != _crosses(e, px, py))


def _polygon_rows(polygons: DataFrame, order: str, w: float, h: float) -> DataFrame:
    """Per polygon and row of tiles: the edges that touch the row, the runs of
    tiles that edges touch (``edge_runs``) and the runs wholly inside (``full_runs``).

    Storage follows the polygon's outline, not the area it covers."""
    n = F.size("xs")
    corners = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(
        F.element_at("xs", i).alias("x1"), F.element_at("ys", i).alias("y1"),
        F.element_at("xs", i + 1).alias("x2"), F.element_at("ys", i + 1).alias("y2")))
    e = (polygons.where(n > 1).select(F.col(order).alias("__o"), F.explode(corners).alias("e"))
         .withColumns({"lo": F.least("e.y1", "e.y2") / h - MARGIN, "hi": F.greatest("e.y1", "e.y2") / h + MARGIN}))
    e = e.withColumn("__ty", F.explode(F.sequence(F.floor("lo").cast("bigint"), F.floor("hi").cast("bigint"))))

    def x_at(y: Column) -> Column:
        part = F.when(F.col("e.y1") == F.col("e.y2"), 0.0).otherwise((y - F.col("e.y1")) / F.nullif(F.col("e.y2") - F.col("e.y1"), F.lit(0.0)))
        return F.col("e.x1") + (F.col("e.x2") - F.col("e.x1")) * F.least(F.greatest(part, F.lit(0.0)), F.lit(1.0))

    below, above = (F.col("__ty") - MARGIN) * h, (F.col("__ty") + 1 + MARGIN) * h
    flat = F.col("e.y1") == F.col("e.y2")
    left = F.when(flat, F.least("e.x1", "e.x2")).otherwise(F.least(x_at(below), x_at(above)))
    right = F.when(flat, F.greatest("e.x1", "e.x2")).otherwise(F.greatest(x_at(below), x_at(above)))
    run = F.struct(F.floor(left / w - MARGIN).cast("bigint").alias("lo"), F.floor(right / w + MARGIN).cast("bigint").alias("hi"))
    rows = e.groupBy("__o", "__ty").agg(F.collect_list("e").alias("edges"), F.array_sort(F.collect_set(run)).alias("runs"))
    merged = F.aggregate("runs", F.slice("runs", 1, 1), lambda acc, r: F.when(
        r["lo"] <= F.element_at(acc, -1)["hi"] + 1,
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["lo"].alias("lo"), F.greatest(F.element_at(acc, -1)["hi"], r["hi"]).alias("hi")))))
        .otherwise(F.concat(acc, F.array(r))))
    rows = rows.withColumn("edge_runs", merged)
    after = F.slice("edge_runs", F.lit(2), F.size("edge_runs"))
    gaps = F.zip_with(F.slice("edge_runs", F.lit(1), F.size("edge_runs") - 1), after, lambda a, b: F.struct(
        (a["hi"] + 1).alias("lo"), (b["lo"] - 1).alias("hi")))
    inside = F.filter(gaps, lambda g: (g["lo"] <= g["hi"]) & _odd(
        F.col("edges"), (g["lo"] + 0.5) * w, (F.col("__ty") + 0.5) * h))
    return rows.withColumn("full_runs", inside).drop("runs")


def assign_region(df: DataFrame, polygons: DataFrame, lon: str = "Longitude", lat: str = "Latitude",
                  keep: tuple[str, ...] = ("Region", "SubRegion"), order: str = "poly_idx") -> DataFrame:
    """Each point gets the first polygon (in ``order``) containing it;
    points outside every polygon are dropped.  ``polygons`` holds closed
    vertex arrays ``xs``/``ys`` (first vertex repeated last).

    The plane is cut into tiles (as large as an average bounding box, and at
    least 1/``TILES_PER_SIDE`` of the whole extent).  A polygon is kept per
    row of tiles, as runs of tiles that its outline touches and runs wholly
    inside it; the tiles that hold points, each once, meet the runs in
    buckets of the runs' length.  Points then meet their tile in an equi-join
    that Spark can split at a hot spot: inside a full run nothing is left to
    test, elsewhere the ray is cast against the edges of that row of tiles."""
    from harmonia.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    shapes = polygons.select(F.col(order).alias("__o"), *keep, F.col("xs").cast("array<double>").alias("xs"),
                             F.col("ys").cast("array<double>").alias("ys")).where("xs is not null and ys is not null")
    box = shapes.select(F.array_min("xs").alias("x0"), F.array_max("xs").alias("x1"), F.array_min("ys").alias("y0"),
                        F.array_max("ys").alias("y1"))
    size = box.agg(F.avg(F.expr("x1 - x0")), F.expr("max(x1) - min(x0)"), F.avg(F.expr("y1 - y0")), F.expr("max(y1) - min(y0)")).first()
    w, h = (max(avg or 0.0, (extent or 0.0) / TILES_PER_SIDE) or 1.0 for avg, extent in (size[:2], size[2:]))
    rows = _polygon_rows(shapes, "__o", w, h).checkpoint()
    runs = rows.select("__o", "__ty", F.explode(F.concat(
        F.transform("edge_runs", lambda r: F.struct(r["lo"].alias("lo"), r["hi"].alias("hi"), F.lit(False).alias("full"))),
        F.transform("full_runs", lambda r: F.struct(r["lo"].alias("lo"), r["hi"].alias("hi"), F.lit(True).alias("full"))))).alias("r"))
    runs = runs.select("__o", "__ty", "r.*").withColumn(
        "__level", F.when(F.col("lo") == F.col("hi"), 0).otherwise(F.length(F.bin(F.col("hi") - F.col("lo")))))
    runs = runs.withColumn("__bucket", F.explode(F.array_distinct(F.array(F.expr("shiftright(lo, __level)"), F.expr("shiftright(hi, __level)")))))

    px, py = F.col(lon).cast("double"), F.col(lat).cast("double")
    points = df.withColumns({"__tx": _tile(px, w), "__ty": _tile(py, h)})
    levels = TILES_PER_SIDE.bit_length() + 1
    tiles = points.select("__tx", "__ty").distinct().withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    tiles = tiles.withColumn("__bucket", F.expr("shiftright(__tx, __level)"))
    met = (tiles.join(runs, ["__ty", "__level", "__bucket"]).where((F.col("__tx") >= F.col("lo")) & (F.col("__tx") <= F.col("hi")))
           .select("__tx", "__ty", "__o", "full"))
    near = F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= (F.col("__tx") - MARGIN) * w)
    # a tile is never both: full runs lie between the runs that edges touch
    local = (met.join(rows.select("__o", "__ty", "edges"), ["__o", "__ty"]).join(shapes.drop("xs", "ys"), "__o")
             .select("__tx", "__ty", F.struct("__o", *keep, "full", F.when(~F.col("full"), near).alias("edges")).alias("p"))
             .groupBy("__tx", "__ty").agg(F.array_sort(F.collect_list("p")).alias("__polys")))
    first = F.try_element_at(F.filter("__polys", lambda p: p["full"] | _odd(p["edges"], px, py)), F.lit(1))
    out = points.join(local, ["__tx", "__ty"]).withColumn("__hit", first).where(F.col("__hit").isNotNull())
    return out.withColumns({k: F.col("__hit")[k] for k in keep}).drop("__tx", "__ty", "__polys", "__hit")
