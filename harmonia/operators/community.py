"""A4-A10: group sums, community matrices, dissimilarities, SIMPER,
top-taxa summaries, shares and extreme-value filters.

The community matrix stays LONG (unit, taxon, value); the wide form is
produced only on request with explicit taxon columns.  Pairwise measures
(A6, A7) are quadratic in units by definition.  They run on aggregated units,
never on raw rows, and meet block by block (``pairs_within``), so that no
unit, taxon or group has to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harmonia.frame import null_safe_join
from harmonia.functions.exprs import sum_strict

#: Rows of a block that meets others in ``pairs_within``.
BLOCK_ROWS = 512
#: Permutations whose labels share one bit mask.
MASK_BITS = 62


def group_sums(df: DataFrame, by: list[str], measures: list[str], na_strict: bool = True,
               binary: bool = True) -> DataFrame:
    """A4: measure sums per group (NULL as soon as one value is NULL when
    ``na_strict``, as R ``sum`` without ``na.rm``) and a presence flag."""
    aggs = [(sum_strict(m) if na_strict else F.sum(m)).alias(m) for m in measures]
    out = df.groupBy(*by).agg(*aggs)
    return out.withColumn("Binary", F.lit(1)) if binary else out


def community_long(df: DataFrame, group_var: list[str], measure: str, taxa_var: str = "Taxon",
                   factor_var: list[str] | None = None, avg_var: list[str] | None = None) -> DataFrame:
    """A5: (group, factor, taxon, value) with value = sum(measure, NULLs
    skipped, 0 if none); with ``avg_var`` divided by the number of distinct
    ``avg_var`` combinations in the group (sampling effort)."""
    factor_var = list(factor_var or [])
    keys = list(group_var) + factor_var + [taxa_var]
    s = df.groupBy(*keys).agg(F.coalesce(F.sum(measure), F.lit(0.0)).cast("double").alias("value"))
    if avg_var:
        effort = (df.select(*group_var, *avg_var).distinct().groupBy(*group_var)
                    .agg(F.count(F.lit(1)).alias("__n")))
        s = null_safe_join(s, effort, group_var, "left").withColumn("value", F.col("value") / F.col("__n")).drop("__n")
    return s


def community_wide(long: DataFrame, meta_vars: list[str], taxa_var: str, taxa: list[str]) -> DataFrame:
    """A5 / R2: the matrix form, one column per taxon (explicit list), 0 fill."""
    w = long.groupBy(*meta_vars).pivot(taxa_var, taxa).agg(F.first("value"))
    return w.fillna(0.0, subset=[t for t in taxa])


def pairs_within(rows: DataFrame, keys: list[str], member: str, blocks: Column, cols: list[str]) -> DataFrame:
    """Every unordered pair of a key's rows once, as structs ``l`` and ``r`` of ``cols``.

    ``member`` tells the rows of a key apart.  A key's rows are dealt into
    ``blocks`` by hash and the blocks meet in pairs, in an equi-join on key and
    block pair: a key that every row has spreads over ``blocks^2 / 2`` join
    keys, and a row is copied once per block of its own key.
    """
    own = F.pmod(F.xxhash64(member, F.lit("block")), blocks).cast("int")
    r = rows.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
    r = r.withColumns({"__i": F.least("__own", "__other"), "__j": F.greatest("__own", "__other")})
    on = [*keys, "__i", "__j"]
    left = r.where(F.col("__own") == F.col("__i")).select(*on, F.struct(*cols).alias("l"))
    right = r.where(F.col("__own") == F.col("__j")).select(*on, F.struct(*cols).alias("r"))
    met = left.join(right, on)
    return met.where((F.col("__i") < F.col("__j")) | (F.col(f"l.{member}") < F.col(f"r.{member}"))).drop("__i", "__j")


def _text_key(c: str) -> Column:
    """A text that is never NULL and tells NULL from every value."""
    return F.coalesce(F.concat(F.lit("1"), F.col(c).cast("string")), F.lit("0"))


def _value_of(key: Column) -> Column:
    return F.when(key.startswith("1"), F.substring(key, 2, 2147483647))


def _block_count(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``__blocks``: the number of blocks for the size of each row's key."""
    size = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("__blocks"))
    return rows.join(size, keys)


def dissimilarity(long: DataFrame, unit: str, taxa_var: str = "Taxon", value: str = "value",
                  method: str = "bray") -> DataFrame:
    """Bray-Curtis (1 - 2 sum(min) / (sum a + sum b)) or quantitative
    Jaccard (2B / (1 + B)) of every pair of non-empty units.

    Only units that share a taxon meet over it: each taxon's list of units is
    cut into blocks that meet in pairs.  Pairs that share nothing are at
    distance 1.  The result is quadratic in units by definition; the
    aggregated matrix is computed once and cut.  A NULL taxon is one taxon."""
    from harmonia.session import checkpoint_dir
    checkpoint_dir(long.sparkSession)
    x = long.where(F.col(value) > 0).select(F.col(unit).alias("u"), _text_key(taxa_var).alias("t"),
                                            F.col(value).cast("double").alias("v")).checkpoint()
    met = pairs_within(_block_count(x, ["t"]), ["t"], "u", F.col("__blocks"), ["u", "v"])
    shared = (met.groupBy(F.least("l.u", "r.u").alias("ua"), F.greatest("l.u", "r.u").alias("ub"))
              .agg(F.sum(F.least("l.v", "r.v")).alias("smin")))
    tot = x.groupBy("u").agg(F.sum("v").alias("tot"))
    blocks = F.lit(max(1, -(-tot.count() // BLOCK_ROWS)))
    both = pairs_within(tot, [], "u", blocks, ["u", "tot"])
    d = both.select(F.least("l.u", "r.u").alias("ua"), F.greatest("l.u", "r.u").alias("ub"),
                    (F.col("l.tot") + F.col("r.tot")).alias("whole")).join(shared, ["ua", "ub"], "left")
    bray = F.lit(1.0) - F.lit(2.0) * F.coalesce("smin", F.lit(0.0)) / F.col("whole")
    dist = bray if method == "bray" else F.lit(2.0) * bray / (F.lit(1.0) + bray)
    return d.select(F.col("ua").alias(f"{unit}_a"), F.col("ub").alias(f"{unit}_b"), dist.alias("dissimilarity"))


def _simper_input(long: DataFrame, unit: str, group: str, taxa_var: str, value: str) -> DataFrame:
    """One row per unit and taxon: keys ``g, u, t`` (never NULL), ``m`` (the unit
    with its group), amount ``v`` and the unit's total ``tot``; computed once and cut."""
    from harmonia.session import checkpoint_dir
    checkpoint_dir(long.sparkSession)
    x = (long.select(_text_key(group).alias("g"), _text_key(unit).alias("u"), _text_key(taxa_var).alias("t"),
                     F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v"))
         .groupBy("g", "u", "t").agg(F.sum("v").alias("v")))
    tot = x.groupBy("g", "u").agg(F.sum("v").alias("tot"))
    return x.join(tot, ["g", "u"]).withColumn("m", F.concat_ws("\u0001", "g", "u")).checkpoint()


def _overlap(a: Column, b: Column) -> Column:
    """``|a| + |b| - |a - b|``: what two units that share a taxon differ less than units that do not."""
    return F.abs(a) + F.abs(b) - F.abs(a - b)


def simper(long: DataFrame, unit: str, group: str, taxa_var: str = "Taxon", value: str = "value",
           permutations: int = 0, seed: int = 42) -> DataFrame:
    """SIMPER contributions for every pair of groups.

    For each between-group pair of units (i, j) the contribution of taxon t
    is |x_it - x_jt| / (total_i + total_j); per taxon the mean (average), sd,
    ratio, the group means (ava, avb) and the cumulative share of the sorted
    averages (ties in taxon order; averages compared at 1e-12).

    As |a - b| is |a| + |b| less an overlap that only shared taxa have, the
    sums over all pairs are the units' own amounts weighted by
    ``sum_j 1 / (total_i + total_j)``, less a sum over pairs that share the
    taxon; squares likewise.  Pairs are made block by block (``pairs_within``),
    summed where they are made, and nothing is held per group.

    With ``permutations`` > 0 a column ``p`` holds the permutation p-value
    (share of seeded label permutations whose average is at least the
    observed one, (k + 1) / (n + 1)); labels are permuted among the units of
    the two groups compared, see ``permuted_sides``.

    A NULL group, unit or taxon is one of its own (NULL groups come first); a
    NULL value counts 0; two units without any amount do not differ; one pair
    of units alone has no sd; an sd below 1e-7 of the average is rounding and
    0, without a ratio."""
    x = _simper_input(long, unit, group, taxa_var, value)
    units = x.select("g", "u", "m", "tot").distinct()
    blocks = F.lit(max(1, -(-units.count() // BLOCK_ROWS)))
    whole = F.col("l.tot") + F.col("r.tot")
    per = F.when(whole != 0, 1 / whole).otherwise(0.0)
    met = pairs_within(units, [], "m", blocks, ["g", "u", "m", "tot"]).where(F.col("l.g") != F.col("r.g"))
    ends = F.array(F.struct("l.g", "l.u", F.col("r.g").alias("h")), F.struct("r.g", "r.u", F.col("l.g").alias("h")))
    weights = (met.select(per.alias("w"), F.explode(ends).alias("e"))
               .groupBy("e.g", "e.u", "e.h").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("w")).alias("w2")))
    first = F.col("g") < F.col("h")
    ordered = [F.least("g", "h").alias("ga"), F.greatest("g", "h").alias("gb")]
    alone = x.join(weights, ["g", "u"]).select(
        *ordered, "t", (F.abs("v") * F.col("w")).alias("s1"), (F.col("v") * F.col("v") * F.col("w2")).alias("s2"),
        F.when(first, F.col("v")).alias("va"), F.when(~first, F.col("v")).alias("vb"))
    shared = pairs_within(_block_count(x, ["t"]), ["t"], "m", F.col("__blocks"), ["g", "m", "v", "tot"])
    a, b = F.col("l.v"), F.col("r.v")
    none = F.lit(None).cast("double")
    shared = shared.where(F.col("l.g") != F.col("r.g")).select(
        F.least("l.g", "r.g").alias("ga"), F.greatest("l.g", "r.g").alias("gb"), "t",
        (-_overlap(a, b) * per).alias("s1"), (-2 * a * b * per * per).alias("s2"), none.alias("va"), none.alias("vb"))
    sums = alone.unionByName(shared).groupBy("ga", "gb", "t").agg(
        *[F.sum(c).alias(c) for c in ("s1", "s2")], *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("va", "vb")])
    sizes = units.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    got = (sums.join(sizes.select(F.col("g").alias("ga"), F.col("n").alias("na")), "ga")
           .join(sizes.select(F.col("g").alias("gb"), F.col("n").alias("nb")), "gb")
           .withColumn("n", F.col("na") * F.col("nb")))
    mean = F.col("s1") / F.col("n")
    spread = F.col("s2") - F.col("s1") * mean
    sd = F.when(F.col("n") > 1, F.when(spread > 1e-14 * F.col("s2"), F.sqrt(spread / F.when(F.col("n") > 1, F.col("n") - 1)))
                .otherwise(0.0))
    got = got.select("ga", "gb", "t", "n", mean.alias("average"), sd.alias("sd"), (F.col("va") / F.col("na")).alias("ava"),
                     (F.col("vb") / F.col("nb")).alias("avb"))
    if permutations:
        got = got.join(_permutation_hits(x, units, got, permutations, seed), ["ga", "gb", "t"])
    taxon = _value_of(F.col("t"))
    w = Window.partitionBy("ga", "gb")
    sofar = w.orderBy(F.round("average", 12).desc(), taxon).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("average").over(w)
    out = got.select(
        _value_of(F.col("ga")).alias("group_a"), _value_of(F.col("gb")).alias("group_b"), taxon.alias("taxon"), "average",
        "sd", F.when(F.col("sd") > 0, F.col("average") / F.col("sd")).alias("ratio"), "ava", "avb",
        F.when(total > 0, F.sum("average").over(sofar) / total).alias("cumsum"), *(["hits"] if permutations else []))
    if permutations:
        out = out.withColumn("p", (F.col("hits") + 1) / (permutations + 1)).drop("hits")
    return out


def permuted_sides(units: DataFrame, permutations: int, seed: int) -> DataFrame:
    """For every pair of groups and each of their units the sides it takes in
    the permutations: ``ga, gb, m`` and ``sides``, bit masks of ``MASK_BITS``
    permutations each (bit set: on the side of ``gb``).

    Permutation ``r`` puts the units whose
    ``md5(seed|r|group_a|group_b|group|unit)`` are the smallest on the side of
    ``group_a``, as many as that group has.  (Ranking the units of two groups
    is small beside their pairs, which are needed in any case.)
    """
    sizes = units.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    a, b = sizes.select(F.col("g").alias("ga"), F.col("n").alias("na")), sizes.select(F.col("g").alias("gb"))
    pools = a.join(b, F.col("ga") < F.col("gb"))
    members = units.join(pools, (F.col("g") == F.col("ga"))).unionByName(units.join(pools, (F.col("g") == F.col("gb"))))
    names = [_value_of(F.col(c)) for c in ("ga", "gb", "g", "u")]
    drawn = members.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), (F.col("r") + 1).cast("string"), *names).cast("binary"))
    rank = F.row_number().over(Window.partitionBy("ga", "gb", "r").orderBy(draw, "m"))
    drawn = drawn.withColumn("far", rank > F.col("na"))
    words = [F.bit_or(F.when(F.col("far") & (F.floor(F.col("r") / MASK_BITS) == i),
                             F.expr(f"shiftleft(1L, r % {MASK_BITS})")).otherwise(F.lit(0).cast("long")))
             for i in range(-(-permutations // MASK_BITS))]
    return drawn.groupBy("ga", "gb", "m", "tot").agg(F.array(*words).alias("sides"))


def _permutation_hits(x: DataFrame, units: DataFrame, observed: DataFrame, permutations: int, seed: int) -> DataFrame:
    """Per pair of groups and taxon the permutations whose average is at least
    the observed one (``hits``): sums as in ``simper`` over the pairs of units
    that a permutation puts on different sides, for all permutations at once."""
    sides = permuted_sides(units, permutations, seed).checkpoint()
    pool, whole = ["ga", "gb"], F.col("l.tot") + F.col("r.tot")
    per = F.when(whole != 0, 1 / whole).otherwise(0.0)
    differ = F.filter(F.sequence(F.lit(0), F.lit(permutations - 1)), lambda p: F.getbit(
        F.get(F.col("l.sides"), F.floor(p / MASK_BITS).cast("int")).bitwiseXOR(
            F.get(F.col("r.sides"), F.floor(p / MASK_BITS).cast("int"))), p % MASK_BITS) == 1)

    met = pairs_within(_block_count(sides, pool), pool, "m", F.col("__blocks"), ["m", "tot", "sides"])
    weights = (met.select(*pool, per.alias("w"), F.array("l.m", "r.m").alias("ends"), F.explode(differ).alias("p"))
               .select(*pool, "w", "p", F.explode("ends").alias("m")).groupBy(*pool, "m", "p").agg(F.sum("w").alias("w")))
    own = x.select("m", "t", "v")
    alone = own.join(weights, "m").select(*pool, "t", "p", (F.abs("v") * F.col("w")).alias("s"))
    placed = sides.join(own, "m")
    shared = pairs_within(_block_count(placed, [*pool, "t"]), [*pool, "t"], "m", F.col("__blocks"), ["m", "v", "tot", "sides"])
    shared = shared.select(*pool, "t", (-_overlap(F.col("l.v"), F.col("r.v")) * per).alias("s"), F.explode(differ).alias("p"))
    sums = alone.unionByName(shared.select(*pool, "t", "p", "s")).groupBy(*pool, "t", "p").agg(F.sum("s").alias("s"))
    reached = F.count(F.when(F.col("s") >= (F.col("average") - 1e-12) * F.col("n"), 1))
    # a taxon without amounts on either side has no sums: its average is 0 in every permutation
    return (observed.select(*pool, "t", "average", "n").join(sums, [*pool, "t"], "left").groupBy(*pool, "t")
            .agg(F.when(F.count("p") == 0, F.lit(permutations)).otherwise(reached).alias("hits")))


def top_taxa_summary(df: DataFrame, ranking: DataFrame, taxa_var: str, score: str, x: str, y: str,
                     k: int = 6, agg: str = "sum", p_col: str | None = None, p: float = 0.05) -> DataFrame:
    """Keep the top ``k`` taxa of ``ranking`` (by ``score`` desc, optional
    p filter) and aggregate ``y`` with ``agg`` per taxon x ``x`` (NULLs
    skipped).  The top-k list is bounded by k and broadcast."""
    r = ranking
    if p_col:
        r = r.where(F.col(p_col) <= p)
    top = r.orderBy(F.col(score).desc_nulls_last(), F.col(taxa_var)).limit(k).select(taxa_var)
    fn = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "median": F.median}[agg]
    return (df.join(F.broadcast(top), taxa_var, "left_semi")
              .groupBy(taxa_var, x).agg(fn(y).alias("Value")))


def year_group_share(df: DataFrame, year: str, group: str, measure: str,
                     extra: list[str] | None = None) -> DataFrame:
    """Totals per (year, group) and their share of the year's total; the
    window runs on the aggregated (small) table."""
    keys = [year] + list(extra or []) + [group]
    tot = df.groupBy(*keys).agg(F.coalesce(F.sum(measure), F.lit(0.0)).alias("total"))
    w = Window.partitionBy(*([year] + list(extra or [])))
    return tot.withColumn("share", F.col("total") / F.sum("total").over(w))


def extreme_values(df: DataFrame, col: str, threshold: float = 1e7) -> DataFrame:
    """A10: rows whose value exceeds the threshold."""
    return df.where(F.col(col) > threshold)
