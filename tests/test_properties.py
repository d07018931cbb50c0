"""Properties over whole test tables and plan-shape checks."""

from pyspark.sql import functions as F

from harmonia.operators import filters as FL
from harmonia.operators import taxonomy as X
from harmonia.plans import q_combine, q_project, q_taxa  # noqa: F401
from harmonia.plans.fixtures import fixture, load


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_combine_conserves_sums(spark, sf_small):
    src = fixture(spark, sf_small, "li_taxa")
    out = q_combine.a1_result(spark, sf_small).df
    for c in ("Cells_per_mL", "Units_per_mL", "Biovolume_per_mL"):
        a = src.agg(F.sum(c)).first()[0]
        b = out.agg(F.sum(c)).first()[0]
        assert abs(a - b) < 1e-6 * max(1.0, abs(a))
    # every input row lands in exactly one output group
    n_out = out.agg(F.sum(F.when(F.col("Notes").contains("MultipleEntries"), 0).otherwise(1))).first()[0]
    assert n_out <= src.count()


def test_remove_nodata_rows_kept_plus_logged(spark, sf_small):
    src = fixture(spark, sf_small, "li_counts")
    res = FL.remove_nodata(src)
    null_taxon_dropped = src.where(F.col("Taxon").isNull()
                                   & F.coalesce(F.col("Cells_per_mL"), F.lit(0.0)).__eq__(0)
                                   & F.coalesce(F.col("Units_per_mL"), F.lit(0.0)).__eq__(0)
                                   & F.coalesce(F.col("Biovolume_per_mL"), F.lit(0.0)).__eq__(0)).count()
    assert src.count() == res.df.count() + res.logs["nodata"].count() + null_taxon_dropped


def test_filter_methods_rows_kept_plus_removed(spark, sf_small):
    o = load(spark, sf_small, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("sampler"))
    corr = o.groupBy("o_custkey").agg(F.min("sampler").alias("sampler"))
    res = FL.filter_methods(o, corr, ["o_custkey"])
    removed_rows = o.join(corr.withColumnRenamed("sampler", "c"), "o_custkey").where(F.col("sampler") != F.col("c"))
    assert o.count() == res.df.count() + removed_rows.count()


def test_typo_correction_idempotent(spark, sf_small):
    data, typos = fixture(spark, sf_small, "part_typo_data"), fixture(spark, sf_small, "part_typos")
    once = X.correct_taxon_typos(data, typos, order="o").df
    twice = X.correct_taxon_typos(once, typos, order="o").df
    a = sorted(tuple(r) for r in once.collect())
    b = sorted(tuple(r) for r in twice.collect())
    assert a == b


def test_scan_pushdown_and_pruning(spark, sf_small):
    from harmonia.plans.q_checks import c28_station_set_difference
    plan = _plan(c28_station_set_difference(spark, sf_small))
    assert "PushedFilters: [" in plan and "EqualNullSafe(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_returnflag:string>" in plan


def test_no_nested_loop_or_cartesian_joins(spark, sf_small):
    from harmonia.plans.q_joins import j3_meta_last_match, j14_point_in_polygon
    for df in (q_combine.a1_combine_taxa(spark, sf_small), j3_meta_last_match(spark, sf_small),
               j14_point_in_polygon(spark, sf_small)):
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
