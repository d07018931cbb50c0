"""What was changed for size: lookups by distinct name, stages as Parquet, rows that move once, ingest without sorts."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from harmonia.operators.combine import combine_taxa
from harmonia.plans import programs as PG
from harmonia.plans import q_combine
from harmonia.session import checkpoint_dir, stage
from harmonia.sources import readers as RD


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


TAXA = "Taxon string, Kingdom string, AlgalGroup string, Genus string, Species string, CurrentTaxon string"


def test_taxon_steps_run_on_distinct_names(spark):
    df = spark.createDataFrame([(1, "Old  ring", "x"), (2, None, "y"), (3, "rinx smal", "x"), (4, "Old  ring", None)],
                               "id int, Taxon string, Notes string")
    taxa = spark.createDataFrame([("Ring small", "K", "Green Algae", "Ring", "small", "None"), ("Ring small", "K2", "Green Algae", "Ring", "small", "None"),
                                  ("Old ring", "P", "Green Algae", "Old", "ring", "Ring small")], TAXA)
    typos = spark.createDataFrame([("rinx smal", "Ring small", 1)], "Taxon string, TaxonCorrected string, o int")
    res = PG.taxon_chain(df, typos, taxa, "unified", typo_order="o", taxa_order=["Kingdom"])
    assert res.df.columns == ["id", "OrigTaxon", "Taxon", "Notes", "Kingdom", "AlgalGroup", "Genus", "Species"]
    got = sorted((r.id, r.OrigTaxon, r.Taxon, r.Kingdom, r.Notes) for r in res.df.collect())
    assert got == [(1, "Old ring", "Ring small", "K", "x"), (1, "Old ring", "Ring small", "K2", "x"), (2, None, None, None, "y"),
                   (3, None, "Ring small", "K", "x"), (3, None, "Ring small", "K2", "x"),
                   (4, "Old ring", "Ring small", "K", None), (4, "Old ring", "Ring small", "K2", None)]
    assert "Exchange hash" not in plan(res.df)  # few names: the rows stay where they are


def test_a_stage_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 2), (1, None))], "n int, s string, d date, r struct<a:int,b:string>")
    assert stage(df).schema == df.schema and stage(df).collect() == df.collect()
    assert stage(df.withColumn("v", F.lit(None))).collect() == df.withColumn("v", F.lit(None)).collect()
    assert checkpoint_dir(spark) in stage(df).inputFiles()[0]


def test_combining_moves_rows_twice_at_most(spark):
    rows = [("e", "A", "c1", "p", "k", 1.0, 1), ("e", "A", "c2", "p", "k", 2.0, 2), ("e", "Unknown c1", "c1", "p", "k", 4.0, 3)]
    df = spark.createDataFrame(rows, "Event string, Taxon string, Class string, Phylum string, Kingdom string, Cells_per_mL double, _row_id int")
    out = combine_taxa(df, ["Event"], ["Cells_per_mL"]).df
    assert plan(out).count("Exchange hash") == 2
    assert sorted((r.Taxon, r.Cells_per_mL, r.Class) for r in out.collect()) == [("Unknown c1", 5.0, "c1"), ("Unknown c2", 2.0, "c2")]
    assert plan(combine_taxa(df.repartition("Event"), ["Event"], ["Cells_per_mL"]).df).count("Exchange hash") == 1


def test_a1_deals_its_rows_once(spark, sf_small):
    text = plan(q_combine.a1_result(spark, sf_small).df)
    assert text.count("Exchange hash") == 1 and "row_number" not in text


def test_ingest_sorts_no_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n  \nk,v\nx,1\ny,n/a\n")
    (tmp_path / "b.csv").write_text("v,k\n2,z\n")
    files = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    rows = RD.read_uploads(spark, files)
    assert "SortMergeJoin" not in plan(rows)
    rules = RD._upload_findings({"v": {"type": "integer", "required": True, "max": 1}, "k": {"type": "character"}})
    flags = rows.withColumn("is_head", F.col("at") == F.col("head_at")).groupBy("name").agg(
        F.array_compact(F.array(*[F.when(hit, F.lit(text)) for text, hit in rules])).alias("errors"))
    assert {r.name: r.errors for r in flags.collect()} == {"a.csv": ["v: not numeric"], "b.csv": ["v: above max"]}
    top = plan(flags).split("BroadcastExchange")[0]
    assert "SortAggregate" not in top and "Sort [" not in top
