"""Sources, sinks, schema config and the incremental (streaming) ingest."""

import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from harmonia.sources import config as CFG
from harmonia.sources import readers as RD
from harmonia.sources import sinks as SK
from harmonia.streaming.incremental import ingest_new_files


def _tmp():
    return tempfile.mkdtemp(prefix="harmonia-test-")


def test_csv_round_trip_and_log_sink(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5)], "id int, s string, v double")
    SK.write_csv(df, os.path.join(d, "out"))
    back = RD.read_csv(spark, os.path.join(d, "out"), "id int, s string, v double")
    assert sorted(map(tuple, back.collect())) == [(1, "a", None), (2, None, 2.5)]
    assert SK.write_log(df.limit(0), os.path.join(d, "empty")) is False
    assert not os.path.exists(os.path.join(d, "empty"))
    assert SK.write_log(df, os.path.join(d, "log")) is True


def test_write_by_key_keeps_key(spark):
    d = _tmp()
    df = spark.createDataFrame([("S1", 1), ("S2", 2), ("S1", 3)], "Survey string, x int")
    SK.write_by_key(df, d, "Survey", fmt="parquet")
    parts = sorted(p for p in os.listdir(d) if p.startswith("__part_Survey="))
    assert parts == ["__part_Survey=S1", "__part_Survey=S2"]
    assert spark.read.parquet(os.path.join(d, parts[0])).columns == ["Survey", "x"]


def test_all_text_union_pads_missing_columns(spark):
    d = _tmp()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("A,B\n1,x\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("B,C\ny,2\n")
    df = RD.read_all_text(spark, [os.path.join(d, "a.csv"), os.path.join(d, "b.csv")])
    assert sorted(df.columns) == ["A", "B", "C", "_file_index"]
    assert dict(df.dtypes)["A"] == "string"
    assert df.where(F.col("C").isNull()).count() == 1


def test_ingest_manifest(spark):
    d = _tmp()
    with open(os.path.join(d, "good.csv"), "w") as f:
        f.write("Station,Count\nA,3\nB,4\n")
    with open(os.path.join(d, "bad.csv"), "w") as f:
        f.write("Station,Count\nA,-1\n")
    schema = {"columns": {"Station": {"type": "character", "required": True},
                          "Count": {"type": "integer", "required": True, "min": 0}}}
    files = [os.path.join(d, "good.csv"), os.path.join(d, "bad.csv"), os.path.join(d, "good.csv")]
    manifest, merged = RD.ingest_manifest(spark, files, schema)
    got = {r["name"]: r["status"] for r in manifest.collect()}
    assert got == {"good.csv": "valid", "bad.csv": "invalid"}
    assert merged.count() == 2


def test_schema_config(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"survey": "S", "presets": ["std", "alt"],
                                                 "steps": {"combine_taxa": {"std": {"applies": False}}}}))
    sch = CFG.load_schemas(str(tmp_path))["S"]
    assert CFG.applies(sch, "combine_taxa", "std") is False
    assert CFG.applies(sch, "update_synonyms", "alt") is True
    assert CFG.step(sch, "standardize_unknowns", "std")["std_suffix"] is True


def test_matrix_export_layout(spark):
    meta = spark.createDataFrame([("s1", "wet"), ("s2", "dry")], "sample string, Season string")
    com = spark.createDataFrame([("s1", "A", 1.0), ("s2", "A", 2.0), ("s2", "B", 3.0)],
                                "sample string, Taxon string, value double")
    out = SK.matrix_export(meta, com, ["sample"]).collect()
    assert out[0]["Variable"] == "Environmental variables"
    assert out[1]["R1"] == "R1" and out[1]["R2"] == "R2"
    body = {r["Variable"]: (r["R1"], r["R2"]) for r in out[2:] if r["block"] in (2, 4)}
    assert body["A"] == ("1.0", "2.0") and body["B"] == (None, "3.0") and body["Season"] == ("wet", "dry")


def test_matrix_export_keeps_cells_of_odd_sample_ids(spark):
    ids = [(0.00001, True), (None, False), (2.0, None)]
    meta = spark.createDataFrame([(*i, f"m{k}") for k, i in enumerate(ids)], "x double, b boolean, Season string")
    com = spark.createDataFrame([(*i, "A", float(k)) for k, i in enumerate(ids)], "x double, b boolean, Taxon string, value double")
    rows = {r["Variable"]: r for r in SK.matrix_export(meta, com, ["x", "b"]).collect()}
    assert [rows["A"][f"R{i}"] for i in (1, 2, 3)] == ["1.0", "0.0", "2.0"]  # NULL id first
    assert [rows["Season"][f"R{i}"] for i in (1, 2, 3)] == ["m1", "m0", "m2"]
    other = spark.createDataFrame([(5.0, True, "A", 1.0), (None, False, "A", 1.0), (2.0, None, "A", 1.0)], com.schema)
    with pytest.raises(ValueError):
        SK.matrix_export(meta, other, ["x", "b"])


def test_write_by_key_splits_a_hot_key(spark):
    df = spark.range(0, 400_000).select(F.lit("S1").alias("Survey"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        d = os.path.join(_tmp(), "t")
        SK.write_by_key(df, d, "Survey", fmt="parquet")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = [f for _, _, names in os.walk(d) for f in names if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(d).count() == 400_000


def test_incremental_ingest_processes_each_file_once(spark):
    src, out, ck = _tmp(), _tmp(), _tmp()
    schema = T.StructType([T.StructField("Taxon", T.StringType()), T.StructField("Comments", T.StringType()),
                           T.StructField("Time", T.StringType())])
    with open(os.path.join(src, "f1.csv"), "w") as f:
        f.write("Taxon,Comments,Time\nunidentified diatom sp.,CMT > 5,10:00:00\n")
    n1 = ingest_new_files(spark, src, schema, os.path.join(out, "t"), os.path.join(ck, "c"), comment_col="Comments")
    with open(os.path.join(src, "f2.csv"), "w") as f:
        f.write("Taxon,Comments,Time\nUnknown,high sediment,00:00:00\n")
    n2 = ingest_new_files(spark, src, schema, os.path.join(out, "t"), os.path.join(ck, "c"), comment_col="Comments")
    assert (n1, n2) == (1, 1)
    res = {r["Taxon"]: r for r in spark.read.parquet(os.path.join(out, "t")).collect()}
    assert res["Unknown diatom"]["QualityCheck"] == "TallyNotMet_Over5 TallyNotMet"
    assert res["Unknown diatom"]["Time"] == "10:00"
    assert res["Unknown sp."]["Debris"] == "High" and res["Unknown sp."]["Time"] is None
