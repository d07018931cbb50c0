"""L1 on disk: stages leave no exchange behind, rows move once between two stages, and a key of many rows is no task's share."""

import contextlib
import datetime as dt
import io
import time

import pytest
from pyspark.sql import functions as F

from harmonia import frame
from harmonia.frame import deals_evenly, untouched
from harmonia.plans import programs as PG
from harmonia.session import DROP_EXCHANGES, stage


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def exchanges(spark) -> set[str]:
    """The exchange files that the session has on disk."""
    env = getattr(spark._jvm.org.apache.spark, "SparkEnv").get()
    blocks = env.blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(i).name() for i in range(blocks.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_after(spark, before: set[str]) -> set[str]:
    for _ in range(50):  # files go in the background
        if not (left := exchanges(spark) - before):
            break
        time.sleep(0.1)
    return left


TAXA = "Taxon string, Kingdom string, Phylum string, Class string, AlgalGroup string, Genus string, Species string, CurrentTaxon string"
RAW = "Event int, Station string, Taxon string, Line int, Factor double, unit double, cells double, Comments string"
#: Equal rows, keys without a value, names that become one.
ROWS = [(1, "A", "Ring small", 1, 2.0, 1.0, 3.0, "CMT > 5"), (1, "A", "Ring small", 1, 2.0, 1.0, 3.0, "CMT > 5"),
        (1, "A", "Old ring", 2, 1.0, 5.0, 7.0, "cyst"), (1, None, "Ring small", 1, 1.0, 1.0, 1.0, "ok"),
        (None, None, "Ring small", 1, 1.0, 2.0, 2.0, "ok"), (None, None, "ring  small", 2, 1.0, 4.0, 4.0, None),
        (2, "A", "Ring small", 1, 1.0, 0.0, 0.0, "ok"), (2, "B", None, 1, 1.0, 1.0, 9.0, "ok")]
#: Event, Station, Taxon: OrigTaxon, Units, Cells, Line (of the first row), Notes
WANT = {(1, "A", "Ring small"): ("Old ring; Ring small", 7.0, 13.0, 1, "Cyst MultipleEntries"), (1, None, "Ring small"): (None, 1.0, 1.0, 1, "NoNote"),
        (None, None, "Ring small"): (None, 6.0, 6.0, 1, "MultipleEntries")}
CFG = {"density": {"unit": "unit", "cell": "cells"}, "comment_col": "Comments", "key_cols": ["Event", "Station"],
       "order_cols": ["Event", "Line", "Taxon", "cells"]}


def formatted(spark, rows=ROWS, cfg=CFG, **kwargs):
    taxa = spark.createDataFrame([("Ring small", "K", "P", "C", "Green Algae", "Ring", "small", "None"),
                                  ("Old ring", "K", "P", "C", "Green Algae", "Old", "ring", "Ring small")], TAXA)
    typos = spark.createDataFrame([("rinx", "Ring small", 1)], "Taxon string, TaxonCorrected string, o int")
    df = spark.createDataFrame(rows, RAW).withColumn("Biovolume_1", F.lit(None).cast("double"))
    return PG.format_program(df, cfg, typos=typos, taxa=taxa, typo_order="o", taxa_order=["Taxon", "Kingdom"], **kwargs)


def got(res) -> dict:
    rows = [r for r in res.df.collect() if r.Taxon is not None]
    out = {(r.Event, r.Station, r.Taxon): (r.OrigTaxon, r.Units_per_mL, r.Cells_per_mL, r.Line, r.Notes) for r in rows}
    assert len(out) == len(rows)
    return out


def test_a_stage_leaves_no_exchange(spark):
    setting, before = spark.conf.get(DROP_EXCHANGES), exchanges(spark)
    df = spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count()
    kept = stage(df)
    assert not left_after(spark, before)
    assert spark.conf.get(DROP_EXCHANGES) == setting
    assert sorted(kept.collect()) == sorted(stage(df).collect()) == sorted((k, 143 if k < 6 else 142) for k in range(7))


def test_a_stage_that_fails_keeps_the_setting(spark):
    setting = spark.conf.get(DROP_EXCHANGES)
    with pytest.raises(Exception, match="no such row"):
        stage(spark.range(3).select(F.raise_error(F.lit("no such row")).cast("int").alias("x")))
    assert spark.conf.get(DROP_EXCHANGES) == setting


def test_l1_moves_rows_once_between_its_stages(spark):
    res = formatted(spark)
    text = plan(res.df)
    assert text.count("Exchange hash") == 1
    exchange = next(line for line in text.splitlines() if "Exchange hash" in line)
    assert "Event" in exchange and "Station" in exchange
    below = text.split("Exchange hash")[1]  # what moves is the rows as they were staged
    assert "Notes" not in below and "named_struct" not in below and "struct(" not in below
    assert got(res) == WANT


def test_l1_with_a_key_of_many_rows_deals_states(spark, monkeypatch):
    monkeypatch.setattr(frame, "TASK_ROWS", 20)
    hot = [(3, "H", "Ring small", i, 1.0, 1.0, 1.0, "ok") for i in range(300)]
    res = formatted(spark, ROWS + hot)
    assert plan(res.df).count("Exchange hash") == 2
    assert got(res) == {**WANT, (3, "H", "Ring small"): (None, 300.0, 300.0, 0, "MultipleEntries")}
    assert got(formatted(spark)) == WANT


def test_dealing_is_judged_by_the_rows_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(frame, "TASK_ROWS", 0)
    df = spark.range(4000).select((F.col("id") % 1000).cast("int").alias("a"), F.when(F.col("id") < 3000, "x").alias("b"))
    assert deals_evenly(df, ["a"]) and deals_evenly(df, ["a", "b"]) and deals_evenly(df.limit(0), ["a"])
    assert not deals_evenly(df, ["b"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = df.repartition(n, "b").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most > 4 * 4000 / n


def test_l1_with_keys_made_by_its_steps(spark):
    df = [(*r[:1], "A", *r[2:]) for r in ROWS[:3]] + [(2, "B", "Ring small", 1, 1.0, 1.0, 1.0, "ok")]
    cfg = {**CFG, "key_cols": ["Ev", "Lab"], "renames": {"Ev": "Event"}, "meta_cols": ["Lab"]}
    meta = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2020, 12, 31), "L1")], "meta_idx int, start_date date, end_date date, Lab string")
    taxa = spark.createDataFrame([("Ring small", "K", "P", "C", "Green Algae", "Ring", "small", "None")], TAXA)
    raw = spark.createDataFrame(df, RAW).withColumns({"Biovolume_1": F.lit(None).cast("double"), "Date": F.lit("2020-05-01").cast("date")})
    res = PG.format_program(raw, cfg, taxa=taxa, meta=meta, taxa_order=["Taxon", "Kingdom"])
    rows = sorted((r.Ev, r.Lab, r.Taxon, r.Cells_per_mL) for r in res.df.collect())
    assert rows == [(1, "L1", "Old ring", 7.0), (1, "L1", "Ring small", 6.0), (2, "L1", "Ring small", 1.0)]
    with pytest.raises(ValueError, match="order_cols"):
        formatted(spark, cfg={**CFG, "order_cols": None})


def test_columns_that_are_handed_on(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "k int, s string, v double")
    assert untouched(df.withColumn("w", F.col("v") + 1).drop("v"), df, ["k", "s"])
    assert not untouched(df.withColumn("s", F.trim("s")), df, ["k", "s"])
    assert not untouched(df.drop("s"), df, ["s"]) and not untouched(df.withColumn("w", F.col("v")), df, ["w"])
