"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark setting: the exchanges of an SQL execution are removed when it ends.
DROP_EXCHANGES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "harmonia") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster the master and most settings come from spark-submit; only
    the values below are set here, and only if the caller did not set them.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of RDDs no longer referenced are removed by Spark
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # broadcast only sides proven small; lookups stay well under this
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # partition sizing for large inputs; only where the cluster set nothing
    for k, v in {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
                 "spark.sql.files.maxPartitionBytes": "256m",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4"}.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a local default is set
    only when it is unset (tests, single machine runs).
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="harmonia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Written as Parquet: a checkpoint keeps rows uncompressed and whole, Parquet
    takes a fraction of that, is read by column, and its size tells Spark
    whether a lookup is small enough to broadcast.  What Parquet cannot hold
    (columns without a type, repeated names) is checkpointed.

    The exchanges of the job that writes are off the disks when it ends; Spark
    else keeps them until the driver happens to collect its garbage, so that
    those of all stages add up."""
    spark = df.sparkSession
    root = checkpoint_dir(spark)
    names = [c.lower() for c in df.columns]
    if not names or len(set(names)) < len(names) or '"void"' in df.schema.json():
        return df.checkpoint()
    path = f"{root}/stage-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_EXCHANGES, "false")
    spark.conf.set(DROP_EXCHANGES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(DROP_EXCHANGES, before)
    return spark.read.schema(df.schema).parquet(path)
