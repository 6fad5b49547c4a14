"""Session construction and cluster-shared locations."""

from __future__ import annotations

import gc
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job of the pipeline relies on.  Lookups broadcast only
# dimensions of measured size (operators.lookup); for every other join AQE
# re-plans at runtime: a side that materialises under the adaptive
# threshold is broadcast, small shuffle partitions are coalesced and
# skewed join partitions are split.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "qualis", extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialize(df, spark: SparkSession | None = None):
    """Cut lineage: reliable checkpoint into the cluster's shared checkpoint folder.

    Uses ``spark.checkpoint.dir`` as the session names it; when no folder is
    configured the DataFrame stays lazy in local mode (same result, longer
    lineage) and a cluster is an error, for the plan would be computed anew
    by each use.
    Never a local checkpoint: the files must survive a lost executor.
    """
    spark = spark or df.sparkSession
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")
        return df
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return df.checkpoint(eager=True)


#: A step over so many rows is followed by ``release``.
RELEASE_ROWS = 1_000_000


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files and checkpoints of frames that nothing names any more.

    It does so when the driver's heap is collected; a driver that is short of
    nothing would keep the files of all past steps on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def kept(df):
    """The rows of ``df``, computed once, for the time of a block.

    As ``materialize``, but in compressed columns, and removed after the block.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "rows")
    df.write.option("compression", "zstd").parquet(path)
    release(spark)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Only when the session names no shared folder and runs in local mode
    (tests) is a local temporary folder used.
    """
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")
        base = tempfile.mkdtemp(prefix="qualis-")
    return f"{base.rstrip('/')}/qualis-{name}-{uuid.uuid4().hex}"
