"""Session building and the runtime settings every job relies on."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job may change at run time. They only switch Spark's own adaptive behaviour on.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Alignment rows carry whole transcripts: keep Arrow batches small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def tune(spark):
    """Apply the run-time settings to a session somebody else created."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark, key, value):
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def build(app="callweave", master=None, shuffle_partitions=None):
    """A session for local runs and tests; on a cluster pass no master and let spark-submit decide."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark):
    """The shared folder the cluster names in spark.checkpoint.dir. Only a local master, as in tests, may leave that unset: it
    gets a fresh temporary folder, which executors of a cluster could not see."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="callweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def settle(df):
    """Write an expensive intermediate result once, reliably, instead of computing it for every later use. The files are
    on shared storage, so a lost executor costs a read and not the whole lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def spread(df, *columns):
    """Spread rows evenly before costly per-row Python work. The explicit count keeps Spark from merging the small
    partitions again: bytes say little about the work in them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def work_folder(spark, name):
    """A new folder for one job's stream state and output, under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df, name):
    """Write an intermediate result that several branches read in part: as Parquet on shared storage, so each reads only its columns."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def widen(df, min_bytes=1 << 20):
    """Spread a table that arrives in fewer partitions than there are cores (one small file). Large inputs already come
    in many splits and pass through untouched, so nothing is added at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < min_bytes or df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores)
