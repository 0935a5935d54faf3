"""Session helpers.

Only settings that are safe on a cluster are applied here; a cluster keeps its
own values because every setter checks the session first.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Opt-in: spread scans of unsplit single files (local benchmarks), see balanced_scan.
SPREAD_SCANS = "spark.lakeward.spreadScans"

# Settings applied to sessions built by :func:`local_session` (tests, bench).
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    SPREAD_SCANS: "true",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lakeward") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("LAKEWARD_DRIVER_MEM", "8g")))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, creating a private one only
    when the session names none (local runs).  On a cluster the shared folder
    configured in ``spark.checkpoint.dir`` is always used as is."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        configured = tempfile.mkdtemp(prefix="lakeward-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Most bytes of an Arrow batch between a task and its Python worker.  Spark's own bounds,
# 10,000 rows and 64 MB, are held several times over on either side, by every core.
ARROW_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that Python workers get, for steps that hand whole texts
    to them.  It changes no result; a session that names a bound keeps it."""
    name, most = ARROW_BATCH
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, most)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# An input of at least this size that the reader cannot split (one file with
# one row group) is spread over the cluster's cores after the scan.
UNSPLIT_SCAN_BYTES = 8 << 20


def balanced_scan(df: DataFrame) -> DataFrame:
    """Round-robin an under-split scan over the default parallelism.

    A Parquet file with a single row group is read by one task, so every
    per-row step before the first shuffle (filters, text cleaning, map-side
    aggregation, broadcast probes) would run on one core.  When the scan has
    fewer partitions than the default parallelism and holds at least
    UNSPLIT_SCAN_BYTES, one round-robin exchange spreads the rows; inputs that
    are already split (any normal multi-file table on a cluster) are left
    untouched.  Off unless the session sets SPREAD_SCANS, as sessions for local
    tests and benchmarks do, whose tables are single files."""
    spark = df.sparkSession
    par = spark.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    if n >= par:
        return df
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    size = 0
    for f in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(f)
        size += p.getFileSystem(conf).getFileStatus(p).getLen()
    if size < UNSPLIT_SCAN_BYTES * n:
        return df
    return df.repartition(par)
