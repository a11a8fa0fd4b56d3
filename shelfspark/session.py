"""SparkSession construction with the settings the jobs are designed around."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast when a shuffled
# side turns out small, split skewed partitions of semi/anti/inner/outer joins) and
# coalesces small shuffle partitions; the session zone only matters for timestamp display.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "shelfspark", extra: dict | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """Local/test session. On a cluster, use the cluster's builder and call ``apply_job_conf``."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (cluster or driver-made)."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local master without the setting (tests) gets a
    private scratch folder; anywhere else a machine's own folder would lose rows, so a missing
    setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="shelfspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder, deleted when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfspark-{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder and continue from it.

    Used for tables that later stages read several times. The stored copy cuts the lineage
    (plans stay small; a lost executor does not force recomputing from the raw events), costs
    one job (an RDD checkpoint would compute twice), and gives the planner real file sizes, so
    a small table can be broadcast by Spark's own size threshold while a large one stays a
    shuffle join. The folder is deleted when the application ends: the DataFrames a job returns
    still read it until then.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shelfspark-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    jvm = spark.sparkContext._jvm
    stored = jvm.org.apache.hadoop.fs.Path(path)
    stored.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(stored)
    return spark.read.parquet(path)


def release(*stages) -> None:
    """Delete materialised tables that nothing reads any more, and let go of finished shuffles.

    Only for tables whose every reader has been materialised itself. Spark removes the shuffle
    files of DataFrames that nobody holds when the driver's JVM collects garbage, which on a large
    heap may be long after the disk is full.
    """
    for df in stages:
        spark = df.sparkSession
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for name in folders:
            if "/shelfspark-" not in name:
                raise ValueError(f"not a materialised table: {name}")
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    gc.collect()
    if (spark := SparkSession.getActiveSession()) is not None:
        spark.sparkContext._jvm.System.gc()
