"""Session settings and the one way intermediate results are pinned."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app: str = "txnlytics", cores: str = "*", **conf) -> SparkSession:
    """A session for tests and local runs; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by the session.

    A local session without the setting gets a fresh temporary folder. A cluster
    without it is an error: executors could not read a folder of one machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="txnlytics-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def run_folder(spark: SparkSession, label: str) -> str:
    """Name of a new folder in the shared one."""
    return f"{checkpoint_dir(spark)}/txnlytics/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, compression: str = "snappy", schema=None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Used where a result is read more than once or joined as a lookup. It survives
    the loss of executors, and the scan's file size is known to the optimiser, so
    a lookup is broadcast only when it really is below
    ``spark.sql.autoBroadcastJoinThreshold``; above that the join is a shuffle
    join whose hot keys the adaptive skew handling splits. ``schema`` names other types
    with the same stored form, such as vectors for structs.
    """
    spark = df.sparkSession
    path = run_folder(spark, label)
    df.write.parquet(path, compression=compression)
    stored = spark.read.schema(schema or df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Removes intermediate tables that nothing reads any more, so that rounds of a job don't pile up.

    To be called once everything that derives from them is itself written. The shuffles behind
    them are garbage then too; Spark's cleaner removes their files when the driver has noticed that.
    """
    gc.collect()
    for frame in frames:
        spark, path = frame.sparkSession, frame.stored_at
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if frames:
        frames[0].sparkSession._jvm.System.gc()
