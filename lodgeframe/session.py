"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small post-shuffle partitions keep CPU-heavy narrow stages (contract
    # checks, vector blocks) parallel when a shuffle's output is small
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Embedding / vector blocks travel as Arrow batches of bounded size.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "lodgeframe", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[*]``.  ``shuffle_partitions`` should be sized so one shuffle
    partition stays around 128-256 MB at the target scale; AQE coalesces
    the small ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            builder = builder.config("spark.driver.memory", "16g")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/lodgeframe-checkpoints") -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  A folder of our own is set only for
    a local-mode session without one (tests); on a cluster a missing
    setting is an error, because a machine-local folder would not be shared
    by the executors.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
        conf_dir = fallback
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def own_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session of the same application with ``spark``'s settings and some of
    its own (dots as double underscores), which no later query of ``spark`` sees."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key.replace("__", "."), value)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder.

    Used for staged tables, round-trip sinks and stream checkpoints, so
    every executor (and a restarted driver) sees the same files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lodgeframe/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop FileSystem (works for s3a/hdfs/local)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, through Hadoop FileSystem."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.getFileStatus(hpath).isDirectory())


__all__ = ["get_spark", "own_session", "ensure_checkpoint_dir", "scratch_path", "path_exists", "is_folder",
           "DEFAULT_CONF"]
