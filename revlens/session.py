"""Session helpers.

Library operators never create sessions; they take DataFrames.  These helpers
are for the jobs in ``plans`` and for tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins and partition counts from
# runtime sizes, skew-join splitting is on, timestamps are read in UTC.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Text cleaning and TF-IDF are CPU-heavy per row: let AQE keep small
    # shuffle partitions apart instead of merging them into one or two
    # tasks (large data is unaffected: partitions are sized by bytes).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the operators assume (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "revlens", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # checkpoint files of frames that went out of scope are removed
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read.  When
    it is unset and Spark runs in local mode (tests), a fresh local folder is
    registered; a cluster without the setting is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        current = fallback or tempfile.mkdtemp(prefix="revlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


# Shuffle files of a write go when it ends; else they stay until the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return a frame reading it.  The write's shuffle files are
    removed at its end: nothing reads them again, as the written rows take their place."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` (a Spark job, run at once) as Parquet in the shared
    checkpoint folder and return a frame reading it: lineage ends there, a lost
    executor loses nothing, and every later read prunes columns and pushes
    filters.  Used where one intermediate feeds several branches."""
    return write_once(df, f"{checkpoint_dir(df.sparkSession).rstrip('/')}/lineage-{uuid.uuid4().hex}")


def discard(df: DataFrame) -> None:
    """Remove the files of a frame that ``cut_lineage`` returned, once all that was to read it is written."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if folder.rsplit("/", 1)[-1].startswith("lineage-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
