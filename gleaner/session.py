"""Session settings and lineage cutting shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot join key over several tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A page row is far larger than a TPC-H row, so Arrow batches are cut by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
    # Checkpoint files go when the table they hold is no longer used.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Recording the caller of every column call makes long expressions slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Sessions are merged in each map task first, so a hot run shuffles one row per task and session.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_session(app: str = "gleaner", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def set_checkpoint_folder(spark: SparkSession) -> None:
    """Use the shared folder named in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="gleaner-checkpoint-")
        context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and read it back, so later stages never recompute it."""
    set_checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core before an expensive per-row step.

    A large table already has more splits than cores and passes through without a shuffle. Call it on a
    bare scan only: counting the partitions of a later plan would run its shuffles.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch_folder(spark: SparkSession) -> str:
    """The checkpoint folder, for files a later step reads again."""
    set_checkpoint_folder(spark)
    return spark.sparkContext.getCheckpointDir()
