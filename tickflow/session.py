"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings a job should start with. Sizes are left to AQE, which splits skewed
#: join partitions and merges small shuffle partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE merges partitions but never adds any: large jobs raise both, so that a partition fits its task's memory
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.streaming.stopGracefullyOnShutdown": "true",
}


def build_session(name: str = "tickflow", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`SETTINGS`."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    names none gets a temporary one; a cluster without the setting is an error,
    because a machine-local folder would not survive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not getattr(spark, "_tickflow_dir", None):
        spark._tickflow_dir = tempfile.mkdtemp(prefix="tickflow-")
    return spark._tickflow_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (reliable checkpoint).

    Used where a plan refers twice to rows whose placement must be the same
    both times (range partitions, sketches).
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
