"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job of this package relies on. On a cluster these come from the
# cluster's own configuration; the builder below is for local runs and tests.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": os.environ.get("FLOWGUARD_DRIVER_MEMORY", "6g"),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "flowguard") -> SparkSession:
    """Build (or reuse) a session with the settings above."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    parts = shuffle_partitions or int(os.environ.get("BENCH_CPUS", "8"))
    builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only where it is unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that folder is used
    as is. Only a local-mode session (tests, bench) without one gets a fresh
    folder of its own. A cluster session without the setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    # tests and bench: FLOWGUARD_CHECKPOINT_DIR, or a fresh temporary folder
    sc.setCheckpointDir(os.environ.get("FLOWGUARD_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="flowguard-ckpt-"))
    return sc.getCheckpointDir()


def checkpointed(df):
    """Reliable checkpoint of ``df`` (cuts lineage, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
