"""Session helpers.

Cluster settings (shuffle partitions, checkpoint dir, AQE) belong to whoever
launches the job; these helpers only fill in values that are unset, which is
what tests and the local bench need.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of unreferenced DataFrames (rank sorts, cubes) are
    # removed by the context cleaner instead of accumulating
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(master: str | None = None, app: str = "panelgap",
                  shuffle_partitions: int | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when the
    session names none (tests / local bench).  On a cluster the launcher sets
    ``spark.checkpoint.dir`` to shared storage and we use it as is."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="panelgap-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()
