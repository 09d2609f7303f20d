"""Session helpers.

The library never creates a hidden session: every operator takes DataFrames.
These helpers exist for tests, the bench and the driver entry point.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on: UTC for date arithmetic, AQE for runtime
# coalescing / skew-join splitting, Arrow for the few pandas UDF paths.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Broadcast only what the optimizer can prove small; operators that force a
    # broadcast check the size bound themselves.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "custos") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    b = b.config("spark.driver.memory", os.environ.get("CUSTOS_DRIVER_MEM", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only where it is unset under a local master (tests) a scratch
    directory is created; elsewhere that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="custos-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path
