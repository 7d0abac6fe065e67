"""Session settings the job is designed for.

* Adaptive execution re-plans at run time: coalesces small shuffle
  partitions, splits skewed join partitions and turns a sort-merge join into
  a broadcast join only when the *measured* size of a side is under the
  adaptive threshold. The static, estimate-based broadcast is switched off,
  so nothing is broadcast on a guess.
* Times are compared in UTC unless the caller says otherwise.
* The web UI stays off.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitwise") -> SparkSession:
    """A local session for tests and benchmarks with the recommended settings.

    ``spark.checkpoint.dir`` is set only when the environment has none (a
    fresh temporary folder, fine for a single machine).
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in RECOMMENDED.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("PITWISE_DRIVER_MEMORY", "12g"))
    # Small memory pages: many sorters and hash maps of one task pipeline
    # each hold at least one page.
    builder = builder.config("spark.buffer.pageSize", "8m")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory.

    A local session without one gets a temporary folder; a cluster must name
    a shared one, since its executors do not see the driver's folders.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a directory that all executors share")
    path = tempfile.mkdtemp(prefix="pitwise-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()
