"""Session settings for running the operators outside a managed cluster."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators are tested under.

    On a cluster the session comes from the platform; nothing in the operators changes its
    configuration.  They rely on two Spark defaults: adaptive execution (skew-join splitting and
    partition coalescing) and the automatic broadcast threshold.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A local session without one gets a scratch folder.  On a cluster that would be a folder of one
    machine, so there it is an error.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="ledgerloom-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named

