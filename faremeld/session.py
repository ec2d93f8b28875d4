"""Session set-up and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "faremeld", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume.

    Shuffle partitions start high on a cluster and adaptive execution merges
    small ones; skewed joins are split at run time even where that costs one
    more exchange, because a hot key may hold a large share of all rows.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by `spark.checkpoint.dir`.

    Only a local session with neither that setting nor a folder already set
    gets a folder of its own; on a cluster a machine-local folder would be
    lost with its machine, so there the missing setting is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        folder = tempfile.mkdtemp(prefix="faremeld-checkpoint-")
    sc.setCheckpointDir(folder)
