"""Session set-up and the shared folder for staged results."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, ANSI mode and adaptive execution; `conf` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split hot keys even where that costs one more shuffle after the join.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    The cluster names it in `spark.checkpoint.dir`. Only a local session without the setting
    gets a temporary folder, because there driver and executors are one machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
            configured = tempfile.mkdtemp(prefix="tidewater-")
        elif not sc.master.startswith("local") and "://" not in configured and not configured.startswith("file:"):
            raise ValueError(f"spark.checkpoint.dir is {configured!r}: name the shared file system in it")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
