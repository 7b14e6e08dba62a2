"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def session_builder(app_name: str = "pairloom") -> SparkSession.Builder:
    """A builder with the settings the operators are written for."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="pairloom-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared folder, so later passes see the same partitions."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpointed_by(df: DataFrame, column: str) -> DataFrame:
    """`checkpointed`, dealt by a column in a way that Spark remembers: grouping by it shuffles these rows no more.

    Spark forgets how an adaptive plan dealt its rows, so this step is planned once and for all.
    """
    conf = df.sparkSession.conf
    parts, adaptive = int(conf.get("spark.sql.shuffle.partitions")), conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return checkpointed(df.repartition(parts, column))
    finally:
        conf.set("spark.sql.adaptive.enabled", adaptive)


def free_unused(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files and checkpoints of frames that nobody holds any more.

    Its cleaner learns of them from the driver's garbage collection, which a driver with
    little to do runs too rarely for the executors' disks; and the JVM learns only once a
    second which objects Python holds no more. A call takes one and a half seconds, so it
    belongs after steps that wrote much.
    """
    gc.collect()
    time.sleep(1.2)
    spark.sparkContext._jvm.System.gc()
