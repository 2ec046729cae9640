"""Session set-up and the two ways lineage is cut: checkpoint() in the shared folder, or a written table."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "12g", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench. On a cluster the driver's own session is used."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("claimloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir; a local one only on a local master and where the setting is absent."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not sc.master.startswith(("local[", "local-cluster[")) and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "claimloom-checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there; a lost executor loses nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder for tables beside the checkpoints, where all executors can write."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/tables-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
