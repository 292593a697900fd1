"""Session settings the package relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast table is at most this many narrow rows; larger ones are joined by shuffle.
BROADCAST_ROWS = 20_000


def utc(spark: SparkSession) -> SparkSession:
    """Timestamps without zone are read and written as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one only for a local session."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rollsight-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """Store a result once, as a table in the shared folder, and read it back.

    Several branches then see the same rows, a lost executor costs no recomputation, readers
    fetch only the columns they need and the planner knows the true size.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, "stored")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Store a summary table and mark it for broadcast only if its row count allows it."""
    ensure_checkpoint_dir(df.sparkSession)
    stored = df.checkpoint()
    return F.broadcast(stored) if stored.count() <= limit else stored


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
