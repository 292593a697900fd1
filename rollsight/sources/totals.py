"""Running totals of the stored events: one small row per micro-batch instead of a read of the store.

A batch adds its number of events, its first and last event time and the coils that no earlier batch
held. Each row depends on the batch and on older rows alone, so a replayed batch writes its row again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import small_side
from .markers import numbers
from .tables import append_batch, read_batches

SCHEMA = "events long, min_ts timestamp_ntz, max_ts timestamp_ntz, new_coils long"


def _older(spark: SparkSession, path: str, batch_id: int) -> list[str]:
    return [f"{path}/coils/batch_id={n}" for n in numbers(spark, f"{path}/coils", "batch_id") if n < batch_id]


def add_batch(events: DataFrame, path: str, batch_id: int) -> None:
    """Add a stored batch (coil_id, ts) to the totals below `path`.

    Known coils are looked up among those between the batch's least and greatest id; the stored ids are
    sorted, so files of other ranges are skipped. Null coils count as none.
    """
    spark = events.sparkSession
    span = events.agg(F.count(F.lit(1)), F.min("ts"), F.max("ts"), F.min("coil_id"), F.max("coil_id")).first()
    coils = events.where("coil_id IS NOT NULL").select("coil_id").distinct()
    older = _older(spark, path, batch_id)
    if older and span[3] is not None:
        known = spark.read.schema("coil_id long").parquet(*older).where(F.col("coil_id").between(span[3], span[4]))
        met = known.join(small_side(coils), "coil_id", "left_semi")
        coils = coils.join(met, "coil_id", "left_anti")
    append_batch(coils.sortWithinPartitions("coil_id"), f"{path}/coils", batch_id, by_day=False)
    new = spark.read.schema("coil_id long").parquet(f"{path}/coils/batch_id={batch_id}").count()
    row = spark.createDataFrame([(span[0], span[1], span[2], new)], SCHEMA).coalesce(1)
    append_batch(row, f"{path}/rows", batch_id, by_day=False)


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """One row: events_total, coils_total, first_ts and anchor_ts; zeros and nulls before any batch."""
    if numbers(spark, f"{path}/rows", "batch_id"):
        rows = read_batches(spark, f"{path}/rows")
    else:
        rows = spark.createDataFrame([], SCHEMA)
    return rows.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("events_total"),
        F.coalesce(F.sum("new_coils"), F.lit(0)).alias("coils_total"),
        F.min("min_ts").alias("first_ts"), F.max("max_ts").alias("anchor_ts"),
    )
