"""Detector state of a running stream: a small table per micro-batch, one row per stand.

A state row holds the moments that the batch detectors carry from block to block, about the
stand's first mean, the reference rows and the two distance moments. A micro-batch is one block:
it joins the state of the newest batch before it, is scored where the rows are, and the state
moves on by aggregation and the same closed form. Nothing of it passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.session import materialised, small_side
from ..operators.detectors import (
    NARROW_ROWS, _remaining, _with_ridge_on_first, block_stats, score_rows, tail_rows, watched,
)
from ..plans.registry import numbered_folders

STATE_SCHEMA = (
    "stand int, n_seen long, pivot array<double>, moments array<double>, "
    "reference array<array<double>>, distance_moments array<double>"
)
# Of older states this many stay readable, so that replayed batches find theirs.
KEPT_STATES = 10
ROW = "_row"


def state_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The state that the newest batch before this one left; without rows at the start."""
    earlier = [b for b in numbered_folders(spark, path, "batch_id") if b < batch_id]
    if not earlier:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(f"{path}/batch_id={earlier[-1]}")


def save_state(state: DataFrame, path: str, batch_id: int) -> None:
    """Write the state of a batch and remove what lies more than KEPT_STATES batches back."""
    spark = state.sparkSession
    state.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    kept = numbered_folders(spark, path, "batch_id")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for old in [b for b in kept if b < batch_id][:-KEPT_STATES]:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={old}")
        folder.getFileSystem(conf).delete(folder, True)


def advance(
    events: DataFrame, state: DataFrame, signals, params: C.DetectorParams = C.DetectorParams()
) -> tuple[DataFrame, DataFrame]:
    """Score one micro-batch and move the state on: (`_row` with scores, new state).

    `events` is a stored batch whose rows are numbered in `_row`. Stands are whatever the rows
    hold; a stand without rows keeps its state.
    """
    rows = watched(
        events.withColumns({"block": F.lit(0), "reading_id": F.col(ROW)}), signals,
        "stand", "block", "ts", "reading_id", "coil_id",
    )
    state = state.withColumnsRenamed({"pivot": "old_pivot", "moments": "old_moments"})
    averages = F.array(*[F.avg(s) for s in signals])
    pivot = rows.groupBy("stand").agg(averages.alias("own")).join(state, "stand", "left").select(
        "stand", F.coalesce("old_pivot", "own").alias("pivot")
    )
    stats = block_stats(rows, signals, small_side(pivot))
    joined = stats.join(state.select("stand", "n_seen", "old_moments", "reference"), "stand", "left")
    fresh = F.col("old_moments").isNull()
    # The ridge belongs to a stand's first block only; `_first` is read where there is no state.
    first = _with_ridge_on_first(joined, signals, params).select("stand", F.col("moments").alias("_first"))
    mixed = F.zip_with(
        "old_moments", "moments",
        lambda old, new: old + (1 - _remaining(params.alpha, F.col("n"))) * (new - old),
    )
    states = materialised(
        joined.join(first, "stand").select(
            "stand", "block", "n", "pivot", F.coalesce("n_seen", F.lit(0)).alias("n_before"),
            F.col("old_moments").alias("before"), "reference",
            F.when(fresh, F.col("_first")).otherwise(mixed).alias("after"),
        )
    )
    refs = states.select("stand", "block", F.explode("reference").alias("z"))
    scored = materialised(score_rows(rows, states.drop("reference"), refs, signals, ["reading_id"], params))
    start = F.array(F.lit(0.0), F.lit(1.0))
    held = small_side(
        state.select("stand", F.coalesce("distance_moments", start).alias("d")), NARROW_ROWS
    )
    spread = F.sqrt(F.greatest(F.col("d")[1] - F.col("d")[0] * F.col("d")[0], F.lit(params.distance_floor)))
    scores = scored.join(held, "stand", "left").select(
        F.col("reading_id").alias(ROW), "u_maha", "u_spc",
        F.coalesce((F.col("distance") - F.col("d")[0]) / spread, F.lit(0.0)).alias("u_knn"),
    )
    distances = scored.groupBy("stand").agg(
        F.count("distance").alias("n_near"), F.avg("distance").alias("first"),
        F.avg(F.col("distance") * F.col("distance")).alias("second"),
    )
    tails = tail_rows(rows, states, signals, params).groupBy("stand").agg(
        F.sort_array(F.collect_list(F.struct("position", "z"))).alias("tail")
    )
    near_share = 1 - _remaining(params.alpha, F.col("n_near"))
    d = F.coalesce("distance_moments", start)
    moved = F.array(*[d[k] + near_share * (F.col(name) - d[k]) for k, name in enumerate(("first", "second"))])
    none = F.array().cast("array<array<double>>")
    together = F.concat(F.coalesce("reference", none), F.expr("transform(tail, t -> t.z)"))
    after = (
        states.join(tails, "stand").join(distances, "stand").join(state.select("stand", "distance_moments"), "stand", "left")
        .select(
            "stand", (F.col("n_before") + F.col("n")).alias("n_seen"), "pivot", F.col("after").alias("moments"),
            F.slice(together, F.greatest(F.size(together) - params.buffer + 1, F.lit(1)), params.buffer).alias("reference"),
            F.when(F.col("n_near") > 0, moved).otherwise(d).alias("distance_moments"),
        )
    )
    idle = state.withColumnsRenamed({"old_pivot": "pivot", "old_moments": "moments"})
    idle = idle.join(states.select("stand"), "stand", "left_anti")
    return scores, after.unionByName(idle)
