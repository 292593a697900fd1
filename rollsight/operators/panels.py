"""Analytical panels: distributions, attribution, control charts, tension and roll wear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..functions.session import small_side
from .evaluation import precision_recall
from .latest import latest
from .ordered import PIECE, across, inside, pieces
from .selection import percentiles


def score_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    """Scores of the newest model, faults against normal rows."""
    newest = df.agg(F.max("model_version").alias("v")).scalar()
    last_bin = F.lit(bins - 1).cast("long")
    scored = df.where(F.col("model_version") == newest)
    return scored.groupBy(
        F.least(F.floor(F.col("anomaly_score") * bins), last_bin).alias("bin"), "y_any"
    ).agg(F.count(F.lit(1)).alias("events"))


def live_precision_recall(df: DataFrame, threshold: float) -> DataFrame:
    rows = df.select("coil_id", "stand", "reading_id", "anomaly_score", "y_any")
    return precision_recall(latest(rows, ["coil_id", "stand"]), threshold)


def confusion_matrix(df: DataFrame, threshold: float) -> DataFrame:
    return df.groupBy("y_any", X.is_alarm(threshold).alias("predicted")).agg(
        F.count(F.lit(1)).alias("events")
    )


def precision_recall_over_time(df: DataFrame, threshold: float, unit: str = "minute") -> DataFrame:
    moment = F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("moment")
    return precision_recall(df, threshold, moment).select("moment", "precision", "recall")


def family_mix(df: DataFrame) -> DataFrame:
    """Events per true primary family."""
    family = X.primary_label().alias("family")
    return df.groupBy(family).agg(F.count(F.lit(1)).alias("events"))


def fault_attribution(df: DataFrame, threshold: float) -> DataFrame:
    """True primary family against the predicted one, over alarmed rows."""
    return df.where(X.is_alarm(threshold)).groupBy(
        X.primary_label().alias("actual"), X.predicted_family().alias("predicted")
    ).agg(F.count(F.lit(1)).alias("events"))


def first_stand_histogram(df: DataFrame, threshold: float) -> DataFrame:
    """At which stand a coil raises its first alarm."""
    first = df.where(X.is_alarm(threshold)).groupBy("coil_id").agg(F.min("stand").alias("first_stand"))
    return first.groupBy("first_stand").agg(F.count(F.lit(1)).alias("coils"))


def medians_by_stand(df: DataFrame, measures=("force", "torque", "gap")) -> DataFrame:
    """Exact medians, a row per stand."""
    long = percentiles(df, ["stand"], list(measures), {"median": 0.5})
    picked = [
        F.max(F.when(F.col("measure") == m, F.col("median"))).alias(f"median_{m}") for m in measures
    ]
    return long.groupBy("stand").agg(*picked)


def control_limits(df: DataFrame, measure: str = "force", sigmas: float = 3.0) -> DataFrame:
    limits = df.groupBy("stand").agg(
        F.avg(measure).alias("center"), F.stddev_samp(measure).alias("sigma")
    )
    return limits.select(
        "stand", "center",
        (F.col("center") - sigmas * F.col("sigma")).alias("lower"),
        (F.col("center") + sigmas * F.col("sigma")).alias("upper"),
    )


def control_chart(df: DataFrame, measure: str = "force", sigmas: float = 3.0) -> DataFrame:
    """Every reading with its stand's limits. The limits are aggregated and joined back, so
    a stand's rows are never gathered as a window over the stand would."""
    limits = small_side(control_limits(df, measure, sigmas))
    value = F.col(measure)
    outside = (value < F.col("lower")) | (value > F.col("upper"))
    return df.join(limits, "stand").select(
        "reading_id", "ts", "stand", measure, "center", "lower", "upper",
        F.coalesce(outside, F.lit(False)).alias("out_of_control"),
    )


def tension_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("stand").agg(
        F.avg("tension_in").alias("tension_in"), F.avg("tension_out").alias("tension_out")
    )


def roll_campaigns(df: DataFrame) -> DataFrame:
    """Mileage saw-tooth per stand: a drop is a roll change and starts a new campaign.

    A row without mileage is kept and is no change; the row after it is none either.

    The order (stand, ts, reading_id) is cut into equal pieces; each piece needs only the
    last mileage and the number of changes before it, from a summary of the pieces.
    """
    order = ["stand", "ts", "reading_id"]
    mileage = F.col("work_roll_mileage")
    rows = df.select(*order, "force", "work_roll_mileage")
    cut = pieces(rows, *order)
    in_piece = inside(["stand"], "ts", "reading_id")
    stepped = cut.withColumn("_before", F.lag(mileage).over(in_piece))
    key = F.struct("ts", "reading_id")
    summary = stepped.groupBy("stand", PIECE).agg(
        F.max_by("work_roll_mileage", key).alias("last_mileage"),
        F.min_by("work_roll_mileage", key).alias("first_mileage"),
        F.count(F.when(mileage < F.col("_before"), 1)).alias("drops"),
    )
    by_piece = W.partitionBy("stand").orderBy(PIECE)
    carried = summary.withColumn("carry", F.lag("last_mileage").over(by_piece)).select(
        "stand", PIECE, "carry",
        (F.col("drops") + F.when(F.col("first_mileage") < F.col("carry"), 1).otherwise(0)).alias("changes"),
    )
    carried = carried.select(
        F.col("stand").alias("of_stand"), F.col(PIECE).alias("of_piece"), "carry",
        F.coalesce(F.sum("changes").over(across(["stand"])), F.lit(0)).alias("changes_before"),
    )
    small = small_side(carried.withColumnRenamed("of_piece", "_of_piece"))
    joined = stepped.join(
        small,
        stepped["stand"].eqNullSafe(small["of_stand"]) & (stepped[PIECE] == small["_of_piece"]),
    )
    # Only a piece's first row looks across the border; a missing mileage is not looked past.
    first = F.row_number().over(in_piece) == 1
    before = F.when(first, F.col("carry")).otherwise(F.col("_before"))
    changed = joined.withColumn("roll_change", F.coalesce(mileage < before, F.lit(False)))
    so_far = in_piece.rowsBetween(W.unboundedPreceding, 0)
    campaign = F.col("changes_before") + F.sum(F.col("roll_change").cast("int")).over(so_far)
    return changed.select(
        *order, "work_roll_mileage", "force", "roll_change", campaign.alias("campaign")
    )


def version_annotations(registry: DataFrame) -> DataFrame:
    """A mark and its text for each model hot-swap."""
    text = F.concat(
        F.lit("model v"), F.col("version").cast("string"), F.lit(" · F1 "),
        X.half_up(F.col("overall_f1"), 2).cast("decimal(10,2)").cast("string"),
    )
    return registry.where(F.col("version") >= 1).select(F.col("trained_at").alias("time"), text.alias("text"))


def model_history(registry: DataFrame) -> DataFrame:
    names = [n for n in [f.name for f in C.REGISTRY_SCHEMA] if n in registry.columns]
    return registry.select(*names).orderBy("version")
