"""Coils to inspect, the alarm ticker and the profile of one coil."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..sources.tables import newest_batches
from .latest import latest, worst_stand

_SEEN = ["anomaly_score", *C.PROBABILITIES, "model_version", "ts", "u_anomaly", "u_votes"]


def flagged_coils(df: DataFrame, threshold) -> DataFrame:
    """Coils flagged by the model or by the detectors' vote, with their worst stand.

    Two aggregations: replayed copies collapse to one row per (coil, stand) before the
    shuffle, then at most one row per stand is folded into the coil. The worst stand and
    the coil totals come from the same pass, so there is no join of the two.
    """
    events = latest(df.select("coil_id", "stand", "reading_id", *_SEEN), ["coil_id", "stand"])
    payload = F.struct(
        "stand", "anomaly_score", "model_version", "ts",
        X.predicted_family().alias("predicted_fault"),
    )
    alarm = X.is_alarm(threshold)
    coils = events.groupBy("coil_id").agg(
        F.max_by(payload, F.struct("anomaly_score", -F.col("stand"))).alias("worst"),
        F.max("anomaly_score").alias("max_score"),
        F.bool_or("u_anomaly").alias("unsup_flag"),
        F.max("u_votes").alias("u_votes"),
        F.count(F.when(alarm, 1)).alias("stands_alarmed"),
        F.min(F.when(alarm, F.col("stand"))).alias("first_stand"),
    )
    model_flag = F.col("max_score") >= threshold
    return coils.where(model_flag | F.col("unsup_flag")).select(
        "coil_id",
        F.col("worst.anomaly_score").alias("confidence"),
        F.col("worst.predicted_fault").alias("predicted_fault"),
        F.col("worst.stand").alias("worst_stand"),
        "first_stand", "stands_alarmed",
        F.col("worst.model_version").alias("model_version"),
        F.col("worst.ts").alias("ts"),
        F.coalesce(model_flag, F.lit(False)).alias("model_flag"),
        F.coalesce("unsup_flag", F.lit(False)).alias("unsup_flag"),
        "u_votes", "max_score",
    )


def _by_urgency(coils: DataFrame, limit: int) -> DataFrame:
    return coils.orderBy(
        F.desc("model_flag"), F.desc_nulls_last("max_score"), F.desc_nulls_last("u_votes"),
        F.asc("coil_id"),
    ).limit(limit)


def coils_to_inspect(df: DataFrame, threshold, limit: int = 100) -> DataFrame:
    """The most urgent flagged coils; the fault is shown only where the model flags."""
    by_model, by_vote = F.col("model_flag"), F.col("unsup_flag")
    who = F.when(by_model & by_vote, "both").when(by_model, "model").otherwise("ensemble")
    return _by_urgency(flagged_coils(df, threshold), limit).select(
        "coil_id", "confidence",
        F.when(by_model, F.col("predicted_fault")).alias("predicted_fault"),
        "worst_stand", "first_stand", "stands_alarmed", "model_version", "ts",
        "model_flag", "unsup_flag", "u_votes", who.alias("flagged_by"),
    )


def inspection_board(df: DataFrame, threshold, limit: int = 50) -> DataFrame:
    """The same list with the wording of the dashboard table."""
    by_model = F.col("model_flag")
    vote_text = F.concat(F.lit("ensemble "), F.col("u_votes").cast("string"), F.lit("/3"))
    who = (
        F.when(by_model & F.col("unsup_flag"), "model + ensemble")
        .when(by_model, "model")
        .otherwise(vote_text)
    )
    return _by_urgency(flagged_coils(df, threshold), limit).select(
        F.col("coil_id").alias("coil"),
        F.when(by_model, F.col("predicted_fault")).otherwise("unsupervised").alias("fault"),
        who.alias("flagged_by"),
        X.half_up(F.col("confidence") * 100, 1).alias("confidence_pct"),
        "worst_stand",
        F.col("first_stand").alias("first_flagged"),
        "stands_alarmed",
    )


def resorted(inspect: DataFrame, column: str, ascending: bool = False) -> DataFrame:
    """Sort the inspection list by one column, unknown values last in either direction.

    A confidence that comes from the vote alone counts as unknown.
    """
    key = F.col(column)
    if column == "confidence":
        key = F.when(F.col("model_flag"), key)
    order = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    return inspect.orderBy(order, F.asc("coil_id"))


def alarm_ticker(df: DataFrame, threshold, limit: int = 25) -> DataFrame:
    """Newest alarms first."""
    alarm = X.is_alarm(threshold)
    return (
        newest_batches(df, alarm, limit)
        .where(alarm)
        .orderBy(F.desc("reading_id"))
        .limit(limit)
        .select(
            "reading_id", "ts", "coil_id", "stand", "anomaly_score",
            X.dominant_family().alias("family"),
        )
    )


def with_age(ticker: DataFrame, anchor) -> DataFrame:
    seconds = F.greatest(X.seconds_between(anchor, F.col("ts")), F.lit(0.0))
    return ticker.withColumn("age", X.age_text(seconds))


PROFILE = [
    "stand", "ts", "force", "torque", "gap", "tension_in", "tension_out", "anomaly_score",
    *C.PROBABILITIES, *C.LABELS, "y_any", "model_version",
]


def coil_profile(df: DataFrame, coil_id) -> DataFrame:
    """Latest row of each stand of one coil."""
    rows = df.where(F.col("coil_id") == coil_id).select("coil_id", "reading_id", *PROFILE)
    return latest(rows, ["coil_id", "stand"]).select(*PROFILE)


__all__ = [
    "alarm_ticker", "coil_profile", "coils_to_inspect", "flagged_coils", "inspection_board",
    "resorted", "with_age", "worst_stand",
]
