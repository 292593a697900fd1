"""The drift policy: decide from stored events whether to train again."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from .evaluation import family_counts
from .rates import recent, stream_anchor, wall_clock


def effective_threshold(registry: DataFrame, fallback: float = C.FALLBACK_THRESHOLD) -> DataFrame:
    """Threshold of the newest version; the fallback without one (0 counts as missing)."""
    newest = registry.agg(F.max_by("threshold", "version").alias("threshold"))
    known = F.nullif(F.col("threshold"), F.lit(0.0))
    return newest.select(F.coalesce(known, F.lit(fallback)).alias("threshold"))


def newest_version(registry: DataFrame) -> DataFrame:
    return registry.agg(
        F.max("version").alias("version"),
        F.max_by("threshold", "version").alias("threshold"),
        F.max_by("trained_at", "version").alias("trained_at"),
    )


def live_recall_counts(scored: DataFrame, threshold, window: str = "3 minutes") -> DataFrame:
    """Positives and catches per family over the last window of stream time."""
    return family_counts(recent(scored, window, inclusive=True), threshold)


def drift_decision(
    scored: DataFrame, registry: DataFrame, policy: C.DriftPolicy = C.DriftPolicy(), now=None
) -> DataFrame:
    """One row: `fire`, `reason` and the live recall of each family (NULL without faults).

    Guards in order: no model, no events, idle stream, young model; then the recall floor.
    """
    clock = wall_clock(now)
    model = newest_version(registry)
    threshold = model.select("threshold").scalar()
    counts = live_recall_counts(scored, threshold, policy.window)
    idle = X.seconds_between(clock, stream_anchor(scored))
    age = X.seconds_between(clock, model.select("trained_at").scalar())
    facts = counts.select(
        "*",
        model.select("version").scalar().alias("version"),
        idle.alias("idle_s"),
        age.alias("age_s"),
    )

    def recall(family):
        positives = F.col(f"{family}_pos")
        return F.when(positives > 0, F.col(f"{family}_caught") / positives)

    def drifted(family):
        enough = F.col(f"{family}_pos") >= policy.min_positives
        return F.coalesce(enough & (recall(family) < policy.recall_floor), F.lit(False))

    named = [
        F.when(
            drifted(family),
            F.format_string(
                f"{family} %.2f of %d faults", recall(family), F.col(f"{family}_pos")
            ),
        )
        for family in C.FAMILIES
    ]
    healthy = [
        F.when(
            recall(family).isNotNull(),
            F.concat(F.lit(f"{family} "), F.round(recall(family), 3).cast("string")),
        )
        for family in C.FAMILIES
    ]
    any_drift = reduce(or_, [drifted(family) for family in C.FAMILIES])
    summary = F.concat_ws(", ", *healthy)
    guarded = (
        F.when(F.lit(not policy.enabled), F.lit("off by configuration"))
        .when(F.col("version").isNull(), F.lit("nothing published so far"))
        .when(F.col("idle_s").isNull(), F.lit("no event stored so far"))
        .when(
            F.col("idle_s") > policy.max_idle_s,
            F.format_string("last event %.0f s ago", F.col("idle_s")),
        )
        .when(
            F.col("age_s") < policy.min_interval_s,
            F.format_string("newest version published %.0f s ago", F.col("age_s")),
        )
    )
    verdict = F.when(
        any_drift, F.concat(F.lit("recall too low: "), F.concat_ws(", ", *named))
    ).otherwise(
        F.concat(
            F.lit("recall in order: "),
            F.when(summary == "", "no confirmed fault to judge by").otherwise(summary),
        )
    )
    return facts.select(
        (guarded.isNull() & any_drift).alias("fire"),
        F.coalesce(guarded, verdict).alias("reason"),
        *[F.round(recall(family), 3).alias(f"recall_{family}") for family in C.FAMILIES],
    )


def hot_swap_gap(scored: DataFrame, registry: DataFrame, length: str = "10 seconds") -> DataFrame:
    """Registered against scoring version; a gap means the new model is still being loaded."""
    live = recent(scored, length).agg(F.max("model_version").alias("live_version"))
    both = live.select(
        "live_version", registry.agg(F.max("version").alias("v")).scalar().alias("latest_version")
    )
    swapping = F.coalesce(F.col("latest_version") > F.col("live_version"), F.lit(False))
    return both.withColumn("swapping", swapping)


def swap_phases(snapshots: DataFrame) -> DataFrame:
    """Phase of each snapshot (`snapshot_at, live_version, latest_version`): `swap` while a
    newer version is registered, `flash` on the first change after it, then `sync`.

    Snapshots are one row per poll; the window orders that log, not the events.
    """
    order = W.orderBy("snapshot_at")
    pair = F.struct("live_version", "latest_version")
    changed = snapshots.withColumn("_previous", F.lag(pair).over(order)).where(
        F.col("_previous").isNull() | ~pair.eqNullSafe(F.col("_previous"))
    )
    swapping = F.coalesce(F.col("latest_version") > F.col("live_version"), F.lit(False))
    before = F.coalesce(F.lag(swapping).over(order), F.lit(False))
    phase = F.when(swapping, "swap").when(before, "flash").otherwise("sync")
    return changed.withColumn("phase", phase).drop("_previous")
