"""Leak-free splits: whole coils go to one side, the same way on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..functions.session import materialised
from .selection import share_cut


def coil_families(events: DataFrame) -> DataFrame:
    """Per coil: any() of each label, and its primary family."""
    flags = [F.coalesce(F.bool_or(label), F.lit(False)).alias(label) for label in C.LABELS]
    return events.groupBy("coil_id").agg(*flags).withColumn("family", X.primary_label())


def family_coverage(events: DataFrame) -> DataFrame:
    """Distinct coils, and coils with a positive label of each family.

    One row per coil first, then plain sums: no multi-distinct row expansion.
    """
    return coil_families(events).agg(
        F.count("coil_id").alias("coils"),
        *[F.count(F.when(F.col(label), 1)).alias(f"coils_{f}") for f, label in zip(C.FAMILIES, C.LABELS)],
    )


def can_carve(coverage) -> bool:
    return coverage["coils"] >= C.MIN_COILS


def can_freeze(coverage) -> bool:
    """Freeze the held-out set only once every family is represented well enough."""
    return all(coverage[f"coils_{family}"] >= C.MIN_FAMILY_COILS for family in C.FAMILIES)


def _lowest_share(coils: DataFrame, stratum: str, share: float, seed: int) -> DataFrame:
    """ceil(share · n) coils of each stratum: those with the lowest seeded hash.

    The cut is an order statistic, so no stratum is ever sorted in one task. Coils that
    share the cut's hash value stay together.
    """
    hashed = coils.withColumn("hash", X.coil_hash(seed))
    cuts = share_cut(hashed, stratum, "hash", share).select(
        F.col(stratum).alias("of_stratum"), "cut"
    )
    # One row per stratum: the four families, `normal`, or the single word `all`.
    joined = hashed.join(F.broadcast(cuts), F.col(stratum) == F.col("of_stratum"))
    return joined.where(F.col("hash") <= F.col("cut")).select("coil_id", stratum)


def holdout_coils(
    events: DataFrame, share: float = C.HOLDOUT_SHARE, seed: int = C.HOLDOUT_SEED
) -> DataFrame:
    """Held-out coils, stratified by primary family; unstratified if a stratum has one coil."""
    coils = materialised(coil_families(events).select("coil_id", "family"))
    sizes = [row["count"] for row in coils.groupBy("family").count().collect()]
    if sizes and min(sizes) < 2:
        coils = coils.withColumn("family", F.lit("all"))
    return _lowest_share(coils, "family", share, seed)


def validation_coils(
    events: DataFrame, share: float = C.VALIDATION_SHARE, seed: int = C.VALIDATION_SEED
) -> DataFrame:
    coils = materialised(events.select("coil_id").distinct().withColumn("side", F.lit("validation")))
    return _lowest_share(coils, "side", share, seed)


def rows_of(events: DataFrame, coils: DataFrame) -> DataFrame:
    return events.join(coils.select("coil_id"), "coil_id", "left_semi")


def rows_without(events: DataFrame, coils: DataFrame) -> DataFrame:
    return events.join(coils.select("coil_id"), "coil_id", "left_anti")
