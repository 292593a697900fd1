"""Exact order statistics that never gather a group into one task.

`percentile` keeps every distinct value of a group in one hash map. Here a group's rows are
first reduced to (value, count) pairs, on the map side. For continuous measures a quantile
sketch brackets the wanted ranks first: rows outside the brackets are only counted, so two
scans and a very small shuffle give the exact value.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.session import materialised, small_side

SKETCH_ACCURACY = 10_000
# Half widths of the brackets, in errors of the sketch; groups that miss a rank get the next one,
# and after the last one all their values.
MARGINS = (3.0, 30.0, 300.0)


def _pick_ranks(counts: DataFrame, groups: list[str], positions: dict[str, object]) -> DataFrame:
    """Values at fractional positions, interpolated between the two neighbours.

    `counts` holds groups, slot, exact, cnt. A position is an expression over `n`. `sure` tells
    whether all wanted ranks lay among the exact values; without that the values mean nothing.
    """
    everything = W.partitionBy(*groups)
    ordered = everything.orderBy("slot", F.desc("exact")).rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.select(
        *groups, "slot", "exact",
        F.sum("cnt").over(ordered).alias("upto"),
        F.sum("cnt").over(everything).alias("n"),
        "cnt",
    )
    aggregates = [F.max("n").alias("n")]
    for name, position in positions.items():
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("upto") - F.col("cnt") <= rank) & (rank < F.col("upto"))
            aggregates += [
                F.max(F.when(here, F.col("slot"))).alias(f"{name}_{side}"),
                F.min(F.when(here, F.col("exact"))).alias(f"{name}_{side}_exact"),
            ]
    found = ranked.groupBy(*groups).agg(*aggregates)

    def value(name, position):
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return low + (high - low) * (position - F.floor(position))

    sure = reduce(and_, [F.col(f"{name}_{side}_exact") for name in positions for side in ("lo", "hi")])
    return found.select(
        *groups, "n", *[value(name, pos).alias(name) for name, pos in positions.items()],
        F.coalesce(sure, F.lit(False)).alias("sure"),
    )


def _positions(probs: dict[str, float]):
    return {name: F.lit(p) * (F.col("n") - 1) for name, p in probs.items()}


def percentiles_of_steps(
    df: DataFrame, groups: list[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Exact interpolated percentiles of a measure with a fixed step, such as whole ms.

    A group has at most range / step distinct values; after the map-side count that is all
    a task ever sorts (and the sort spills).
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, F.col(value).cast("double").alias("slot"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("exact", F.lit(True))
    )
    return _pick_ranks(counts, groups, _positions(probs)).drop("sure")


def _same_group(left: DataFrame, right: DataFrame, groups: list[str]):
    return reduce(and_, [left[g].eqNullSafe(right[f"of_{g}"]) for g in groups])


def _selected(values: DataFrame, groups: list[str], probs: list[float], positions, accuracy: int, margins) -> DataFrame:
    """The exact values at the positions, from brackets that are widened where they missed.

    A row per group is stored and looked at after each try; only groups that missed are read again.
    """
    found = None
    for margin in (*margins, None):
        counts = _bracketed(values, groups, probs, accuracy, margin)
        tried = materialised(_pick_ranks(counts, groups, positions))
        hit = tried.where("sure").drop("sure")
        found = hit if found is None else found.unionByName(hit)
        missed = tried.where("NOT sure").select(*[F.col(g).alias(f"of_{g}") for g in groups])
        if missed.isEmpty():
            return found
        values = values.join(small_side(missed), _same_group(values, missed, groups), "left_semi")
    return found


def _bracketed(values: DataFrame, groups: list[str], probs: list[float], accuracy: int, errors: float | None):
    """(group, slot, exact, cnt): exact values near the wanted ranks, totals elsewhere.

    The sketch errs by at most n/accuracy ranks, the brackets allow `errors` times that. Groups too
    small for that margin keep all their (few) values; without a margin every group does.
    """
    if errors is None:
        return values.groupBy(*groups, F.col("value").alias("slot")).agg(F.count(F.lit(1)).alias("cnt")).withColumn(
            "exact", F.lit(True)
        )
    margin = errors / accuracy
    edges = [min(1.0, max(0.0, p + side * margin)) for p in probs for side in (-1, 1)]
    sketch = small_side(
        values.groupBy(*[F.col(g).alias(f"of_{g}") for g in groups]).agg(
            F.count(F.lit(1)).alias("size"),
            F.percentile_approx("value", edges, accuracy).alias("edge"),
        )
    )
    joined = values.join(sketch, _same_group(values, sketch, groups))
    value, edge = F.col("value"), F.col("edge")
    inside = [
        (F.lit(True) if p <= margin else value >= edge[2 * i])
        & (F.lit(True) if p >= 1 - margin else value <= edge[2 * i + 1])
        for i, p in enumerate(probs)
    ]
    exact = (F.col("size") <= 4 * accuracy) | reduce(or_, inside)
    # A row outside all brackets stands at the nearest bracket end below it.
    below = [F.when(value > edge[2 * i + 1], edge[2 * i + 1]) for i in range(len(probs))]
    elsewhere = F.coalesce(F.greatest(*below, F.lit(float("-inf"))), F.lit(float("-inf")))
    return (
        joined.select(*groups, F.when(exact, value).otherwise(elsewhere).alias("slot"),
                      exact.alias("exact"))
        .groupBy(*groups, "slot", "exact")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def percentiles(
    df: DataFrame,
    groups: list[str],
    measures: list[str],
    probs: dict[str, float],
    accuracy: int = SKETCH_ACCURACY,
    margins=MARGINS,
) -> DataFrame:
    """Exact interpolated percentiles of continuous measures: a row per group and measure."""
    pairs = [
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
        for m in measures
    ]
    values = df.select(*groups, F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
    keys = [*groups, "measure"]
    return _selected(values, keys, list(probs.values()), _positions(probs), accuracy, margins)


def share_cut(
    df: DataFrame, group: str, value: str, share: float, accuracy: int = SKETCH_ACCURACY, margins=MARGINS
) -> DataFrame:
    """Per group the value at rank ceil(share · n): rows up to it make up the share."""
    values = df.select(group, F.col(value).cast("double").alias("value"))
    position = F.ceil(F.lit(share) * F.col("n")) - 1
    return _selected(values, [group], [share], {"cut": position}, accuracy, margins)
