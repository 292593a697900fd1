"""Running totals and previous-row reads over one global order, without a one-task window.

Rows are range-partitioned by the order and stored, so each partition is a contiguous and
equally large piece of the order whatever the keys' skew. Windows run inside a piece; what
crosses a border is carried by a summary with one row per piece and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.session import materialised, shuffle_width, small_side

PIECE = "_piece"


def pieces(df: DataFrame, *order) -> DataFrame:
    """Stored rows with the number of their piece; pieces follow the order."""
    ranged = df.repartitionByRange(shuffle_width(df.sparkSession), *order)
    return materialised(ranged.withColumn(PIECE, F.spark_partition_id()))


def inside(groups: list[str], *order):
    return W.partitionBy(*groups, PIECE).orderBy(*order)


def across(groups: list[str]):
    """All earlier pieces of the group; used on the summary only."""
    return W.partitionBy(*groups).orderBy(PIECE).rowsBetween(W.unboundedPreceding, -1)


def running_totals(df: DataFrame, order: list, sums: list[str]) -> DataFrame:
    """`upto_<name>` = inclusive running sum of each named column over the whole order."""
    cut = pieces(df, *order)
    totals = cut.groupBy(PIECE).agg(*[F.sum(name).alias(name) for name in sums])
    before = totals.select(
        F.col(PIECE),
        *[
            F.coalesce(F.sum(name).over(across([])), F.lit(0)).alias(f"before_{name}")
            for name in sums
        ],
    )
    window = inside([], *order).rowsBetween(W.unboundedPreceding, 0)
    return cut.join(small_side(before), PIECE).select(
        *df.columns,
        *[
            (F.col(f"before_{name}") + F.sum(name).over(window)).alias(f"upto_{name}")
            for name in sums
        ],
    )
