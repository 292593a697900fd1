"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node and a join, so a hub only ever meets one row; the joins leave a
hub's links to adaptive skew splitting. Before the first step each partition replaces its links
by a spanning forest of them, which keeps what is connected and drops what is redundant.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import materialised

FOREST_ROWS = 500_000
_LINK = "hi long, lo long"


def _forest(batches):
    """Spanning links of the rows held at once, each node to the smallest node of its tree."""

    def shrink(rows):
        above: dict[int, int] = {}

        def top(x):
            root = x
            while above.get(root, root) != root:
                root = above[root]
            while above.get(x, x) != root:
                above[x], x = root, above[x]
            return root

        for a, b in rows:
            a, b = top(a), top(b)
            if a != b:
                above[max(a, b)] = min(a, b)
        found = [(x, top(x)) for x in above]
        return pd.DataFrame(found, columns=["hi", "lo"], dtype="int64")

    held = []
    for batch in batches:
        held.extend(zip(batch["hi"].tolist(), batch["lo"].tolist()))
        if len(held) >= FOREST_ROWS:
            yield shrink(held)
            held = []
    if held:
        yield shrink(held)


def _smallest(links: DataFrame, node: str, other: str) -> DataFrame:
    return materialised(links.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("low")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node goes to the smallest node around it."""
    both = links.select("hi", "lo").unionAll(links.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
    low = _smallest(both, "u", "v").select("node", F.least("node", "low").alias("low"))
    return (
        both.where("v > u")
        .join(low, F.col("u") == F.col("node"))
        .select(F.col("v").alias("hi"), F.col("low").alias("lo"))
        .where("hi > lo").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, go to its smallest neighbour."""
    low = _smallest(links, "hi", "lo")
    moved = links.join(low, F.col("hi") == F.col("node")).select("lo", "low").toDF("hi", "lo")
    own = low.select(F.col("node").alias("hi"), F.col("low").alias("lo"))
    return moved.unionAll(own).where("hi > lo").distinct()


def _signature(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every linked node and the smallest node it can reach.

    `links` holds two columns of 64-bit node numbers. Links of a node to itself, repeated links
    and links with a null end change nothing; without links the result is empty. A component's
    smallest node is returned with itself as root.
    """
    pairs = links.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo"))
    pairs = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("hi > lo")
    stars = materialised(pairs.mapInPandas(_forest, _LINK).distinct())
    seen = _signature(stars)
    while True:
        stars = materialised(_small_star(materialised(_large_star(stars))))
        now = _signature(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select("lo").distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        roots.select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    )
