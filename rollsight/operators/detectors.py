"""Model-free detectors: Mahalanobis distance, control-chart z and nearest-neighbour distance.

Each stand has an adaptive state that a block of events updates after the block is scored.
A block is an event-time bucket in batch and a micro-batch in a stream. Instead of walking
the blocks one by one, the state before every block is computed in closed form:

1. `block_stats`   one row per (stand, block): count, means, second moments;
2. `ewma_before`   the recurrence  M' = (1 − β) M + β b  as prefix sums over those rows;
3. `buffers`       per block the last 300 standardised rows before it;
4. `score_rows`    rows meet the state of their block and are scored in parallel. A block
                   that holds many rows is dealt out to as many groups as it needs.

Second moments are kept relative to a pivot near the stand's mean, where the covariance
(second moment minus squared mean) loses no digits.
"""

from __future__ import annotations

import math
from dataclasses import asdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..functions.session import materialised, small_side

# Rows one Python group scores at a time.
GROUP_ROWS = 50_000

# Rows whose distance table (rows × 300) stays inside a core's cache.
SLICE = 512

# An old state whose weight is e^-FADED is below any rounding, and e^FADED is no overflow.
FADED = 200.0

# Narrow per-block tables (a few numbers a row) may be broadcast up to this many rows.
NARROW_ROWS = 500_000


def with_block(df: DataFrame, every_s: int) -> DataFrame:
    """Number the fixed event-time buckets that act as blocks."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return df.withColumn("block", F.floor(micros / F.lit(every_s * 1_000_000)).cast("long"))


def _diagonal(count: int) -> list[int]:
    """Where the second moment of each signal stands in a moments array."""
    return [count + k for k, (i, j) in enumerate(_pairs(count)) if i == j]


def watched(df: DataFrame, signals, *keep: str) -> DataFrame:
    return df.selectExpr(*keep, *[f"{X.usable(s)} AS `{s}`" for s in signals])


def _pairs(count: int):
    return [(i, j) for i in range(count) for j in range(i, count)]


def pivots(rows: DataFrame, signals) -> DataFrame:
    """A fixed point per stand near its mean; any value gives the same scores."""
    averages = ", ".join(f"avg(`{s}`)" for s in signals)
    return small_side(rows.groupBy("stand").agg(F.expr(f"array({averages}) AS pivot")))


def block_stats(rows: DataFrame, signals, pivot: DataFrame | None = None) -> DataFrame:
    """(stand, block): `n`, `pivot`, `moments` = shifted means, then shifted second moments.

    Plain sums with map-side combine: a block with most of the rows costs no more than
    others after the combine.
    """
    pivot = pivots(rows, signals) if pivot is None else pivot
    # Scalar, never-NULL pivots keep the 65 sums free of array reads and null branches; sums
    # instead of averages halve the buffers, so the aggregation is still compiled.
    count = len(signals)
    flat = pivot.selectExpr("stand", *[f"coalesce(pivot[{i}], 0.0D) AS p{i}" for i in range(count)])
    joined = rows.join(flat, "stand").selectExpr(
        "stand", "block", *[f"`{s}` - p{i} AS x{i}" for i, s in enumerate(signals)]
    )
    terms = [f"x{i}" for i in range(count)] + [f"x{i} * x{j}" for i, j in _pairs(count)]
    sums = joined.groupBy("stand", "block").agg(
        F.count(F.lit(1)).alias("n"), *[F.expr(f"sum({t}) AS m{k}") for k, t in enumerate(terms)]
    )
    moments = ", ".join(f"m{k} / n" for k in range(len(terms)))
    return sums.selectExpr("stand", "block", "n", f"array({moments}) AS moments").join(pivot, "stand")


def block_moments(stats: DataFrame, signals) -> DataFrame:
    """Readable form of the statistics: a row per (stand, block, signal)."""
    index = _diagonal(len(signals))
    rows = ", ".join(
        f"struct('{s}' AS signal, moments[{i}] + pivot[{i}] AS mean, "
        f"moments[{index[i]}] - moments[{i}] * moments[{i}] AS variance)"
        for i, s in enumerate(signals)
    )
    return stats.selectExpr("stand", "block", "n", f"inline(array({rows}))")


def fade_samples(alpha: float) -> int:
    """Samples after which an old state no longer weighs anything."""
    if not 0 < alpha < 1:
        raise ValueError("the rate per sample lies between 0 and 1")
    return max(1, math.ceil(FADED / -math.log1p(-alpha)))


def _remaining(alpha: float, samples):
    """(1 − α)^samples."""
    return F.exp(samples * F.lit(math.log1p(-alpha)))


def ewma_before(blocks: DataFrame, alpha: float, prior=None) -> DataFrame:
    """State before and after every block: adds `n_before`, `before`, `after`.

    `blocks` holds stand, block, n and an array column `moments`, which is consumed; other
    columns are kept. With `prior` (an array
    column or None) the state starts there; without it the first block sets the state and
    `before` is NULL for it.

    Within a chunk of `fade_samples` the recurrence is a prefix sum of terms scaled by
    (1 − α)^-samples, which stays far from overflow; a chunk starts from the states of the
    two chunks before it, as all earlier ones have faded out. The windows see one row per
    block and moment, whose number depends on the time span, not on the row count.
    """
    fade = fade_samples(alpha)
    by_stand = W.partitionBy("stand").orderBy("block")
    ahead = by_stand.rowsBetween(W.unboundedPreceding, -1)
    counted = blocks.withColumn("n_before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    counted = counted.withColumn("chunk", F.floor(F.col("n_before") / fade))
    start = F.col("chunk") * fade
    weight = 1 - _remaining(alpha, F.col("n"))
    if prior is None:
        weight = F.when(F.col("n_before") == 0, 1.0).otherwise(weight)
    ends_inside = F.col("n_before") + F.col("n") < start + fade
    scaled = F.when(
        ends_inside, F.col("value") * F.col("beta") / _remaining(alpha, F.col("n_before") + F.col("n") - start)
    ).otherwise(0.0)
    first = F.lit(None).cast("array<double>") if prior is None else prior
    kept = [name for name in counted.columns if name not in ("stand", "block", "moments", "chunk")]
    long = counted.select(
        "stand", "block", *kept, "chunk",
        weight.alias("beta"), first.alias("prior"), F.posexplode("moments").alias("k", "value"),
    )
    # All windows share the partitioning by (stand, moment): one shuffle, no join.
    by_moment = W.partitionBy("stand", "k").orderBy("block")
    in_chunk = W.partitionBy("stand", "k", "chunk").orderBy("block")
    earlier = in_chunk.rowsBetween(W.unboundedPreceding, -1)
    # `own`: the state before the block if its chunk had started from zero; `own_after` after it.
    state = long.withColumns({
        "own": F.coalesce(F.sum(scaled).over(earlier), F.lit(0.0))
        * _remaining(alpha, F.col("n_before") - start),
        "chunk_start": F.first("n_before").over(in_chunk),
    })
    state = state.withColumn(
        "own_after", F.col("own") * (1 - F.col("beta")) + F.col("beta") * F.col("value")
    )
    # A chunk's first row sees how the chunk before it ended, and so on one chunk further.
    state = state.withColumns({
        "last": F.lag("own_after").over(by_moment), "last_start": F.lag("chunk_start").over(by_moment),
    })
    state = state.withColumns({
        "one": F.first("last").over(in_chunk), "one_start": F.first("last_start").over(in_chunk),
    })
    state = state.withColumn("last", F.lag("one").over(by_moment))
    state = state.withColumn("two", F.first("last").over(in_chunk))
    carry = (
        F.coalesce("one", F.lit(0.0))
        + F.coalesce(F.col("two") * _remaining(alpha, F.col("chunk_start") - F.col("one_start")), F.lit(0.0))
        + F.coalesce(F.col("prior")[F.col("k")], F.lit(0.0)) * _remaining(alpha, F.col("chunk_start"))
    )
    state = state.withColumn(
        "before",
        F.col("own") + carry * _remaining(alpha, F.col("n_before") - F.col("chunk_start")),
    )
    state = state.withColumn(
        "after", F.col("before") * (1 - F.col("beta")) + F.col("beta") * F.col("value")
    )
    # As many values as there are moments: at most 65 per block.
    found = state.groupBy("stand", "block").agg(
        *[F.any_value(name).alias(name) for name in kept],
        F.sort_array(F.collect_list(F.struct("k", "before", "after"))).alias("all"),
    )
    found = found.select(
        "stand", "block", *kept, F.col("all.before").alias("before"), F.col("all.after").alias("after")
    )
    if prior is None:
        found = found.withColumn("before", F.when(F.col("n_before") > 0, F.col("before")))
    return found


def _with_ridge_on_first(stats: DataFrame, signals, params) -> DataFrame:
    """The first block's covariance carries the ridge."""
    count = len(signals)
    diagonal = _diagonal(count)
    size = count + len(_pairs(count))
    ridge = ", ".join(f"{params.ridge if k in diagonal else 0.0!r}D" for k in range(size))
    first = F.min("block").over(W.partitionBy("stand")) == F.col("block")
    lifted = F.expr(f"zip_with(moments, array({ridge}), (value, extra) -> value + extra)")
    return stats.withColumn("moments", F.when(first, lifted).otherwise(F.col("moments")))


def block_states(stats: DataFrame, signals, params=C.DetectorParams()) -> DataFrame:
    """State of each stand before and after each block, from the block statistics."""
    return ewma_before(_with_ridge_on_first(stats, signals, params), params.alpha)


def _mean_and_sd(moments: str, signals, floor: float) -> list[tuple[str, str]]:
    """Per signal (mean, standard deviation) out of a state vector, as SQL text."""
    return [
        (
            f"({moments}[{i}] + pivot[{i}])",
            f"sqrt(greatest({moments}[{d}] - {moments}[{i}] * {moments}[{i}], {floor!r}D))",
        )
        for i, d in enumerate(_diagonal(len(signals)))
    ]


def ewma_means(states: DataFrame, signals, params=C.DetectorParams()) -> DataFrame:
    """The adaptive mean and deviation after each block, a row per signal."""
    scale = _mean_and_sd("after", signals, params.variance_floor)
    rows = ", ".join(
        f"struct('{s}' AS signal, {mean} AS mean, {sd} AS sd)" for s, (mean, sd) in zip(signals, scale)
    )
    return states.selectExpr("stand", "block", "n_before", f"inline(array({rows}))")


def tail_rows(rows: DataFrame, states: DataFrame, signals, params=C.DetectorParams()) -> DataFrame:
    """The last `buffer` rows of each block, standardised by the state after their block.

    The rank limit is applied on the map side, so a task ships at most `buffer` rows of a
    block; `back` counts from the block's end.
    """
    newest = W.partitionBy("stand", "block").orderBy(F.desc("ts"), F.desc("reading_id"))
    tails = rows.withColumn("back", F.row_number().over(newest)).where(F.col("back") <= params.buffer)
    state = states.select("stand", "block", "n", "n_before", "pivot", "after")
    scale = _mean_and_sd("after", signals, params.variance_floor)
    z = ", ".join(f"(`{s}` - {mean}) / {sd}" for s, (mean, sd) in zip(signals, scale))
    return tails.join(state, ["stand", "block"]).select(
        "stand", "block", "reading_id", "back",
        (F.col("n_before") + F.col("n") - F.col("back")).alias("position"),
        F.expr(f"array({z}) AS z"),
    )


def buffers(tails: DataFrame, states: DataFrame, params=C.DetectorParams()) -> DataFrame:
    """Rows each block is compared with: those at positions n_before − 300 … n_before − 1.

    Positions count a stand's rows from its start. Rows and blocks meet by an equi-join on
    position // 300: a block's buffer touches two such cells, so the intermediate result is
    at most twice the buffers themselves.
    """
    size = params.buffer
    cells = states.where(F.col("n_before") >= params.warmup).select(
        "stand", F.col("block").alias("for_block"), "n_before",
        F.explode(
            F.sequence(
                F.floor(F.greatest(F.col("n_before") - size, F.lit(0)) / size),
                F.floor((F.col("n_before") - 1) / size),
            )
        ).alias("cell"),
    )
    placed = tails.withColumn("cell", F.floor(F.col("position") / size))
    met = placed.join(cells, ["stand", "cell"]).where(
        F.col("position").between(F.col("n_before") - size, F.col("n_before") - 1)
    )
    return met.select("stand", F.col("for_block").alias("block"), "reading_id", "position", "z")


def _full(upper: np.ndarray, count: int) -> np.ndarray:
    square = np.zeros((count, count))
    for value, (i, j) in zip(upper, _pairs(count)):
        square[i, j] = square[j, i] = value
    return square


def nearest_mean(z: np.ndarray, buffer: np.ndarray, neighbours: int) -> np.ndarray:
    """Mean distance of each row to its nearest buffer rows, a slice of rows at a time."""
    k = min(neighbours, len(buffer))
    found = np.empty(len(z))
    for at in range(0, len(z), SLICE):
        part = z[at : at + SLICE]
        squares = np.zeros((len(part), len(buffer)))
        for column in range(z.shape[1]):
            gap = part[:, column, None] - buffer[None, :, column]
            squares += gap * gap
        nearest = np.partition(squares, k - 1, axis=1)[:, :k]
        found[at : at + SLICE] = np.sqrt(nearest).mean(axis=1)
    return found


class Yardstick:
    """One state, prepared once for all rows that are measured by it.

    The covariance with its ridge is brought to unit diagonal, so that signals of any size are
    treated alike, and split into principal axes; along them the Mahalanobis distance is a plain
    sum of squares. Axes without any spread do not count.
    """

    def __init__(self, mean: np.ndarray, cov: np.ndarray, params: C.DetectorParams):
        ridged = cov + params.ridge * np.eye(len(mean))
        unit = np.sqrt(np.maximum(ridged.diagonal(), params.variance_floor))
        spread, axes = np.linalg.eigh(ridged / np.outer(unit, unit))
        usable = spread > 1e-14
        self.mean, self.axes = mean, axes[:, usable] / np.sqrt(spread[usable]) / unit[:, None]
        self.scale = np.sqrt(np.maximum(cov.diagonal(), params.variance_floor))

    def measure(self, x: np.ndarray):
        """(Mahalanobis distance squared, largest z, all z) of rows."""
        gaps = x - self.mean
        z = gaps / self.scale
        return np.square(gaps @ self.axes).sum(axis=1), np.abs(z).max(axis=1), z


def score_rows(rows: DataFrame, states: DataFrame, refs: DataFrame, signals, keys, params):
    """u_maha, u_spc and the raw neighbour distance of every row.

    Rows and states are brought together per (stand, block, deal). The number of deals
    follows from the block's size, so no group exceeds about GROUP_ROWS rows. Rows of a block
    before the warm-up, or without a state to compare with, score zero; the distance is NULL
    there and while a stand has fewer than `least_buffer` reference rows.
    """
    deals = F.ceil(F.col("n") / GROUP_ROWS).cast("int")
    sizes = small_side(states.select("stand", "block", deals.alias("deals")), NARROW_ROWS)
    deal = F.pmod(F.xxhash64("reading_id"), F.col("deals")).cast("int").alias("deal")
    left = rows.join(sizes, ["stand", "block"]).select("stand", "block", deal, *keys, *signals)
    gathered = refs.groupBy("stand", "block").agg(F.collect_list("z").alias("buffer"))
    ready = (F.col("n_before") >= params.warmup) & F.col("before").isNotNull() & F.col("buffer").isNotNull()
    # Every group of rows meets one state row, those that score zero too.
    right = states.join(gathered, ["stand", "block"], "left").select(
        F.col("stand").alias("of_stand"), F.col("block").alias("of_block"), "pivot",
        ready.alias("ready"), F.coalesce("before", F.array().cast("array<double>")).alias("before"),
        F.coalesce("buffer", F.array().cast("array<array<double>>")).alias("buffer"),
        F.explode(F.sequence(F.lit(0), deals - 1)).alias("of_deal"),
    )
    settings, count, names = asdict(params), len(signals), list(signals)

    def score(events: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        out = events[["stand", "block", *keys]].copy()
        if len(out) == 0 or len(state) == 0 or not state["ready"].iloc[0]:
            return out.assign(u_maha=0.0, u_spc=0.0, distance=np.nan)
        setup, held = C.DetectorParams(**settings), state.iloc[0]
        shift = np.asarray(held["before"][:count], dtype="float64")
        cov = _full(np.asarray(held["before"][count:], dtype="float64"), count) - np.outer(shift, shift)
        yardstick = Yardstick(shift + np.asarray(held["pivot"], dtype="float64"), cov, setup)
        maha, spc, z = yardstick.measure(events[names].to_numpy("float64"))
        buffer = np.stack([np.asarray(z, dtype="float64") for z in held["buffer"]])
        near = np.nan
        if len(buffer) >= setup.least_buffer:
            near = nearest_mean(z, buffer, setup.neighbours)
        return out.assign(u_maha=maha, u_spc=spc, distance=near)

    types = dict(left.dtypes)
    schema = ", ".join(
        [f"`{k}` {types[k]}" for k in ["stand", "block", *keys]]
        + ["u_maha double", "u_spc double", "distance double"]
    )
    states_by_deal = right.groupBy("of_stand", "of_block", "of_deal")
    scored = left.groupBy("stand", "block", "deal").cogroup(states_by_deal).applyInPandas(score, schema)
    return scored.withColumn("distance", F.nanvl("distance", F.lit(None).cast("double")))


def standardised(scored: DataFrame, params=C.DetectorParams()) -> DataFrame:
    """u_knn: the distance against its own adaptive mean and variance before the block."""
    scored = materialised(scored)
    blocks = scored.where("distance IS NOT NULL").groupBy("stand", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(F.avg("distance"), F.avg(F.col("distance") * F.col("distance"))).alias("moments"),
    )
    blocks = materialised(blocks)
    start = F.array(F.lit(0.0), F.lit(1.0))
    states = small_side(
        ewma_before(blocks, params.alpha, start).select("stand", "block", F.col("before").alias("d")),
        NARROW_ROWS,
    )
    variance = F.col("d")[1] - F.col("d")[0] * F.col("d")[0]
    sd = F.sqrt(F.greatest(variance, F.lit(params.distance_floor)))
    return scored.join(states, ["stand", "block"], "left").withColumn(
        "u_knn", F.coalesce((F.col("distance") - F.col("d")[0]) / sd, F.lit(0.0))
    ).drop("d", "distance")


def detector_scores(
    df: DataFrame,
    every_s: int = 60,
    signals=tuple(C.PROCESS_SIGNALS),
    keys=("reading_id",),
    params: C.DetectorParams = C.DetectorParams(),
) -> DataFrame:
    """u_maha, u_spc, u_knn and the vote for every row; zeros until a stand is warm."""
    keys = [k for k in keys if k != "stand"]
    rows = with_block(df, every_s)
    rows = watched(rows, signals, "stand", "block", "ts", *keys)
    stats = materialised(block_stats(rows, signals))
    states = materialised(block_states(stats, signals, params))
    refs = buffers(tail_rows(rows, states, signals, params), states, params)
    scored = standardised(score_rows(rows, states, refs, signals, keys, params), params)
    return scored.withColumn("u_votes", X.votes()).withColumn("u_anomaly", F.col("u_votes") >= C.VOTES_NEEDED)
