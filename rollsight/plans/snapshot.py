"""The operational snapshot: everything the live view shows, as a dict of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import drift as D
from ..operators import inspection as I
from ..operators import rates as A
from ..operators.panels import model_history


def snapshot_rates(
    scored: DataFrame,
    kpis: DataFrame,
    threshold,
    now=None,
    short: str = "10 seconds",
    latency: str = "60 seconds",
    rollup: DataFrame | None = None,
    totals_row: DataFrame | None = None,
) -> DataFrame:
    """One row of vitals: event and coil speed, totals, vote rate, freshness, latency.

    `totals_row` (`sources.totals.read_totals`) gives the coils so far and the newest event time
    without a read of all events.
    """
    stands = A.stand_rollup(scored, threshold, short) if rollup is None else rollup
    events, voted = F.sum("events"), F.sum(F.col("events") * F.col("u_rate"))
    totals = stands.agg(
        events.alias("events_recent"),
        F.when(events > 0, F.bround(voted / events, 4)).otherwise(F.lit(0.0)).alias("unsup_rate_recent"),
        F.max("model_version").alias("live_version"),
    )
    origin = F.lit("2000-01-01").cast("timestamp_ntz")
    length_s = X.seconds_between(origin + F.expr(f"interval {short}"), origin)
    if totals_row is None:
        whole = scored.agg(F.count_distinct("coil_id").alias("coils_total")).select(
            "coils_total", A.stream_anchor(scored).alias("anchor_ts")
        )
    else:
        whole = totals_row.select("coils_total", "anchor_ts")
    speed = A.latest_kpi(kpis).select(
        F.col("window_start").alias("kpi_start"), F.col("window_end").alias("kpi_end"),
        F.col("coils").alias("kpi_coils"), "coils_per_min",
    )

    def row(part: DataFrame):
        """A one-row (or empty) result as a scalar struct."""
        return part.select(F.struct("*").alias("row")).scalar()

    vitals = totals.select(
        "*",
        row(whole).alias("whole"),
        row(speed).alias("kpi"),
        row(A.latency_recent(scored, latency, now)).alias("latency"),
    )
    return vitals.select(
        "whole.anchor_ts", "events_recent",
        F.bround(F.col("events_recent") / length_s, 1).alias("events_per_s"),
        "kpi.coils_per_min", "whole.coils_total", "unsup_rate_recent",
        X.seconds_between(A.wall_clock(now), F.col("whole.anchor_ts")).alias("freshness_s"),
        "latency.latency_ms_p50", "latency.latency_ms_p95", "kpi.kpi_start", "kpi.kpi_end",
        "kpi.kpi_coils", "live_version",
    )


def snapshot(
    scored: DataFrame, kpis: DataFrame, registry: DataFrame, now=None, totals_row: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Stands, ticker, coils to inspect, vitals and model history.

    The anchor (newest event time) restricts every read but the ticker and the totals to
    the last minutes of the stream.
    """
    threshold = D.effective_threshold(registry).scalar()
    stands = A.stand_rollup(scored, threshold)
    return {
        "stands": stands,
        "stand_status": A.stand_status(stands),
        "ticker": I.with_age(I.alarm_ticker(scored, threshold), A.stream_anchor(scored)),
        "inspect": I.coils_to_inspect(A.recent(scored, "15 minutes"), threshold),
        "rates": snapshot_rates(scored, kpis, threshold, now, rollup=stands, totals_row=totals_row),
        "model": model_history(registry),
        "threshold": D.effective_threshold(registry),
        "hot_swap": D.hot_swap_gap(scored, registry),
    }
