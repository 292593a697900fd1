"""Windowed KPIs, alarm rates, latency and freshness."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..sources.tables import DAY
from .selection import percentiles_of_steps


def wall_clock(now=None) -> Column:
    """`now` as a column; pass a value to repeat a result."""
    if now is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(now if isinstance(now, datetime) else str(now)).cast("timestamp_ntz")


def stream_anchor(df: DataFrame) -> Column:
    """max(ts) as a scalar; with day folders only the newest day is scanned for it."""
    if DAY in df.columns:
        newest = df.agg(F.max(DAY).alias("day")).scalar()
        df = df.where(F.col(DAY) == newest)
    return df.agg(F.max("ts").alias("anchor")).scalar()


def recent(df: DataFrame, length: str, inclusive: bool = False) -> DataFrame:
    """Rows of the last `length` of stream time: ts > max(ts) − length (>= if inclusive)."""
    start = stream_anchor(df) - F.expr(f"interval {length}")
    ts = F.col("ts")
    rows = df.where(ts >= start if inclusive else ts > start)
    return rows.where(F.col(DAY) >= F.to_date(start)) if DAY in df.columns else rows


def window_coils(df: DataFrame, every: str, threshold: float) -> DataFrame:
    """First KPI level: one row per window and coil. Keys are spread by coil, so a window
    holding most of the rows still combines on the map side and shuffles by coil."""
    return df.groupBy(F.window("ts", every).alias("window"), "coil_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.when(X.is_alarm(threshold), 1).otherwise(0)).alias("anomalies"),
    )


def window_totals(per_coil: DataFrame, threshold: float) -> DataFrame:
    """Second KPI level: a row per window."""
    totals = per_coil.groupBy("window").agg(
        F.count("coil_id").alias("coils"),
        F.sum("events").alias("events"),
        F.sum("anomalies").alias("anomalies"),
    )
    return totals.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "coils", "events", "anomalies",
        (F.col("anomalies").cast("double") / F.col("events")).alias("anomaly_rate"),
        F.lit(float(threshold)).alias("threshold"),
    )


def kpi_windows(
    df: DataFrame, every: str = C.KPI_WINDOW, threshold: float = C.KPI_THRESHOLD
) -> DataFrame:
    """Tumbling-window KPIs: distinct coils, events, alarms and their rate."""
    return window_totals(window_coils(df, every, threshold), threshold)


def stand_rollup(df: DataFrame, threshold, length: str = "10 seconds") -> DataFrame:
    """The last seconds per stand; a stand without events appears with zeros."""
    over = {"u_maha": C.MAHA_CUT, "u_spc": C.SPC_CUT, "u_knn": C.KNN_CUT}
    measured = (
        recent(df, length)
        .where(F.col("stand").isin(*C.STANDS))
        .groupBy("stand")
        .agg(
            F.count(F.lit(1)).alias("events"),
            X.share(X.is_alarm(threshold)).alias("alarm_rate"),
            *[F.avg(name).alias(name) for name in C.PROBABILITIES],
            F.avg("force").alias("force"),
            F.avg("work_roll_mileage").alias("work_roll_mileage"),
            F.max("model_version").alias("model_version"),
            X.share_or_zero(F.col("u_anomaly")).alias("u_rate"),
            *[
                X.share_or_zero(F.col(name) > cut).alias(f"{name}_rate")
                for name, cut in over.items()
            ],
        )
    )
    stands = df.sparkSession.range(1, len(C.STANDS) + 1).select(F.col("id").cast("int").alias("stand"))
    zeroed = ["events", "alarm_rate", "u_rate", *[f"{name}_rate" for name in over]]
    # At most one measured row per contract stand: the broadcast has five rows or fewer.
    joined = stands.join(F.broadcast(measured), "stand", "left")
    return joined.fillna(0, subset=zeroed).withColumn("dominant", X.dominant_family())


def stand_status(rollup: DataFrame) -> DataFrame:
    """Lamps, wear and the label shown per stand."""
    percent = X.wear_percent(F.col("work_roll_mileage"))
    alarmed = (F.col("events") > 0) & (F.col("alarm_rate") >= 0.02)
    return rollup.select(
        "stand", "events", "alarm_rate",
        X.lamp(F.col("events"), F.col("alarm_rate")).alias("lamp"),
        X.lamp(F.col("events"), F.col("u_rate")).alias("ensemble_lamp"),
        F.when(alarmed, F.col("dominant")).alias("family_shown"),
        percent.alias("wear_percent"),
        X.wear_band(percent).alias("wear_band"),
    )


def alarm_rate_by_stand(df: DataFrame, threshold: float) -> DataFrame:
    rates = df.groupBy("stand").agg(X.share(X.is_alarm(threshold)).alias("alarm_rate"))
    return rates.select(
        F.concat(F.lit("Stand "), F.col("stand").cast("string")).alias("stand_name"), "alarm_rate"
    )


def rate_per_minute(df: DataFrame, flag: Column, name: str) -> DataFrame:
    return df.groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute")).agg(
        X.share(flag).alias(name)
    )


def anomaly_rate_per_minute(df: DataFrame, threshold: float) -> DataFrame:
    return rate_per_minute(df, X.is_alarm(threshold), "anomaly_rate")


def unsupervised_rate_per_minute(df: DataFrame) -> DataFrame:
    return rate_per_minute(df, F.col("u_anomaly"), "unsup_rate")


def with_latency(df: DataFrame) -> DataFrame:
    """Whole microseconds from event to stored row, the step that timestamps have."""
    arrived, happened = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("ingested_at", "ts"))
    return df.withColumn("latency_us", arrived - happened)


def latency_per_minute(df: DataFrame) -> DataFrame:
    """Exact p50 and p95 latency, in seconds, per minute of stream time."""
    rows = with_latency(df.where(F.col("ingested_at").isNotNull())).select(
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"), "latency_us"
    )
    found = percentiles_of_steps(rows, ["minute"], "latency_us", {"p50": 0.5, "p95": 0.95})
    return found.select("minute", *[(F.col(p) / 1_000_000).alias(p) for p in ("p50", "p95")])


def latency_recent(df: DataFrame, length: str = "60 seconds", now=None) -> DataFrame:
    """p50 and p95 latency in ms over rows recent in stream time and in wall-clock time.

    Always one row; NULL when nothing qualifies or the table has no arrival time.
    """
    names = {"latency_ms_p50": 0.5, "latency_ms_p95": 0.95}
    if "ingested_at" not in df.columns:
        return df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(name) for name in names])
    arrived = F.col("ingested_at") > wall_clock(now) - F.expr(f"interval {length}")
    rows = with_latency(recent(df, length).where(arrived)).select(
        F.lit("all").alias("scope"), "latency_us"
    )
    found = percentiles_of_steps(rows, ["scope"], "latency_us", names)
    return found.agg(*[(F.max(name) / 1000).alias(name) for name in names])


def coils_total(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count("coil_id").alias("coils_total"))


def throughput(kpis: DataFrame) -> DataFrame:
    """Events per second of each KPI window; a window counts as one second at least."""
    length = F.greatest(X.seconds_between(F.col("window_end"), F.col("window_start")), F.lit(1.0))
    return kpis.select(
        F.col("window_start"), F.round(F.col("events") / length, 0).alias("events_per_s")
    )


def latest_kpi(kpis: DataFrame) -> DataFrame:
    """The newest window and its coils per minute (NULL for a window without length)."""
    length = X.seconds_between(F.col("window_end"), F.col("window_start"))
    speed = F.when(length > 0, F.bround(F.col("coils") * 60.0 / length, 1))
    newest = kpis.orderBy(F.desc("window_end")).limit(1)
    return newest.withColumn("coils_per_min", speed)


def freshness(df: DataFrame, now=None, live_s: float = 8.0, idle_s: float = 60.0) -> DataFrame:
    """Seconds since the newest event, and what they mean."""
    newest = df.sparkSession.range(1).select(stream_anchor(df).alias("anchor_ts"))
    seconds = X.seconds_between(wall_clock(now), F.col("anchor_ts"))
    return newest.select(
        "anchor_ts",
        seconds.alias("freshness_s"),
        F.coalesce(seconds < live_s, F.lit(False)).alias("live"),
        F.coalesce(seconds > idle_s, F.lit(False)).alias("stream_idle"),
    )
