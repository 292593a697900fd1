"""Every operator as a named query over the driver's tables.

The functions under test are the library's; this module only binds them to the fixture
views, gives the parameters of the check (days instead of seconds, a pinned clock) and
rounds averages whose last digits depend on summation order.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..operators import detectors as D
from ..operators import drift as R
from ..operators import evaluation as E
from ..operators import inspection as I
from ..operators import latest as L
from ..operators import panels as P
from ..operators import rates as A
from ..operators import splits as S
from ..sources import coils as K
from ..sources import fixtures as V
from ..sources import tables as T
from ..sources import wire as J
from ..sources.totals import read_totals
from ..functions.session import materialised, scratch_folder
from ..streaming import jobs as B
from . import policy as Q
from . import registry as G
from . import training as M
from .scoring import apply_model
from .snapshot import snapshot_rates

NOW = "2024-01-31 00:00:00"
DAY_S = 86_400
THRESHOLD = 0.85
SHORT, MIDDLE, LONG = "1 day", "3 days", "7 days"
TWO_SIGNALS = ("force", "gap")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(view: str | None = None, name: str | None = None):
    """Register a function under its name; it gets the named fixture view(s)."""

    def wrap(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if view is None:
                return function(spark, sf_dir)
            names = view.split()
            return function(*[getattr(V, name)(spark, sf_dir) for name in names])

        run.__name__ = name or function.__name__
        run.__doc__ = function.__doc__
        QUERIES[run.__name__] = run
        return function

    return wrap


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), digits) for name in names})


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


# --- sources, decoding, sinks -------------------------------------------------------------


@query()
def merge_sources(spark, sf_dir):
    orders = K.read_coil_parquet(spark, f"{sf_dir}/orders.parquet", 1)
    customers = K.read_coil_parquet(spark, f"{sf_dir}/customer.parquet", 2)
    parts = [
        orders.select("file_no", "row_index", F.col("o_totalprice").alias("force_1")),
        customers.select("file_no", "row_index", F.col("c_acctbal").alias("force_1")),
    ]
    return K.merge_sources(parts)


@query()
def coil_id_assign(spark, sf_dir):
    events = K.read_coil_parquet(V.utc(spark), f"{sf_dir}/events.parquet", 1)
    return K.assign_coil_ids(events).select("coil_id", "file_no", "event_id")


@query("coil_wide")
def seeded_shuffle(wide):
    return K.seeded_shuffle(wide).select("coil_id", "file_no", "shuffle_key", "force_1")


@query("coil_wide")
def unfold_per_stand(wide):
    return K.unfold(wide)


@query("coil_wide")
def unfold_ordered(wide):
    """Source order, then stand: the wide rows are sorted and unfolding keeps their order."""
    ordered = wide.withColumn("shuffle_key", K.shuffle_key()).orderBy("shuffle_key")
    return K.unfold(ordered, "shuffle_key").select(
        "shuffle_key", "coil_id", "stand", "force", "tension_in", "tension_out"
    )


@query("coil_wide")
def first_n_coils(wide):
    keyed = wide.withColumn("shuffle_key", K.shuffle_key())
    return K.unfold(K.first_coils(keyed, 100, "shuffle_key", "coil_id")).select(
        "coil_id", "stand", "force", "y_reduction"
    )


def _wire_events(readings):
    return readings.withColumn("ts_ms", F.unix_millis(F.col("ts").cast("timestamp")))


@query("readings")
def json_encode(readings):
    """Every field of the message, read back from its text."""
    sent = J.encode(_wire_events(readings))
    return sent.select(
        "key",
        *[F.get_json_object("value", f"$.{f.name}").cast(f.dataType).alias(f.name) for f in C.READING_SCHEMA],
    )


@query("readings")
def json_decode(readings):
    """Stand 2 sends garbage, stand 3 leaves a field out, stand 4 sends text for a number."""
    events = _wire_events(readings)
    value = F.col("value")
    damaged = (
        F.when(F.col("stand") == 2, F.lit("garbage"))
        .when(F.col("stand") == 3, F.replace(value, F.lit('"force":'), F.lit('"farce":')))
        .when(F.col("stand") == 4, F.regexp_replace(value, '"torque":[^,]*', '"torque":"x"'))
        .otherwise(value)
    )
    packed = F.to_json(F.struct(*[f.name for f in C.READING_SCHEMA]))
    raw = events.withColumn("value", packed).select(damaged.alias("value"))
    return J.keyed_only(J.decode(raw)).select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), "coil_id", "stand", "file_no", *C.SIGNALS, *C.LABELS,
    )


@query("readings")
def null_guard(readings):
    holes = readings.select(
        "reading_id",
        F.when(F.col("file_no") != 3, F.unix_millis(F.col("ts").cast("timestamp"))).alias("ts_ms"),
        F.when(~F.col("y_reduction"), F.col("coil_id")).alias("coil_id"),
        F.nullif(F.col("stand"), F.lit(4)).alias("stand"),
    )
    return J.keyed_only(holes)


@query("readings")
def to_sink_schema(readings):
    return T.to_sink_schema(readings)


@query("readings")
def retention_filter(readings):
    day = F.when(F.col("stand") != 5, F.to_date("ts"))
    kept = T.retained(readings.withColumn(T.DAY, day), 7)
    return kept.select("reading_id", F.col(T.DAY).cast("string").alias("ts_day"))


@query("readings")
def kpi_upsert(readings):
    """A later batch restates the windows of the third model with another threshold."""
    first = A.kpi_windows(readings, "1 hour", THRESHOLD).withColumn("batch_id", F.lit(0))
    third = readings.where(F.col("model_version") == 3)
    second = A.kpi_windows(third, "1 hour", 0.5).withColumn("batch_id", F.lit(1))
    return T.upserted(first.unionByName(second), ["window_start", "window_end"])


@query("registry")
def registry_upsert(registry):
    first = registry.withColumn("batch_id", F.lit(0))
    again = registry.where(F.col("version") >= 2).withColumns(
        {"batch_id": F.lit(1), "trained_on": F.lit("again"), "threshold": F.lit(0.5)}
    )
    return T.upserted(first.unionByName(again), ["version"])


# --- column expressions -------------------------------------------------------------------


@query("coil_wide")
def label_normalize(wide):
    names = [n for n in wide.columns if n.startswith("Anomaly_")]
    return wide.select("coil_id", *[X.is_true(F.col(n)).alias(n.lower()) for n in names])


@query("readings")
def y_any(readings):
    """The electric label is unknown at stand 2."""
    electric = F.when(F.col("stand") != 2, F.col("y_electric"))
    labels = [electric, *[F.col(n) for n in C.LABELS[1:]]]
    return readings.select("reading_id", X.any_label(*labels).alias("y_any"))


@query("readings")
def clean_features(readings):
    stand = F.col("stand")
    force = (
        F.when(stand == 1, F.lit(float("nan")))
        .when(stand == 2, F.lit(float("inf")))
        .when(stand == 3, F.lit(None))
        .when(stand == 4, F.lit(float("-inf")))
        .otherwise(F.col("force"))
    )
    others = [X.finite_or_zero(F.col(n)).alias(n) for n in C.SIGNALS if n != "force"]
    return readings.select("reading_id", X.finite_or_zero(force).alias("force"), *others)


@query("readings")
def contract_check(readings):
    C.check_contract(readings)
    names = C.FEATURES + C.LABELS
    counted = readings.agg(*[F.count(n).alias(n) for n in names])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), F.col(n).alias("known"))
        for i, n in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))


@query("readings")
def label_matrix(readings):
    bits = F.transform(X.label_array(), lambda flag: flag.cast("int").cast("string"))
    return readings.select("reading_id", F.array_join(bits, "").alias("labels"))


@query("readings")
def vote_2of3(readings):
    return readings.select("reading_id", X.votes().alias("u_votes"), X.voted().alias("u_anomaly"))


@query("readings")
def predicted_family(readings):
    return readings.select("reading_id", X.predicted_family().alias("family"))


@query("readings")
def dominant_family(readings):
    """No probability is known at stand 1, the bearing one is missing at stand 2."""
    stand = F.col("stand")
    holes = readings.withColumns(
        {p: F.when(stand != 1, F.col(p)) for p in C.PROBABILITIES if p != "p_bearing"}
        | {"p_bearing": F.when(stand > 2, F.col("p_bearing"))}
    )
    return holes.select("reading_id", X.dominant_family().alias("family"))


@query("readings")
def scalar_surface(readings):
    """All scalar functions of the surface side by side."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return readings.select(
        "reading_id",
        F.timestamp_millis(millis).cast("timestamp_ntz").alias("from_millis"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"),
        (F.col("ts") - F.expr("interval 15 minutes")).alias("earlier"),
        X.seconds_between(F.col("ingested_at"), F.col("ts")).alias("latency_s"),
        F.greatest(*C.PROBABILITIES).alias("best"),
        F.coalesce(F.nullif(F.col("gap"), F.lit(0.0)), F.lit(-1.0)).alias("gap_known"),
        X.half_up(F.col("force"), 1).cast("double").alias("force_1"),
        F.concat(F.lit("Stand "), F.col("stand").cast("string")).alias("stand_name"),
        F.col("y_any").cast("int").alias("y_int"),
        F.when(F.col("force") > 100, "high").otherwise("low").alias("band"),
        (F.col("y_electric") | F.col("y_bearing")).alias("either"),
    )


# --- aggregates and panels ----------------------------------------------------------------


@query("readings")
def kpi_windows(readings):
    return A.kpi_windows(readings, "1 hour", THRESHOLD)


@query("readings_big")
def kpi_windows_big(readings):
    return A.kpi_windows(readings, "1 day", 0.05)


@query("readings")
def stand_rollup_10s(readings):
    averages = [*C.PROBABILITIES, "force", "work_roll_mileage"]
    return rounded(A.stand_rollup(readings, THRESHOLD, SHORT), *averages)


@query("readings")
def stand_status(readings):
    return rounded(A.stand_status(A.stand_rollup(readings, THRESHOLD, SHORT)), "wear_percent")


@query("readings")
def alarm_rate_by_stand(readings):
    ranged = T.between_ts(readings, "2024-01-10 00:00:00", "2024-01-20 12:00:00")
    return A.alarm_rate_by_stand(ranged, THRESHOLD)


@query("readings")
def default_range(readings):
    """The half hour that a board shows unless told otherwise, and one with an end of its own."""
    latest = T.between_ts(readings, now="2024-01-20 12:00:00").withColumn("shown", F.lit("until now"))
    earlier = T.between_ts(readings, end="2024-01-10 06:30:00").withColumn("shown", F.lit("until its end"))
    return latest.unionByName(earlier).select("shown", "reading_id", "ts", "coil_id", "stand")


@query("readings")
def anomaly_rate_per_minute(readings):
    return A.anomaly_rate_per_minute(readings, THRESHOLD)


@query("readings")
def unsup_rate_per_minute(readings):
    return A.unsupervised_rate_per_minute(readings)


@query("readings")
def latency_per_minute(readings):
    return rounded(A.latency_per_minute(readings), "p50", "p95", digits=9)


@query("readings")
def latency_recent(readings):
    return rounded(A.latency_recent(readings, SHORT, NOW), "latency_ms_p50", "latency_ms_p95")


@query("readings")
def coils_total(readings):
    return A.coils_total(readings)


@query("readings")
def throughput_per_window(readings):
    return A.throughput(A.kpi_windows(readings, "1 hour", THRESHOLD))


@query("readings")
def latest_kpi(readings):
    return A.latest_kpi(A.kpi_windows(readings, "1 hour", THRESHOLD))


@query("readings")
def freshness(readings):
    return A.freshness(readings, NOW)


@query("readings", name="snapshot_rates")
def snapshot_vitals(readings):
    kpis = A.kpi_windows(readings, "1 hour", THRESHOLD)
    vitals = snapshot_rates(readings, kpis, THRESHOLD, NOW, SHORT, SHORT)
    return rounded(vitals, "latency_ms_p50", "latency_ms_p95")


@query("readings")
def score_histogram(readings):
    return P.score_histogram(readings)


@query("readings")
def live_prf(readings):
    return P.live_precision_recall(readings, THRESHOLD)


@query("readings")
def recall_by_family(readings):
    return E.family_rows(E.family_counts(readings, THRESHOLD))


@query("readings")
def confusion_matrix(readings):
    return P.confusion_matrix(readings, THRESHOLD)


@query("readings")
def pr_over_time(readings):
    return P.precision_recall_over_time(readings, THRESHOLD, "hour")


@query("readings")
def family_mix(readings):
    return P.family_mix(readings)


@query("readings")
def fault_attribution(readings):
    return P.fault_attribution(readings, THRESHOLD)


@query("readings")
def first_stand_histogram(readings):
    return P.first_stand_histogram(readings, THRESHOLD)


@query("readings")
def median_by_stand(readings):
    return rounded(P.medians_by_stand(readings), "median_force", "median_torque", "median_gap")


@query("readings_big")
def median_by_stand_big(readings):
    medians = P.medians_by_stand(readings, ("force", "torque"))
    return rounded(medians, "median_force", "median_torque")


@query("readings")
def spc_control_chart(readings):
    return rounded(P.control_chart(readings), "center", "lower", "upper")


@query("readings")
def tension_profile(readings):
    return rounded(P.tension_profile(readings), "tension_in", "tension_out")


@query("readings")
def roll_wear(readings):
    return P.roll_campaigns(readings)


# --- dedup, ranking, inspection -----------------------------------------------------------


@query("readings_numbered")
def latest_per_key(readings):
    return L.latest(readings, ["coil_id", "stand"])


@query("readings")
def worst_stand(readings):
    events = L.latest(readings, ["coil_id", "stand"])
    return L.worst_stand(events, "model_version", "reading_id")


@query("readings registry")
def coils_to_inspect(readings, registry):
    threshold = R.effective_threshold(registry).scalar()
    return I.coils_to_inspect(A.recent(readings, MIDDLE), threshold)


@query("readings")
def coils_inspect_board(readings):
    ranged = T.between_ts(readings, "2024-01-10 00:00:00", "2024-01-20 12:00:00")
    return as_double(I.inspection_board(ranged, THRESHOLD), "confidence_pct")


@query("readings")
def coils_flagged(readings):
    """The full list behind the inspection table, over the whole history."""
    return I.flagged_coils(readings, THRESHOLD)


@query("readings")
def inspect_sorted(readings):
    return I.resorted(I.coils_to_inspect(A.recent(readings, MIDDLE), THRESHOLD), "confidence", True)


@query("readings")
def alarm_ticker(readings):
    return I.with_age(I.alarm_ticker(readings, THRESHOLD), A.stream_anchor(readings))


@query("readings")
def ticker_delta(readings):
    """Rows past the last reading the second model scored."""
    seen = readings.where(F.col("model_version") == 2).agg(F.max("reading_id")).scalar()
    fresh = L.newest_above(readings.where(X.is_alarm(THRESHOLD)), seen, 40)
    return fresh.select("reading_id", "coil_id", "stand", "anomaly_score")


@query("readings")
def coil_profile(readings):
    """The coil of the newest reading."""
    newest = readings.agg(F.max_by("coil_id", "reading_id")).scalar()
    return I.coil_profile(readings, newest)


# --- registry and drift -------------------------------------------------------------------


@query("registry")
def model_history(registry):
    return P.model_history(registry)


@query("registry")
def next_version(registry):
    return L.next_version(registry)


@query("registry")
def version_delta(registry):
    return L.version_changes(registry, C.FAMILY_RECALLS)


@query("registry")
def hot_swap_annotations(registry):
    return P.version_annotations(registry)


@query("registry")
def effective_threshold(registry):
    return R.effective_threshold(registry)


@query("readings registry")
def hot_swap_gap(readings, registry):
    return R.hot_swap_gap(readings, registry, SHORT)


@query("readings")
def hot_swap_phases(readings):
    """Daily snapshots; every seventh day a newer version is already registered."""
    daily = readings.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("snapshot_at")).agg(
        F.max("model_version").alias("live_version")
    )
    ahead = F.when(F.dayofmonth("snapshot_at") % 7 == 0, 1).otherwise(0)
    return R.swap_phases(daily.withColumn("latest_version", F.col("live_version") + ahead))


@query("readings registry")
def drift_recall_window(readings, registry):
    threshold = R.effective_threshold(registry).scalar()
    return E.family_rows(R.live_recall_counts(readings, threshold, LONG))


@query("readings registry")
def drift_decision(readings, registry):
    policy = C.DriftPolicy(
        window=LONG, recall_floor=1.1, min_positives=1, max_idle_s=DAY_S, min_interval_s=0
    )
    return R.drift_decision(readings, registry, policy, NOW)


@query("readings_dense registry")
def policy_log(readings, registry):
    """The policy's log after checks that meet each of its guards in turn, with its own parameters.

    The readings are those of a stream whose last three minutes hold all of them.
    """
    spark = readings.sparkSession
    readings, registry = materialised(readings.select("ts", "anomaly_score", *C.LABELS)), materialised(registry)
    anchor = readings.agg(F.max("ts")).first()[0]
    path = scratch_folder(spark, "policy")

    def model(threshold, age_s):
        moment = F.lit(anchor - dt.timedelta(seconds=age_s)).cast("timestamp_ntz")
        return registry.where("version = 1").withColumns({"threshold": F.lit(threshold), "trained_at": moment})

    steady, poor = model(0.5, 1000), model(0.99, 1000)
    checks = [
        (20, readings, steady, C.DriftPolicy(enabled=False)), (20, readings, registry.limit(0), C.DriftPolicy()),
        (20, readings.limit(0), steady, C.DriftPolicy()), (75, readings, steady, C.DriftPolicy()),
        (20, readings, model(0.5, 100), C.DriftPolicy()), (30, readings, steady, C.DriftPolicy()),
        (5, readings, poor, C.DriftPolicy()), (45, readings, poor, C.DriftPolicy()),
    ]
    for after_s, events, versions, policy in checks:
        now = anchor + dt.timedelta(seconds=after_s)
        Q.check(events, versions, path, lambda: {"version": 2}, policy, now)
    return Q.read_log(spark, path)


# --- evaluation and splits ----------------------------------------------------------------


@query("readings")
def tune_threshold(readings):
    return E.tune_threshold(readings)


@query("readings")
def eval_metrics(readings):
    metrics = E.evaluate(readings, THRESHOLD)
    return rounded(metrics, "pr_auc", *C.FAMILY_RECALLS, digits=9)


@query("readings")
def average_precision(readings):
    return rounded(E.average_precision(readings), "average_precision", digits=9)


@query("readings")
def balanced_weights(readings):
    return E.class_weights(readings)


@query("readings")
def coil_primary_family(readings):
    return S.coil_families(readings)


@query("readings")
def family_coverage(readings):
    return S.family_coverage(readings)


@query("readings")
def holdout_split(readings):
    return S.holdout_coils(readings)


@query("readings")
def train_val_split(readings):
    return S.validation_coils(readings)


@query("readings")
def holdout_rows(readings):
    return S.rows_of(readings, S.holdout_coils(readings)).select("reading_id", "coil_id", "stand")


@query("readings")
def train_minus_holdout(readings):
    return S.rows_without(readings, S.holdout_coils(readings)).select("reading_id", "coil_id", "stand")


@query("readings")
def cold_start_scores(readings):
    """Scores before the first model: zeros and version 0, never NULL."""
    plain = readings.drop("anomaly_score", "model_version", *C.PROBABILITIES)
    return apply_model(plain, None).select(
        "reading_id", "anomaly_score", *C.PROBABILITIES, "model_version"
    )


# --- detectors ----------------------------------------------------------------------------


def _watched(readings, signals=C.PROCESS_SIGNALS):
    return D.watched(D.with_block(readings, DAY_S), signals, "stand", "block", "ts", "reading_id")


@query("readings")
def block_stats(readings):
    stats = D.block_stats(_watched(readings), C.PROCESS_SIGNALS)
    moments = D.block_moments(stats, C.PROCESS_SIGNALS)
    # Block means are often exact decimals; the offset keeps them off the rounding edge.
    edge = {name: F.col(name) + 3.7e-8 for name in ("mean", "variance")}
    return rounded(moments.withColumns(edge), "mean", "variance")


@query("readings")
def ewma_mean(readings):
    signals = C.PROCESS_SIGNALS
    states = D.block_states(D.block_stats(_watched(readings), signals), signals)
    edge = {name: F.col(name) + 3.7e-8 for name in ("mean", "sd")}
    return rounded(D.ewma_means(states, signals).withColumns(edge), "mean", "sd")


@query("readings")
def knn_buffer(readings):
    """The standardised reference rows of every block."""
    signals = C.PROCESS_SIGNALS
    rows = _watched(readings)
    states = D.materialised(D.block_states(D.block_stats(rows, signals), signals))
    kept = D.buffers(D.tail_rows(rows, states, signals), states)
    names = [f"z_{signal}" for signal in signals]
    named = kept.select(
        "stand", "block", "reading_id", *[(F.col("z")[k] + 3.7e-7).alias(name) for k, name in enumerate(names)]
    )
    return rounded(named, *names, digits=5)


def _scored(readings, signals):
    scores = D.detector_scores(readings, DAY_S, signals)
    return rounded(scores, "u_maha", "u_spc", "u_knn", digits=5).drop("block")


@query("readings")
def detector_scores(readings):
    """Two signals, a quick look at the scores."""
    return _scored(readings, TWO_SIGNALS)


@query("readings")
def detector_scores_full(readings):
    """All ten process signals."""
    return _scored(readings, tuple(C.PROCESS_SIGNALS))


# --- streaming and training ---------------------------------------------------------------


_SCORES = ["u_maha", "u_spc", "u_knn", "u_votes", "u_anomaly"]


def _finished(stream):
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


@query("readings_stream")
def stream_kpi_windows(stream):
    """Closed windows of the streaming KPI job, run over the events until it has caught up."""
    stores = B.Stores(scratch_folder(stream.sparkSession, "stream"))
    _finished(B.start_kpis(stream, stores, "1 hour", THRESHOLD, trigger={"availableNow": True}))
    return B.read_kpis(stream.sparkSession, stores)


@query("readings_stream")
def stream_scored_events(stream):
    """Events sent as JSON, then decoded, scored (no model yet) and stored by the job: every stored
    field, the day folder, and whether the sink's id and arrival time are as they should be."""
    stores = B.Stores(scratch_folder(stream.sparkSession, "stream"))
    raw = J.encode(_wire_events(stream)).select("value")
    _finished(B.start_scoring(raw, stores, {"availableNow": True}))
    stored = B.read_events(stream.sparkSession, stores)
    # Ids of the first batch are dense from 0: as many different ones as rows, below their number.
    count = stored.agg(F.count_distinct("reading_id")).scalar()
    return stored.select(
        *[f.name for f in C.SCORED_SCHEMA], F.col(T.DAY).cast("string").alias(T.DAY),
        F.col("reading_id").between(F.lit(0), count - 1).alias("id_in_range"), count.alias("different_ids"),
        (F.col("ingested_at") > F.col("ts")).alias("stamped"),
    )


@query("readings")
def stream_detector_scores(readings):
    """Detector scores of the scoring job over micro-batches of three days each, in order of time.

    The feed has one file per micro-batch, written one after another, as the job reads the oldest
    file first; every batch starts from the detector state the one before has stored.
    """
    spark = readings.sparkSession
    stores, feed = B.Stores(scratch_folder(spark, "stream")), scratch_folder(spark, "feed")
    blocks = materialised(D.with_block(_wire_events(readings.drop(*_SCORES)), 3 * DAY_S).orderBy("block", "ts", "reading_id"))
    for row in blocks.select("block").distinct().orderBy("block").collect():
        part = blocks.where(F.col("block") == row["block"]).coalesce(1).sortWithinPartitions("ts", "reading_id")
        J.encode(part).select("value").write.mode("append").text(feed)
    _finished(B.start_scoring(J.file_events(spark, feed, 1), stores, {"availableNow": True}))
    scores = B.read_events(spark, stores).select("ts", "coil_id", "stand", *_SCORES)
    return rounded(scores, "u_maha", "u_spc", "u_knn", digits=5)


@query("readings")
def stream_late_and_replayed(readings):
    """Both streaming jobs over three deliveries of ten days, with rows too late and rows sent twice.

    Some rows of the first days come with the second delivery: they are stored, but their windows
    have closed. Of each delivery some rows come twice: both are stored, one is counted.
    """
    spark = readings.sparkSession
    stores, feed = B.Stores(scratch_folder(spark, "stream")), scratch_folder(spark, "feed")
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int")
    late = (F.col("reading_id") % 97 == 0) & (F.dayofmonth("ts") < 10)
    twice = F.array_repeat(F.lit(0), F.when(F.col("reading_id") % 50 == 0, 2).otherwise(1))
    sent = materialised(_wire_events(readings.drop(*_SCORES)).select(
        "*", F.when(late, 1).otherwise(third).alias("delivery"), F.explode(twice).alias("copy")
    ))
    for delivery in range(3):
        J.encode(sent.where(F.col("delivery") == delivery)).select("value").write.mode("append").text(feed)
        _finished(B.start_scoring(J.file_events(spark, feed), stores, {"availableNow": True}))
        _finished(B.start_kpis(B.stored_events(spark, stores), stores, "1 hour", THRESHOLD, trigger={"availableNow": True}))
    stored = B.read_events(spark, stores).groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("stored"))
    kpis = B.read_kpis(spark, stores)
    return kpis.join(stored, kpis["window_start"] == stored["w.start"]).select(
        "window_start", "window_end", "coils", "events", "anomalies", "stored"
    )


@query("readings")
def stream_totals(readings):
    """Events and different coils so far, from the rows the scoring job adds per micro-batch.

    Three deliveries share nearly all their coils.
    """
    spark = readings.sparkSession
    stores, feed = B.Stores(scratch_folder(spark, "stream")), scratch_folder(spark, "feed")
    sent = materialised(_wire_events(readings.drop(*_SCORES)))
    for delivery in range(3):
        J.encode(sent.where(F.col("reading_id") % 3 == delivery)).select("value").write.mode("append").text(feed)
        _finished(B.start_scoring(J.file_events(spark, feed), stores, {"availableNow": True}))
    return read_totals(spark, stores.totals)


@query("readings")
def retrain_registry(readings):
    """A training run on all readings, with the package's own parameters, and the version it registers."""
    stores = B.Stores(scratch_folder(readings.sparkSession, "train"))
    M.retrain(readings, stores.models, stores.registry, stores.holdout)
    return G.read_registry(readings.sparkSession, stores.registry)
