"""Aggregates, order statistics, evaluation, splits and the drift policy on edge rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rollsight import contract as C
from rollsight.operators import drift as R
from rollsight.operators import evaluation as E
from rollsight.operators import inspection as I
from rollsight.operators import latest as L
from rollsight.operators import panels as P
from rollsight.operators import rates as A
from rollsight.operators import selection as Q
from rollsight.operators import splits as S

T0 = dt.datetime(2024, 5, 1, 12)


def exact(values, p):
    ordered = sorted(values)
    at = p * (len(ordered) - 1)
    low = int(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


def test_latest_keeps_the_highest_reading(spark):
    rows = [(1, 1, 5, "a"), (1, 1, 9, "b"), (1, 1, 7, "c"), (1, 2, 1, "d")]
    frame = spark.createDataFrame(rows, "coil_id int, stand int, reading_id int, v string")
    expected = {(1, 9, "b"), (2, 1, "d")}
    assert {(r["stand"], r["reading_id"], r["v"]) for r in L.latest(frame, ["coil_id", "stand"]).collect()} == expected
    wide = frame.select("*", *[F.lit(i).alias(f"c{i}") for i in range(L.AGGREGATED_COLUMNS)])
    got = L.latest(wide, ["coil_id", "stand"])
    assert {(r["stand"], r["reading_id"], r["v"]) for r in got.collect()} == expected


def test_worst_stand_prefers_the_lowest_on_a_tie(spark):
    rows = [(1, 3, 0.9), (1, 2, 0.9), (1, 1, 0.1), (2, 1, None), (2, 4, 0.2)]
    frame = spark.createDataFrame(rows, "coil_id int, stand int, anomaly_score double")
    assert {(r["coil_id"], r["worst_stand"]) for r in L.worst_stand(frame).collect()} == {(1, 2), (2, 4)}


def test_bracketed_percentiles_are_exact_beyond_the_small_group_limit(spark):
    random.seed(3)
    values = [(1, round(random.gauss(100, 20), 3)) for _ in range(30_000)]
    values += [(2, float(i % 7)) for i in range(20_000)] + [(3, 4.25)]
    frame = spark.createDataFrame(values, "stand int, force double").repartition(8)
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    # A coarse sketch, so the large groups go through the brackets.
    got = Q.percentiles(frame, ["stand"], ["force"], probs, accuracy=500).collect()
    assert len(got) == 3
    for row in got:
        mine = [v for s, v in values if s == row["stand"]]
        assert row["n"] == len(mine)
        for name, p in probs.items():
            assert row[name] == pytest.approx(exact(mine, p), abs=1e-9)


def test_percentiles_with_one_value_holding_a_third(spark):
    values = [(1, 5.0)] * 10_000 + [(1, float(i)) for i in range(20_000)]
    frame = spark.createDataFrame(values, "stand int, v double").repartition(8)
    row = Q.percentiles(frame, ["stand"], ["v"], {"p33": 1 / 3, "p50": 0.5}, accuracy=400).first()
    for name, p in (("p33", 1 / 3), ("p50", 0.5)):
        assert row[name] == pytest.approx(exact([v for _, v in values], p), abs=1e-6)


def test_share_cut_counts_are_exact(spark):
    frame = spark.range(50_000).select(
        F.when(F.col("id") < 49_000, "normal").otherwise("rare").alias("family"),
        F.col("id").alias("coil_id"),
    )
    held = S._lowest_share(frame, "family", 0.15, 42).groupBy("family").count().collect()
    assert {r["family"]: r["count"] for r in held} == {"normal": 7350, "rare": 150}


def test_kpi_windows_count_distinct_coils(spark):
    rows = [(T0 + dt.timedelta(seconds=s), coil, score) for s, coil, score in
            [(0, 1, 0.85), (1, 1, 0.2), (59, 2, 0.9), (60, 1, None)]]
    frame = spark.createDataFrame(rows, "ts timestamp_ntz, coil_id long, anomaly_score double")
    got = A.kpi_windows(frame).orderBy("window_start").collect()
    assert [(r["coils"], r["events"], r["anomalies"]) for r in got] == [(2, 3, 2), (1, 1, 0)]
    assert got[0]["window_end"] - got[0]["window_start"] == dt.timedelta(minutes=1)
    assert A.latest_kpi(A.kpi_windows(frame)).first()["coils_per_min"] == 1.0


def test_rollup_fills_idle_stands(spark):
    schema = ("ts timestamp_ntz, stand int, anomaly_score double, force double, work_roll_mileage double, "
              "model_version int, u_anomaly boolean, u_maha double, u_spc double, u_knn double, "
              + ", ".join(f"{p} double" for p in C.PROBABILITIES))
    def row(s, stand):
        return (T0 + dt.timedelta(seconds=s), stand, 0.9, 1.0, 60.0, 2, None, 30.0, 1.0, 1.0, 0.1, 0.2, 0.3, 0.9)
    frame = spark.createDataFrame([row(0, 1), row(10, 2), row(20, 2)], schema)
    got = {r["stand"]: r for r in A.stand_rollup(frame, 0.85).collect()}
    assert [got[s]["events"] for s in range(1, 6)] == [0, 1, 0, 0, 0]  # ts > max − 10 s, strictly
    assert got[2]["u_rate"] == 0.0 and got[2]["u_maha_rate"] == 1.0 and got[2]["dominant"] == "reduction"
    assert got[1]["alarm_rate"] == 0.0 and got[1]["dominant"] is None and got[1]["force"] is None
    status = {r["stand"]: r for r in A.stand_status(A.stand_rollup(frame, 0.85)).collect()}
    assert (status[2]["lamp"], status[2]["wear_band"], status[1]["lamp"]) == ("r", "a", "off")


def test_latency_without_arrival_time_is_null(spark):
    frame = spark.createDataFrame([(T0,)], "ts timestamp_ntz")
    row = A.latency_recent(frame, now=T0).first()
    assert (row["latency_ms_p50"], row["latency_ms_p95"]) == (None, None)
    late = frame.withColumn("ingested_at", F.col("ts") + F.expr("interval 0.25 seconds"))
    row = A.latency_recent(late, now=T0 + dt.timedelta(seconds=30)).first()
    assert tuple(row) == (250.0, 250.0)
    assert tuple(A.latency_recent(late, now=T0 + dt.timedelta(hours=1)).first()) == (None, None)


def test_freshness_bounds(spark):
    frame = spark.createDataFrame([(T0,)], "ts timestamp_ntz")
    seen = [A.freshness(frame, T0 + dt.timedelta(seconds=s)).first() for s in (7, 8, 60, 61)]
    assert [(r["live"], r["stream_idle"]) for r in seen] == [(True, False), (False, False), (False, False), (False, True)]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "anomaly_score double, y_any boolean")


def test_threshold_tuning_edges(spark):
    only = labelled(spark, [(0.9, True), (0.1, True)])
    none = labelled(spark, [(0.9, False)])
    assert E.tune_threshold(only).first()["threshold"] == 0.5
    assert E.tune_threshold(none).first()["threshold"] == 0.5
    tie = labelled(spark, [(0.9, True), (0.2, False)])
    row = E.tune_threshold(tie).first()
    assert (row["threshold"], row["f1"]) == (0.25, 1.0)


def brute_average_precision(rows):
    total = sum(y for _, y in rows)
    area = last = 0.0
    for t in sorted({s for s, _ in rows}, reverse=True):
        picked = [y for s, y in rows if s >= t]
        recall = sum(picked) / total
        area += (recall - last) * sum(picked) / len(picked)
        last = recall
    return area


def test_average_precision(spark):
    random.seed(5)
    rows = [(round(random.random(), 2), random.random() < 0.3) for _ in range(400)]
    got = E.average_precision(labelled(spark, rows)).first()[0]
    assert got == pytest.approx(brute_average_precision(rows), abs=1e-12)
    assert E.average_precision(labelled(spark, [(0.5, True)])).first()[0] == 0.0


def test_evaluation_never_divides_by_zero(spark):
    schema = "anomaly_score double, y_any boolean, " + ", ".join(f"{y} boolean" for y in C.LABELS)
    frame = spark.createDataFrame([(0.1, False, False, False, False, False)], schema)
    row = E.evaluate(frame, 0.5).first()
    assert (row["precision"], row["recall"], row["f1"], row["pr_auc"], row["n_eval"]) == (0, 0, 0, 0, 1)
    assert row["recall_electric"] == 0.0


def test_class_weights(spark):
    schema = ", ".join(f"{y} boolean" for y in C.LABELS)
    frame = spark.createDataFrame([(True, False, False, True)] + [(False, False, False, True)] * 3, schema)
    got = {r["family"]: (r["weight_fault"], r["weight_normal"]) for r in E.class_weights(frame).collect()}
    assert got["electric"] == (2.0, 4 / 6)
    assert got["bearing"] == (None, 0.5) and got["reduction"] == (0.5, None)


def coils(spark, families, rows=1):
    data = [(coil, family == "electric", family == "bearing", family == "workroll", family == "reduction")
            for coil, family in enumerate(families) for _ in range(rows)]
    return spark.createDataFrame(data, "coil_id long, " + ", ".join(f"{y} boolean" for y in C.LABELS))


def test_holdout_is_stratified_repeatable_and_leak_free(spark):
    events = coils(spark, ["normal"] * 300 + ["electric"] * 40 + ["bearing"] * 20, rows=3)
    held = S.holdout_coils(events)
    sizes = {r["family"]: r["count"] for r in held.groupBy("family").count().collect()}
    assert sizes == {"normal": 45, "y_electric": 6, "y_bearing": 3}
    ids = {r["coil_id"] for r in held.collect()}
    assert ids == {r["coil_id"] for r in S.holdout_coils(events.repartition(5)).collect()}
    inside, outside = S.rows_of(events, held), S.rows_without(events, held)
    assert inside.count() == 54 * 3 and outside.count() == 306 * 3
    lonely = S.holdout_coils(coils(spark, ["normal"] * 99 + ["electric"]))
    assert {r["family"] for r in lonely.collect()} == {"all"} and lonely.count() == 15


@pytest.mark.parametrize("n, carve", [(199, False), (200, True)])
def test_carve_needs_enough_coils(spark, n, carve):
    assert S.can_carve(S.family_coverage(coils(spark, ["normal"] * n)).first()) is carve


@pytest.mark.parametrize("n, freeze", [(24, False), (25, True)])
def test_freeze_needs_every_family(spark, n, freeze):
    families = ["electric"] * 25 + ["bearing"] * 25 + ["workroll"] * n + ["reduction"] * 30
    assert S.can_freeze(S.family_coverage(coils(spark, families)).first()) is freeze


def drift_case(spark, positives, caught, trained_ago=3600, now_after=5, versions=True, events=True):
    schema = "ts timestamp_ntz, anomaly_score double, " + ", ".join(f"{y} boolean" for y in C.LABELS)
    rows = [(T0, 0.9 if i < caught else 0.1, True, False, False, False) for i in range(positives)]
    scored = spark.createDataFrame(rows + [(T0, 0.1, False, False, False, False)] if events else [], schema)
    model = [(1, 0.5, T0 - dt.timedelta(seconds=trained_ago - now_after))] if versions else []
    registry = spark.createDataFrame(model, "version int, threshold double, trained_at timestamp_ntz")
    return R.drift_decision(scored, registry, now=T0 + dt.timedelta(seconds=now_after)).first()


@pytest.mark.parametrize(
    "kwargs, fire, reason",
    [
        (dict(positives=9, caught=0, versions=False), False, "nothing published so far"),
        (dict(positives=0, caught=0, events=False), False, "no event stored so far"),
        (dict(positives=300, caught=0, now_after=61), False, "last event 61 s ago"),
        (dict(positives=300, caught=0, trained_ago=179), False, "newest version published 179 s ago"),
        (dict(positives=199, caught=97), False, "recall in order: electric 0.487"),
        (dict(positives=200, caught=98), True, "recall too low: electric 0.49 of 200 faults"),
        (dict(positives=200, caught=100), False, "recall in order: electric 0.5"),
        (dict(positives=0, caught=0), False, "recall in order: no confirmed fault to judge by"),
    ],
)
def test_drift_guards(spark, kwargs, fire, reason):
    row = drift_case(spark, **kwargs)
    assert (row["fire"], row["reason"]) == (fire, reason)


def test_empty_registry(spark):
    empty = spark.createDataFrame([], C.REGISTRY_SCHEMA)
    assert L.next_version(empty).first()[0] == 1
    assert R.effective_threshold(empty).first()[0] == 0.85
    zero = spark.createDataFrame([(3, 0.0)], "version int, threshold double")
    assert R.effective_threshold(zero).first()[0] == 0.85


def test_roll_campaigns_across_pieces(spark):
    random.seed(1)
    rows, km = [], {1: 0.0, 2: 50.0}
    for i in range(500):
        stand = 1 if i % 3 else 2
        km[stand] = 0.0 if random.random() < 0.05 else km[stand] + 1
        rows.append((stand, T0 + dt.timedelta(seconds=i // 2), i, 1.0, km[stand]))
    frame = spark.createDataFrame(rows, "stand int, ts timestamp_ntz, reading_id long, force double, work_roll_mileage double")
    got = {r["reading_id"]: r for r in P.roll_campaigns(frame.repartition(6)).collect()}
    for stand in (1, 2):
        last, campaign = None, 0
        for r in [r for r in rows if r[0] == stand]:
            change = last is not None and r[4] < last
            campaign += change
            last = r[4]
            assert (got[r[2]]["roll_change"], got[r[2]]["campaign"]) == (change, campaign)


def test_inspection_hides_the_fault_of_vote_only_coils(spark):
    schema = ("coil_id long, stand int, reading_id long, anomaly_score double, "
              + ", ".join(f"{p} double" for p in C.PROBABILITIES)
              + ", model_version int, ts timestamp_ntz, u_anomaly boolean, u_votes int")
    def row(coil, stand, reading, score, flag, votes):
        return (coil, stand, reading, score, score, 0.0, 0.0, 0.0, 1, T0, flag, votes)
    rows = [row(1, 1, 1, 0.9, False, 0), row(1, 1, 2, 0.3, False, 0),  # alarm replaced by a later row
            row(2, 1, 3, 0.85, False, 0), row(2, 4, 4, 0.95, True, 2),
            row(3, 2, 5, 0.1, True, 3), row(4, 1, 6, 0.2, False, 1)]
    frame = spark.createDataFrame(rows, schema)
    got = I.coils_to_inspect(frame, 0.85).collect()
    assert [(r["coil_id"], r["flagged_by"], r["predicted_fault"], r["worst_stand"], r["first_stand"], r["stands_alarmed"]) for r in got] == [
        (2, "both", "electric", 4, 1, 2), (3, "ensemble", None, 2, None, 0)]
    board = I.inspection_board(frame, 0.85).collect()
    assert [(r["fault"], r["flagged_by"]) for r in board] == [("electric", "model + ensemble"), ("unsupervised", "ensemble 3/3")]
    resorted = I.resorted(I.coils_to_inspect(frame, 0.85), "confidence", ascending=True).collect()
    assert [r["coil_id"] for r in resorted] == [2, 3]
    assert [r["coil_id"] for r in I.alarm_ticker(frame, 0.85).collect()] == [2, 2, 1]


def test_swap_phases(spark):
    pairs = [(1, 1), (1, 2), (1, 2), (2, 2), (2, 2), (2, 3), (3, 3), (None, 3)]
    rows = [(T0 + dt.timedelta(seconds=i), live, newest) for i, (live, newest) in enumerate(pairs)]
    frame = spark.createDataFrame(rows, "snapshot_at timestamp_ntz, live_version int, latest_version int")
    phases = [r["phase"] for r in R.swap_phases(frame).orderBy("snapshot_at").collect()]
    assert phases == ["sync", "swap", "flash", "swap", "flash", "sync"]


def test_roll_campaigns_keep_rows_without_mileage(spark):
    rows = [(1, T0 + dt.timedelta(seconds=k), k, m, 1.0) for k, m in enumerate([5.0, 6.0, None, 1.0, 2.0, 1.0])]
    frame = spark.createDataFrame(rows, "stand int, ts timestamp, reading_id long, work_roll_mileage double, force double")
    got = {r["reading_id"]: (r["roll_change"], r["campaign"]) for r in P.roll_campaigns(frame).collect()}
    assert got == {0: (False, 0), 1: (False, 0), 2: (False, 0), 3: (False, 0), 4: (False, 0), 5: (True, 1)}


def test_latency_below_a_millisecond(spark):
    rows = [(T0, T0 + dt.timedelta(microseconds=us)) for us in (400, 1400)]
    row = A.latency_per_minute(spark.createDataFrame(rows, "ts timestamp, ingested_at timestamp")).first()
    assert row["p50"] == pytest.approx(0.0009)


def test_brackets_that_miss_are_widened(spark):
    """A sketch of a few points and brackets without width miss nearly every rank."""
    rows = spark.range(0, 40_000, 1, 8).select(
        (F.col("id") % 3).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("v")
    ).unionByName(spark.range(3).select(F.lit(None).cast("long").alias("g"), F.col("id").cast("double").alias("v")))
    probs = {"low": 0.013, "mid": 0.5, "high": 0.987}
    want = {
        r["g"]: (r["low"], r["mid"], r["high"]) for r in rows.groupBy("g").agg(
            *[F.percentile("v", p).alias(name) for name, p in probs.items()]
        ).collect()
    }
    for margins in ((), (0.0,), (0.0, 0.5), (3.0,)):
        got = Q.percentiles(rows, ["g"], ["v"], probs, accuracy=20, margins=margins).collect()
        assert len(got) == len(want)
        assert all((r["low"], r["mid"], r["high"]) == pytest.approx(want[r["g"]]) for r in got)
    first = Q._bracketed(rows.withColumn("value", F.col("v")), ["g"], [0.5], 20, 0.0)
    tried = Q._pick_ranks(first, ["g"], Q._positions({"mid": 0.5}))
    assert tried.where("NOT sure").count() == 3  # so the widening was needed
    cuts = Q.share_cut(rows, "g", "v", 0.15, accuracy=20, margins=(0.0,)).collect()
    ranks = {r["g"]: rows.where(F.col("g").eqNullSafe(F.lit(r["g"])) & (F.col("v") <= r["cut"])).count() for r in cuts}
    sizes = {r["g"]: r["n"] for r in cuts}
    assert all(ranks[g] >= 0.15 * sizes[g] > ranks[g] - 2 for g in ranks)
