"""Claims, pinned held-out rows, and the policy that fires."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from rollsight import contract as C
from rollsight.plans import policy as Q
from rollsight.plans import registry as R
from rollsight.plans import training as M
from rollsight.plans.scoring import Model
from rollsight.sources import markers as K
from rollsight.sources import tables as T
from rollsight.streaming.jobs import Stores
from tests.test_training import QUICK, T0, events  # noqa: F401  (fixture)

CONSTANT = {family: None for family in C.FAMILIES}
METRICS = {name: 0.5 for name in ("f1", "pr_auc", "precision", "recall", *C.FAMILY_RECALLS)}


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def publish(spark, stores, moment, threshold=0.5):
    version = R.claim_version(spark, stores.registry)
    model = Model(version, CONSTANT, threshold=threshold, metrics=METRICS)
    R.register(M.registry_row(spark, model, 1, moment), stores.registry)
    R.save_model(spark, model, stores.models)
    return version


def test_only_one_creates_a_marker(spark, tmp_path):
    path = str(tmp_path / "deep" / "mark")
    with ThreadPoolExecutor(16) as pool:
        made = list(pool.map(lambda k: K.create_once(spark, path, f"text {k}"), range(16)))
    assert sum(made) == 1 and K.text_of(spark, path) == f"text {made.index(True)}"
    K.swap_text(spark, path, "later")
    assert K.text_of(spark, path) == "later" and K.text_of(spark, path + "-none") is None
    assert sorted(p.name for p in (tmp_path / "deep").iterdir()) == ["mark"]


def test_trainings_at_once_publish_versions_of_their_own(spark, tmp_path):
    stores = Stores(str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda k: publish(spark, stores, at(k), 0.1 * (k + 1)), range(4)))
    assert sorted(versions) == [1, 2, 3, 4]
    rows = {r["version"]: r for r in R.read_registry(spark, stores.registry).collect()}
    assert {v: round(rows[v]["threshold"] * 10) for v in rows} == {v: k + 1 for k, v in enumerate(versions)}
    assert R.numbered_folders(spark, stores.models, "version", "ready") == [1, 2, 3, 4]
    for k, version in enumerate(versions):
        assert R.load_model(spark, stores.models, version).threshold == pytest.approx(0.1 * (k + 1))


def store(spark, path, rows, batch):
    T.append_batch(rows.withColumn(T.DAY, F.to_date("ts")), path, batch)


def test_held_out_rows_survive_expiry_replay_and_correction(spark, events, tmp_path):
    full = events.withColumn("y_reduction", F.col("coil_id") % 10 == 4).withColumn(
        "ts", F.col("ts") + F.expr("make_dt_interval(coil_id div 350)")
    )
    path, holdout = str(tmp_path / "events"), str(tmp_path / "holdout")
    store(spark, path, full, 0)
    stored = T.read_batches(spark, path)
    held, frozen = M.carve_holdout(spark, M.training_rows(stored), holdout)
    assert frozen and set(M.HOLDOUT_COLUMNS) == set(held.columns)
    classifiers, _ = M.fit(M.training_rows(stored).where("coil_id % 2 = 0"), QUICK)
    model = Model(1, classifiers, threshold=0.5)
    before = M.evaluated(held, model)
    assert before["n_eval"] == held.count() and before["recall_electric"] > 0
    # Half of the coils expire; the others arrive again with other labels and later ids.
    assert T.drop_expired(spark, path, 1)
    changed = full.where("coil_id >= 350").withColumns({
        "reading_id": F.col("reading_id") + 10_000_000, "force": F.lit(0.0), "y_electric": ~F.col("y_electric"),
    })
    store(spark, path, changed, 1)
    spark.catalog.refreshByPath(path)
    now = M.training_rows(T.read_batches(spark, path))
    assert now.select("coil_id").distinct().count() == 350
    again, frozen = M.carve_holdout(spark, now, holdout)
    assert frozen and M.evaluated(again, model) == before
    assert again.select("coil_id").distinct().count() > 100


def test_freezing_at_once_pins_one_set(spark, events, tmp_path):
    full = events.withColumn("y_reduction", F.col("coil_id") % 10 == 4)
    parts = [M.training_rows(full.where(f"coil_id >= {k}")).persist() for k in (0, 50)]
    path = str(tmp_path / "holdout")
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda rows: M.carve_holdout(spark, rows, path), parts))
    # One pinned it; the other saw the pinned set or kept its own for this time.
    assert any(frozen for _, frozen in results)
    pinned = {r[0] for r in M.frozen_holdout(spark, path).select("coil_id").distinct().collect()}
    for rows, frozen in results:
        if frozen:
            assert {r[0] for r in rows.select("coil_id").distinct().collect()} == pinned


@pytest.fixture()
def drifting(spark, events):
    """A stream of under three minutes whose faults score low."""
    return events.where("coil_id < 280").withColumns({
        "y_electric": F.lit(True), "anomaly_score": F.lit(0.1), "ts": F.col("ts").cast("timestamp_ntz"),
    }).persist()


def test_policy_fires_once_and_trains_for_real(spark, events, tmp_path):
    stores, log = Stores(str(tmp_path)), str(tmp_path / "policy")
    publish(spark, stores, at(-1000))
    scored = events.where("coil_id < 280").withColumns({"anomaly_score": F.lit(0.1), "y_electric": F.col("coil_id") % 2 == 1}).persist()
    last = scored.agg(F.max("ts")).first()[0]

    def train(moment):
        return lambda: M.retrain(scored, stores.models, stores.registry, stores.holdout, QUICK, moment)

    def check(seconds):
        moment = last + dt.timedelta(seconds=seconds)
        return Q.check(scored, R.read_registry(spark, stores.registry), log, train(moment), now=moment)

    first = check(1)
    assert (first["fired"], first["fires"], first["version"]) == (True, 1, 2)
    assert first["recall_electric"] == 0.0 and first["reason"].endswith("trained version 2")
    second = check(50)
    assert not second["fired"] and second["fires"] == 1 and "published 49 s ago" in second["reason"]
    assert check(70)["reason"] == "last event 70 s ago"
    rows = Q.read_log(spark, log).orderBy("check_no").collect()
    assert [r["check_no"] for r in rows] == [0, 1, 2] and [r["fired"] for r in rows] == [True, False, False]
    assert R.numbered_folders(spark, stores.models, "version", "ready") == [1, 2]
    assert Q.state(spark, log)["last_fired"] == last + dt.timedelta(seconds=1)


def test_one_training_at_a_time_and_failures_do_not_end_the_loop(spark, drifting, tmp_path):
    stores, log = Stores(str(tmp_path)), str(tmp_path / "policy")
    publish(spark, stores, at(-1000))
    registry = R.read_registry(spark, stores.registry)
    last = drifting.agg(F.max("ts")).first()[0]
    calls = []

    def train():
        calls.append(1)
        raise RuntimeError("no memory")

    held = Q.Lease(spark, f"{log}/_training", last)
    assert held.take() and not Q.Lease(spark, f"{log}/_training", last).take()
    busy = Q.check(drifting, registry, log, train, now=last)
    assert busy["drifted"] and not busy["fired"] and busy["reason"].endswith("a training is under way") and not calls
    held.give_back()
    failed = Q.check(drifting, registry, log, train, now=last + dt.timedelta(seconds=5))
    assert failed["fired"] and failed["version"] is None and "no memory" in failed["reason"] and len(calls) == 1
    rested = Q.check(drifting, registry, log, train, now=last + dt.timedelta(seconds=50))
    assert "trained for it 45 s ago" in rested["reason"] and len(calls) == 1


def test_checks_at_once_train_once(spark, drifting, tmp_path):
    stores, log = Stores(str(tmp_path)), str(tmp_path / "policy")
    publish(spark, stores, at(-1000))
    registry = R.read_registry(spark, stores.registry)
    last = drifting.agg(F.max("ts")).first()[0]
    calls = []

    def train():
        calls.append(1)
        return {"version": publish(spark, stores, last)}

    with ThreadPoolExecutor(3) as pool:
        rows = list(pool.map(lambda k: Q.check(drifting, registry, log, train, now=last), range(3)))
    assert len(calls) == 1 and sum(r["fired"] for r in rows) == 1
    assert sorted(r["check_no"] for r in rows) == [0, 1, 2]


def test_lease_of_a_lost_driver_is_taken_over_once(spark, tmp_path):
    path = str(tmp_path / "lease")
    lost = Q.Lease(spark, path, at(0), 100)
    assert lost.take()
    assert not Q.Lease(spark, path, at(99), 100).take()
    late = [Q.Lease(spark, path, at(101), 100) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        assert sum(pool.map(lambda lease: lease.take(), late)) == 1
    lost.give_back()  # not its own any more
    assert not Q.Lease(spark, path, at(102), 100).take()
