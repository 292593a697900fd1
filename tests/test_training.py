"""Training, publication, the model registry and scoring with a trained version."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rollsight import contract as C
from rollsight.plans import registry as R
from rollsight.plans import training as M
from rollsight.plans.scoring import apply_model
from rollsight.plans.snapshot import snapshot
from rollsight.sources import markers as K
from rollsight.operators.drift import hot_swap_gap
from rollsight.operators.latest import version_changes
from rollsight.streaming.jobs import Stores

T0 = dt.datetime(2024, 5, 1, 12)
QUICK = M.BoostParams(iterations=3, step=0.3, depth=3)


@pytest.fixture(scope="module")
def events(spark):
    """700 coils; three families show in one signal each, `reduction` never occurs."""
    ids = spark.range(3500).repartition(8)
    frame = ids.select(
        F.col("id").alias("reading_id"),
        (F.col("id") / 5).cast("long").alias("coil_id"),
        (F.col("id") % 5 + 1).cast("int").alias("stand"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") / 10)).alias("ts"),
    )
    kind = F.col("coil_id") % 10
    frame = frame.withColumns({
        "y_electric": kind == 1, "y_bearing": kind == 2, "y_workroll": kind == 3, "y_reduction": F.lit(False),
    })
    noise = {s: F.rand(i) for i, s in enumerate(C.SIGNALS)}
    bump = {"force": "y_electric", "torque": "y_bearing", "gap": "y_workroll"}
    signals = {s: v + F.col(bump[s]).cast("int") * 2 if s in bump else v for s, v in noise.items()}
    return frame.withColumns(signals).persist()


@pytest.fixture(scope="module")
def trained(spark, events, tmp_path_factory):
    stores = Stores(str(tmp_path_factory.mktemp("train")))
    results = [
        M.retrain(events, stores.models, stores.registry, stores.holdout, QUICK, T0 + dt.timedelta(hours=h))
        for h in (1, 2)
    ]
    return stores, results


def test_training_learns_and_reports(trained):
    _, (first, second) = trained
    assert (first["version"], second["version"]) == (1, 2)
    assert first["metrics"]["f1"] > 0.95 and first["metrics"]["pr_auc"] > 0.95
    assert first["metrics"]["recall_reduction"] == 0.0
    assert first["family_positives"]["reduction"] == 0 and first["family_positives"]["electric"] > 200
    assert 0.05 <= first["threshold"] <= 0.95
    assert first["n_coils"] == 700 - (74 + 3 * 11)  # ceil(15 %) of each stratum
    assert first["holdout_frozen"] is False  # one family has no coils yet


def test_registry_rows(spark, trained):
    stores, results = trained
    registry = R.read_registry(spark, stores.registry)
    rows = registry.orderBy("version").collect()
    assert [r["version"] for r in rows] == [1, 2]
    assert rows[1]["trained_at"] == T0 + dt.timedelta(hours=2)
    assert rows[0]["overall_f1"] == pytest.approx(results[0]["metrics"]["f1"])
    assert rows[0]["trained_on"] == "streamed 593 coils"
    assert M.next_version(spark, stores.registry) == 3
    delta = version_changes(registry, C.FAMILY_RECALLS).orderBy("version").collect()
    assert delta[0]["previous_recall_electric"] is None
    assert delta[1]["previous_recall_electric"] == rows[0]["recall_electric"]


def test_reloaded_model_scores_alike(spark, events, trained):
    stores, _ = trained
    model = R.CurrentModel(spark, stores.models).refresh()
    assert model.version == 2 and model.classifiers.get("reduction") is None
    scored = apply_model(events, model)
    assert set(C.PROBABILITIES + ["anomaly_score", "model_version"]) <= set(scored.columns)
    assert "_features" not in scored.columns
    found = scored.groupBy("y_electric").agg(
        F.avg("p_electric").alias("p"), F.max("p_reduction").alias("r"), F.max("model_version").alias("v")
    ).collect()
    means = {r["y_electric"]: r["p"] for r in found}
    assert means[True] > means[False] + 0.3
    assert {(r["r"], r["v"]) for r in found} == {(0.0, 2)}


def test_frozen_holdout_is_reused_until_the_contract_changes(spark, events, tmp_path):
    full = events.withColumn("y_reduction", F.col("coil_id") % 10 == 4)
    rows = M.training_rows(full)
    path = str(tmp_path / "holdout")
    coils, frozen = M.carve_holdout(spark, rows, path)
    assert frozen
    ids = {r[0] for r in coils.collect()}
    later, frozen = M.carve_holdout(spark, rows.where("coil_id < 300"), path)
    assert frozen and {r[0] for r in later.collect()} == ids
    manifest = json.loads(K.text_of(spark, f"{path}/manifest")) | {"contract": "another contract"}
    K.swap_text(spark, f"{path}/manifest", json.dumps(manifest))
    again, frozen = M.carve_holdout(spark, rows.where("coil_id >= 20"), path)
    assert frozen and {r[0] for r in again.collect()} != ids


def test_too_little_data(spark, events, tmp_path):
    stores = Stores(str(tmp_path))
    with pytest.raises(M.NotEnoughData, match="199 coils"):
        M.retrain(events.where("coil_id < 199"), stores.models, stores.registry, stores.holdout, QUICK)
    with pytest.raises(M.NotEnoughData, match="rows are too few"):
        M.retrain(events.where("coil_id < 210"), stores.models, stores.registry, stores.holdout, QUICK)
    assert R.numbered_folders(spark, stores.models, "version") == []


def test_snapshot_of_a_scored_table(spark, events, trained):
    stores, _ = trained
    model = R.CurrentModel(spark, stores.models).refresh()
    scored = apply_model(events, model).withColumns({
        "y_any": F.col("y_electric"), "u_maha": F.lit(30.0), "u_spc": F.lit(4.0), "u_knn": F.lit(0.0),
        "u_votes": F.lit(2), "u_anomaly": F.lit(True), "file_no": F.lit(1),
        "ingested_at": F.col("ts") + F.expr("interval 0.5 seconds"),
    }).persist()
    from rollsight.operators.rates import kpi_windows

    registry = R.read_registry(spark, stores.registry)
    now = T0 + dt.timedelta(seconds=352)
    parts = {k: v.collect() for k, v in snapshot(scored, kpi_windows(scored), registry, now).items()}
    assert len(parts["stands"]) == 5 and all(r["events"] == 20 for r in parts["stands"])
    rates = parts["rates"][0]
    assert (rates["events_recent"], rates["events_per_s"], rates["coils_total"]) == (100, 10.0, 700)
    assert rates["unsup_rate_recent"] == 1.0 and rates["latency_ms_p50"] == 500.0
    assert rates["freshness_s"] == pytest.approx(2.1)
    assert len(parts["inspect"]) == 100 and {r["flagged_by"] for r in parts["inspect"]} <= {"both", "ensemble"}
    assert len(parts["ticker"]) == 25 and [r["version"] for r in parts["model"]] == [1, 2]
    assert parts["hot_swap"][0]["swapping"] is False
    behind = hot_swap_gap(scored.withColumn("model_version", F.lit(1)), registry).first()
    assert behind["swapping"] is True
