"""Streaming jobs end to end: score, store, window, replay, hot-swap, late events."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from rollsight import contract as C
from rollsight.operators.rates import kpi_windows
from rollsight.plans import registry as R
from rollsight.plans.scoring import Model
from rollsight.streaming import jobs as B
from rollsight.sources.totals import add_batch, read_totals
from rollsight.sources.wire import decode, file_events

T0 = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone.utc)


def drop_file(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")


def event(coil, second, stand=1, **changes):
    base = {"coil_id": coil, "stand": stand, "file_no": 1, "ts_ms": int((T0.timestamp() + second) * 1000)}
    rng = random.Random(coil * 10 + stand)
    base |= {s: 10 + rng.random() for s in C.SIGNALS} | {y: False for y in C.LABELS}
    return base | changes


def coil(number, second):
    return [event(number, second, stand) for stand in C.STANDS]


def run_scoring(spark, source, stores):
    query = B.start_scoring(file_events(spark, str(source), 1), stores, {"availableNow": True})
    query.awaitTermination(240)
    assert query.exception() is None


def run_kpis(spark, stores, per_batch=None):
    events = B.stored_events(spark, stores, per_batch)
    query = B.start_kpis(events, stores, trigger={"availableNow": True})
    query.awaitTermination(240)
    assert query.exception() is None


def test_stored_events_and_closed_windows(spark, tmp_path):
    source, stores = tmp_path / "in", B.Stores(str(tmp_path / "out"))
    first = [e for i in range(60) for e in coil(i, i)] + ["garbage", json.dumps({"coil_id": 1})]
    drop_file(source, "a.json", first)
    drop_file(source, "b.json", [e for i in range(60, 150) for e in coil(i, i)])
    run_scoring(spark, source, stores)
    stored = B.read_events(spark, stores)
    assert stored.count() == 150 * 5
    assert stored.select("reading_id").distinct().count() == 150 * 5
    row = stored.where("coil_id = 3 AND stand = 2").first()
    assert (row["anomaly_score"], row["p_electric"], row["model_version"], row["y_any"]) == (0.0, 0.0, 0, False)
    assert row["ingested_at"] is not None and str(row["ts_day"]) == "2024-05-01"
    run_kpis(spark, stores)
    got = {r["window_start"]: (r["coils"], r["events"]) for r in B.read_kpis(spark, stores).collect()}
    batch = {r["window_start"]: (r["coils"], r["events"]) for r in kpi_windows(stored).collect()}
    last = max(batch)
    assert got == {w: v for w, v in batch.items() if w != last} and len(got) == 2


def test_late_events_are_stored_but_not_windowed(spark, tmp_path):
    source, stores = tmp_path / "in", B.Stores(str(tmp_path / "out"))
    drop_file(source, "a.json", [event(1, 10), event(2, 200)])
    run_scoring(spark, source, stores)
    run_kpis(spark, stores)
    drop_file(source, "b.json", [event(3, 15), event(4, 400)])
    run_scoring(spark, source, stores)
    run_kpis(spark, stores)
    drop_file(source, "c.json", [event(5, 600)])
    run_scoring(spark, source, stores)
    run_kpis(spark, stores)
    assert B.read_events(spark, stores).where("coil_id = 3").count() == 1
    kpis = {r["window_start"].minute: r["events"] for r in B.read_kpis(spark, stores).collect()}
    assert kpis[0] == 1 and sum(kpis.values()) <= 3


def test_replayed_batch_changes_nothing(spark, tmp_path):
    stores = B.Stores(str(tmp_path / "out"))
    R.make_folder(spark, stores.models)
    current = R.CurrentModel(spark, stores.models)
    lines = [json.dumps(e) for i in range(250) for e in coil(i, i)]
    raw = spark.createDataFrame([(v,) for v in lines], "value string")
    batches = [decode(raw.limit(1000)), decode(raw.offset(1000))]
    for n, batch in enumerate(batches):
        B.store_batch(batch, n, stores, current)
    columns = ["reading_id", "coil_id", "stand", "u_maha", "u_spc", "u_knn", "batch_id"]
    before = B.read_events(spark, stores).select(*columns).orderBy("reading_id").collect()
    state = spark.read.parquet(f"{stores.detector_state}/batch_id=1").orderBy("stand").collect()
    B.store_batch(batches[1], 1, stores, current)
    assert B.read_events(spark, stores).select(*columns).orderBy("reading_id").collect() == before
    assert spark.read.parquet(f"{stores.detector_state}/batch_id=1").orderBy("stand").collect() == state
    assert {r["u_maha"] > 0 for r in before if r["batch_id"] == 1} == {True}


def test_replayed_files_do_not_count_twice_in_windows(spark, tmp_path):
    source, stores = tmp_path / "in", B.Stores(str(tmp_path / "out"))
    drop_file(source, "a.json", [e for i in range(60) for e in coil(i, i)] + coil(99, 130))
    run_scoring(spark, source, stores)
    files = sorted((tmp_path / "out" / "scored_events").glob("batch_id=0/*/*.parquet"))
    (files[0].parent / "part-copy.parquet").write_bytes(files[0].read_bytes())
    run_kpis(spark, stores)
    kpis = {r["window_start"].minute: (r["coils"], r["events"]) for r in B.read_kpis(spark, stores).collect()}
    assert kpis[0] == (60, 300)


def test_hot_swap_and_rejected_models(spark, tmp_path):
    stores = B.Stores(str(tmp_path / "out"))
    R.make_folder(spark, stores.models)
    current = R.CurrentModel(spark, stores.models)
    raw = spark.createDataFrame([(json.dumps(e),) for e in coil(1, 0)], "value string")

    def version_of(batch):
        B.store_batch(decode(raw), batch, stores, current)
        rows = B.read_events(spark, stores).where(F.col("batch_id") == batch).select("model_version").distinct()
        return [r[0] for r in rows.collect()]

    constant = {family: None for family in C.FAMILIES}
    assert version_of(0) == [0]
    R.save_model(spark, Model(1, constant), stores.models)
    assert version_of(1) == [1]
    foreign = f"{stores.models}/version=2"
    meta = Model(2, constant).meta() | {"features": C.FEATURES[::-1]}
    R.write_text(spark, f"{foreign}/meta", json.dumps(meta))
    assert version_of(2) == [1]  # not marked ready: invisible
    R.write_text(spark, f"{foreign}/ready", "2")
    assert version_of(3) == [1] and 2 in current.rejected
    R.save_model(spark, Model(3, constant), stores.models)
    assert version_of(4) == [3]
    # A restarted job starts from the newest usable version.
    fresh = R.CurrentModel(spark, stores.models)
    assert fresh.refresh().version == 3


def test_batch_replayed_after_a_publication_keeps_its_model(spark, tmp_path):
    stores = B.Stores(str(tmp_path / "out"))
    R.make_folder(spark, stores.models)
    raw = [spark.createDataFrame([(json.dumps(e),) for i in range(20) for e in coil(n * 20 + i, n * 20 + i)], "value string") for n in range(3)]
    constant = {family: None for family in C.FAMILIES}
    current = R.CurrentModel(spark, stores.models)

    def rows(batch):
        found = B.read_events(spark, stores).where(F.col("batch_id") == batch)
        return found.drop("ingested_at").orderBy("reading_id").collect()

    B.store_batch(decode(raw[0]), 0, stores, current)
    R.save_model(spark, Model(1, constant), stores.models)
    B.store_batch(decode(raw[1]), 1, stores, current)
    before = rows(0), rows(1)
    assert {r["model_version"] for r in before[0]} == {0} and {r["model_version"] for r in before[1]} == {1}
    R.save_model(spark, Model(2, constant), stores.models)
    restarted = R.CurrentModel(spark, stores.models)
    for batch in (0, 1):
        B.store_batch(decode(raw[batch]), batch, stores, restarted)
    assert (rows(0), rows(1)) == before
    B.store_batch(decode(raw[2]), 2, stores, restarted)
    assert {r["model_version"] for r in rows(2)} == {2}


def test_totals_count_every_coil_once_and_replays_not_at_all(spark, tmp_path):
    path = str(tmp_path / "totals")
    assert tuple(read_totals(spark, path).first()) == (0, 0, None, None)
    times = [T0.replace(tzinfo=None) + dt.timedelta(seconds=s) for s in range(10)]
    batches = [[(1, 0), (2, 1), (2, 2)], [(2, 3), (3, 4), (None, 5)], [(9, 6), (1, 7), (3, 8), (3, 9)], []]
    frames = [spark.createDataFrame([(c, times[t]) for c, t in rows], "coil_id long, ts timestamp_ntz") for rows in batches]
    for number, frame in enumerate(frames):
        add_batch(frame, path, number)
    want = (10, 4, times[0], times[9])
    assert tuple(read_totals(spark, path).first()) == want
    add_batch(frames[1], path, 1)
    assert tuple(read_totals(spark, path).first()) == want


def test_bad_kafka_environment_is_reported(spark):
    from rollsight.sources.wire import kafka_events

    with pytest.raises(Exception):
        kafka_events(spark, "nowhere:9092", "readings")
