"""CSV scan and ids, merge, unfold, JSON, stored batches, retention."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rollsight import contract as C
from rollsight.sources import coils as K
from rollsight.sources import tables as T
from rollsight.sources import wire as J

WIDE = C.wide_schema()


def write_csv(folder, number, rows):
    names = WIDE.fieldNames()
    lines = [",".join(names)]
    for i in range(rows):
        cells = [("True" if i % 2 else "False") if n.startswith("Anomaly") else f"{number * 1000 + i}.5" for n in names]
        lines.append(",".join(cells))
    (folder / f"mill_dataset_{number}.csv").write_text("\n".join(lines) + "\n")


def test_csv_ids_follow_the_rows_of_each_file(spark, tmp_path):
    sizes = {2: 400, 10: 150, 1: 30}
    for number, rows in sizes.items():
        write_csv(tmp_path, number, rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)  # many blocks per file
    try:
        ids = K.assign_coil_ids(K.read_coil_csv(spark, f"{tmp_path}/*_dataset_*.csv"))
        got = ids.select("coil_id", "file_no", "row_index", "force_1").collect()
        blocks = spark.read.csv(f"{tmp_path}/mill_dataset_2.csv").rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert blocks > 3
    assert len(got) == sum(sizes.values())
    for row in got:
        assert row["coil_id"] == row["file_no"] * 1_000_000 + row["row_index"]
        assert row["force_1"] == row["file_no"] * 1000 + row["row_index"] + 0.5


def test_merged_source_is_built_once_and_repeatable(spark, tmp_path):
    for number in (1, 2):
        write_csv(tmp_path, number, 50)
    merged = f"{tmp_path}/merged.parquet"
    first = [r["coil_id"] for r in K.merged_source(spark, str(tmp_path), merged).collect()]
    assert sorted(first) == [n * 1_000_000 + i for n in (1, 2) for i in range(50)]
    assert first != sorted(first)
    write_csv(tmp_path, 3, 10)  # ignored: the stored merge is used
    assert K.merged_source(spark, str(tmp_path), merged).count() == 100
    again = K.seeded_shuffle(spark.read.parquet(merged)).select("coil_id").collect()
    assert [r[0] for r in again] == first
    other = K.seeded_shuffle(spark.read.parquet(merged), seed=1).select("coil_id").collect()
    assert [r[0] for r in other] != first


def test_unfold_copies_set_points_and_brackets_tensions(spark, tmp_path):
    write_csv(tmp_path, 1, 4)
    wide = K.assign_coil_ids(K.read_coil_csv(spark, f"{tmp_path}/*.csv"))
    wide = wide.withColumns({f"tension_{i}": F.lit(float(i)) for i in range(6)})
    rows = K.unfold(wide).orderBy("coil_id", "stand").collect()
    assert len(rows) == 20
    assert [(r["stand"], r["tension_in"], r["tension_out"]) for r in rows[:5]] == [
        (s, s - 1.0, float(s)) for s in range(1, 6)
    ]
    assert {r["width"] for r in rows[:5]} == {1000.5}
    assert rows[0]["y_reduction"] is False and rows[5]["y_reduction"] is True
    two = K.unfold(K.first_coils(wide, 2, "coil_id").withColumn("ts_ms", F.lit(7)), "ts_ms").collect()
    assert len(two) == 10 and {r["ts_ms"] for r in two} == {7}
    assert K.first_coils(wide, 0).count() == 4


def test_json_round_trip_and_lenient_decode(spark):
    event = {"coil_id": 7, "stand": 2, "file_no": 1, "ts_ms": 1_700_000_000_123}
    event |= {s: 1.5 for s in C.SIGNALS} | {y: False for y in C.LABELS}
    no_gap = {k: v for k, v in event.items() if k != "gap"}
    texts = [
        json.dumps(event), "garbage", json.dumps(no_gap), json.dumps(event | {"force": "heavy"}),
        json.dumps(event | {"coil_id": None}), json.dumps(event | {"extra": 1}),
    ]
    decoded = J.keyed_only(J.decode(spark.createDataFrame([(t,) for t in texts], "value string")))
    rows = decoded.collect()
    assert [(r["gap"], r["force"]) for r in rows] == [(1.5, 1.5), (None, 1.5), (1.5, None), (1.5, 1.5)]
    millis = decoded.select(F.unix_millis("ts")).first()[0]
    assert millis == event["ts_ms"]
    sent = J.encode(decoded).first()
    assert sent["key"] == "7" and json.loads(sent["value"]) == event


def scored(spark, days):
    base = dt.datetime(2024, 5, 1, 12)
    rows = [(i, base + dt.timedelta(days=d, microseconds=1500 * i)) for i, d in enumerate(days)]
    frame = spark.createDataFrame(rows, "coil_id long, ts timestamp_ntz")
    missing = [f for f in C.SCORED_SCHEMA if f.name not in ("coil_id", "ts")]
    return T.to_sink_schema(frame.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}))


def test_batches_are_idempotent_and_ids_grow(spark, tmp_path):
    path = f"{tmp_path}/events"
    for batch, days in ((0, [0, 0, 1]), (1, [1, 2])):
        T.append_batch(T.stamp(scored(spark, days), batch), path, batch)
    before = sorted(r["reading_id"] for r in T.read_batches(spark, path).collect())
    T.append_batch(T.stamp(scored(spark, [1, 2]), 1), path, 1)
    stored = T.read_batches(spark, path)
    assert sorted(r["reading_id"] for r in stored.collect()) == before
    assert before == [0, 1, 2, 1 << 38, (1 << 38) + 1]
    assert stored.select("ts").first()["ts"].microsecond % 1000 == 0


def test_stamp_numbers_many_partitions_densely(spark):
    frame = scored(spark, [0] * 100).repartition(7)
    ids = sorted(r["reading_id"] for r in T.stamp(frame.persist(), 3).collect())
    assert ids == [3 * (1 << 38) + i for i in range(100)]


def test_retention_drops_whole_days(spark, tmp_path):
    path = f"{tmp_path}/events"
    T.append_batch(T.stamp(scored(spark, [0, 1, 2, 5]), 0), path, 0)
    assert T.retained(T.read_batches(spark, path), 3).count() == 1
    assert T.retained(T.read_batches(spark, path), 5).count() == 3
    gone = T.drop_expired(spark, path, 5)
    assert len(gone) == 1 and gone[0].endswith("ts_day=2024-05-01")
    assert T.read_batches(spark, path).count() == 3


def test_time_range_prunes_day_folders(spark, tmp_path):
    path = f"{tmp_path}/events"
    T.append_batch(T.stamp(scored(spark, range(6)), 0), path, 0)
    recent = T.between_ts(T.read_batches(spark, path), now="2024-05-02 12:00:00")
    assert "PartitionFilters" in recent._jdf.queryExecution().executedPlan().toString()
    assert "ts_day" in str(recent._jdf.queryExecution().executedPlan()).split("PartitionFilters", 1)[1][:200]
    ranged = T.between_ts(T.read_batches(spark, path), "2024-05-02 00:00:00", "2024-05-03 23:00:00")
    assert ranged.count() == 2
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_day" in plan


def test_upsert_and_compaction(spark, tmp_path):
    path = f"{tmp_path}/kpi"
    for batch, rows in ((0, [("a", 1), ("b", 2)]), (1, [("b", 20), ("c", 30)])):
        T.append_batch(spark.createDataFrame(rows, "k string, v int"), path, batch, by_day=False)
    view = T.upserted(T.read_batches(spark, path), ["k"])
    assert {(r["k"], r["v"]) for r in view.collect()} == {("a", 1), ("b", 20), ("c", 30)}
    T.compact(spark, path, f"{tmp_path}/kpi2", ["k"])
    assert T.read_batches(spark, f"{tmp_path}/kpi2").count() == 3
    with pytest.raises(Exception):
        T.compact(spark, path, f"{tmp_path}/kpi2", ["k"])


def test_event_compaction_keeps_every_row(spark, tmp_path):
    path, target = f"{tmp_path}/events", f"{tmp_path}/compact"
    for batch in range(4):
        T.append_batch(T.stamp(scored(spark, [0, 0, 0, batch]), batch), path, batch)
    T.compact_events(spark, path, target, rows_per_file=5)
    before, after = (
        sorted((r["reading_id"], r["ts"]) for r in T.read_batches(spark, p).collect()) for p in (path, target)
    )
    assert after == before and len(after) == 16
    files = list((tmp_path / "compact").glob("batch_id=0/ts_day=2024-05-01/*.parquet"))
    assert len(files) >= 3


@pytest.mark.parametrize("every, expected", [(1, 25), (30, 7), (1000, 1)])
def test_newest_rows_come_from_the_last_batches(spark, every, expected):
    frame = spark.range(200).selectExpr("id AS reading_id", "CAST(id AS INT) AS batch_id")
    wanted = F.col("reading_id") % every == 0
    part = T.newest_batches(frame, wanted, 25)
    got = [r[0] for r in part.where(wanted).orderBy(F.desc("reading_id")).limit(25).select("reading_id").collect()]
    assert got == [i for i in range(199, -1, -1) if i % every == 0][:25] and len(got) == expected


def test_ids_too_large_for_64_bits(spark, tmp_path):
    """Part numbers of tables sixty times as large; the later row of a key is the one with the larger id."""
    from rollsight.plans.catalog import QUERIES
    from rollsight.sources import fixtures as V

    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    names += "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"
    day = dt.datetime(2024, 1, 1)
    small = [(1, 900_000, 7, 1, 1.0, 10.25, 0.1, 0.0, "R", day), (1, 600_000, 9, 6, 2.0, 20.5, 0.1, 0.0, "N", day),
             (2, None, 9, 6, 2.0, 20.5, 0.1, 0.0, "N", day)]
    large = [(1, 1_200_000, 60_000, 6, 3.0, 30.0, 0.1, 0.0, "R", day), (2, 1_200_000, 60_001, 1, 4.0, 0.5, 0.1, 0.0, "N", day)]
    for name, rows in (("small", small), ("large", small + large), ("edge", small + [(3, 922_336, 9, 6, 2.0, 20.5, 0.1, 0.0, "N", day)])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
        found = QUERIES["latest_per_key"](spark, folder)
        got = {(r["coil_id"], r["stand"]): (r["reading_id"], r["torque"]) for r in found.collect()}
        expected = {(1, 1): ((900_000 * 10 ** 5 + 7) * 10 ** 8 + 1025, 1.0), (2, 1): (None, None)}
        if name == "large":
            expected = {(1, 1): ((1_200_000 * 10 ** 5 + 60_000) * 10 ** 8 + 3000, 3.0),
                        (2, 1): ((1_200_000 * 10 ** 5 + 60_001) * 10 ** 8 + 50, 4.0)}
        if name == "edge":
            expected[(3, 1)] = ((922_336 * 10 ** 5 + 9) * 10 ** 8 + 2050, 2.0)
        assert got == expected
        assert (found.schema["reading_id"].dataType.simpleString() == "bigint") == (name != "large")
        assert V.readings_numbered(spark, folder).columns == V.readings_big(spark, folder).columns
