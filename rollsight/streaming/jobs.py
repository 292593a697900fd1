"""The two streaming queries: score and store events; window the stored events into KPIs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import contract as C
from ..functions import columns as X
from ..functions.session import ensure_checkpoint_dir, materialised, utc
from ..operators.rates import window_coils, window_totals
from ..plans.registry import CurrentModel, make_folder
from ..plans.scoring import Model, apply_model
from ..sources.tables import append_batch, read_batches, stamp, to_sink_schema, upserted
from ..sources.totals import add_batch
from ..sources.wire import decode, keyed_only
from . import state as S


# A micro-batch starts as soon as the one before has ended.
AT_ONCE = {"processingTime": "0 seconds"}


@dataclass(frozen=True)
class Stores:
    """Folders of one deployment, all below a path every executor reaches."""

    root: str

    @property
    def events(self):
        return f"{self.root}/scored_events"

    @property
    def kpis(self):
        return f"{self.root}/kpi_windows"

    @property
    def models(self):
        return f"{self.root}/models"

    @property
    def registry(self):
        return f"{self.root}/model_versions"

    @property
    def holdout(self):
        return f"{self.root}/holdout"

    @property
    def detector_state(self):
        return f"{self.root}/detector_state"

    @property
    def totals(self):
        return f"{self.root}/totals"

    @property
    def journal(self):
        return f"{self.root}/model_journal"

    def checkpoint(self, query: str):
        return f"{self.root}/checkpoints/{query}"


def score(events: DataFrame, model: Model | None) -> DataFrame:
    """Decoded events → label and model scores, each event scored once."""
    return apply_model(events.withColumn("y_any", X.any_label()), model)


def store_batch(
    events: DataFrame, batch_id: int, stores: Stores, current: CurrentModel,
    params: C.DetectorParams = C.DetectorParams(),
) -> None:
    """One micro-batch: score, append under its batch folder, advance the detectors.

    Everything it writes is named by the batch, the detector state it reads is older and the model
    is the one noted at its first attempt, so a replayed batch overwrites what it wrote with the
    same rows.
    """
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    signals = tuple(C.PROCESS_SIGNALS)
    batch = materialised(score(keyed_only(events), current.at(batch_id, stores.journal)).withColumn(S.ROW, F.monotonically_increasing_id()))
    scores, after = S.advance(batch, S.state_before(spark, stores.detector_state, batch_id), signals, params)
    scored = batch.join(scores, S.ROW).withColumns({"u_votes": X.votes(), "u_anomaly": X.voted()})
    numbered = to_sink_schema(scored.withColumnRenamed(S.ROW, "_number"), "_number")
    append_batch(stamp(numbered, batch_id, "_number"), stores.events, batch_id)
    add_batch(batch.select("coil_id", "ts"), stores.totals, batch_id)
    S.save_state(after, stores.detector_state, batch_id)


def start_scoring(
    raw: DataFrame, stores: Stores, trigger: dict | None = None,
    params: C.DetectorParams = C.DetectorParams(),
) -> StreamingQuery:
    """Query 1: raw `value` stream → stored scored events. Late events are stored too."""
    spark = utc(raw.sparkSession)
    for folder in (stores.events, stores.models):
        make_folder(spark, folder)
    current = CurrentModel(spark, stores.models)
    return (
        decode(raw).writeStream.queryName("score_events")
        .option("checkpointLocation", stores.checkpoint("score_events"))
        .foreachBatch(lambda batch, n: store_batch(batch, n, stores, current, params))
        .trigger(**(trigger or AT_ONCE))
        .start()
    )


STORED_SCHEMA = C.SCORED_SCHEMA


def stored_events(spark: SparkSession, stores: Stores, per_batch: int | None = None) -> DataFrame:
    """The stored events as a stream."""
    reader = spark.readStream.schema(STORED_SCHEMA).option("recursiveFileLookup", "true")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(stores.events)


def windowed(
    events: DataFrame, every: str = C.KPI_WINDOW, threshold: float = C.KPI_THRESHOLD,
    delay: str = C.WATERMARK,
) -> DataFrame:
    """KPI windows of a stream: replayed rows are dropped, rows behind the watermark too.

    A distinct count is not available on streams; two chained aggregations, per coil and
    then per window, give the same numbers.
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    once = timed.dropDuplicatesWithinWatermark(["coil_id", "stand", "ts"])
    return window_totals(window_coils(once, every, threshold), threshold)


def start_kpis(
    events: DataFrame, stores: Stores, every: str = C.KPI_WINDOW,
    threshold: float = C.KPI_THRESHOLD, delay: str = C.WATERMARK, trigger: dict | None = None,
) -> StreamingQuery:
    """Query 2: stored events → closed KPI windows, appended under the batch id."""
    utc(events.sparkSession)
    return (
        windowed(events, every, threshold, delay)
        .writeStream.queryName("kpi_windows").outputMode("append")
        .option("checkpointLocation", stores.checkpoint("kpi_windows"))
        .foreachBatch(lambda batch, n: append_batch(batch, stores.kpis, n, by_day=False))
        .trigger(**(trigger or AT_ONCE))
        .start()
    )


def run_stream(
    raw: DataFrame, stores: Stores, every: str = C.KPI_WINDOW,
    threshold: float = C.KPI_THRESHOLD, trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Both queries; events are scored once and the KPIs read what was stored."""
    first = start_scoring(raw, stores, trigger)
    second = start_kpis(stored_events(raw.sparkSession, stores), stores, every, threshold, trigger=trigger)
    return [first, second]


def read_events(spark: SparkSession, stores: Stores) -> DataFrame:
    return read_batches(spark, stores.events)


def read_kpis(spark: SparkSession, stores: Stores) -> DataFrame:
    batches = read_batches(spark, stores.kpis)
    return upserted(batches, ["window_start", "window_end"]).drop("batch_id")
