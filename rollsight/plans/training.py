"""Training from stored events: split, fit, tune, evaluate, publish."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..functions.session import materialised
from ..operators import evaluation as E
from ..operators import latest as L
from ..operators import splits as S
from ..sources import markers as K
from . import boosting
from . import registry as R
from .scoring import Model, apply_model, with_features


@dataclass(frozen=True)
class BoostParams:
    """Boosted trees; depth 5 gives the 31-leaf trees of the original setting."""

    iterations: int = 200
    step: float = 0.08
    depth: int = 5
    seed: int = 0


class NotEnoughData(RuntimeError):
    pass


def training_rows(scored: DataFrame) -> DataFrame:
    """Latest row per (coil, stand): features and labels only."""
    signals = [f for f in C.FEATURES if f != "stand"]
    columns = ["coil_id", "stand", "reading_id", *signals, *C.LABELS]
    return L.latest(scored.select(*columns), ["coil_id", "stand"]).withColumn(
        "y_any", F.coalesce(F.greatest(*C.LABELS), F.lit(False))
    )


HOLDOUT_COLUMNS = ["coil_id", *C.FEATURES, *C.LABELS, "y_any"]


def contract_stamp() -> str:
    return json.dumps({"features": C.FEATURES, "labels": C.FAMILIES})


def frozen_holdout(spark: SparkSession, path: str) -> DataFrame | None:
    """The pinned held-out rows; None before the freeze and after a change of the contract."""
    text = K.text_of(spark, f"{path}/manifest")
    if not text:
        return None
    manifest = json.loads(text)
    if manifest["contract"] != contract_stamp():
        return None
    return spark.read.parquet(f"{path}/{manifest['folder']}")


def carve_holdout(spark: SparkSession, rows: DataFrame, path: str) -> tuple[DataFrame, bool]:
    """(held-out rows, frozen?). Frozen once all families are covered; until then each training
    carves its own. A set frozen under another contract is carved again.

    What is frozen are the rows with their values, so evaluations stay comparable when events
    expire, arrive again or are corrected. The manifest names the folder of rows and goes live by
    one rename; of several trainings that freeze at once one does it, the others keep their own
    set for this time.
    """
    pinned = frozen_holdout(spark, path)
    if pinned is not None:
        return pinned, True
    earlier = json.loads(K.text_of(spark, f"{path}/manifest") or "{}").get("folder", "none")
    coverage = S.family_coverage(rows).first()
    if not S.can_carve(coverage):
        raise NotEnoughData(f"{coverage['coils']} coils are too few for a held-out set")
    coils = S.holdout_coils(rows).select("coil_id")
    held = S.rows_of(rows, coils).select(*[name for name in HOLDOUT_COLUMNS])
    if not S.can_freeze(coverage):
        return materialised(held), False
    folder = f"rows-{uuid.uuid4().hex}"
    held.write.parquet(f"{path}/{folder}")
    stored = spark.read.parquet(f"{path}/{folder}")
    counted = stored.agg(F.count(F.lit(1)), F.count_distinct("coil_id")).first()
    # The first to claim the place after the set before publishes its rows.
    if not K.create_once(spark, f"{path}/_claims/after={earlier}"):
        return stored, False
    K.swap_text(spark, f"{path}/manifest", json.dumps({
        "folder": folder, "contract": contract_stamp(), "rows": counted[0], "coils": counted[1],
    }))
    return stored, True


def fit(rows: DataFrame, params: BoostParams = BoostParams()) -> tuple[dict, dict]:
    """One class-balanced classifier per family; None where only one class occurs, which
    then scores 0. Also the positives per family."""
    weights = {row["family"]: row for row in E.class_weights(rows).collect()}
    known = [f for f in C.FAMILIES if None not in (weights[f]["weight_fault"], weights[f]["weight_normal"])]
    truth = {family: F.coalesce(F.col(f"y_{family}"), F.lit(False)) for family in known}
    classifier = GBTClassifier(
        featuresCol="_features", labelCol="label", weightCol="weight",
        maxIter=params.iterations, stepSize=params.step, maxDepth=params.depth, seed=params.seed,
    )
    labels = [
        boosting.Label(family, classifier.copy(), row["weight_fault"], row["weight_normal"], row["n"], row["positives"])
        for family, row in ((family, weights[family]) for family in known)
    ]
    vectors = with_features(rows).select("_features", *C.LABELS).persist()
    weighted = [
        vectors.select(
            "_features",
            truth[label.name].cast("double").alias("label"),
            F.when(truth[label.name], label.fault).otherwise(label.normal).alias("weight"),
        )
        for label in labels
    ]
    binned = rows.select(
        *[X.finite_or_zero(F.col(name)).cast("double").alias(name) for name in C.FEATURES],
        *[truth[family].alias(f"y_{family}") for family in known],
    )
    models = boosting.boosted(binned, C.FEATURES, [f"y_{family}" for family in known], labels, weighted)
    vectors.unpersist()
    return (
        {family: models.get(family) for family in C.FAMILIES},
        {family: weights[family]["positives"] for family in C.FAMILIES},
    )


def retrain(
    scored: DataFrame,
    models_path: str,
    registry_path: str,
    holdout_path: str,
    params: BoostParams = BoostParams(),
    now: dt.datetime | None = None,
) -> dict:
    """Train, tune on validation coils, evaluate on held-out rows, publish the version.

    The version number is claimed before publication, so trainings at the same time publish under
    numbers of their own. Only counts, metrics and the trees reach the driver. The registry row is written before
    the model becomes visible.
    """
    spark = scored.sparkSession
    rows = materialised(training_rows(scored))
    C.check_contract(rows)
    holdout, frozen = carve_holdout(spark, rows, holdout_path)
    usable = materialised(S.rows_without(rows, holdout.select("coil_id").distinct()))
    n_rows, n_coils = usable.agg(F.count(F.lit(1)), F.count_distinct("coil_id")).first()
    if n_rows < C.MIN_TRAIN_ROWS:
        raise NotEnoughData(f"{n_rows} rows are too few to train on")
    validation = materialised(S.validation_coils(usable).select("coil_id"))
    train = materialised(S.rows_without(usable, validation))
    n_train = train.count()
    classifiers, positives = fit(train, params)

    version = R.claim_version(spark, registry_path)
    moment = (now or dt.datetime.now(dt.timezone.utc)).replace(tzinfo=None)
    model = Model(version, classifiers, trained_at=moment.isoformat(), trained_on=f"streamed {n_coils} coils")
    tuned = apply_model(S.rows_of(usable, validation), model).select("anomaly_score", "y_any")
    model.threshold = E.tune_threshold(tuned).first()["threshold"]
    model.metrics = evaluated(holdout, model)
    R.register(registry_row(spark, model, n_train, moment), registry_path)
    R.save_model(spark, model, models_path)
    return {
        "version": version, "threshold": round(model.threshold, 3), "n_train": n_train,
        "n_coils": n_coils, "family_positives": positives, "metrics": model.metrics,
        "holdout_frozen": frozen,
    }


def evaluated(holdout: DataFrame, model: Model) -> dict:
    """Metrics of a model on held-out rows."""
    held = E.stored(apply_model(holdout, model).select("anomaly_score", "y_any", *C.LABELS))
    return E.evaluate(held, model.threshold).first().asDict()


def next_version(spark: SparkSession, registry_path: str) -> int:
    return L.next_version(R.read_registry(spark, registry_path)).first()["next_version"]


def registry_row(spark: SparkSession, model: Model, n_train: int, moment) -> DataFrame:
    measured = model.metrics
    row = (
        model.version, moment, n_train, float(model.threshold),
        measured["f1"], measured["pr_auc"], measured["precision"], measured["recall"],
        *[measured[name] for name in C.FAMILY_RECALLS], model.trained_on,
    )
    return spark.createDataFrame([row], C.REGISTRY_SCHEMA)
