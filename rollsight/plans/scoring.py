"""Applying a trained model to rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X


@dataclass
class Model:
    """A version of the fault model: one classifier per family, None for a constant one."""

    version: int
    classifiers: dict
    threshold: float = C.NEUTRAL_THRESHOLD
    trained_at: str = ""
    trained_on: str = ""
    metrics: dict = field(default_factory=dict)

    def meta(self) -> dict:
        return {
            "version": self.version,
            "threshold": self.threshold,
            "features": C.FEATURES,
            "labels": C.FAMILIES,
            "trained": [f for f in C.FAMILIES if self.classifiers.get(f) is not None],
            "trained_at": self.trained_at,
            "trained_on": self.trained_on,
            "metrics": self.metrics,
        }


def with_features(df: DataFrame) -> DataFrame:
    """The 16 cleaned features in contract order as one vector column."""
    cleaned = F.array(*[X.finite_or_zero(F.col(name)) for name in C.FEATURES])
    return df.withColumn("_features", array_to_vector(cleaned))


def apply_model(df: DataFrame, model: Model | None) -> DataFrame:
    """Family probabilities, their maximum and the version; zeros while no model exists."""
    out = with_features(df) if model else df
    for family, column in zip(C.FAMILIES, C.PROBABILITIES):
        classifier = model.classifiers.get(family) if model else None
        if classifier is None:
            out = out.withColumn(column, F.lit(0.0))
            continue
        classifier = classifier.copy()
        classifier.setFeaturesCol("_features").setProbabilityCol("_probability")
        classifier.setRawPredictionCol("").setPredictionCol("")
        out = classifier.transform(out).withColumn(
            column, vector_to_array("_probability")[1]
        ).drop("_probability")
    return out.drop("_features").withColumns(
        {
            "anomaly_score": F.greatest(*C.PROBABILITIES),
            "model_version": F.lit(model.version if model else 0),
        }
    )
