"""Names, schemas and parameters shared by every part of the package.

The values under "fixed values" define the data contract: a model trained on one order of
the features must score on the same order, and the tables are read by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The 16 model features in training order, and the 4 fault families.
FEATURES = [
    "work_roll_diam", "work_roll_mileage", "reduction", "roll_speed",
    "force", "torque", "gap", "motor_power",
    "thickness_entry", "thickness_exit", "width", "ys_entry", "ys_exit",
    "tension_in", "tension_out", "stand",
]
FAMILIES = ["electric", "bearing", "workroll", "reduction"]

SIGNALS = [name for name in FEATURES if name != "stand"]
SET_POINTS = ["thickness_entry", "thickness_exit", "width", "ys_entry", "ys_exit"]
PROCESS_SIGNALS = [name for name in SIGNALS if name not in SET_POINTS]
STAND_SIGNALS = [name for name in PROCESS_SIGNALS if not name.startswith("tension_")]
STANDS = (1, 2, 3, 4, 5)
LABELS = [f"y_{family}" for family in FAMILIES]
PROBABILITIES = [f"p_{family}" for family in FAMILIES]

# Label columns of the wide source; the reduction label covers all stands.
WIDE_LABELS = {
    "electric": "Anomaly_Electric_{stand}",
    "bearing": "Anomaly_Bearing_{stand}",
    "workroll": "Anomaly_WorkRoll_{stand}",
    "reduction": "Anomaly_Reduction",
}
# What counts as true in label columns.
TRUE_WORDS = ["true", "1", "t", "yes"]

COIL_STRIDE = 1_000_000
SHUFFLE_SEED = 42

KPI_THRESHOLD = 0.85
FALLBACK_THRESHOLD = 0.85
KPI_WINDOW = "1 minute"
WATERMARK = "1 second"

MAHA_CUT = 23.21
SPC_CUT = 3.0
KNN_CUT = 3.0
VOTES_NEEDED = 2

HOLDOUT_SHARE, HOLDOUT_SEED = 0.15, 42
VALIDATION_SHARE, VALIDATION_SEED = 0.15, 7
MIN_COILS, MIN_FAMILY_COILS, MIN_TRAIN_ROWS = 200, 25, 1000

# The threshold sweep 0.05, 0.10 ... 0.95 and its fallback.
THRESHOLD_GRID = [round(0.05 * step, 2) for step in range(1, 20)]
NEUTRAL_THRESHOLD = 0.5

ROLL_LIFE_KM = 120.0


@dataclass(frozen=True)
class DetectorParams:
    """Parameters of the adaptive per-stand detectors."""

    alpha: float = 0.002
    warmup: int = 200
    ridge: float = 1e-3
    buffer: int = 300
    neighbours: int = 5
    least_buffer: int = 50
    variance_floor: float = 1e-12
    distance_floor: float = 1e-9


@dataclass(frozen=True)
class DriftPolicy:
    """When live recall is low enough to train again."""

    enabled: bool = True
    window: str = "3 minutes"
    recall_floor: float = 0.5
    min_positives: int = 200
    min_interval_s: float = 180.0
    max_idle_s: float = 60.0


def _fields(names, kind):
    return [T.StructField(name, kind) for name in names]


# One event of the JSON topic.
READING_SCHEMA = T.StructType(
    [
        T.StructField("coil_id", T.LongType()),
        T.StructField("stand", T.IntegerType()),
        T.StructField("file_no", T.IntegerType()),
        T.StructField("ts_ms", T.LongType()),
    ]
    + _fields(SIGNALS, T.DoubleType())
    + _fields(LABELS, T.BooleanType())
)

# One stored event; `reading_id` and `ingested_at` are added by the sink.
SCORED_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("coil_id", T.LongType()),
        T.StructField("stand", T.IntegerType()),
        T.StructField("file_no", T.IntegerType()),
    ]
    + _fields(SIGNALS, T.DoubleType())
    + _fields(["anomaly_score"] + PROBABILITIES, T.DoubleType())
    + _fields(LABELS + ["y_any"], T.BooleanType())
    + [T.StructField("model_version", T.IntegerType())]
    + _fields(["u_maha", "u_spc", "u_knn"], T.DoubleType())
    + [T.StructField("u_votes", T.IntegerType()), T.StructField("u_anomaly", T.BooleanType())]
)

KPI_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("coils", T.LongType()),
        T.StructField("events", T.LongType()),
        T.StructField("anomalies", T.LongType()),
        T.StructField("anomaly_rate", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
    ]
)

METRICS = ["overall_f1", "overall_pr_auc", "precision", "recall"]
FAMILY_RECALLS = [f"recall_{family}" for family in FAMILIES]

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField("trained_at", T.TimestampNTZType()),
        T.StructField("n_train_samples", T.LongType()),
    ]
    + _fields(["threshold"] + METRICS + FAMILY_RECALLS, T.DoubleType())
    + [T.StructField("trained_on", T.StringType())]
)


def wide_schema() -> T.StructType:
    """Schema of one raw wide CSV row; labels are read as text and normalised later."""
    numeric = [f"{signal}_{stand}" for signal in STAND_SIGNALS for stand in STANDS]
    numeric += SET_POINTS + [f"tension_{i}" for i in range(len(STANDS) + 1)]
    labels = [
        WIDE_LABELS[family].format(stand=stand)
        for family in FAMILIES[:-1]
        for stand in STANDS
    ] + [WIDE_LABELS["reduction"]]
    return T.StructType(_fields(numeric, T.DoubleType()) + _fields(labels, T.StringType()))


class ContractError(ValueError):
    """Raised when a table or a model does not carry exactly the agreed columns."""


def contract_mismatches(features, labels) -> list[str]:
    """Reasons why these feature and label lists cannot be used; empty when they can."""
    reasons = []
    if list(features) != FEATURES:
        reasons.append("features differ in name, number or order")
    if len(set(features)) != len(list(features)):
        reasons.append("duplicate features")
    if list(labels) != FAMILIES:
        reasons.append("fault families differ in name, number or order")
    return reasons


def check_contract(df) -> None:
    """Fail before a job starts when features or labels are absent from the schema."""
    names = df.columns
    missing = [name for name in FEATURES + LABELS if name not in names]
    repeated = sorted({name for name in FEATURES + LABELS if names.count(name) > 1})
    if missing or repeated:
        raise ContractError(f"missing columns {missing}, repeated columns {repeated}")
