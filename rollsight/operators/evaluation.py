"""Model evaluation: confusion counts, threshold sweep, average precision, recalls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import columns as X
from ..functions.session import materialised
from .ordered import running_totals


def _count(flag: Column) -> Column:
    return F.count(F.when(flag, 1))


def _ratio(part: Column, whole: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, threshold, *groups, truth: str = "y_any") -> DataFrame:
    hit, fault = X.is_alarm(threshold), F.col(truth)
    return df.groupBy(*groups).agg(
        _count(hit & fault).alias("tp"),
        _count(hit & ~fault).alias("fp"),
        _count(~hit & fault).alias("fn"),
        _count(~hit & ~fault).alias("tn"),
    )


def _precision_recall_f1():
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall))
    return [
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(f1, F.lit(0.0)).alias("f1"),
    ]


def precision_recall(df: DataFrame, threshold, *groups, truth: str = "y_any") -> DataFrame:
    counts = confusion_counts(df, threshold, *groups, truth=truth)
    kept = [c for c in counts.columns if c not in ("tp", "fp", "fn", "tn")]
    return counts.select(*kept, "tp", "fp", "fn", "tn", *_precision_recall_f1())


def family_counts(df: DataFrame, threshold) -> DataFrame:
    """Positives and caught positives of the four families, one pass, one row."""
    hit = X.is_alarm(threshold)
    return df.agg(
        *[
            agg
            for family in C.FAMILIES
            for agg in (
                _count(F.col(f"y_{family}")).alias(f"{family}_pos"),
                _count(F.col(f"y_{family}") & hit).alias(f"{family}_caught"),
            )
        ]
    )


def family_rows(counts: DataFrame) -> DataFrame:
    """The one-row counts as a row per family, with the recall of each."""
    rows = [
        F.struct(
            F.lit(family).alias("family"),
            F.col(f"{family}_pos").alias("positives"),
            F.col(f"{family}_caught").alias("caught"),
        )
        for family in C.FAMILIES
    ]
    return counts.select(F.inline(F.array(*rows))).withColumn(
        "recall", F.when(F.col("positives") > 0, F.col("caught") / F.col("positives"))
    )


def average_precision(df: DataFrame, truth: str = "y_any") -> DataFrame:
    """Σ (Rᵢ − Rᵢ₋₁) · Pᵢ over descending distinct scores; 0 if only one class occurs.

    Rows are reduced to distinct scores first; the running counts over the score order are
    taken piece by piece (`operators.ordered`), never in one task.
    """
    fault = F.col(truth)
    by_score = df.groupBy("anomaly_score").agg(
        _count(fault).alias("faults"), F.count(F.lit(1)).alias("rows")
    )
    swept = running_totals(by_score, [F.desc("anomaly_score")], ["faults", "rows"])
    gain = F.col("faults") * (F.col("upto_faults") / F.col("upto_rows"))
    total, everything = F.sum("faults"), F.sum("rows")
    mixed = (total > 0) & (total < everything)
    return swept.agg(
        F.when(mixed, F.sum(gain) / total).otherwise(F.lit(0.0)).alias("average_precision")
    )


def threshold_sweep(df: DataFrame, truth: str = "y_any") -> DataFrame:
    """F1 of every candidate threshold, from one aggregation with conditional sums."""
    fault = F.coalesce(F.col(truth), F.lit(False))
    sums = [_count(fault).alias("faults"), F.count(F.lit(1)).alias("rows")]
    for i, t in enumerate(C.THRESHOLD_GRID):
        hit = F.col("anomaly_score") >= t
        sums += [_count(hit & fault).alias(f"tp{i}"), _count(hit).alias(f"hits{i}")]
    rows = [
        F.struct(
            F.lit(t).alias("threshold"),
            F.col(f"tp{i}").alias("tp"),
            (F.col(f"hits{i}") - F.col(f"tp{i}")).alias("fp"),
            (F.col("faults") - F.col(f"tp{i}")).alias("fn"),
        )
        for i, t in enumerate(C.THRESHOLD_GRID)
    ]
    tp2 = 2 * F.col("tp")
    return df.agg(*sums).select("faults", "rows", F.inline(F.array(*rows))).withColumn(
        "f1", _ratio(tp2, tp2 + F.col("fp") + F.col("fn"))
    )


def tune_threshold(df: DataFrame, truth: str = "y_any") -> DataFrame:
    """Best threshold by F1, the smallest on a tie; neutral when one class is missing."""
    sweep = threshold_sweep(df, truth)
    mixed = (F.col("faults") > 0) & (F.col("faults") < F.col("rows"))
    best = sweep.agg(
        F.max_by("threshold", F.struct("f1", -F.col("threshold"))).alias("best"),
        F.max("f1").alias("best_f1"),
        F.bool_and(mixed).alias("mixed"),
    )
    return best.select(
        F.when(F.col("mixed"), F.col("best")).otherwise(C.NEUTRAL_THRESHOLD).alias("threshold"),
        F.when(F.col("mixed"), F.col("best_f1")).otherwise(F.lit(0.0)).alias("f1"),
    )


def evaluate(df: DataFrame, threshold) -> DataFrame:
    """All metrics of a scored, labelled set in one row."""
    hit = X.is_alarm(threshold)
    recalls = [
        F.coalesce(F.avg(F.when(F.col(f"y_{family}"), hit.cast("double"))), F.lit(0.0)).alias(
            f"recall_{family}"
        )
        for family in C.FAMILIES
    ]
    fault = F.col("y_any")
    measured = df.agg(
        _count(hit & fault).alias("tp"),
        _count(hit & ~fault).alias("fp"),
        _count(~hit & fault).alias("fn"),
        F.count(F.lit(1)).alias("n_eval"),
        *recalls,
    )
    pr_auc = average_precision(df).scalar()
    return measured.select(
        *_precision_recall_f1(), pr_auc.alias("pr_auc"), *C.FAMILY_RECALLS, "n_eval"
    )


def class_weights(df: DataFrame) -> DataFrame:
    """Balanced weights n / (2 · class size) per family; NULL for an absent class."""
    total = F.count(F.lit(1))
    counted = df.agg(
        total.alias("n"), *[_count(F.col(label)).alias(label) for label in C.LABELS]
    )
    rows = [
        F.struct(
            F.lit(family).alias("family"),
            F.col("n").alias("n"),
            F.col(f"y_{family}").alias("positives"),
        )
        for family in C.FAMILIES
    ]
    def weight(size):
        return F.when(size > 0, F.col("n") / (2.0 * size))

    return counted.select(F.inline(F.array(*rows))).select(
        "family", "n", "positives",
        weight(F.col("positives")).alias("weight_fault"),
        weight(F.col("n") - F.col("positives")).alias("weight_normal"),
    )


def stored(df: DataFrame) -> DataFrame:
    """Score a set once when several metrics read it."""
    return materialised(df)
