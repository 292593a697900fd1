"""The families' trees grown together: the trees of MLlib's classifier, in fewer jobs."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rollsight import contract as C
from rollsight.operators import evaluation as E
from rollsight.plans import boosting as B
from rollsight.plans import training as M
from rollsight.plans.scoring import with_features


def rows_of(spark, count, seed, parts=3):
    """Noisy labels over a few signals, some of them missing, coarse or constant."""
    frame = spark.range(count).repartition(parts).sortWithinPartitions("id")
    signals = {s: F.rand(seed + i) for i, s in enumerate(C.SIGNALS)}
    signals["width"] = F.lit(1000.0)
    signals["reduction"] = F.floor(F.rand(seed + 50) * 6).cast("double")
    signals["torque"] = F.when(F.rand(seed + 51) > 0.1, F.rand(seed + 52))
    frame = frame.withColumns(signals).withColumn("stand", (F.col("id") % 5 + 1).cast("int"))
    noise = F.rand(seed + 53) < 0.05
    return frame.withColumns({
        "y_electric": (F.col("force") + F.col("gap") > 1.4) | noise,
        "y_bearing": (F.col("torque") > 0.7) & (F.col("reduction") > 2),
        "y_workroll": (F.col("tension_in") * F.col("roll_speed") > 0.5) != noise,
        "y_reduction": F.lit(False),
    })


def mllib(rows, family, params):
    weights = {row["family"]: row for row in E.class_weights(rows).collect()}[family]
    label = F.coalesce(F.col(f"y_{family}"), F.lit(False))
    weighted = with_features(rows).select(
        "_features", label.cast("double").alias("label"),
        F.when(label, weights["weight_fault"]).otherwise(weights["weight_normal"]).alias("weight"),
    )
    return GBTClassifier(
        featuresCol="_features", labelCol="label", weightCol="weight", maxIter=params.iterations,
        stepSize=params.step, maxDepth=params.depth, seed=params.seed,
    ).fit(weighted)


def scored(model, rows, column):
    model = model.copy().setFeaturesCol("_features").setProbabilityCol("_p")
    model.setRawPredictionCol("").setPredictionCol("")
    return model.transform(rows).withColumn(column, vector_to_array("_p")[1]).drop("_p")


@pytest.mark.parametrize("count", [3_000, 25_000])
def test_trees_are_those_of_the_classifier(spark, tmp_path, monkeypatch, count):
    """Equal scores on the rows they are fitted to, with several blocks and stored margins; over 10,000 rows
    MLlib finds its thresholds in a sample. Of equally good splits rounding may pick another one, which
    only rows outside the training can tell."""
    monkeypatch.setattr(B, "STORED_EVERY", 2)
    rows_of(spark, count, 7).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    params = M.BoostParams(iterations=5, step=0.3, depth=4)
    models, positives = M.fit(rows, params)
    assert models["reduction"] is None and positives["reduction"] == 0
    known, fresh = with_features(rows), with_features(rows_of(spark, 2_000, 900)).persist()
    for family in ("electric", "bearing", "workroll"):
        model, expected = models[family], mllib(rows, family, params)
        assert isinstance(model, GBTClassificationModel) and model.getNumTrees == 5
        assert model.treeWeights == expected.treeWeights and model.numFeatures == len(C.FEATURES)
        assert model.getMaxIter() == 5 and model.getStepSize() == 0.3
        gap = F.abs(F.col("p") - F.col("q"))
        assert scored(expected, scored(model, known, "p"), "q").agg(F.max(gap)).first()[0] < 1e-9
        assert scored(expected, scored(model, fresh, "p"), "q").where(gap > 1e-9).count() <= 40
        for tree, other in zip(model.trees, expected.trees):
            assert tree.toDebugString.splitlines()[1] == other.toDebugString.splitlines()[1]
        assert max(abs(model.featureImportances.toArray() - expected.featureImportances.toArray())) < 0.02


def test_one_job_per_level_for_all_families(spark):
    """Before, each family ran its own jobs for each level of each tree: over 20 x 3 x 3 here."""
    rows = rows_of(spark, 1_500, 3, parts=1).persist()
    rows.count()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    before = max(jobs())
    M.fit(rows, M.BoostParams(iterations=20, step=0.3, depth=3))
    assert max(jobs()) - before < 20 * 3 + 110
    rows.unpersist()


def test_rows_without_any_difference(spark):
    """All features are constant: every tree is its root."""
    rows = spark.range(400).select(
        *[F.lit(1.0).alias(s) for s in C.SIGNALS], F.lit(1).alias("stand"),
        *[(F.col("id") % (k + 2) == 0).alias(label) for k, label in enumerate(C.LABELS)],
    )
    models, _ = M.fit(rows, M.BoostParams(iterations=3, step=0.3, depth=3))
    assert all(tree.numNodes == 1 for tree in models["bearing"].trees)
    p = scored(models["bearing"], with_features(rows), "p").agg(F.min("p"), F.max("p")).first()
    assert p[0] == p[1] == pytest.approx(0.5)


def test_sums_of_a_block_against_counting():
    """All labels' places and more bins than the classifier asks for, which its weights can make."""
    random = np.random.default_rng(5)
    width, size = 35, 4_000
    bins = random.integers(0, width, (3, size)).astype(np.uint8)
    truth, pull = random.random(size) < 0.1, random.normal(size=size)
    column, cut = np.zeros(8, dtype=np.intp), np.full(8, B.NO_CUT, dtype=np.uint16)
    column[1], cut[1], column[3], cut[3] = 2, 33, 1, 10
    node = np.where(bins[2] > 33, np.where(bins[1] > 10, 7, 6), 4)
    assert (B.nodes_of(bins, column, cut, 2) == node).all()
    total, sums, counts = B._counted(bins, truth, pull, 2, column, cut, [7, 6], [0, 2], width, False)
    assert total == pytest.approx(pull.sum())
    for k, place in enumerate([0, 2]):
        for slot, wanted in enumerate([7, 6]):
            for b in range(width):
                here = (node == wanted) & (bins[place] == b)
                at = slot * width + b
                assert sums[k, at] == pytest.approx(pull[here].sum())
                assert counts[0, k, at] == here.sum() and counts[1, k, at] == (here & truth).sum()
