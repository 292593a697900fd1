"""Column expressions on hand-made edge rows."""

import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rollsight import contract as C
from rollsight.functions import columns as X


def values(spark, schema, rows, expression):
    frame = spark.createDataFrame(rows, schema)
    return [r[0] for r in frame.select(expression).collect()]


def test_true_words(spark):
    words = ["True", " true ", "1", "t", "yes", "no", None, "", "0"]
    got = values(spark, "v string", [(w,) for w in words], X.is_true(F.col("v")))
    assert got == [True] * 5 + [False] * 4
    assert values(spark, "v boolean", [(True,), (False,), (None,)], X.is_true(F.col("v"))) == [True, False, False]


def test_unusable_numbers_become_zero(spark):
    rows = [(v,) for v in (None, math.nan, math.inf, -math.inf, 2.5, -0.5)]
    assert values(spark, "v double", rows, X.finite_or_zero(F.col("v"))) == [0, 0, 0, 0, 2.5, -0.5]


def test_any_label_is_three_valued(spark):
    rows = [(True, None, False, False), (False, None, False, False), (False,) * 4]
    schema = ", ".join(f"{n} boolean" for n in C.LABELS)
    assert values(spark, schema, rows, X.any_label()) == [True, None, False]


def test_votes_are_strict(spark):
    rows = [(23.21, 3.0, 3.0), (23.22, 3.0, 3.0), (23.22, 3.01, 3.0), (99.0, 9.0, 9.0), (None, 9.0, 9.0)]
    frame = spark.createDataFrame(rows, "u_maha double, u_spc double, u_knn double")
    got = frame.select(X.votes().alias("v"), X.voted().alias("a")).collect()
    assert [tuple(r) for r in got] == [(0, False), (1, False), (2, True), (3, True), (2, True)]


def test_alarm_includes_the_threshold(spark):
    got = values(spark, "anomaly_score double", [(0.85,), (0.8499,), (None,)], X.is_alarm(0.85))
    assert got == [True, False, None]


@pytest.mark.parametrize(
    "row, predicted, dominant",
    [
        ((0.1, 0.9, 0.2, 0.3), "bearing", "bearing"),
        ((0.0, 0.0, 0.0, 0.0), "electric", "electric"),
        ((0.1, 0.7, 0.7, 0.7), "bearing", "bearing"),
        ((None, None, None, None), "reduction", None),
        ((None, 0.2, None, 0.1), "bearing", "bearing"),
        ((None, None, None, 0.0), "reduction", "reduction"),
    ],
)
def test_families(spark, row, predicted, dominant):
    schema = ", ".join(f"{p} double" for p in C.PROBABILITIES)
    frame = spark.createDataFrame([row], schema)
    assert tuple(frame.select(X.predicted_family(), X.dominant_family()).first()) == (predicted, dominant)


def test_lamps_wear_and_age(spark):
    rows = [(0, 0.9), (10, 0.15), (10, 0.02), (10, 0.019)]
    assert values(spark, "e int, r double", rows, X.lamp(F.col("e"), F.col("r"))) == ["off", "r", "a", "g"]
    rows = [(None,), (-5.0,), (60.0,), (96.0,), (500.0,)]
    percent = X.wear_percent(F.col("km"))
    assert values(spark, "km double", rows, percent) == [None, 0.0, 50.0, 80.0, 100.0]
    assert values(spark, "km double", rows, X.wear_band(percent)) == [None, "g", "a", "r", "r"]
    rows = [(-3.0,), (0.9,), (1.0,), (59.4,), (90.0,), (7200.0,)]
    assert values(spark, "s double", rows, X.age_text(F.col("s"))) == ["now", "now", "1s", "59s", "2m", "2h"]


def test_rounding_is_half_up(spark):
    got = values(spark, "v double", [(0.125,), (2.675,), (-0.125,)], X.half_up(F.col("v"), 2).cast("double"))
    assert got == [0.13, 2.68, -0.13]


def test_contract(spark):
    assert C.contract_mismatches(C.FEATURES, C.FAMILIES) == []
    assert C.contract_mismatches(C.FEATURES[::-1], C.FAMILIES)
    assert C.contract_mismatches(C.FEATURES[:-1] + ["force"], C.FAMILIES)
    assert len(C.FEATURES) == 16 and C.FEATURES[-1] == "stand" and len(C.PROCESS_SIGNALS) == 10
    with pytest.raises(C.ContractError):
        C.check_contract(spark.createDataFrame([Row(force=1.0)]))


def test_labels_in_order(spark):
    schema = ", ".join(f"{n} boolean" for n in C.LABELS)
    assert values(spark, schema, [(True, False, False, True)], X.label_array()) == [[True, False, False, True]]
