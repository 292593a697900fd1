"""Column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contract as C


def is_true(value: Column) -> Column:
    """Boolean from a boolean or from a word such as ` True `; anything else is false."""
    word = F.lower(F.trim(value.cast("string")))
    return F.coalesce(word.isin(C.TRUE_WORDS), F.lit(False))


def any_label(*labels: Column) -> Column:
    """Three-valued OR of the label columns."""
    return reduce(or_, labels or [F.col(name) for name in C.LABELS])


def finite_or_zero(value: Column) -> Column:
    """NULL, NaN and infinities become 0.0, the same way for training and scoring."""
    value = value.cast("double")
    unusable = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(unusable, 0.0).otherwise(value)


def usable(name: str) -> str:
    """`finite_or_zero` of a named column as SQL text, for selections with many columns."""
    return (
        f"CASE WHEN `{name}` IS NULL OR isnan(`{name}`) OR abs(`{name}`) = double('Infinity') "
        f"THEN 0.0D ELSE double(`{name}`) END"
    )


def label_array(*labels: Column) -> Column:
    """The labels in contract order as one boolean array."""
    return F.array(*[c.cast("boolean") for c in labels or [F.col(n) for n in C.LABELS]])


def votes(
    maha: float = C.MAHA_CUT, spc: float = C.SPC_CUT, knn: float = C.KNN_CUT
) -> Column:
    """How many of the three detectors exceed their cut-off (strictly)."""
    over = [F.col("u_maha") > maha, F.col("u_spc") > spc, F.col("u_knn") > knn]
    return reduce(add, [F.when(flag, 1).otherwise(0) for flag in over])


def voted(needed: int = C.VOTES_NEEDED) -> Column:
    return votes() >= needed


def is_alarm(threshold) -> Column:
    return F.col("anomaly_score") >= threshold


def share(flag: Column) -> Column:
    """Average of a boolean; NULL flags are left out, as SQL `avg` does."""
    return F.avg(flag.cast("int"))


def share_or_zero(flag: Column) -> Column:
    """Average of a boolean where NULL counts as false."""
    return F.avg(F.when(flag, 1).otherwise(0))


def when_equal(value: Column, choices: list[tuple[Column, str]], otherwise) -> Column:
    """First choice whose column equals `value`."""
    first, *rest = choices
    chain = F.when(value == first[0], F.lit(first[1]))
    for column, name in rest:
        chain = chain.when(value == column, F.lit(name))
    return chain.otherwise(otherwise)


def predicted_family() -> Column:
    """Family with the greatest probability; the first in contract order wins a tie."""
    named = [(F.col(f"p_{family}"), family) for family in C.FAMILIES]
    best = F.greatest(*[column for column, _ in named])
    return when_equal(best, named[:-1], F.lit(C.FAMILIES[-1]))


def dominant_family() -> Column:
    """As `predicted_family`, but NULL when no probability is known."""
    known = [
        (F.coalesce(F.col(f"p_{family}"), F.lit(-1.0)), family) for family in C.FAMILIES
    ]
    best = F.greatest(*[column for column, _ in known])
    return F.when(best >= 0, when_equal(best, known, F.lit(None)))


def primary_label(labels=None, none: str = "normal") -> Column:
    """First true label in contract order, as its column name."""
    names = labels or C.LABELS
    return F.coalesce(*[F.when(F.col(name), F.lit(name)) for name in names], F.lit(none))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Fractional seconds between two timestamps (either kind)."""
    def micros(value):
        return F.unix_micros(value.cast("timestamp"))

    return (micros(later) - micros(earlier)) / F.lit(1e6)


def half_up(value: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero."""
    return F.round(value.cast("decimal(38,12)"), digits)


def lamp(events: Column, rate: Column) -> Column:
    """Colour of a stand: off without events, else by its alarm rate."""
    return (
        F.when(events == 0, "off").when(rate >= 0.15, "r").when(rate >= 0.02, "a").otherwise("g")
    )


def wear_percent(mileage: Column, life: float = C.ROLL_LIFE_KM) -> Column:
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), mileage / life))
    return F.when(mileage.isNotNull(), bounded * 100)


def wear_band(percent: Column) -> Column:
    return F.when(percent.isNull(), None).when(percent < 50, "g").when(percent < 80, "a").otherwise("r")


def age_text(seconds: Column) -> Column:
    """Short age such as `now`, `12s`, `3m`, `5h`; negative ages count as zero."""
    age = F.greatest(seconds, F.lit(0.0))

    def whole(value):
        return F.floor(value + 0.5).cast("string")

    return (
        F.when(age < 1, "now")
        .when(age < 60, F.concat(whole(age), F.lit("s")))
        .when(age < 3600, F.concat(whole(age / 60), F.lit("m")))
        .otherwise(F.concat(whole(age / 3600), F.lit("h")))
    )


def coil_hash(seed: int, coil: str = "coil_id") -> Column:
    """52 bits of md5(coil ‖ seed): uniform, the same on every run, exact as a double."""
    digest = F.md5(F.concat(F.col(coil).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
