"""Toxicity classifier whose scores do not depend on the groups that a text names.

A logistic model over hashed words and word beginnings is trained on labelled texts. Every
training text with a sentence gives a pair of texts that differ in the group they name: if it
names one, each identity term is swapped for another of its kind; if not, two terms of a kind
are put at the same place of one of its sentences. Kind and place come from a hash of the text.
The squared difference of the pair's scores (before the logistic function) is added to the loss,
so that weights on identity terms, on their beginnings, and on what only stands for them, are
driven together. Neutral mentions of a group then do not raise a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import materialised
from .common import fold_table, utf8

# Labelled rows that the classifier is fitted on, at most; chosen by a hash of the id.
TRAINING_ROWS = 20_000
SLOTS = 1 << 18
FEATURES = 4_096
LEAST_DOCS = 4
SWAP_WEIGHT = 1.0
RIDGE = 1e-4
STEPS = 300
# Swaps go round within a kind; a kind has one language.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("immigrants", "natives", "refugees"),
    ("african", "european", "american", "mexican", "chinese", "indian"), ("old", "young"),
    ("blind", "deaf", "disabled"),
    ("frauen", "männer"), ("mädchen", "jungen"), ("schwule", "lesben", "heteros"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("ausländer", "inländer", "flüchtlinge"), ("türken", "polen", "deutsche", "franzosen"),
    ("femmes", "hommes"), ("filles", "garçons"), ("homosexuels", "hétérosexuels"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("étrangers", "réfugiés", "immigrés"), ("africains", "européens", "asiatiques"),
    ("mujeres", "hombres"), ("chicas", "chicos"), ("homosexuales", "heterosexuales"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("extranjeros", "refugiados", "inmigrantes"), ("africanos", "europeos", "asiáticos"),
)
SENTENCE = re.compile(r"[^.!?\n]*\w[^.!?\n]*")
PREFIX = (3, 10)


class Model(NamedTuple):
    places: np.ndarray  # slot -> feature, -1 for none
    weights: np.ndarray
    bias: float
    terms: tuple[tuple[str, ...], ...]
    pairs: int = 0  # training texts whose scores were compared with another group's


def _prepared(text: str | None) -> np.ndarray:
    """Bytes with A-Z lower-cased, runs of ASCII non-letters as one blank, a blank at both ends."""
    raw = b" " + b" ".join(utf8(text).translate(fold_table(True)).split()) + b" "
    return np.frombuffer(raw, dtype=np.uint8)


def slots_of(text: str | None) -> np.ndarray:
    """Hash slots of the words and of the beginnings of longer words, not unique.

    Beginnings have `PREFIX` bytes and are other features than a word of the same letters, so a
    stem that is harmless by itself can still count where words are made from it.
    """
    data = _prepared(text)
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64)
    blank = data == 32
    at = np.arange(len(data))
    start = np.maximum.accumulate(np.where(blank, at, 0))
    inside = (at - start).astype(np.uint32)
    # The hash of a word's first bytes is a sum over them, each mixed with its place in the word.
    mixed = (data.astype(np.uint32) + np.uint32(1)) * (inside * np.uint32(0x9E3779B1) | np.uint32(1))
    mixed ^= mixed >> np.uint32(15)
    total = np.cumsum(mixed * np.uint32(0x85EBCA6B), dtype=np.uint32)
    upto = total - total[start]
    last = np.append(blank[1:], True) & ~blank
    begun = (inside >= PREFIX[0]) & (inside <= PREFIX[1]) & ~last & ~blank
    return np.concatenate((_spread(upto[last], 1), _spread(upto[begun], 2)))


def _spread(values: np.ndarray, salt: int) -> np.ndarray:
    values = (values + np.uint32(salt)) * np.uint32(0x9E3779B1)
    values ^= values >> np.uint32(16)
    values = values * np.uint32(0x85EBCA6B)
    return ((values ^ (values >> np.uint32(13))) % np.uint32(SLOTS)).astype(np.int64)


def _swapper(terms):
    after = {term: kind[(place + 1) % len(kind)] for kind in terms for place, term in enumerate(kind)}
    if not after:
        return lambda text: None
    pattern = re.compile(r"\b(" + "|".join(sorted(map(re.escape, after), key=len, reverse=True)) + r")\b", re.IGNORECASE)

    def swapped(text: str | None) -> str | None:
        """The text with every identity term replaced by the next of its kind; None without any."""
        changed, n = pattern.subn(lambda m: after[m.group().lower()], text or "")
        return changed if n else None

    return swapped


def counterfactual(terms):
    """Function from a text to its pair of texts; None for a text without a sentence."""
    swapped = _swapper(terms)
    kinds = [kind for kind in terms if len(kind) > 1]

    def pair(text: str | None) -> tuple[str, str] | None:
        other = swapped(text)
        if other is not None:
            return text, other
        sentences = list(SENTENCE.finditer(text or ""))
        if not sentences or not kinds:
            return None
        draw = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), len(text))
        draw, kind = divmod(draw, len(kinds))
        draw, first = divmod(draw, len(kinds[kind]))
        draw, sentence = divmod(draw, len(sentences))
        start, stop = sentences[sentence].span()
        gaps = [start, *(m.end() + start for m in re.finditer(r"\w+", text[start:stop]))]
        place = gaps[draw % len(gaps)]
        named = (kinds[kind][first], kinds[kind][(first + 1) % len(kinds[kind])])
        return tuple(f"{text[:place]} {term} {text[place:]}" for term in named)

    return pair


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of at most `limit` labelled documents, chosen by a hash of the id.

    Labels that are null or contradict each other for one id are not used. The chosen ids and
    labels are bounded by `limit` and therefore broadcast; no text is shuffled.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most")
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.select("text", F.col("toxic").cast("int").alias("toxic"))


def _slot_counts(batches):
    counts = np.zeros((2, SLOTS), dtype=np.int64)
    docs = np.zeros(2, dtype=np.int64)
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            counts[int(toxic != 0)][np.unique(slots_of(text))] += 1
            docs[int(toxic != 0)] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"slot": used, "clean": counts[0][used], "toxic": counts[1][used]})
    yield pd.DataFrame({"slot": [-1], "clean": docs[:1], "toxic": docs[1:]})


def _telling(counted: DataFrame, features: int) -> tuple[np.ndarray, int, int]:
    """The slots that tell the classes apart best, by the likelihood ratio of their presence."""
    total = counted.where("slot = -1").first()
    clean, toxic = (int(total["clean"]), int(total["toxic"])) if total else (0, 0)
    if not clean or not toxic:
        return np.zeros(0, dtype=np.int64), clean, toxic
    n = float(clean + toxic)

    def part(seen, size):
        expected = (F.col("clean") + F.col("toxic")) * F.lit(size / n)
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    absent_all = F.lit(n) - F.col("clean") - F.col("toxic")

    def missing(seen, size):
        gone = F.lit(float(size)) - seen
        return F.when(gone > 0, gone * F.log(gone / (absent_all * F.lit(size / n)))).otherwise(0.0)

    gain = (
        part(F.col("clean"), clean) + part(F.col("toxic"), toxic)
        + missing(F.col("clean"), clean) + missing(F.col("toxic"), toxic)
    )
    best = (
        counted.where((F.col("slot") >= 0) & (F.col("clean") + F.col("toxic") >= LEAST_DOCS))
        .select("slot", gain.alias("gain")).orderBy(F.desc("gain"), "slot").limit(features)
    )
    return np.sort(np.array([row["slot"] for row in best.collect()], dtype=np.int64)), clean, toxic


def _design(places: np.ndarray, terms):
    """Per training text its features, and those that only one text of its pair has."""

    def rows(batches):
        pair = counterfactual(terms)
        for batch in batches:
            out = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                both, plus, minus = pair(text), None, None
                if both is not None:
                    one, other = (_present(t, places) for t in both)
                    plus, minus = np.setdiff1d(one, other).tolist(), np.setdiff1d(other, one).tolist()
                out.append((int(toxic != 0), _present(text, places).tolist(), plus, minus))
            yield pd.DataFrame(out, columns=["toxic", "own", "plus", "minus"])

    return rows


def _present(text: str | None, places: np.ndarray) -> np.ndarray:
    found = places[slots_of(text)]
    return np.unique(found[found >= 0])


class _Rows:
    """Sets of features as one flat list; products with a weight vector and back."""

    def __init__(self, sets, features):
        sizes = [len(s) for s in sets]
        self.row = np.repeat(np.arange(len(sets)), sizes)
        self.column = np.array([c for s in sets for c in s], dtype=np.int64)
        self.shape = (len(sets), features)

    def times(self, weights):
        return np.bincount(self.row, weights[self.column], minlength=self.shape[0])

    def back(self, values):
        return np.bincount(self.column, values[self.row], minlength=self.shape[1])


class _Loss(NamedTuple):
    """The training loss: logistic, swaps and ridge."""

    x: _Rows
    plus: _Rows
    minus: _Rows
    y: np.ndarray
    share: np.ndarray
    swap_weight: float
    ridge: float

    def slope(self, weights: np.ndarray, bias: float) -> np.ndarray:
        """Derivatives by each weight, then by the bias."""
        z = self.x.times(weights) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - self.y) * self.share
        gap = 2 * self.swap_weight * (self.plus.times(weights) - self.minus.times(weights)) / max(len(self.y), 1)
        by_weight = self.x.back(error) + self.ridge * weights + self.plus.back(gap) - self.minus.back(gap)
        return np.append(by_weight, error.sum())


def fit(rows: DataFrame, terms=IDENTITY_TERMS, swap_weight: float = SWAP_WEIGHT,
        features: int = FEATURES, steps: int = STEPS, ridge: float = RIDGE) -> Model:
    """Model from (text, toxic) rows; without rows of both classes every score is the share of toxic.

    Slots are counted over all given rows in Spark; the driver gets the telling slots and, for
    each row, which of them it has: small sets, at most `TRAINING_ROWS` of them.
    """
    rows = materialised(rows)
    counted = materialised(
        rows.mapInPandas(_slot_counts, "slot long, clean long, toxic long")
        .groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    slots, clean, toxic = _telling(counted, features)
    places = np.full(SLOTS, -1, dtype=np.int32)
    places[slots] = np.arange(len(slots))
    bias = float(np.log((toxic + 0.5) / (clean + 0.5)))
    if not len(slots):
        return Model(places, np.zeros(0), bias, tuple(terms))
    data = rows.mapInPandas(
        _design(places, terms), "toxic int, own array<int>, plus array<int>, minus array<int>"
    ).toPandas()
    data = data.sort_values("toxic", kind="stable", ignore_index=True)
    y = data["toxic"].to_numpy(dtype=float)
    paired = data["plus"].notna()
    plus, minus = (_Rows([() if v is None else v for v in data[side]], len(slots)) for side in ("plus", "minus"))
    # Both classes weigh the same, so 0.5 parts them whatever their numbers.
    share = np.where(y > 0, 0.5 / max(toxic, 1), 0.5 / max(clean, 1))
    loss = _Loss(_Rows(data["own"], len(slots)), plus, minus, y, share, swap_weight, ridge)
    bias = 0.0
    weights = np.zeros(len(slots))
    mean, speed = np.zeros(len(slots) + 1), np.zeros(len(slots) + 1)
    for step in range(1, steps + 1):
        slope = loss.slope(weights, bias)
        mean, speed = 0.9 * mean + 0.1 * slope, 0.999 * speed + 0.001 * slope ** 2
        move = 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(speed / (1 - 0.999 ** step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return Model(places, weights, float(bias), tuple(terms), int(paired.sum()))


def score_text(text: str | None, model: Model) -> float:
    z = model.bias + (model.weights[_present(text, model.places)].sum() if len(model.weights) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def toxicity(text: Column | str, model: Model) -> Column:
    """Score of a text column, 0 to 1. A null or empty text has no features: the model's base rate."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([score_text(text, model) for text in batch], dtype=float)

    return of(text)


def not_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, that score below the threshold."""
    return docs.where(toxicity(F.col("text"), model) < threshold)
