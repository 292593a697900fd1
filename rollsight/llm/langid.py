"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent letter n-grams (one to three letters, blanks at word borders)
of a language by rank. A document is compared to a profile by the out-of-place distance: each of
its own most frequent n-grams adds how far its rank is from its rank in the profile, n-grams that
are missing there add the largest distance. Profiles are counted over all texts they may see.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PROFILE = 400
DOC_PROFILE = 300
CHUNK_CHARS = 1_000_000
UNKNOWN = "und"


BLANK = 1


@functools.cache
def _letters() -> np.ndarray:
    """Symbol of every code point: that of the lower-cased letter, or `BLANK` for no letter."""
    table = np.full(0x110000, BLANK, dtype=np.int32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def symbols(text: str | None) -> np.ndarray:
    """Symbols of a text between two blanks; no two letters share one."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.concatenate(([BLANK], _letters()[codes], [BLANK])).astype(np.int64)


def grams(signs: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of one to three letters; blanks only at an end of an n-gram.

    Symbols have 21 bits, so three fill 63; no symbol is zero, so lengths differ by the upper bits.
    """
    letter = signs != BLANK
    two = ((signs[:-1] << 21) | signs[1:])[letter[:-1] | letter[1:]]
    three = ((signs[:-2] << 42) | (signs[1:-1] << 21) | signs[2:])[letter[1:-1]]
    return np.concatenate((signs[letter], two, three))


class Profiles(NamedTuple):
    """The n-grams of all profiles in ascending order and their rank in each language's."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray  # languages x codes; the profile's length where the n-gram is missing
    length: int


def _count(batches):
    """Partial counts of a partition's n-grams per language."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[np.ndarray]] = {}
    weight: dict[str, int] = {}

    def settle(lang):
        codes, counts = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
        if lang in total:
            known, before = total[lang]
            both, place = np.unique(np.concatenate((known, codes)), return_inverse=True)
            codes, counts = both, np.bincount(place, np.concatenate((before, counts))).astype(np.int64)
        total[lang] = codes, counts
        weight[lang] = 0

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            found = grams(symbols(text))
            waiting.setdefault(lang, []).append(found)
            weight[lang] = weight.get(lang, 0) + len(found)
            if weight[lang] >= CHUNK_CHARS:
                settle(lang)
    for lang in list(waiting):
        settle(lang)
    for lang, (codes, counts) in total.items():
        yield pd.DataFrame({"lang": lang, "code": codes.astype(np.int64), "n": counts.astype(np.int64)})


def learn(docs: DataFrame, length: int = PROFILE) -> Profiles:
    """Profiles from the columns text and lang of `docs`; rows without language are left out.

    Equal counts are ranked by n-gram code. Only the ranked lists, `length` rows per language,
    come to the driver. Without any rows there are no languages.
    """
    counted = (
        docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
        .mapInPandas(_count, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
    )
    ranked = counted.withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code"))
    ).where(F.col("rank") <= length)
    rows = ranked.select("lang", "code", "rank").collect()
    languages = sorted({row["lang"] for row in rows})
    codes = np.unique(np.array([row["code"] for row in rows], dtype=np.int64))
    ranks = np.full((len(languages), len(codes)), length, dtype=np.int64)
    for row in rows:
        ranks[languages.index(row["lang"]), np.searchsorted(codes, row["code"])] = row["rank"] - 1
    return Profiles(languages, codes, ranks, length)


def distances(text: str | None, profiles: Profiles, top: int = DOC_PROFILE) -> np.ndarray | None:
    """Mean out-of-place distance to each language, 0 to 1; None for a text without letters."""
    found = grams(symbols(text))
    if not len(found) or not profiles.languages:
        return None
    codes, counts = np.unique(found, return_counts=True)
    codes = codes[np.argsort(-counts, kind="stable")[:top]].astype(np.int64)
    place = np.minimum(np.searchsorted(profiles.codes, codes), len(profiles.codes) - 1)
    known = profiles.codes[place] == codes
    there = np.where(known, profiles.ranks[:, place], profiles.length)
    away = np.abs(there - np.arange(len(codes)))
    away = np.where(there == profiles.length, profiles.length, away)
    return away.mean(axis=1) / profiles.length


def language(text: Column | str, profiles: Profiles, top: int = DOC_PROFILE) -> Column:
    """struct(lang, score) of a text column.

    lang is the nearest profile (the first by name of equally near ones), `und` for a null text
    or one without a letter, or if nothing was learned. score is the second-nearest distance's
    share in the two nearest: 0.5 for a tie, towards 1 for a clear case; 1 for a single language,
    0 for `und`.
    """

    @F.pandas_udf("lang string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                found = distances(text, profiles, top)
                if found is None:
                    rows.append((UNKNOWN, 0.0))
                    continue
                near = np.sort(found)[:2]
                score = near[1] / near.sum() if len(near) == 2 and near.sum() else 1.0 if len(near) == 1 else 0.5
                rows.append((profiles.languages[int(found.argmin())], float(score)))
            yield pd.DataFrame(rows, columns=["lang", "score"])

    return of(text)
