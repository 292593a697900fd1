"""Document fingerprints by one-permutation MinHash with optimal densification.

The hashes of a text's word shingles are dealt into bins once; each bin keeps its minimum. An
empty bin copies the bin that its own fixed sequence of pseudo-random bins meets first among the
filled ones (the sequence depends on the bin only, so equal sets fill alike). Of every minimum
only the low bits are stored; their chance agreement is taken out of the estimated likeness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import shuffle_width
from .common import fold_table, utf8

BINS = 512
BITS = 4
SHINGLE_WORDS = 5
SEED = 42
# Attempts of an empty bin that are looked at together.
TRIES = 32
# Ranges of ids per shuffle partition.
RANGES_PER_PARTITION = 4


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps around."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """One 64-bit hash per word shingle (fewer words: the whole sequence; none: no hash)."""
    digest = xxhash.xxh64_intdigest
    words = utf8(text).translate(fold_table(False)).split()
    hashes = np.array([digest(word, SEED) for word in words], dtype=np.uint64)
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for place in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[place:place + n]
    return _mixed(out)


class Bins:
    """Signatures of sets of hashes and their likeness."""

    def __init__(self, bins: int = BINS, bits: int = BITS):
        if bins & (bins - 1) or bits not in (1, 2, 4, 8) or bins * bits % 8:
            raise ValueError("bins: a power of two; bits: 1, 2, 4 or 8; together whole bytes")
        self.bins, self.bits = bins, bits
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self._tries: list[np.ndarray] = []

    def _block(self, number: int) -> np.ndarray:
        """The bins that TRIES further attempts of every bin go to, one row per attempt."""
        while len(self._tries) <= number:
            first = len(self._tries) * TRIES
            attempt = np.arange(first + 1, first + TRIES + 1, dtype=np.uint64)[:, None]
            spread = np.arange(self.bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            self._tries.append((_mixed(_mixed(attempt) + spread) % np.uint64(self.bins)).astype(np.int64))
        return self._tries[number]

    def signature(self, hashes: np.ndarray) -> np.ndarray | None:
        """Low bits of each bin's minimum; None for an empty set."""
        if not len(hashes):
            return None
        ordered = np.sort(hashes)
        places = (ordered >> self.shift).astype(np.int64)
        first = np.flatnonzero(np.diff(places, prepend=-1))
        least = np.zeros(self.bins, dtype=np.uint64)
        filled = np.zeros(self.bins, dtype=bool)
        least[places[first]], filled[places[first]] = ordered[first], True
        out, empty, number = least.copy(), np.flatnonzero(~filled), 0
        while len(empty):
            source = self._block(number)[:, empty]
            met = filled[source]
            hit = met.any(axis=0)
            out[empty[hit]] = least[source[met.argmax(axis=0)[hit], np.flatnonzero(hit)]]
            empty, number = empty[~hit], number + 1
        return (_mixed(out) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)

    def packed(self, signature: np.ndarray | None) -> str:
        """Hex digits of the low bits, bin 0 first; empty for an empty set."""
        if signature is None:
            return ""
        bits = np.unpackbits(signature[:, None], axis=1)[:, 8 - self.bits:]
        return np.packbits(bits.ravel()).tobytes().hex()

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated Jaccard likeness, corrected for low bits that agree by chance."""
        if a is None or b is None:
            return float(a is None and b is None)
        chance = 0.5 ** self.bits
        return float(max(0.0, ((a == b).mean() - chance) / (1 - chance)))


def fingerprint(text: Column | str, bins: int = BINS, bits: int = BITS) -> Column:
    """Packed fingerprint of a text column, as hex digits; empty for a text without words."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        maker = Bins(bins, bits)
        for batch in batches:
            yield pd.Series([maker.packed(maker.signature(shingle_set(text))) for text in batch], dtype=object)

    return of(text)


def _walk(bins: int, bits: int):
    """Per range of ids: each document with the one that follows it."""

    def walk(batches):
        maker, out, weight, held = Bins(bins, bits), [], 0, None
        for batch in batches:
            for piece, visit, doc_id, text in zip(batch["piece"], batch["visit"], batch["doc_id"], batch["text"]):
                text = text or ""
                made = maker.signature(shingle_set(text))
                if held is not None and held[0] == piece:
                    out.append(_compared(maker, *held[1:], text, made))
                    weight += len(text)
                # The first visitor follows the range's last document; nothing follows a visitor.
                held = None if visit else (piece, doc_id, text, made)
                if weight > 4_000_000:
                    yield _frame(out)
                    out, weight = [], 0
        if out:
            yield _frame(out)

    return walk


def _compared(maker, doc_id, text, made, following, following_made):
    n = len(text)
    edited = text[:n - n // 4] + following[:n // 4]
    edited_made = maker.signature(shingle_set(edited))
    return (
        doc_id, n, edited, maker.packed(made), maker.packed(edited_made),
        maker.likeness(made, edited_made), maker.likeness(made, following_made),
    )


def _frame(rows):
    names = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pd.DataFrame(rows, columns=names)


def _ranged(ids: DataFrame) -> tuple[np.ndarray, dict[int, int]]:
    """Inner bounds of the ranges, and the range each range's first document visits by its id.

    One number per range reaches the driver; there are as many ranges as shuffle partitions times
    a constant. A first id visits the range before its own, the first of all the last range.
    """
    width = shuffle_width(ids.sparkSession) * RANGES_PER_PARTITION
    shares = [k / width for k in range(1, width)]
    points = ids.agg(F.percentile_approx("key", shares, max(10_000, 20 * width))).first()[0]
    bounds = np.unique(np.array(points or [], dtype=np.int64))
    firsts = ids.groupBy(_piece(bounds)("key").alias("piece")).agg(F.min("key").alias("key"))
    found = sorted((row["piece"], row["key"]) for row in firsts.collect())
    return bounds, {key: found[place - 1][0] for place, (_, key) in enumerate(found)}


def _piece(bounds: np.ndarray):
    @F.pandas_udf("int")
    def of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), side="right").astype(np.int32))

    return of


def compared_with_next(docs: DataFrame, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """One row per row of `docs`: its fingerprint and likeness to its edited text and successor.

    The edited text ends, in place of its last quarter of code points, with as many first ones of
    the next document by ascending doc_id (null ids first, equal ids by text; after the last comes
    the first). Columns: doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next. Null texts count as empty; texts without words have an empty fingerprint, are
    alike (1) to each other and unlike (0) to all others; repeated rows follow each other; a
    single document follows itself. Other columns are ignored; an empty table gives no rows.
    """
    least = -(2 ** 63)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("key"), "doc_id", "text")
    bounds, visits = _ranged(keyed.select("key"))
    own = F.struct(_piece(bounds)("key").alias("piece"), F.lit(False).alias("visit"))
    heads = np.array(sorted(visits), dtype=np.int64)
    targets = np.array([visits[key] for key in heads.tolist()], dtype=np.int32)

    @F.pandas_udf("int")
    def visited(key: pd.Series) -> pd.Series:
        """The range a first document visits; null for all others."""
        values = key.to_numpy()
        place = np.minimum(np.searchsorted(heads, values), max(len(heads) - 1, 0))
        if not len(heads):
            return pd.Series([None] * len(values), dtype="Int32")
        return pd.Series(targets[place], dtype="Int32").where(pd.Series(heads[place] == values))

    both = keyed.withColumns({"own": own, "guest": visited("key")})
    seats = F.when(F.col("guest").isNull(), F.array("own")).otherwise(
        F.array("own", F.struct(F.col("guest").alias("piece"), F.lit(True).alias("visit")))
    )
    dealt = both.select("key", F.col("doc_id").cast("string"), "text", F.inline_outer(seats))
    ordered = dealt.repartition("piece").sortWithinPartitions("piece", "visit", "key", "text")
    schema = (
        "doc_id string, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    made = ordered.drop("key").mapInPandas(_walk(bins, bits), schema)
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
