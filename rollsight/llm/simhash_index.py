"""Near-duplicate documents by 64-bit SimHash and multi-index hashing.

A fingerprint is cut into two 32-bit halves. Two fingerprints at most three bits apart differ in
at most one bit in one of their halves, so it is enough to look up, for each half, the ball of
radius one around its value in a table of all halves, and to verify the whole distance of what
is found. A ball is only entered by setting bits: of two halves one bit apart exactly one side
has the other in its upward ball, so each pair is met once per half.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import materialised
from .common import fold_table, run_starts, slices
from .components import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
# Halves shared by more fingerprints than this are looked up together with a quarter of the rest.
BUCKET_ROWS = 256


def _shingle_hashes(words: list[bytes], width: int) -> list[int]:
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-width].tolist()]
    stops = (ends[width - 1:] - 1).tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]


def majorities(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per run of hashes the word of bits that more than half of them have set."""
    out = np.zeros(len(lengths), dtype=np.uint64)
    filled = np.flatnonzero(lengths)
    if len(filled):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, run_starts(lengths)[:-1][filled], axis=0, dtype=np.int32)
        most = np.packbits(2 * ones > lengths[filled][:, None], axis=1)
        out[filled] = most.view(">u8").ravel().astype(np.uint64)
    return out


def fingerprint_texts(texts, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Signed 64-bit SimHash per text; zero for a text without words or a null."""
    table, out = fold_table(False), []
    for part in slices(texts, 1_000_000):
        hashes, lengths = [], []
        for raw in part:
            found = _shingle_hashes(raw.translate(table).split(), width)
            hashes.extend(found)
            lengths.append(len(found))
        out.append(majorities(np.array(hashes, dtype=np.uint64), np.array(lengths, dtype=np.int64)))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def simhash(text: Column | str, width: int = SHINGLE_WORDS) -> Column:
    """SimHash of a text column over word shingles, as a signed 64-bit number.

    Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage
    return, with A-Z lower-cased; repeated shingles count each time.
    """

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(fingerprint_texts(batch, width))

    return of(text)


def _halves(points: DataFrame) -> DataFrame:
    """Two rows per fingerprint: which half, its value, and the other half."""
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)
    both = F.array(
        F.struct(F.lit(0).alias("side"), high.alias("value"), low.alias("rest")),
        F.struct(F.lit(1).alias("side"), low.alias("value"), high.alias("rest")),
    )
    return points.select("fp", F.inline(both))


def _ball(value: str, bits: int) -> Column:
    """The value itself and every value that has one more bit set."""
    return F.expr(
        f"concat(array({value}), transform(filter(sequence(0, {bits - 1}), i -> "
        f"(shiftrightunsigned({value}, i) & 1L) = 0), i -> {value} | shiftleft(1L, i)))"
    )


def _quarters(rows: DataFrame, probe: bool) -> DataFrame:
    """Rows of crowded halves by quarter of the rest too; probes with the ball around it.

    The rest may hold up to three differing bits, so one of its quarters holds at most one. That
    bit may be set on either side, so here the ball goes both ways.
    """
    ball = "concat(array({q}), transform(sequence(0, 15), i -> {q} ^ shiftleft(1L, i)))" if probe else "array({q})"
    sides = [
        f"transform({ball.format(q=quarter)}, v -> struct({part} AS part, v AS quarter))"
        for part, quarter in enumerate(("shiftrightunsigned(rest, 16)", "(rest & 65535L)"))
    ]
    return rows.select("fp", "side", "value", F.inline_outer(F.expr(f"concat({', '.join(sides)})")))


def near_pairs(points: DataFrame, max_distance: int = MAX_DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): all pairs of different fingerprints at most `max_distance` bits apart, each once.

    `points` has a column fp of 64-bit fingerprints; nulls and repeats are ignored. Halves that
    more than `bucket_rows` fingerprints share are matched by half and quarter instead, so that
    no key holds a crowd; nothing is capped.
    """
    if not 0 <= max_distance <= 3:
        raise ValueError("two halves with balls of radius one serve distances up to three")
    points = points.select("fp").where("fp IS NOT NULL").distinct()
    stored = materialised(_halves(points))
    probes = stored.select("fp", "side", "rest", F.explode_outer(_ball("value", 32)).alias("value"))
    crowded = materialised(
        stored.groupBy("side", "value").count().where(F.col("count") > bucket_rows).select("side", "value")
    )
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = (F.col("a") != F.col("b")) & (apart <= max_distance)

    def matched(left, right, keys):
        return (
            left.withColumnRenamed("fp", "a").join(right.withColumnRenamed("fp", "b"), keys)
            .where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        )

    if crowded.isEmpty():
        found = matched(probes.drop("rest"), stored.drop("rest"), ["side", "value"])
    else:
        keys = ["side", "value"]
        found = matched(
            probes.join(crowded, keys, "left_anti").drop("rest"),
            stored.join(crowded, keys, "left_anti").drop("rest"), keys,
        ).unionAll(
            matched(
                _quarters(probes.join(crowded, keys, "left_semi"), True),
                _quarters(stored.join(crowded, keys, "left_semi"), False),
                [*keys, "part", "quarter"],
            )
        )
    return found.distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    max_distance: int = MAX_DISTANCE, also: tuple[Column, ...] = ()) -> DataFrame:
    """(doc_id, fp, component_id, *also): one row per row of `docs`.

    component_id is the smallest non-null id of all documents that can be reached over links of
    at most `max_distance` bits; null if all of them have null ids. Null and empty texts have
    fingerprint zero and are linked like any other; repeated rows are kept. Equal fingerprints
    are one node, so copies are never paired. Other columns are ignored unless named in `also`.
    Empty in, empty out.
    """
    marked = materialised(
        docs.select(F.col(id_column).alias("doc_id"), simhash(F.col(text_column)).alias("fp"), *also)
    )
    nodes = materialised(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = materialised(connected_components(near_pairs(nodes, max_distance), "a", "b"))
    rooted = materialised(
        nodes.join(found, F.col("fp") == F.col("node"), "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    smallest = materialised(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    named = materialised(rooted.join(smallest, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select(*marked.columns, "component_id")


def hex_digits(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def first_of_each(docs: DataFrame, grouped: Callable[..., DataFrame] = near_duplicates) -> DataFrame:
    """The documents without all but the smallest id of each near-duplicate component.

    `grouped` gives the components: `near_duplicates`, or another function with its columns.
    All columns are kept. Rows without an id cannot be chosen between and stay. Of repeated rows
    with equal id and text one stays; rows of the chosen id with other texts stay.
    """
    content = F.xxhash64("text")
    groups = materialised(
        grouped(docs, also=(content.alias("content"),)).select("doc_id", "content", "component_id")
    )
    lost = groups.where("doc_id <> component_id").select("doc_id", "content").distinct()
    lost = lost.toDF("lost_id", "lost_content")
    kept = docs.join(
        materialised(lost), (docs["doc_id"] == F.col("lost_id")) & (content == F.col("lost_content")), "left_anti"
    )
    twice = groups.where("doc_id = component_id").groupBy("doc_id", "content").count().where("count > 1")
    if twice.isEmpty():
        return kept
    return kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).unionAll(kept.where("doc_id IS NULL"))
