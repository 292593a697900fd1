"""Fill-in-middle outputs by a secondary sort of text pieces.

Every document is cut into chunks of units (code points), each keyed by the document and its place
in the output. One shuffle brings the chunks of a document together and sorts them by place, so a
task streams outputs of any length piece by piece, into a digest or into rows. To rebuild the text,
the stream is read for its marks alone, its chunks are keyed by their place in the original and
sorted once more: they stay in their partition, so the second sort moves nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.session import shuffle_width, utc

# The marks before each part, and the parts' order in each form.
MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
ORIGINAL = ("prefix", "middle", "suffix")

PLAIN_PERCENT = 10
SPM_PERCENT = 20
CHUNK_UNITS = 16_384
# Text that a partition of the sort holds on average, at most.
PARTITION_BYTES = 64 << 20
# Chunks of a part are numbered below this; the head of a document stands before all parts.
PART = 1 << 40
HEAD = -1


def planned(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars per row of `docs`.

    The cuts and the form follow from the id (a null id counts as empty) and the text's length. A
    null or empty text and one that holds a mark are plain, with null lengths.
    """
    draws = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    text, n = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit(""))).cast("long")

    def draw(number: int) -> Column:
        return F.conv(F.substring(draws, 8 * number - 7, 8), 16, 10).cast("long")

    marked = text.contains(MARKS["prefix"]) | text.contains(MARKS["suffix"]) | text.contains(MARKS["middle"])
    plain = (n == 0) | marked | (draw(3) % 100 >= 100 - PLAIN_PERCENT)
    form = F.when(plain, "plain").when(draw(4) % 100 < SPM_PERCENT, "spm").otherwise("psm")
    cuts = [draw(1) % (n + 1), draw(2) % (n + 1)]
    return docs.select(
        "doc_id", text.alias("text"), n.alias("n"), form.alias("form"),
        F.when(~plain, F.least(*cuts)).alias("prefix_chars"),
        F.when(~plain, F.greatest(*cuts) - F.least(*cuts)).alias("middle_chars"),
    )


def parts(text: str, form: str, prefix: int | None, middle: int | None) -> list[tuple[str, str]]:
    """(mark, part) in the order of the output."""
    if form == "plain":
        return [("", text)]
    cut = {"prefix": text[:prefix], "middle": text[prefix:prefix + middle], "suffix": text[prefix + middle:]}
    return [(MARKS[name], cut[name]) for name in ORDERS[form]]


def _packed(text: str) -> bytes:
    return zlib.compress(text.encode("utf-8", "replace"), 1)


def _unpacked(piece: bytes) -> str:
    return zlib.decompress(piece).decode("utf-8")


def _of_row(key) -> int:
    """Partition number before the modulus: rows of one scan task are dealt out evenly."""
    return (key[0] * 0x9E3779B97F4A7C15 >> 17) & 0x7FFFFFFF


def _pieces(units: int):
    def cut(rows):
        for row, doc_id, text, n, form, prefix, middle in rows:
            yield (row, HEAD), (doc_id, n, form, prefix, middle)
            for part, (mark, body) in enumerate(parts(text, form, prefix, middle)):
                for number, start in enumerate(range(0, max(len(body), 1), units)):
                    yield (row, part * PART + number), _packed((mark if start == 0 else "") + body[start:start + units])

    return cut


def assembled(docs: DataFrame, units: int = CHUNK_UNITS) -> RDD:
    """((row, place), head or chunk), every document's chunks together and in the output's order.

    `row` numbers the rows in scan order, so repeated and null ids keep rows of their own; `docs`
    should read stored files, whose scan a lost executor repeats alike. The number of partitions
    grows with the bytes of all texts, which are summed first.
    """
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = max(shuffle_width(docs.sparkSession), -(-held // PARTITION_BYTES))
    rows = planned(docs).select(F.monotonically_increasing_id().alias("row"), "*").rdd
    return rows.mapPartitions(_pieces(units)).repartitionAndSortWithinPartitions(width, _of_row)


def _streams(pieces: Iterable) -> Iterator[tuple[int, tuple, Iterator[str]]]:
    """(row, head, its chunks); a stream is read to its end before the next one."""
    pieces = iter(pieces)
    held = next(pieces, None)
    while held is not None:
        (row, _), head = held
        held = None

        def chunks():
            nonlocal held
            for key, piece in pieces:
                if key[0] != row:
                    held = key, piece
                    return
                yield _unpacked(piece)

        stream = chunks()
        yield row, head, stream
        for _ in stream:
            pass


def origins(form: str, chunks: Iterable[str]) -> Iterator[tuple[int, str]]:
    """(place in the original, chunk) from an output read in order, found by its marks alone."""
    if form == "plain":
        yield from enumerate(chunks)
        return
    awaited = list(ORDERS[form])
    part, number, kept = None, 0, ""
    for chunk in chunks:
        kept += chunk
        while awaited and (at := kept.find(MARKS[awaited[0]])) >= 0:
            if kept[:at]:
                yield part * PART + number, kept[:at]
            part, number = ORIGINAL.index(awaited.pop(0)), 0
            kept = kept[at + 3:]
        # A mark may begin in the last two units and end in the next chunk.
        sure = len(kept) - 2 if awaited else len(kept)
        if sure > 0 and part is not None:
            yield part * PART + number, kept[:sure]
            number, kept = number + 1, kept[sure:]
    if awaited:
        raise ValueError(f"an output of form {form} lacks {MARKS[awaited[0]]}")
    if kept:
        yield part * PART + number, kept


def _taken_apart(pieces):
    for row, head, chunks in _streams(pieces):
        digest = hashlib.sha256()

        def read():
            for chunk in chunks:
                digest.update(chunk.encode("utf-8"))
                yield chunk

        for place, chunk in origins(head[2], read()):
            yield (row, place), _packed(chunk)
        yield (row, HEAD), (*head, digest.hexdigest())


def restored(outputs: RDD) -> RDD:
    """((row, place), head with the output's digest, or chunk), chunks in the original's order."""
    apart = outputs.mapPartitions(_taken_apart, preservesPartitioning=True)
    # The partitioning is the one they have, so only the sort within partitions is done.
    return apart.repartitionAndSortWithinPartitions(outputs.getNumPartitions(), _of_row)


def _schema(docs: DataFrame, *texts: str) -> T.StructType:
    made = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)])
    made.add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long")
    for name in texts:
        made.add(name, "string")
    return made


def transformed(docs: DataFrame, units: int = CHUNK_UNITS) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row per row of `docs`.

    Null texts count as empty and are plain; other columns are ignored; an empty table gives no
    rows. A task holds one output at a time.
    """

    def whole(pieces):
        for _, head, chunks in _streams(pieces):
            yield (*head, "".join(chunks))

    rows = assembled(docs, units).mapPartitions(whole)
    return utc(docs.sparkSession).createDataFrame(rows, _schema(docs, "output"), verifySchema=False)


def digests(docs: DataFrame, units: int = CHUNK_UNITS) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 per row of `docs`.

    The second digest is that of the text rebuilt from the output and its form. Edge cases as in
    `transformed`; no task holds more than a chunk of an output.
    """

    def digested(pieces):
        for _, head, chunks in _streams(pieces):
            digest = hashlib.sha256()
            for chunk in chunks:
                digest.update(chunk.encode("utf-8"))
            yield (*head, digest.hexdigest())

    rows = restored(assembled(docs, units)).mapPartitions(digested)
    schema = _schema(docs, "output_sha256", "restored_sha256")
    return utc(docs.sparkSession).createDataFrame(rows, schema, verifySchema=False)


def _hex(number: int) -> str:
    return f"CAST('0x' || substr(draws, {8 * number - 7}, 8) AS BIGINT)"


CHECK = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draws
  FROM documents
), f AS (
  SELECT *, least({_hex(1)} % (n + 1), {_hex(2)} % (n + 1)) AS a, greatest({_hex(1)} % (n + 1), {_hex(2)} % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_hex(3)} % 100 >= 90
         THEN 'plain' WHEN {_hex(4)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
    ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM f
"""
