"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard draws a number for every key; the shard with the best weighted draw takes the record.
A draw depends on key and shard number alone, so a shard that is added takes records only into
itself, one that is removed gives up only its own, and a changed weight moves only the difference.
Records are then ranged by (shard, key) and written as shard files. A record's slot in its shard is
the number of records in the shard's earlier files plus its row in its own file, so no task ever
numbers a whole shard.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.session import shuffle_width, small_side
from .common import unused

# A SHA-256 in hex holds five draws of twelve digits.
DRAW_DIGITS = 12
DRAWS = 5
# Equal records are spread over this many places of the range order.
SALTS = 1024


def _draw(key: Column, shard: int) -> Column:
    """A number between 0 and 1, of key and shard."""
    block, place = divmod(shard, DRAWS)
    digest = F.sha2(F.concat(key, F.lit(f":{block}")).cast("binary"), 256)
    digits = F.substring(digest, place * DRAW_DIGITS + 1, DRAW_DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / 16.0 ** DRAW_DIGITS


def shard_of(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard that takes a key, in proportion to the weights.

    The key is used as text; a null key counts as the empty text. A shard of weight 0 takes
    nothing; the lower shard wins a tie. Cost grows with the number of shards, not with the data.
    """
    for shard, weight in weights.items():
        if shard < 0 or not (weight >= 0 and math.isfinite(weight)):
            raise ValueError("shards are numbered from 0 and weights are 0 or more")
    live = sorted(shard for shard, weight in weights.items() if weight > 0)
    if not live:
        raise ValueError("some shard must have a weight above 0")
    text = F.coalesce(key.cast("string"), F.lit(""))
    bids = [
        F.struct((-F.log(_draw(text, shard)) / F.lit(float(weights[shard]))).alias("cost"), F.lit(shard).alias("shard"))
        for shard in live
    ]
    return (F.least(*bids) if len(bids) > 1 else bids[0])["shard"]


def write_shards(
    docs: DataFrame, folder: str, weights: Mapping[int, float], key: str = "doc_id",
    ties: Sequence[str] = (), shard: str = "shard", slot: str = "slot",
) -> DataFrame:
    """Write all rows as parquet below `folder/<shard>=n` and read them back with shard and slot.

    Within a shard rows stand by key (nulls first), then by `ties`; slots count from 0 without
    gaps. All columns are kept; the names of the two new ones are parameters and must be free.
    Repeated rows each get a slot; equal ones are spread over many files, and any of them may have
    any of their slots. An empty table gives an empty one. Rows of equal keys and ties are told
    apart by their place in the scan, so `docs` should read stored files.
    """
    taken = {name.lower() for name in docs.columns}
    if shard.lower() in taken or slot.lower() in taken:
        raise ValueError(f"{shard} or {slot} is a column already")
    salt = unused(docs, "_salt")
    order = [shard, key, *ties]
    placed = docs.withColumns({
        shard: shard_of(F.col(key), weights),
        salt: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)),
    })
    ranged = placed.repartitionByRange(shuffle_width(docs.sparkSession), *order, salt)
    ranged.sortWithinPartitions(*order).drop(salt).write.partitionBy(shard).parquet(folder)
    return read_shards(docs, folder, shard, slot)


def read_shards(docs: DataFrame, folder: str, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """The rows of written shards, with the columns of `docs`, shard and slot."""
    schema = docs.withColumn(shard, F.lit(0)).schema
    stored = docs.sparkSession.read.schema(schema).parquet(folder)
    file, row, before = (unused(stored, name) for name in ("_file", "_row", "_before"))
    read = stored.select(
        "*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(row)
    )
    files = read.groupBy(shard, file).agg(F.count("*").alias(row))
    # Tasks number their files in the order of their ranges.
    number = F.regexp_extract(file, r"^part-(\d+)", 1).cast("int")
    earlier = W.partitionBy(shard).orderBy(number, file).rowsBetween(W.unboundedPreceding, -1)
    offsets = files.select(shard, file, F.coalesce(F.sum(row).over(earlier), F.lit(0)).alias(before))
    return read.join(small_side(offsets), [shard, file]).select(
        *docs.columns, shard, (F.col(before) + F.col(row)).alias(slot)
    )


# The check: the same draws, and every text's CRC-32 bit by bit from its bytes.
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"""
CHECK = f"""
WITH tab AS (SELECT {_CRC_TABLE} AS tab),
d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
         strlen(coalesce(text, '')) + 1 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
  FROM documents
), c AS (
  SELECT row, doc_id, key, size,
         xor(list_reduce(bytes, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM d, tab
), s AS (SELECT unnest(range(17)) AS shard),
draws AS (
  SELECT row, shard,
         CAST('0x' || substr(sha256(key || ':' || (shard // 5)), (shard % 5) * 12 + 1, 12) AS BIGINT) AS draw
  FROM d, s
), best AS (
  SELECT row, arg_max(shard, draw) FILTER (shard < 16) AS shard, arg_max(shard, draw) AS grown_shard FROM draws GROUP BY row
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM c JOIN best USING (row)
"""
