"""Packed token-id matrices written by best-fit decreasing with a segment tree.

Each task reads its documents in order and packs them group by group: overlong documents are cut
into pieces of the row length without losing an id, pieces go longest first into the open row with
the least room that is enough (found in a segment tree over the rooms), and every row becomes one
record with its ids, the cumulative lengths of its segments and the places where positions start
anew. Nothing is shuffled and a task holds one group at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder

ROW_LENGTH = 2048
GROUP_TOKENS = 4_000_000
END_ID = 50256
PAD_ID = 50256


class RoomTree:
    """Segment tree over rooms 0..size: how many open rows have each room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, change: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += change
            at >>= 1

    def least(self, need: int) -> int | None:
        """The smallest room of at least `need` that an open row has."""
        at = need + self.leaves
        if self.count[at]:
            return need
        while at > 1 and (at & 1 or not self.count[at + 1]):
            at >>= 1
        if at <= 1:
            return None
        at += 1
        while at < self.leaves:
            at *= 2
            if not self.count[at]:
                at += 1
        return at - self.leaves


def best_fit_decreasing(lengths, row_length: int) -> list[list[int]]:
    """Rows as lists of piece numbers, in the order the pieces stand in the row."""
    tree = RoomTree(row_length)
    open_: list[list[int]] = [[] for _ in range(row_length + 1)]
    rows: list[list[int]] = []
    for piece in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        size = int(lengths[piece])
        room = tree.least(size)
        if room is None:
            row, room = len(rows), row_length
            rows.append([])
        else:
            row = open_[room].pop()
            tree.add(room, -1)
        rows[row].append(piece)
        open_[room - size].append(row)
        tree.add(room - size, 1)
    return rows


def _records(pieces, row_length, pad_id, kind, part, group):
    """pieces: (document, piece number, start, ids)."""
    rows = best_fit_decreasing([len(p[3]) for p in pieces], row_length)
    out = []
    for number, row in enumerate(rows):
        held = [pieces[k] for k in row]
        upto = np.cumsum([0, *[len(p[3]) for p in held]])
        ids = np.full(row_length, pad_id, dtype=kind)
        ids[:upto[-1]] = np.concatenate([p[3] for p in held])
        out.append((
            part, group, number, [p[0] for p in held], [p[1] for p in held], [p[2] for p in held],
            ids.tobytes(), upto.tolist(), upto[:-1].tolist(), int(upto[-1]),
        ))
    return pd.DataFrame(out, columns=_NAMES)


_NAMES = [
    "part", "group", "row", "doc_ids", "pieces", "starts", "ids", "cu_seqlens", "position_resets", "n_tokens",
]


def packed_rows(docs: DataFrame, tokenizer: str, row_length: int = ROW_LENGTH, end_id: int | None = END_ID,
                pad_id: int = PAD_ID, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One record per packed row.

    ids: row_length little-endian unsigned ids of 16 bits (32 if the vocabulary needs them),
    padded at the end; cu_seqlens: 0 and the end of every segment; position_resets: where a
    segment starts; doc_ids, pieces, starts: per segment its document, piece number and first id
    within the document. Null texts count as empty; an empty text is a segment of the end id, or
    none without an end id. Repeated rows are packed each for themselves, other columns are
    ignored, an empty table gives no rows.
    """
    if row_length < 1:
        raise ValueError("a row holds at least one id")
    schema = (
        "part int, group int, row int, doc_ids array<string>, pieces array<int>, starts array<long>, "
        "ids binary, cu_seqlens array<int>, position_resets array<int>, n_tokens int"
    )

    def pack(batches):
        coder = encoder(tokenizer)
        kind = "<u2" if max(coder.vocabulary, pad_id + 1, (end_id or 0) + 1) <= 1 << 16 else "<u4"
        tail = np.array([] if end_id is None else [end_id], dtype=np.int32)
        part, group, pieces, weight = TaskContext.get().partitionId(), 0, [], 0
        for keys, texts in _parts(batches):
            flat, lengths = coder.encode(texts)
            at = 0
            for key, n in zip(keys, lengths.tolist()):
                ids = np.concatenate((flat[at:at + n], tail)).astype(kind)
                at += n
                for piece, start in enumerate(range(0, len(ids), row_length)):
                    pieces.append((key, piece, start, ids[start:start + row_length]))
                weight += len(ids)
            if weight >= group_tokens:
                yield _records(pieces, row_length, pad_id, kind, part, group)
                group, pieces, weight = group + 1, [], 0
        if pieces:
            yield _records(pieces, row_length, pad_id, kind, part, group)

    made = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(pack, schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return made.withColumn("doc_ids", F.col("doc_ids").cast(f"array<{kind}>"))


def _parts(batches, chars: int = 1_000_000):
    for batch in batches:
        keys, texts, weight = [], [], 0
        for key, text in zip(batch["doc_id"], batch["text"]):
            keys.append(key)
            texts.append(text or "")
            weight += len(texts[-1])
            if weight >= chars:
                yield keys, texts
                keys, texts, weight = [], [], 0
        if keys:
            yield keys, texts


def write_packed(docs: DataFrame, folder: str, tokenizer: str, **options) -> DataFrame:
    """Write the packed rows below `folder` and read them back."""
    made = packed_rows(docs, tokenizer, **options)
    made.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(made.schema).parquet(folder)


def unpacked(rows: DataFrame, wide: bool = False) -> DataFrame:
    """(doc_id, piece, start, ids): the segments' ids again, for checks and readers of documents."""
    kind = "<u4" if wide else "<u2"
    id_kind = rows.schema["doc_ids"].dataType.elementType

    def take(batches):
        for batch in batches:
            out = []
            for record in batch.itertuples(index=False):
                ids = np.frombuffer(record.ids, dtype=kind)
                for k, key in enumerate(record.doc_ids):
                    a, b = record.cu_seqlens[k], record.cu_seqlens[k + 1]
                    out.append((key, record.pieces[k], record.starts[k], ids[a:b].astype(np.int32).tolist()))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "ids"])

    taken = rows.withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).mapInPandas(
        take, "doc_id string, piece int, start long, ids array<int>"
    )
    return taken.withColumn("doc_id", F.col("doc_id").cast(id_kind))
