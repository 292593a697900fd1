"""Packing documents into sequences by bin completion with branch and bound.

Documents are only told apart by their number of tokens, so the search runs on how many pieces
there are of each length: at most one number per possible length, whatever the corpus. Around the
largest piece left, fillings that no other filling dominates are listed one by one, fullest first;
the search goes down into them, taking a filling as often as the counts allow, and gives up a branch
when the tokens left and the waste made so far cannot beat the best solution known. The first such
solution is best-fit decreasing. Branches with few departures from the fullest filling come first.

Spark does the rest: tokens are cut per partition, pieces are numbered within (length, partition),
offsets per partition make the number unique per length, and the number picks the place.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.session import materialised
from .tokens import encoder

CAPACITY = 2048
END_ID = 0
# Fillings that the search looks at before it settles for the best packing it has.
STEPS = 4_000
# Branches of the search whose listings stay open; the others list again when their turn comes.
LISTINGS = 32
SLICE_CHARS = 1_000_000

Filling = tuple[tuple[int, int], ...]  # (length, times), longest first


# --- the search over counts of lengths ------------------------------------------------------


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that any packing needs: by volume, and by pieces too long to share one."""
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    number, volume = np.cumsum(counts), np.cumsum(counts * sizes)
    by_volume = -(-int(volume[-1]) // capacity)
    k = np.arange(1, capacity // 2 + 1)
    if not len(k):
        return by_volume
    alone = number[-1] - number[capacity - k]
    large = number[capacity - k] - number[capacity // 2]
    large_volume = volume[capacity - k] - volume[capacity // 2]
    medium_volume = volume[capacity // 2] - volume[k - 1]
    more = np.maximum(0, -(-(medium_volume - (large * capacity - large_volume)) // capacity))
    return max(by_volume, int((alone + large + more).max()))


def best_fit(counts: np.ndarray) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, all pieces of one length at a time.

    The fullest open sequence with enough room takes as many as fit before the next one is looked
    at, so sequences that hold the same are filled together and the work does not depend on how
    many pieces there are.
    """
    capacity = len(counts) - 1
    open_: list[Counter] = [Counter() for _ in range(capacity + 1)]
    room = np.zeros(capacity + 1, dtype=bool)

    def put(held: Filling, size: int, each: int, sequences: int, left: int):
        open_[left][_together(held, ((size, each),))] += sequences
        room[left] = True

    for size in np.flatnonzero(counts)[::-1].tolist():
        waiting = int(counts[size])
        for at in (np.flatnonzero(room[size:]) + size).tolist():
            each = at // size
            for held, sequences in list(open_[at].items()):
                if not waiting:
                    break
                del open_[at][held]
                full = min(sequences, waiting // each)
                if full:
                    put(held, size, each, full, at - each * size)
                    waiting -= full * each
                    sequences -= full
                if sequences and waiting:
                    put(held, size, waiting, 1, at - waiting * size)
                    waiting, sequences = 0, sequences - 1
                if sequences:
                    open_[at][held] += sequences
            room[at] = bool(open_[at])
        each = capacity // size
        if waiting // each:
            put((), size, each, waiting // each, capacity - each * size)
        if waiting % each:
            put((), size, waiting % each, 1, capacity - waiting % each * size)
    made: Counter = Counter()
    for level in open_:
        made.update(level)
    return sorted(made.items(), reverse=True)


def _together(*parts: Filling) -> Filling:
    total: dict[int, int] = {}
    for part in parts:
        for size, times in part:
            total[size] = total.get(size, 0) + times
    return tuple(sorted(total.items(), reverse=True))


def _sums(sizes: list[int], most: list[int], room: int) -> list[int]:
    """Per place k the sums up to `room` of the pieces from k on, as bits; the last is the empty sum."""
    mask, out = (1 << (room + 1)) - 1, [1]
    for size, number in zip(reversed(sizes), reversed(most)):
        bits, step = out[-1], 1
        while number > 0:
            taken = min(step, number)
            bits |= bits << (size * taken)
            number -= taken
            step *= 2
        out.append(bits & mask)
    return out[::-1]


def _dominated(filling: Filling, spare: int, counts: np.ndarray) -> bool:
    """Whether a piece left outside fits besides it, or instead of shorter pieces of it.

    `spare` is the room the filling leaves. All sums of its pieces are looked at, so a longer
    piece may stand for one or several of them.
    """
    held, sums = dict(filling), {0}
    for size, times in filling:
        sums |= {have + size * k for have in sums for k in range(1, times + 1)}
        if len(sums) > 4_096:
            return False  # listing a dominated filling costs time only
    for have in sums:
        for longer in range(have + 1, have + spare + 1):
            if longer < len(counts) and counts[longer] > held.get(longer, 0):
                return True
    return False


def fillings(counts: np.ndarray, room: int) -> Iterator[Filling | None]:
    """The undominated fillings of `room` by the pieces left, fullest first, one after the other.

    None stands for a dominated one, so whoever asks can count what was looked at. Sums that can be reached are known for every rest of the lengths, so the listing meets no dead
    ends: it takes as long as the fillings that are asked for, whatever number there is in all.
    """
    there = np.flatnonzero(counts[:room + 1])[::-1]
    sizes, most = there.tolist(), np.minimum(counts[there], room // np.maximum(there, 1)).tolist()
    reach = _sums(sizes, most, room)

    def with_sum(target: int) -> Iterator[Filling]:
        """One piece or two come first, which leaves the short pieces for later sequences."""
        if target <= 0 or not sizes:
            yield ()
            return
        if counts[target]:
            yield ((target, 1),)
        high = np.arange(target - 1, (target - 1) // 2, -1)
        paired = (counts[high] > 0) & (counts[target - high] > 0) & ((2 * high != target) | (counts[high] > 1))
        for long in high[paired].tolist():
            yield ((long, 2),) if 2 * long == target else ((long, 1), (target - long, 1))
        yield from (f for f in of_any_number(target) if sum(times for _, times in f) > 2)

    def of_any_number(target: int) -> Iterator[Filling]:
        open_: list[tuple[int, int, Filling]] = [(0, target, ())]
        while open_:
            place, left, taken = open_.pop()
            if not left:
                yield taken
                continue
            # Longest pieces first, as often as they fit; what is put on the stack last is tried first.
            while place < len(sizes) and sizes[place] > left:
                place += 1
            if place == len(sizes) or not reach[place] >> left & 1:
                continue
            if reach[place + 1] >> left & 1:
                open_.append((place + 1, left, taken))
            for times in range(1, min(most[place], left // sizes[place]) + 1):
                rest = left - times * sizes[place]
                if reach[place + 1] >> rest & 1:
                    open_.append((place + 1, rest, (*taken, (sizes[place], times))))

    level = reach[0]
    while level:
        target = level.bit_length() - 1
        level ^= 1 << target
        for filling in with_sum(target):
            yield None if _dominated(filling, room - target, counts) else filling


class Plan(NamedTuple):
    patterns: list[tuple[Filling, int]]  # what a sequence holds, and how many sequences hold it
    sequences: int
    bound: int  # sequences that any packing needs
    proven: bool  # whether no packing has fewer: the bound is met, or the search has ended


class _Branch:
    """A path of fillings, and the listing of those around the longest piece left after it."""

    def __init__(self, path, counts: np.ndarray, used: int, volume: int):
        self.path, self.counts, self.used, self.volume = path, counts, used, volume
        self.longest = int(np.flatnonzero(counts)[-1])
        self.listing: Iterator[Filling | None] | None = None
        self.listed, self.ended = 0, False
        self.once: list[Filling] = []

    def next(self):
        """The next (filling, times): each as often as it fits, and then, as other branches, once.

        Times are 0 for a filling that need not be tried, and None ends the branch.
        """
        if self.listing is None and not self.ended:
            rest = self.counts.astype(np.int64)
            rest[self.longest] -= 1
            self.listing = itertools.islice(fillings(rest, len(rest) - 1 - self.longest), self.listed, None)
        for rest in self.listing or ():
            self.listed += 1
            if rest is None:
                return (), 0
            whole = _together(((self.longest, 1),), rest)
            times = min(int(self.counts[size]) // n for size, n in whole)
            if times > 1:
                self.once.append(whole)
            return whole, times
        self.listing, self.ended = None, True
        return (self.once.pop(0), 1) if self.once else None

    def park(self):
        """Hold little until the next call, which lists again up to where this one stopped."""
        self.listing = None
        self.counts = self.counts.astype(np.min_scalar_type(int(self.counts.max())))

    def after(self, filling: Filling, times: int):
        left = self.counts.astype(np.int64)
        for size, n in filling:
            left[size] -= n * times
        return left, self.volume - times * sum(size * n for size, n in filling)


def solve(counts, steps: int = STEPS) -> Plan:
    """Pack `counts[length]` pieces of each length; the last index is the capacity.

    Branches are followed in the order of how often they left the fullest filling, so an early wrong
    choice is mended before all late ones were tried. Every filling around the longest piece is a
    branch, taken as often as it fits or once; `steps` bounds how many are looked at. A listing holds
    the sums of all lengths left, so only those of the `LISTINGS` branches used last stay open.
    """
    counts = np.array(counts, dtype=np.int64)
    counts[0] = 0
    capacity = len(counts) - 1
    best = best_fit(counts)
    fewest, bound = sum(n for _, n in best), lower_bound(counts)
    order = itertools.count()
    open_: list[tuple] = []
    listing: dict[_Branch, None] = {}
    if fewest > bound:
        heapq.heappush(open_, (0, 0, next(order), _Branch(None, counts, 0, int(counts @ np.arange(capacity + 1)))))
    while open_ and steps > 0 and fewest > bound:
        turns, _, _, branch = heapq.heappop(open_)
        while branch.used + -(-branch.volume // capacity) < fewest and steps > 0:
            found = branch.next()
            if found is None:
                break
            steps -= 1
            filling, times = found
            if not times:
                continue
            # The other fillings of this branch wait for those with fewer turns.
            heapq.heappush(open_, (turns + 1, -branch.used, next(order), branch))
            listing.pop(branch, None)
            listing[branch] = None
            if len(listing) > LISTINGS:
                oldest = next(iter(listing))
                del listing[oldest]
                oldest.park()
            path, used = (branch.path, filling, times), branch.used + times
            left, volume = branch.after(filling, times)
            if used + -(-volume // capacity) >= fewest:
                break
            if not volume:
                best, fewest = [], used
                while path is not None:
                    best.append((path[1], path[2]))
                    path = path[0]
                break
            if used + lower_bound(left) >= fewest:
                break
            branch = _Branch(path, left, used, volume)
    merged: Counter = Counter()
    for filling, times in best:
        merged[filling] += times
    return Plan(sorted(merged.items(), reverse=True), fewest, bound, fewest == bound or (not open_ and steps > 0))


class Places(NamedTuple):
    """Per length and run of piece numbers: where the first of them goes."""

    key: np.ndarray
    first: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


_SHIFT = 45  # piece numbers below 2^45, lengths below 2^18


def places(plan: Plan) -> Places:
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, number in plan.patterns:
        offset = 0
        for size, times in filling:
            first = taken.get(size, 0)
            rows.append(((size << _SHIFT) + first, first, times, sequence, offset))
            taken[size] = first + times * number
            offset += size * times
        sequence += number
    rows.sort()
    return Places(*np.array(rows or np.zeros((0, 5)), dtype=np.int64).reshape(-1, 5).T)


# --- Spark ----------------------------------------------------------------------------------


def piece_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of the pieces of `total` tokens: whole capacities, the first may be shorter."""
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of the ids as unsigned little-endian 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = END_ID,
        derive: dict[str, tuple[str, Callable]] | None = None) -> DataFrame:
    """Pieces of all texts with their token ids.

    Columns doc_id, piece, start, length, part, number and `ids`, or instead of `ids` one column
    per entry name -> (type, function of the ids) of `derive`, computed where the ids are.
    A null text counts as empty; with an `end_id` it still is a piece of one token.
    """
    columns = derive or {"ids": ("array<int>", lambda ids: ids.tolist())}
    schema = "doc_id string, piece int, start long, length long, part int, number long, "
    schema += ", ".join(f"{name} {kind}" for name, (kind, _) in columns.items())
    tail = [] if end_id is None else [end_id]

    def pieces(batches):
        encode = encoder(tokenizer).encode
        part, seen = TaskContext.get().partitionId(), Counter()

        def framed(keys, texts):
            flat, lengths = encode(texts)
            out, at = [], 0
            for key, n in zip(keys, lengths.tolist()):
                ids = np.append(flat[at:at + n], np.array(tail, dtype=np.int32))
                at += n
                start = 0
                for piece, length in enumerate(piece_lengths(len(ids), capacity)):
                    own = ids[start:start + length]
                    out.append((key, piece, start, length, part, seen[length], *[f(own) for _, f in columns.values()]))
                    seen[length] += 1
                    start += length
            return pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "part", "number", *columns])

        for batch in batches:
            keys, texts, weight = [], [], 0
            for key, text in zip(batch["doc_id"], batch["text"]):
                keys.append(key)
                texts.append(text or "")
                weight += len(texts[-1])
                if weight >= SLICE_CHARS:
                    yield framed(keys, texts)
                    keys, texts, weight = [], [], 0
            if keys:
                yield framed(keys, texts)

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(pieces, schema)


def _placed(found: Places) -> Callable:
    @F.pandas_udf("sequence_id long, offset long")
    def of(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        size, rank = length.to_numpy(np.int64), number.to_numpy(np.int64)
        at = np.searchsorted(found.key, (size << _SHIFT) + rank, side="right") - 1
        along = rank - found.first[at]
        return pd.DataFrame({
            "sequence_id": found.sequence[at] + along // found.times[at],
            "offset": found.offset[at] + along % found.times[at] * size,
        })

    return of


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = END_ID,
           derive: dict[str, tuple[str, Callable]] | None = None, steps: int = STEPS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, `ids` (or `derive`), sequence_id, offset,
    bound (sequences that any packing needs) and proven (whether no packing has fewer than this one).

    Every row of `docs` is packed, repeated rows each for themselves; null and empty texts are
    pieces of the end id alone (no piece without an end id). Pieces of a sequence follow each
    other without gaps from 0. Other columns are ignored; an empty table gives no rows. The
    search sees one count per length; which document gets which place depends on the partitions
    it was read in, the number of sequences does not.
    """
    cuts = materialised(cut(docs, tokenizer, capacity, end_id, derive))
    sizes = materialised(cuts.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    plan = solve(counts, steps)
    found = places(plan)
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = materialised(
        sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    ranked = cuts.join(offsets, ["length", "part"]).withColumn("number", F.col("number") + F.col("before"))
    kind = docs.schema["doc_id"].dataType
    return (
        ranked.withColumn("place", _placed(found)("length", "number"))
        .withColumns({"sequence_id": F.col("place.sequence_id"), "offset": F.col("place.offset")})
        .withColumns({"bound": F.lit(plan.bound).cast("long"), "proven": F.lit(plan.proven)})
        .withColumn("doc_id", F.col("doc_id").cast(kind))
        .select("doc_id", "piece", "start", "length", *(derive or ["ids"]), "sequence_id", "offset", "bound", "proven")
    )
