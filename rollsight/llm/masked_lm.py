"""Documents scored by masked pseudo-likelihood with a small bidirectional window network.

Every word of a text is predicted from the two words before and the two after it; the summed
conditional log-probabilities score the text. A word's probability is that of its class given the
window, from the network, times that of the word within its class, from counts over all documents.
Words are hashed to `SLOTS` slots, so the tables of a task stay bounded; the most frequent slots are
classes of their own, the others share classes by falling frequency. Words that share a slot are not
merged: each word is counted for itself, in a Spark table of any size, and its probability within
its slot is a third factor. A word is known by its slot and 64-bit hash. Tasks know the most frequent word of each slot; what stands in the texts
of the others is joined with the table.

The network (an embedding per window place, a hidden layer, a softmax over classes) is trained in
numpy inside the tasks: in each of `ROUNDS` rounds every partition starts from the common weights,
passes once over its share of the documents, and the weights are averaged by words seen. Over all
rounds every window of every document is used once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import materialised
from .common import fold_table, slices

SLOTS = 1 << 18
CLASSES = 64
OWN_CLASSES = 48
WINDOW = 2
WIDTH = 16
ROUNDS = 3
BATCH = 1024
RATE = 0.02
SLICE = 500_000
# Different words a task counts before it hands them on.
HELD_WORDS = 500_000
SEED = 42


class Words(NamedTuple):
    """Counts over the corpus: class of each slot and its log-probability within the class.

    Of slots that several words share also the hash of the most frequent one and its log-probability
    within the slot, which is 0 for all other slots.
    """

    class_of: np.ndarray
    within: np.ndarray
    first: np.ndarray
    first_share: np.ndarray


class Network(NamedTuple):
    places: np.ndarray  # window places x (classes + edge) x width
    hidden: np.ndarray
    out: np.ndarray  # width x classes
    bias: np.ndarray


_OFFSETS = tuple(k for k in range(-WINDOW, WINDOW + 1) if k)


def words_in(raw: bytes) -> list[bytes]:
    """Words of a text's bytes; they are split at ASCII white space, A-Z lower-cased."""
    return raw.translate(fold_table(False)).split()


def slots_of(words: list[bytes]) -> np.ndarray:
    return (np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % SLOTS).astype(np.int32)


def slots_in(raw: bytes) -> np.ndarray:
    """Slots of the words of a text's bytes."""
    return slots_of(words_in(raw))


def _hashes(words: list[bytes]) -> np.ndarray:
    found = map(xxhash.xxh64_intdigest, words, repeat(SEED))
    return np.fromiter(found, np.uint64, len(words)).view(np.int64)


def _counts(batches):
    total: Counter = Counter()

    def rows():
        words = list(total)
        return pd.DataFrame({"slot": slots_of(words), "word": _hashes(words), "n": list(total.values())})

    for batch in batches:
        for part in slices(batch["text"]):
            for raw in part:
                total.update(words_in(raw))
            if len(total) > HELD_WORDS:
                yield rows()
                total.clear()
    yield rows()


def word_counts(docs: DataFrame) -> DataFrame:
    """(slot, word, n): every word of all documents, as its hash, with its count."""
    counted = docs.select("text").mapInPandas(_counts, "slot int, word long, n long")
    return materialised(counted.groupBy("slot", "word").agg(F.sum("n").alias("n")))


def slot_totals(counted: DataFrame) -> DataFrame:
    """Per slot the words, their sum, and the most frequent one (any of equals) with its count."""
    return materialised(counted.groupBy("slot").agg(
        F.count("*").alias("words"), F.sum("n").alias("total"), F.max("n").alias("most"),
        F.max_by("word", "n").alias("first"),
    ))


def other_words(counted: DataFrame, totals: DataFrame) -> DataFrame:
    """(word, share): log-probability within the slot of all words that are not the first of theirs."""
    slots = totals.where("words > 1").select("slot", "total", "first")
    others = counted.join(slots, "slot").where("word <> first")
    return others.select("word", F.log(F.col("n") / F.col("total")).alias("share"))


def count_words(docs: DataFrame, totals: DataFrame | None = None) -> Words:
    """Classes and within-class probabilities from the counts of all words of all documents.

    One row per slot reaches the driver, whatever the corpus. `totals`: the `slot_totals`, if known.
    """
    slots = slot_totals(word_counts(docs)) if totals is None else totals
    rows = slots.select("slot", "words", F.col("total").alias("n"), "most", "first").toPandas()
    n = np.zeros(SLOTS, dtype=np.int64)
    n[rows["slot"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    order = np.argsort(-n, kind="stable")
    class_of = np.empty(SLOTS, dtype=np.uint8)
    class_of[order[:OWN_CLASSES]] = np.arange(OWN_CLASSES)
    rest = order[OWN_CLASSES:]
    mass = np.cumsum(n[rest] + 0.5)
    shared = CLASSES - OWN_CLASSES
    class_of[rest] = OWN_CLASSES + np.minimum((mass / mass[-1] * shared).astype(np.int64), shared - 1)
    smooth = n + 0.5
    within = np.log(smooth / np.bincount(class_of, smooth, minlength=CLASSES)[class_of])
    first, first_share = np.zeros(SLOTS, dtype=np.int64), np.zeros(SLOTS)
    rows = rows[rows["words"] > 1]
    first[rows["slot"]] = rows["first"]
    first_share[rows["slot"]] = np.log(rows["most"] / rows["n"])
    return Words(class_of, within.astype(np.float32), first, first_share)


def first_network(seed: int = 7) -> Network:
    draw = np.random.default_rng(seed)
    return Network(
        (draw.standard_normal((len(_OFFSETS), CLASSES + 1, WIDTH)) * 0.1).astype(np.float32),
        np.zeros(WIDTH, np.float32),
        (draw.standard_normal((WIDTH, CLASSES)) * 0.1).astype(np.float32), np.zeros(CLASSES, np.float32),
    )


def _windows(parts: list[np.ndarray]):
    """Window classes and middle classes of several texts; CLASSES stands beyond a text's ends."""
    edge = np.full(WINDOW, CLASSES, dtype=np.int64)
    line = np.concatenate([x for part in parts for x in (edge, part)] + [edge])
    at = np.flatnonzero(line < CLASSES)
    return np.stack([line[at + k] for k in _OFFSETS]), line[at]


def _forward(net: Network, around: np.ndarray):
    hidden = np.repeat(net.hidden[None, :], around.shape[1], axis=0)
    for place in range(len(_OFFSETS)):
        hidden += net.places[place][around[place]]
    np.tanh(hidden, out=hidden)
    logits = hidden @ net.out
    logits += net.bias
    logits -= logits.max(axis=1, keepdims=True)
    return hidden, logits


def log_probabilities(net: Network, around: np.ndarray, middle: np.ndarray) -> np.ndarray:
    _, logits = _forward(net, around)
    rows = np.arange(len(middle))
    chosen = logits[rows, middle]
    np.exp(logits, out=logits)
    return chosen - np.log(logits.sum(axis=1))


def _slopes(net: Network, around: np.ndarray, middle: np.ndarray) -> Network:
    """Gradient of the mean negative log-probability."""
    hidden, logits = _forward(net, around)
    n = len(middle)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    logits[np.arange(n), middle] -= 1
    logits /= n
    back = (logits @ net.out.T) * (1 - hidden ** 2)
    places = np.zeros_like(net.places)
    marks = np.zeros((n, CLASSES + 1), dtype=np.float32)
    rows = np.arange(n)
    for place in range(len(_OFFSETS)):
        marks[rows, around[place]] = 1
        places[place] = marks.T @ back
        marks[rows, around[place]] = 0
    return Network(places, back.sum(axis=0), hidden.T @ logits, logits.sum(axis=0))


class _Descent:
    """Adam steps from common weights."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.step = Network(*[x.copy() for x in net]), rate, 0
        self.mean = [np.zeros_like(x) for x in net]
        self.square = [np.zeros_like(x) for x in net]

    def learn(self, around, middle):
        for start in range(0, len(middle), BATCH):
            slopes = _slopes(self.net, around[:, start:start + BATCH], middle[start:start + BATCH])
            self.step += 1
            fade = self.rate * np.sqrt(1 - 0.999 ** self.step) / (1 - 0.9 ** self.step)
            for weight, slope, mean, square in zip(self.net, slopes, self.mean, self.square):
                mean += 0.1 * (slope - mean)
                square += 0.001 * (slope * slope - square)
                weight -= fade * mean / (np.sqrt(square) + 1e-6)


def _packed(net: Network) -> np.ndarray:
    return np.concatenate([x.ravel() for x in net])


def _unpacked(flat: np.ndarray, like: Network) -> Network:
    ends = np.cumsum([x.size for x in like])[:-1]
    return Network(*[p.reshape(x.shape).astype(np.float32) for p, x in zip(np.split(flat, ends), like)])


def _round(words: Words, net: Network, rate: float):
    def train(batches):
        descent, seen = _Descent(net, rate), 0
        for batch in batches:
            for part in slices(batch["text"], SLICE):
                classes = [words.class_of[slots_in(raw)].astype(np.int64) for raw in part]
                around, middle = _windows(classes)
                descent.learn(around, middle)
                seen += len(middle)
        if seen:
            flat = _packed(descent.net).astype(np.float64)
            yield pd.DataFrame({"place": np.arange(len(flat), dtype=np.int32), "value": flat, "n": seen})

    return train


def train(docs: DataFrame, words: Words, rounds: int = ROUNDS, rate: float = RATE) -> Network:
    """Network after `rounds` averaged rounds; each document is in one of them, by a hash of its text.

    Only the averaged weights, some thousands of numbers, reach the driver. Documents without
    words teach nothing; without any words the untrained network is returned.
    """
    net = first_network()
    for number in range(rounds):
        share = docs.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == number).select("text")
        made = share.mapInPandas(_round(words, net, rate / (1 + number)), "place int, value double, n long")
        mean = (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value")
        rows = made.groupBy("place").agg(mean).toPandas().sort_values("place")
        if len(rows):
            net = _unpacked(rows["value"].to_numpy(), net)
    return net


def _likelihood(words: Words, net: Network, each: bool):
    """Scores by slots, or with `each` by words: those of the first words of their slots, and the other words."""
    kind = "n_words long, log_likelihood double" + (", others array<long>" if each else "")

    @F.pandas_udf(kind)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, sums, left = [], [], []
            for part in slices(batch, SLICE):
                split = [words_in(raw) for raw in part]
                slots = [slots_of(found) for found in split]
                found = [len(s) for s in slots]
                lengths.extend(found)
                every = np.concatenate(slots)
                around, middle = _windows([words.class_of[s].astype(np.int64) for s in slots])
                scores = words.within[every].astype(np.float64)
                for start in range(0, len(middle), 8 * BATCH):
                    stop = start + 8 * BATCH
                    scores[start:stop] += log_probabilities(net, around[:, start:stop], middle[start:stop])
                ends = np.cumsum([0, *found])
                if each:
                    flat = list(chain.from_iterable(split))
                    shared = np.flatnonzero(words.first_share[every])
                    keys = _hashes([flat[k] for k in shared.tolist()])
                    is_first = keys == words.first[every[shared]]
                    scores[shared[is_first]] += words.first_share[every[shared[is_first]]]
                    left.extend(np.split(keys[~is_first], np.searchsorted(shared[~is_first], ends[1:-1])))
                upto = np.concatenate(([0.0], np.cumsum(scores)))
                sums.extend(upto[ends[1:]] - upto[ends[:-1]])
            made = {"n_words": lengths, "log_likelihood": sums}
            yield pd.DataFrame(made | {"others": left} if each else made)

    return of


def pseudo_likelihood(text: Column | str, words: Words, net: Network) -> Column:
    """struct(n_words, log_likelihood) of a text column; zero for a text without words or a null.

    A word has the probability of its slot here; `scored` tells the words of a slot apart.
    """
    return _likelihood(words, net, False)(text)


def scored(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, log_likelihood, per_word): counts, training and scores over all rows.

    per_word is null without words. Repeated rows count and score each for themselves; other
    columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    counted = word_counts(docs)
    totals = slot_totals(counted)
    words = count_words(docs, totals)
    net = train(docs, words, rounds)
    found = materialised(
        docs.select("doc_id", _likelihood(words, net, True)("text").alias("found"))
        .select("doc_id", "found.*", F.monotonically_increasing_id().alias("row"))
    )
    left = found.select("row", F.explode("others").alias("word"))
    more = left.join(other_words(counted, totals), "word").groupBy("row").agg(F.sum("share").alias("more"))
    n, total = F.col("n_words"), F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))
    return found.join(more, "row", "left").select(
        "doc_id", "n_words", total.alias("log_likelihood"), F.when(n > 0, total / n).alias("per_word")
    )
