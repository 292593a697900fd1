"""Benchmark passages found in documents by one Aho-Corasick automaton.

A benchmark item is cut into windows of 13 consecutive words (a shorter item is one window).
All distinct windows of all items, as normalised word strings, form one automaton that travels
to the tasks; each document is scanned once and every occurrence is reported with the words it
covers. Word numbers map back to character offsets of the original text.

The automaton's size is checked: windows beyond `AUTOMATON_WINDOWS` go into further automata, each
with its own scan, so what is broadcast stays bounded and nothing is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_table, unused, utf8

WINDOW_WORDS = 13
AUTOMATON_WINDOWS = 500_000
HIT_SHARE = 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER_TO_LOWER = {code: code + 32 for code in range(65, 91)}
_FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def words_of(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and everything beyond ASCII, after lower-casing A-Z."""
    return utf8(text).translate(fold_table(True)).split()


def windows_of(words: list[bytes], width: int = WINDOW_WORDS) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW_WORDS) -> list[list[tuple[str, int, list[str]]]]:
    """Groups of at most AUTOMATON_WINDOWS distinct windows: (string, words, item ids).

    The benchmark is the small side: it is read to the driver group by group. Items without words
    have no windows; windows of items with a null id still hit, but name no item.
    """

    def cut(batches):
        for batch in batches:
            rows = [
                (window.decode("utf-8"), window.count(b" ") + 1, item)
                for item, text in zip(batch["item"], batch["text"])
                for window in windows_of(words_of(text), width)
            ]
            yield pd.DataFrame(rows, columns=["window", "n", "item"])

    named = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    windows = (
        named.mapInPandas(cut, "window string, n long, item string")
        .groupBy("window", "n").agg(F.collect_set("item").alias("items")).orderBy("window")
    )
    groups: list[list] = [[]]
    for row in windows.toLocalIterator():
        if len(groups[-1]) >= AUTOMATON_WINDOWS:
            groups.append([])
        groups[-1].append((row["window"], row["n"], sorted(row["items"])))
    return groups


def _automaton(windows):
    tree = ahocorasick.Automaton()
    for number, (window, n, _) in enumerate(windows):
        tree.add_word(f" {window} ", (number, n))
    tree.make_automaton()
    return tree


def _scan(tree, words: list[bytes]):
    """(window number, first word, last word) of every occurrence."""
    line = b" %s " % b" ".join(words)
    text = line.decode("utf-8", "replace")
    ends = None
    for at, (number, n) in tree.iter(text):
        if ends is None:
            blank = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32) == 32
            ends = np.cumsum(blank) - 2
        last = int(ends[at])
        yield number, last - n + 1, last


def _merged(marked: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _judge(text, tree, windows):
    words = words_of(text)
    hit = np.zeros(len(words), dtype=bool)
    items: set[str] = set()
    if words and len(tree):
        for number, first, last in _scan(tree, words):
            hit[first:last + 1] = True
            items.update(windows[number][2])
    spans = []
    if hit.any():
        at = [m.span() for m in _WORD.finditer(text.translate(_UPPER_TO_LOWER))]
        spans = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in _merged(hit)]
    return len(words), int(hit.sum()), sorted(items), spans


def contamination(text: Column | str, windows) -> Column:
    """struct(n_words, n_hit, items, spans) of a text column against one group of windows."""

    @F.pandas_udf(_FOUND)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tree = _automaton(windows)
        for batch in batches:
            yield pd.DataFrame(
                [_judge(text, tree, windows) for text in batch], columns=["n_words", "n_hit", "items", "spans"]
            )

    return of(text)


def marked(docs: DataFrame, benchmark: DataFrame, name: str = "found", text: str = "text") -> DataFrame:
    """All rows and columns of `docs` with one more column, struct(n_words, n_hit, items, spans).

    n_words: words of the text; n_hit: words inside an occurrence of any window; items: ids (as
    strings, sorted) of the items with an occurring window; spans: the hit stretches as character
    offsets into the original text. A null or empty text has no words and no hits, an empty
    benchmark hits nothing, repeated rows are judged alike and overlapping windows count once.
    """
    groups = benchmark_windows(benchmark)
    if len(groups) == 1:
        return docs.withColumn(name, contamination(F.col(text), groups[0]))
    columns = []
    for windows in groups:
        columns.append(unused(docs, f"{name}_part"))
        docs = docs.withColumn(columns[-1], contamination(F.col(text), windows))
    return docs.withColumn(name, _joined(F.col(text), [F.col(c) for c in columns])).drop(*columns)


def _joined(text: Column, parts: list[Column]) -> Column:
    """The result of several automata over one text as one result."""

    @F.pandas_udf(_FOUND)
    def of(texts: pd.Series, spans: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for whole, found, names in zip(texts, spans, items):
            at = [m.span() for m in _WORD.finditer((whole or "").translate(_UPPER_TO_LOWER))]
            starts = [a for a, _ in at]
            hit = np.zeros(len(at), dtype=bool)
            for span in found:
                first, last = np.searchsorted(starts, [span["start"], span["end"]])
                hit[first:last] = True
            rows.append((
                len(at), int(hit.sum()), sorted(set(names)),
                [{"start": at[a][0], "end": at[b - 1][1]} for a, b in _merged(hit)],
            ))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return of(
        text, F.flatten(F.array(*[p["spans"] for p in parts])), F.flatten(F.array(*[p["items"] for p in parts]))
    )


def is_contaminated(found: Column) -> Column:
    """At least one word in twenty lies inside benchmark windows."""
    return (found["n_hit"] > 0) & (HIT_SHARE * found["n_hit"] >= found["n_words"])


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that are not contaminated."""
    name = unused(docs, "_found")
    return marked(docs, benchmark, name).where(~is_contaminated(F.col(name))).select(*docs.columns)


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)

