"""Token ids of texts by a tokenizer file, fast where words repeat.

For byte-level BPE files with the usual word pattern a text can be cut before every single blank
that stands between two other characters without changing any id: the pattern never joins across
such a place. The cut parts repeat, so each distinct one is encoded once per task and the ids of a
text are gathered from a table. Texts with runs of white space are encoded whole.
"""

from __future__ import annotations

import functools
import itertools
import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

CACHE_PARTS = 500_000
# White space other than a blank, next to a blank.
_SPACED = re.compile(r"[^\S ] | [^\S ]")
# The word pattern of the byte-level pre-tokenizer, and its byte alphabet.
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _alphabet() -> dict[str, int]:
    """Character of the file's alphabet -> byte."""
    others = [b for b in range(256) if b not in set(_PLAIN_BYTES)]
    return {chr(b): b for b in _PLAIN_BYTES} | {chr(256 + k): b for k, b in enumerate(others)}


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes -> id if the file is a plain byte-level BPE whose merges are numbered in order."""
    model, before = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel":
        return None
    if before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    vocab, alphabet = model["vocab"], _alphabet()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(alphabet[c] for c in token): number for token, number in vocab.items() if token not in special}


class Encoder:
    """Ids of texts, without special tokens; the strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            ranks = _ranks(json.load(file))
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.whole.no_padding()
        self.whole.no_truncation()
        self.vocabulary = self.whole.get_vocab_size()
        self.plain = None
        if ranks is not None:
            self.plain = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._line_feed = ranks[b"\n"]
        self._forget()

    def _forget(self):
        # A string stands for itself after a blank, a tuple of one string for itself alone.
        self._place: dict[str | tuple[str], int] = {}
        self._flat, self._used = np.zeros(1 << 16, dtype=np.int32), 0
        self._start = np.zeros(1 << 12, dtype=np.int64)  # of a part's ids, and their end after it

    def _learn(self, parts: list) -> None:
        """Encode new parts; those without white space together, a line each."""
        lines = [p for p in parts if not isinstance(p, tuple) and len(p.split()) == 1]
        # A line feed before a blank and a word is a token of its own and parts the ids again.
        if lines:
            ids = np.array(self.plain.encode_ordinary(" " + "\n ".join(lines) + "\n"), dtype=np.int32)
            ends = np.flatnonzero(ids == self._line_feed)
            if len(ends) == len(lines):
                keep = np.ones(len(ids), dtype=bool)
                keep[ends] = False
                self._add(lines, ids[keep], np.diff(ends, prepend=-1) - 1)
        for part in parts:
            if part not in self._place:
                ids = self.plain.encode_ordinary(part[0] if isinstance(part, tuple) else " " + part)
                self._add([part], np.array(ids, dtype=np.int32), np.array([len(ids)]))

    def _add(self, parts, ids, lengths):
        place, end = len(self._place), self._used + len(ids)
        if end > len(self._flat):
            self._flat = np.concatenate((self._flat, np.zeros(end + len(self._flat), np.int32)))
        need = place + len(parts) + 1
        if need > len(self._start):
            self._start = np.concatenate((self._start, np.zeros(need + len(self._start), np.int64)))
        self._flat[self._used:end] = ids
        self._start[place + 1:need] = self._used + np.cumsum(lengths)
        self._place.update(zip(parts, range(place, place + len(parts))))
        self._used = end

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after the other, and the number of ids of each text."""
        if self.plain is None:
            found = [e.ids for e in self.whole.encode_batch(texts, add_special_tokens=False)]
            lengths = np.array([len(ids) for ids in found], dtype=np.int64)
            return np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum())), lengths
        if len(self._place) > CACHE_PARTS:
            self._forget()
        parts: list = []
        ends = []
        for text in texts:
            if "  " in text or _SPACED.search(text):
                parts.append((text,))
            elif text:
                first, *rest = text.split(" ")
                if first:
                    parts.append((first,))
                parts += rest
            ends.append(len(parts))
        if not parts:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        places = np.fromiter(map(self._place.get, parts, itertools.repeat(-1)), np.int64, len(parts))
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            found = [parts[k] for k in unknown.tolist()]
            self._learn(list(dict.fromkeys(found)))
            places[unknown] = [self._place[part] for part in found]
        starts = self._start[places]
        lengths = self._start[places + 1] - starts
        total = np.cumsum(lengths)
        where = np.repeat(starts - (total - lengths), lengths) + np.arange(int(total[-1]))
        upto = np.concatenate(([0], total))[np.array(ends)]
        return self._flat[where], np.diff(upto, prepend=0)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
