"""Suffix-array dedup with a logarithmic family of indexes.

Removes every byte that a 50-byte string covers which also starts in a document with a smaller id.
``repeats`` brings all places together where such a string can repeat. There, documents arrive
in batches by rising id. Each batch gets a suffix array (its suffixes in the order of their first 50
bytes, with the smallest id of equal ones), which is merge-scanned against every existing level: a common
prefix of 50 bytes with a level is a match with a smaller id. The batch then becomes a level of its own, and levels
of equal size class merge, so a suffix is moved a logarithmic number of times.

Defined results
* NULL text is empty; texts below 50 bytes lose nothing. Matches never cross documents.
* A NULL id takes no part: such rows stay whole.
* Rows that repeat an id are the same document: they do not match one another.
* Bytes may be cut inside a character, so what is kept is binary.
* Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from feira.llm import repeats

LENGTH = repeats.BYTES_50.length
BATCH_SUFFIXES = 1 << 15


class Level:
    """Distinct strings in suffix order, each with the smallest id that holds it."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray):
        self.keys, self.ids = keys, ids

    @staticmethod
    def of(keys: np.ndarray, ids: np.ndarray) -> Level:
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        head = np.ones(keys.size, dtype=bool)
        head[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(head)
        return Level(keys[first], np.minimum.reduceat(ids, first) if ids.size else ids)

    def scan(self, keys: np.ndarray) -> np.ndarray:
        """Smallest id that holds each of the sorted ``keys``, or the largest integer."""
        at = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return np.where(self.keys[at] == keys, self.ids[at], np.iinfo(np.int64).max)

    def merged(self, other: Level) -> Level:
        return Level.of(np.concatenate([self.keys, other.keys]), np.concatenate([self.ids, other.ids]))


class Family:
    """Levels whose size classes (powers of two batches) all differ."""

    def __init__(self):
        self.levels: dict[int, Level] = {}

    def smallest(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(keys.size, np.iinfo(np.int64).max)
        for level in self.levels.values():
            out = np.minimum(out, level.scan(keys))
        return out

    def add(self, level: Level) -> None:
        size = 0
        while size in self.levels:
            level = self.levels.pop(size).merged(level)
            size += 1
        self.levels[size] = level


def match(ids: np.ndarray, contents: list[bytes]) -> list[np.ndarray]:
    """The windows of each run (by rising id) that a run of a smaller id holds too."""
    family = Family()
    out: list[np.ndarray] = []
    windows = np.array([len(c) - LENGTH + 1 for c in contents], dtype=np.int64)
    reach = np.cumsum(windows)
    a = 0
    while a < len(contents):
        b = max(a + 1, int(np.searchsorted(reach, (reach[a - 1] if a else 0) + BATCH_SUFFIXES, side="right")))
        text = np.frombuffer(b"".join(contents[a:b]), dtype=np.uint8)
        n = windows[a:b]
        begins = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        starts = np.repeat(begins, n) + inside
        view = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
        suffixes = np.ascontiguousarray(view[starts]).view(f"S{LENGTH}").ravel()
        owner = np.repeat(ids[a:b], n)
        level = Level.of(suffixes, owner)
        known = np.minimum(family.smallest(level.keys), level.ids)
        hit = known[np.searchsorted(level.keys, suffixes)] < owner
        edges = np.cumsum(n)
        out += [inside[e - m : e][hit[e - m : e]] for e, m in zip(edges.tolist(), n.tolist())]
        family.add(level)
        a = b
    return out


def remove_repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that lose bytes to smaller ids: (doc, ver, n_units, n_removed, spans, kept).

    Later copies of whole texts are given by ``repeats.copies``; they lose everything if they have 50 bytes.
    """
    return repeats.cut(docs, repeats.BYTES_50, match, doc_id, text)
