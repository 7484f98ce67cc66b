"""Substring dedup by relative Lempel-Ziv parsing.

Removes every word that a window of 13 words covers whose words also start in a document with a smaller id.
``repeats`` brings all places together where such a window can repeat. There, the runs
of smaller ids are kept in reference blocks, each with an index of its windows. A new run is parsed greedily:
from every position the longest factor is sought that some reference block holds, and the parse
goes on behind it. Factors of 13 words or more are duplicate spans. A greedy factor may end
inside another match, so the windows across factor boundaries are looked up one by one.

Defined results
* NULL text has no words; texts below 13 words lose nothing.
* A NULL id takes no part: such rows stay whole.
* Rows that repeat an id are the same document: they do not match one another.
* Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from feira.llm import repeats

LENGTH = repeats.WORDS_13.length
BLOCK_RUNS = 4096


class Block:
    """Reference runs of rising ids, indexed by window: the first place of each."""

    def __init__(self):
        self.runs: list[list[bytes]] = []
        self.ids: list[int] = []
        self.places: dict[bytes, tuple[int, int]] = {}

    def add(self, owner: int, words: list[bytes], windows: list[bytes]) -> None:
        run = len(self.runs)
        self.runs.append(words)
        self.ids.append(owner)
        for at, window in enumerate(windows):
            self.places.setdefault(window, (run, at))

    def factor(self, owner: int, words: list[bytes], at: int, window: bytes) -> int:
        """Length in words of the longest factor from ``at`` here that a smaller id holds, 0 if it is below a window.

        The indexed place is the window's first; where it breaks off, another one is met at the boundary.
        """
        place = self.places.get(window)
        if place is None or self.ids[place[0]] >= owner:
            return 0
        run, start = place
        reference = self.runs[run]
        size = LENGTH
        while at + size < len(words) and start + size < len(reference) and words[at + size] == reference[start + size]:
            size += 1
        return size


def match(ids: np.ndarray, contents: list[bytes]) -> list[np.ndarray]:
    """The windows of each run (by rising id) that a run of a smaller id holds too."""
    blocks = [Block()]
    out: list[np.ndarray] = []
    for owner, content in zip(ids.tolist(), contents):
        words = content.split(b" ")
        windows = [b" ".join(words[k : k + LENGTH]) for k in range(len(words) - LENGTH + 1)]
        hit = np.zeros(len(windows), dtype=bool)
        at = 0
        while at < len(windows):
            size = max(block.factor(owner, words, at, windows[at]) for block in blocks)
            if size:
                hit[at : at + size - LENGTH + 1] = True
            # the windows across the factor's end come next, one by one, until a factor starts again
            at += max(1, size - LENGTH + 1)
        out.append(np.flatnonzero(hit))
        if len(blocks[-1].runs) >= BLOCK_RUNS:
            blocks.append(Block())
        blocks[-1].add(owner, words, windows)
    return out


def remove_repeated_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that lose words to smaller ids: (doc, ver, n_units, n_removed, spans, kept).

    Later copies of whole texts are given by ``repeats.copies``; they lose everything if they have 13 words.
    """
    return repeats.cut(docs, repeats.WORDS_13, match, doc_id, text)
