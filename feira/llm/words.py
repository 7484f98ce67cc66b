"""Words and word shingles of whole texts as 64-bit keys, by array operations on bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLANKS = b" \t\n\x0b\x0c\r"
_APART = np.zeros(256, dtype=bool)
_APART[[*BLANKS]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CELLS = np.random.default_rng(11).integers(0, 2**63, (64, 256), dtype=np.int64).astype(np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
GROUP = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """One-to-one mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(texts: list, size: int = GROUP) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts as bytes) in runs of about ``size`` bytes; NULL is empty."""
    held, first, total = [], 0, 0
    for k, text in enumerate(texts):
        raw = text if isinstance(text, bytes) else (text or "").encode()
        held.append(raw)
        total += len(raw)
        if total >= size:
            yield first, held
            held, first, total = [], k + 1, 0
    if held:
        yield first, held


def word_keys(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, start byte in its text, end byte in its text) of every word, and the words per text."""
    joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    apart = _APART[joined]
    edge = np.diff(np.concatenate([[True], apart, [True]]).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not first.size:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(texts), dtype=np.int64)
    size = last - first
    inside = ~apart
    letters = joined[inside]
    if lower:
        letters = _LOWER[letters]
    place = np.flatnonzero(inside) - np.repeat(first, size)
    cells = _CELLS[place & 63, letters]
    far = place >= 64
    if far.any():
        cells[far] *= (2 * (place[far] >> 6) + 1).astype(np.uint64)
    key = mixed(np.add.reduceat(cells, np.concatenate([[0], np.cumsum(size)[:-1]])) + size.astype(np.uint64) * _STEP)
    owner = np.searchsorted(begins, first, side="right") - 1
    return key, first - begins[owner], last - begins[owner], np.bincount(owner, minlength=len(texts))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct keys of each text's shingles of lower-cased words.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    key, _, _, counts = word_keys(texts, lower=True)
    runs = np.zeros(max(key.size - words + 1, 0), dtype=np.uint64)
    for j in range(words):
        runs = runs * _STEP + key[j : j + runs.size]
    runs = mixed(runs)
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(runs[at : at + n - words + 1]))
        elif n:
            whole = np.zeros(1, dtype=np.uint64)
            for j in range(n):
                whole = whole * _STEP + key[at + j]
            out.append(mixed(whole + np.uint64(n)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out
