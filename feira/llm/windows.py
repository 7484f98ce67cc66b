"""Windows of L units (bytes or words) grouped by content-defined anchors, with array operations.

Every window has an anchor: the leftmost of its k-unit strings with the smallest hash. Equal windows have
equal anchors at equal places, so two documents can only share a window where they share an anchor.
Anchors are about 2 / (L - k + 2) as many as windows.
"""

from __future__ import annotations

import numpy as np

from feira.llm.words import mixed

_STEP = np.uint64(0xD1342543DE82EF95)
_PLACE = np.uint64((1 << 24) - 1)
SEGMENT = 1 << 22
BYTE_KEYS = np.random.default_rng(3).integers(0, 2**63, 256, dtype=np.int64).astype(np.uint64)


def strings(units: np.ndarray, k: int) -> np.ndarray:
    """A key per string of ``k`` consecutive units, by doubling."""
    powers = {1: _STEP}
    by_size = {1: units}
    size = 1
    while 2 * size <= k:
        h, p = by_size[size], powers[size]
        by_size[2 * size] = h[: h.size - size] * p + h[size:]
        powers[2 * size] = p * p
        size *= 2
    out, have = by_size[size], size
    for part in sorted((s for s in by_size if s < size), reverse=True):
        if have + part <= k:
            n = out.size - part
            out = out[:n] * powers[part] + by_size[part][have : have + n]
            have += part
    return out


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The smallest of every ``w`` consecutive values."""
    size = 1
    while 2 * size <= w:
        x = np.minimum(x[: x.size - size], x[size:])
        size *= 2
    if size < w:
        x = np.minimum(x[: x.size - (w - size)], x[w - size :])
    return x


def anchored_runs(units: np.ndarray, sizes: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows with one anchor: (text, first window, windows, anchor key).

    ``units`` holds the keys of several texts, one after the other, ``sizes`` their numbers.
    """
    ends = np.cumsum(sizes)
    starts_at = ends - sizes
    found = []
    with np.errstate(over="ignore"):
        for a in range(0, max(units.size - length + 1, 0), SEGMENT):
            b = min(a + SEGMENT, units.size - length + 1)
            key = mixed(strings(units[a : b + length - 1], k))
            ordered = (key & ~_PLACE) | np.arange(key.size, dtype=np.uint64)
            anchor = (sliding_least(ordered, length - k + 1) & _PLACE).astype(np.int64)
            start = np.arange(a, b)
            owner = np.searchsorted(ends, start, side="right")
            valid = np.flatnonzero(start + length <= ends[owner])
            if not valid.size:
                continue
            place = anchor[valid]
            opens = np.ones(valid.size, dtype=bool)
            opens[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1] + 1)
            first = np.flatnonzero(opens)
            count = np.diff(np.concatenate([first, [valid.size]]))
            text = owner[valid[first]]
            found.append((text, valid[first] + a - starts_at[text], count, key[place[first]]))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(part) for part in zip(*found))


def joined_ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted maximal ranges covered by the given [start, end)."""
    if not start.size:
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    opens = np.ones(start.size, dtype=bool)
    opens[1:] = start[1:] > reach[:-1]
    first = np.flatnonzero(opens)
    return start[first], reach[np.concatenate([first[1:] - 1, [start.size - 1]])]
