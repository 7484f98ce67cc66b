"""Order MinHash fingerprints: likeness of texts that falls with their edit distance.

The units of a text are its k-mers of code points, each numbered by how often it has occurred before, so
that all units of a text differ. Every one of the fingerprint's hash functions selects the few units with the smallest
values; the selected units, put back into text order and hashed as a tuple, are one entry. Two texts
share an entry when the selection is the same *and* stands in the same order, so moved passages count as
changes, unlike in MinHash. Likeness is the share of equal entries.

A text of fewer than k code points is one unit, an empty or NULL text has none; texts with fewer units than an entry takes
use those they have. Equal texts have equal fingerprints, also two empty ones. A task's memory grows with its longest
text only (about a hundred bytes a code point).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.common import stored

BLOCK = 4096  # units hashed at a time; bounds the table of values to entries x BLOCK
MOST = np.iinfo(np.uint32).max


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class OrderMinHash:
    """``entries`` hash functions that each select ``chosen`` k-mers of ``k`` code points."""

    k: int = 8
    chosen: int = 2
    entries: int = 64
    seed: int = 1

    @cached_property
    def factors(self) -> np.ndarray:
        """One odd factor per hash function; units are mixed already, so a product modulo 2 ** 32 orders them anew."""
        numbers = np.arange(1, self.entries + 1, dtype=np.uint64) + np.uint64(self.seed << 32)
        return (_mixed(numbers * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    def units(self, points: np.ndarray) -> np.ndarray:
        """The text's numbered k-mers in text order, as distinct 64-bit values."""
        n = len(points)
        if n == 0:
            return np.empty(0, np.uint64)
        k, spread = min(self.k, n), _mixed(points.astype(np.uint64) + np.uint64(1))
        grams = spread[: n - k + 1]
        for j in range(1, k):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + spread[j : n - k + 1 + j]
        order = np.argsort(grams, kind="stable")
        same = grams[order]
        new = np.flatnonzero(np.concatenate(([True], same[1:] != same[:-1])))
        number = np.empty(len(grams), np.uint64)
        number[order] = np.arange(len(grams)) - np.repeat(new, np.diff(np.append(new, len(grams))))
        return _mixed(grams + number * np.uint64(0xD1B54A32D192ED03))

    def of(self, text: str) -> np.ndarray:
        """The fingerprint: ``entries`` unsigned 32-bit integers."""
        units = self.units(np.frombuffer(text.encode("utf-32-le"), "<u4"))
        short = (units >> np.uint64(32)).astype(np.uint32)
        factors, rows = self.factors[:, None], np.arange(self.entries)
        values, places = [], []
        for at in range(0, len(units), BLOCK):
            table = short[at : at + BLOCK] * factors
            for _ in range(min(self.chosen, table.shape[1])):
                least = table.argmin(axis=1)
                values.append(table[rows, least])
                places.append(least + at)
                table[rows, least] = MOST
        places = np.array(places, np.int64).reshape(-1, self.entries)
        if len(places) > self.chosen:
            best = np.argsort(np.array(values), axis=0, kind="stable")[: self.chosen]
            places = np.take_along_axis(places, best, axis=0)
        places.sort(axis=0)  # text order
        entry = np.full(self.entries, len(places), np.uint64)
        for nth in places:
            entry = _mixed(entry * np.uint64(0xD6E8FEB86659FD93) + units[nth])
        return (entry >> np.uint64(32)).astype("<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_RESULT_ARROW = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]


def _compared(method: OrderMinHash, text: str, own: np.ndarray, following: str, others: np.ndarray) -> dict:
    changed = edited(text, following)
    theirs = method.of(changed)
    return {
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
        "fingerprint": own.tobytes(),
        "edited_fingerprint": theirs.tobytes(),
        "near_edited": likeness(own, theirs),
        "near_next": likeness(own, others),
    }


def _along(method: OrderMinHash):
    """Rows of a sorted range compared with the row after each; the first and the last row are also handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in batches:
            schema = pa.schema([
                ("kind", pa.string()), ("part", pa.int32()), ("doc_id", batch.schema.field("doc_id").type),
                ("text", pa.string()), *_RESULT_ARROW,
            ])
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = method.of(text)
                if before is None:
                    out.append({"kind": "first", "part": part, "doc_id": doc, "text": text})
                else:
                    out.append({"kind": "done", "part": part, "doc_id": before[0]})
                    out[-1].update(_compared(method, *before[1:], text, own))
                before = doc, text, own
            yield pa.RecordBatch.from_pylist(out, schema)
        if before is not None:
            last = {"kind": "last", "part": part, "doc_id": before[0], "text": before[1]}
            yield pa.RecordBatch.from_pylist([last], schema)

    return run


def _across(method: OrderMinHash):
    """Last rows of ranges compared with the first row of the range after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), *_RESULT_ARROW])
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "next_text")))
            out = [
                {"doc_id": doc, **_compared(method, text, method.of(text), following, method.of(following))}
                for doc, text, following in rows
            ]
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def fingerprints_with_next(docs: DataFrame, method: OrderMinHash = OrderMinHash()) -> DataFrame:
    """Per document its fingerprint, compared with its edited text's and with the next document's.

    ``docs``: doc_id, text; other columns are ignored. The order is descending doc_id, NULL last, repeated ids by the hash of
    their text; after the last document comes the first, which may be itself. Every row has a
    result, repeated rows one each. Returns doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint (binary,
    little-endian unsigned 32-bit entries), near_edited, near_next.

    Texts are shuffled once, into ranges of the order; only the two rows at the ends of a range are met again.
    """
    given = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = given.withColumns({"__hash": F.xxhash64("text"), "__id": F.monotonically_increasing_id()})
    order = [F.col("doc_id").desc_nulls_last(), F.col("__hash"), F.col("__id")]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    id_type = given.schema["doc_id"].dataType.simpleString()
    met = stored(
        ranged.mapInArrow(_along(method), f"kind string, part int, doc_id {id_type}, text string, {_RESULT}"), "fingerprints"
    )
    done = met.filter("kind = 'done'").drop("kind", "part", "text")
    firsts = met.filter("kind = 'first'").select("part", F.col("text").alias("next_text"))
    # one row per range: its number and the number of the range after it
    ring = firsts.select("part").withColumn("after", F.lead("part").over(Window.orderBy("part")))
    ring = ring.withColumn("after", F.coalesce("after", F.min("part").over(Window.partitionBy(F.lit(1)))))
    lasts = met.filter("kind = 'last'").select("part", "doc_id", "text").join(ring, "part").drop("part")
    ends = lasts.join(firsts, F.col("after") == F.col("part")).select("doc_id", "text", "next_text")
    return done.unionByName(ends.mapInArrow(_across(method), f"doc_id {id_type}, {_RESULT}"))
