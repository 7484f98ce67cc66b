"""Repeated keys of a table: all tested keys in one pass over it, exact at last.

Grouping by the keys themselves would scan the table once per key and shuffle every key. Here one pass groups the 64-bit
hashes of all keys together. Keys whose hash is met once occur once; only rows of the other hashes are read again
and grouped by their values, so two keys of one hash are told apart. Hashes too many to be broadcast are not joined: that would
move every row, and so does grouping the values at once. Hot keys are counted on the map side in both steps.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feira.plans.sizing import BROADCAST_ROWS
from feira.plans.workspace import stored


@dataclass(frozen=True)
class Key:
    """Columns that should identify a row. ``nulls`` says which rows count: ``all`` of them, those with ``some`` value, or
    only rows whose columns are all given (``none`` NULL)."""

    columns: tuple[str, ...]
    nulls: str = "all"

    @property
    def counts(self) -> Column:
        given = [F.col(c).isNotNull() for c in self.columns]
        if self.nulls == "all":
            return F.lit(True)
        return reduce((lambda a, b: a & b) if self.nulls == "none" else (lambda a, b: a | b), given)


@dataclass(frozen=True)
class Repeated:
    """``rows`` that count, ``values`` met more than once, and the ``members`` that hold such a value."""

    rows: int
    values: int
    members: int


def compact(key: Column) -> Column:
    """Equal for equal keys only: a hash in hexadecimal digits as its 16 bytes, any other text in fewer or more than 16."""
    text = key.cast("string")
    digest = F.unhex(text)
    other = text.cast("binary")
    return F.when((F.length(text) == 32) & (F.lower(F.hex(digest)) == text), digest).otherwise(
        F.when(F.octet_length(text) < 16, other).otherwise(F.concat(F.lit(b"\x00"), other))
    )


def _suspects(df: DataFrame, keys: list[Key]) -> tuple[DataFrame, list[int], list[int]]:
    """Hashes met more than once, and per key the rows that count and the number of such hashes; one pass over ``df``."""
    hashes = [
        F.when(k.counts, F.struct(F.lit(i).alias("key"), F.xxhash64(*k.columns).alias("hash"))) for i, k in enumerate(keys)
    ]
    each = df.select(F.explode(F.filter(F.array(*hashes), lambda h: h.isNotNull())).alias("h")).select("h.*")
    met = each.groupBy("key", "hash").agg(F.count("*").alias("n"))
    watched = Observation()
    measures = []
    for i in range(len(keys)):
        own = F.col("key") == i
        measures.append(F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias(f"rows{i}"))
        measures.append(F.count_if(own & (F.col("n") > 1)).alias(f"met{i}"))
    again = stored(met.observe(watched, *measures).filter("n > 1").select("key", "hash"), "suspects")
    seen = watched.get
    return again, [seen[f"rows{i}"] for i in range(len(keys))], [seen[f"met{i}"] for i in range(len(keys))]


def repeated_keys(df: DataFrame, keys: list[Key]) -> list[Repeated]:
    """What repeats of each key of ``df``."""
    again, rows, met = _suspects(df, keys)
    out = []
    for i, key in enumerate(keys):
        if not met[i]:
            out.append(Repeated(rows[i], 0, 0))
            continue
        texts = {c for c, kind in df.select(*key.columns).dtypes if kind == "string"}
        values = [(compact(F.col(c)) if c in texts else F.col(c)).alias(c) for c in key.columns]
        some = df.filter(key.counts).select(F.xxhash64(*key.columns).alias("__hash"), *values)
        if met[i] <= BROADCAST_ROWS:
            mine = again.filter(F.col("key") == i).select(F.col("hash").alias("__hash"))
            some = some.join(F.broadcast(mine), "__hash", "left_semi")
        groups = some.groupBy(*key.columns).agg(F.count("*").alias("__n"))
        found = groups.filter("__n > 1").agg(F.count("*").alias("v"), F.coalesce(F.sum("__n"), F.lit(0)).alias("m")).first()
        out.append(Repeated(rows[i], found["v"], found["m"]))
    return out


def repeated_in(tables: dict[str, tuple[DataFrame, list[Key]]], together: int = 4) -> dict[str, list[Repeated]]:
    """``repeated_keys`` of several tables, a few at a time."""
    with ThreadPoolExecutor(max_workers=together) as pool:
        return dict(zip(tables, pool.map(lambda t: repeated_keys(*t), tables.values())))
