"""Joins of which one key may hold a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.columns import surrogate_key
from feira.plans.sizing import BROADCAST_ROWS
from feira.plans.workspace import stored


def _beside(small: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """``small`` with its keys renamed, and the NULL-safe equality of both sides' keys."""
    renamed = small.withColumnsRenamed({k: f"__{k}" for k in keys})
    return renamed, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


def lookup(df: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Left join ``small`` (one row per key) to ``df``, NULL keys matching NULL keys.

    Also the join to use when ``small`` was grouped by the same keys and ``df``
    has hot ones: NULL-safe keys hash unlike the grouping did, so both sides get
    their own exchange, and only then can a hot partition be split at run time.
    """
    right, test = _beside(small, keys)
    return df.join(right, test, "left").drop(*[f"__{k}" for k in keys])


def with_hashed_key(
    df: DataFrame, rows: DataFrame, dim: DataFrame, column: str, key: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join of ``dim``'s ``key``, the hash of ``column``, without moving the rows of ``df``.

    ``rows`` holds the values of ``column`` in ``df`` before any join, so they are found cheaply. Values that ``dim`` holds exactly
    once need no lookup. The others, of which sound data has few, are broadcast with as many rows as ``dim`` has of them;
    where they are too many, ``dim`` itself is joined.
    """
    have = rows.filter(F.col(column).isNotNull()).select(column).distinct()
    of = dim.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
    n = F.coalesce("__n", F.lit(0))
    odd = stored(have.join(of, column, "left").select(column, n.alias("__n")).filter("__n != 1"), "odd-keys")
    rows_out = F.coalesce(F.sum(F.greatest("__n", F.lit(1))), F.lit(0)).alias("rows")
    size = odd.agg(rows_out, F.count("*").alias("values")).first()
    if not size["values"]:
        return df.withColumn(key, surrogate_key(column))
    if size["rows"] > max_rows:
        return df.join(dim.select(column, key), column, "left")
    copies = F.explode_outer(F.array_repeat(F.lit(True), F.col("__n").cast("int")))
    expanded = odd.select(F.col(column).alias("__odd"), copies.alias("__held"))
    met = df.join(F.broadcast(expanded), F.col(column) == F.col("__odd"), "left")
    return met.withColumn(key, F.when(F.col("__odd").isNull() | F.col("__held"), surrogate_key(column))).drop("__odd", "__held")
