"""Fingerprint of a table's values, whatever the order of its rows and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.columns import TOTAL
from feira.operators.model_tests import stacked

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
HEX_DIGITS = 15  # of a row's MD5; 60 bits fit a bigint


def canonical(name: str, kind: str) -> Column:
    """One text per value: numbers with nine decimals, NULL as ``~``."""
    column = F.col(f"`{name}`")
    if kind.startswith(_NUMBERS):
        column = column.cast(TOTAL)
    return F.coalesce(column.cast("string"), F.lit("~"))


def row_hash(df: DataFrame) -> Column:
    """Hash of a row over its columns in the order of their names."""
    row = F.concat_ws("|", *[canonical(name, kind) for name, kind in sorted(df.dtypes)])
    return F.conv(F.substring(F.md5(row), 1, HEX_DIGITS), 16, 10).cast("bigint")


def table_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, and the sum and exclusive or of the row hashes; one map-side aggregate."""
    return (
        df.select(row_hash(df).alias("h"))
        .agg(
            F.count("*").alias("rows"),
            F.coalesce(F.sum(F.col("h").cast("decimal(28,0)")), F.lit(0)).cast("string").alias("hash_sum"),
            F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
        )
        .select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"), "hash_sum", "hash_xor")
    )


def fingerprints(frames: dict[str, DataFrame]) -> DataFrame:
    return stacked([table_fingerprint(df, name) for name, df in frames.items()])
