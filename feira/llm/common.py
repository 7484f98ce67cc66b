"""Small helpers the text operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.plans.workspace import new_folder


def sized_batches(spark: SparkSession) -> SparkSession:
    """Whole texts travel to Python a thousand at a time, so that a worker's memory stays small.

    A finished query's shuffle files go at once: its result is a stored table by then.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark wherever the folder lies."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once below the cluster's shared folder and read back.

    Unlike a cached frame it survives the loss of executors, and unlike a
    checkpoint its readers prune columns.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_for(amount: float | None, each: float) -> int:
    """How many buckets of about ``each`` hold ``amount``; at least 1."""
    return max(1, math.ceil((amount or 0) / each))


def total_of(df: DataFrame, amount: Column) -> int:
    """Sum of ``amount`` over all rows; one number to the driver."""
    return int(df.agg(F.coalesce(F.sum(amount), F.lit(0)).alias("n")).first()["n"])


def version(text: Column) -> Column:
    """Tells apart rows that share an id but not a text."""
    return F.xxhash64(text)
