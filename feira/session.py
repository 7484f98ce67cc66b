"""Session settings the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Semantics: instants are UTC, a strict CAST fails on bad input.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Scale: let the run-time planner size, merge and split partitions.
SCALE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # the JVM never compiles generated methods above 8000 bytes of bytecode;
    # run those plans operator by operator, which it does compile
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# For joins of facts: the text operators are measured without.
RUNTIME_FILTERS = {
    # rows that cannot meet the kept side of an inner join are left out before they are shuffled; a Bloom filter
    # lets some through and drops none that match. Spark's own thresholds are sizes of files, before any filter
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64GB",
}


def prepare(spark: SparkSession, runtime_filters: bool = False) -> SparkSession:
    """Apply the run-time settings above to an existing session."""
    for key, value in {**SEMANTICS, **SCALE, **(RUNTIME_FILTERS if runtime_filters else {})}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "feira", memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    partitions = str(os.cpu_count() or 8) if cores == "*" else cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        # no Python call-site lookup on every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**SEMANTICS, **SCALE}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
