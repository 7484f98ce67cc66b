"""The shared folder for checkpoints and hand-over tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Keep = Callable[[DataFrame, str], DataFrame]


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only on a local master."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get(SETTING, None) or sc.getConf().get(SETTING)
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="feira-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/feira/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once into the shared folder and read back; unlike a checkpoint's, its readers prune columns."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Keep]:
    """``stored`` for frames that nobody reads after the block; their folders are removed at its end."""
    kept: list[str] = []

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        kept.append(new_folder(spark, purpose))
        df.write.option("compression", "zstd").parquet(kept[-1])
        return spark.read.schema(df.schema).parquet(kept[-1])

    try:
        yield keep
    finally:
        for folder in kept:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action in the block go when it ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before) if before is not None else spark.conf.unset(RELEASE)


def pinned(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
