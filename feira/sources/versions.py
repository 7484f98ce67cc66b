"""Versioned tables: a publication is seen whole or not at all.

Every publication writes into a folder of its own. A log holds one row per publication with the folder of each
table; readers go by its newest row. Appending that row is one file moved into place, so a publication that fails
before leaves the earlier one in force, and one that is being read stays where it is.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from feira.sources.files import resolve_dataset

# hashed keys are half their size in it: hexadecimal digits, which snappy leaves as they are
COMPRESSION = "zstd"

LOG = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("version", T.StringType()),
    T.StructField("tables", T.MapType(T.StringType(), T.StringType())),
    T.StructField("buckets", T.MapType(T.StringType(), T.IntegerType())),
])


@dataclass(frozen=True)
class Publication:
    """One state of a layer: table -> folder, and table -> buckets where it is bucketed."""

    number: int
    version: str
    tables: dict[str, str]
    buckets: dict[str, int]


def layer_folder(root: str, layer: str, env: str) -> str:
    return f"{root.rstrip('/')}/{resolve_dataset(layer, env)}"


def _log(base: str) -> str:
    return f"{base}/_publications"


def publications(spark: SparkSession, base: str) -> DataFrame | None:
    """The log, or None before the first publication."""
    try:
        spark.read.parquet(_log(base))
    except AnalysisException:
        return None
    return spark.read.schema(LOG).parquet(_log(base))


def current(spark: SparkSession, base: str) -> Publication | None:
    """The publication in force."""
    log = publications(spark, base)
    rows = [] if log is None else log.orderBy(F.desc("number"), F.desc("version")).limit(1).collect()
    return Publication(rows[0]["number"], rows[0]["version"], dict(rows[0]["tables"]), dict(rows[0]["buckets"])) if rows else None


class Draft:
    """A publication being written; ``commit`` makes it the one in force."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self.version = uuid.uuid4().hex
        self.tables: dict[str, str] = {}
        self.buckets: dict[str, int] = {}

    def folder(self, name: str) -> str:
        return f"{self.base}/{self.version}/{name}"

    def add(self, name: str, buckets: int | None = None) -> None:
        """Record a table written to its ``folder``."""
        self.tables[name] = self.folder(name)
        if buckets:
            self.buckets[name] = buckets

    def commit(self) -> Publication:
        """Put the draft in force; tables it does not hold stay as they were."""
        before = current(self.spark, self.base)
        old = (before.tables, before.buckets) if before else ({}, {})
        kept = {n: b for n, b in old[1].items() if n not in self.tables}
        done = Publication(before.number + 1 if before else 1, self.version, old[0] | self.tables, kept | self.buckets)
        row = [(done.number, done.version, done.tables, done.buckets)]
        self.spark.createDataFrame(row, LOG).coalesce(1).write.mode("append").parquet(_log(self.base))
        return done


def read_version(spark: SparkSession, publication: Publication, name: str, bucket_key: str, partition_key: str) -> DataFrame:
    """A table of a publication; a bucketed one with its layout known to the planner.

    Files do not say how they are bucketed, the catalog does. The session's catalog gets one external table per bucketed
    table and version.
    """
    path = publication.tables[name]
    if name not in publication.buckets:
        return spark.read.parquet(path)
    table = bucketed_name(name, path)
    if not spark.catalog.tableExists(table):
        register_bucketed(spark, table, path, publication.buckets[name], bucket_key, partition_key)
    return spark.table(table)


def bucketed_name(name: str, path: str) -> str:
    """Catalog name of the table in ``<base>/<version>/<name>``."""
    return f"feira_{name}_{path.rstrip('/').split('/')[-2]}"


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str, partition_key: str) -> None:
    """Folders by ``partition_key``, in them one sorted file per bucket of ``key``; registered as ``table``.

    ``df`` is to be partitioned by the buckets' hash of ``key``, so that each task writes the files of one bucket. Rows of other
    buckets may be added to the table by another call.
    """
    (
        df.write.format("parquet")
        .mode("append")
        .partitionBy(partition_key)
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .option("compression", COMPRESSION)
        .saveAsTable(table)
    )


def register_bucketed(spark: SparkSession, table: str, path: str, buckets: int, key: str, partition_key: str) -> None:
    columns = spark.read.parquet(path).schema.toDDL()
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({partition_key}) "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {table}")
