"""Readers: CSV entities, JSON records, layered tables."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.schemas import ENTITIES, HOLIDAY_RECORD, Entity

BYTE_ORDER_MARK = "﻿"


HEADER_BYTES = 1 << 16
_BAD, _FILE = "__bad", "__file"


def _header(spark: SparkSession, file: str) -> tuple[str, ...] | None:
    """Column names in a file's first line, None for an empty file; only its first bytes are read."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(spark._jvm.java.net.URI(file))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        start = bytes(stream.readNBytes(HEADER_BYTES))
    finally:
        stream.close()
    line = start.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")
    return tuple(next(csv.reader([line]))) if line else None


def csv_headers(spark: SparkSession, path: str | list[str], readers: int = 32) -> dict[tuple[str, ...], list[str]]:
    """Files below ``path`` by their header. A few bytes per file are read, several files at a time."""
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(max_workers=readers) as pool:
        found = list(pool.map(lambda f: _header(spark, f), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, found):
        if header is not None:
            groups.setdefault(header, []).append(file)
    return groups


def _csv_rows(spark: SparkSession, entity: Entity, path: str | list[str]) -> DataFrame:
    """The entity's columns of all files, with the file's name and the whole record where it does not fit the header.

    Spark takes one header for all files of a reader, so files are read in groups of equal headers.
    """
    parts = []
    for header, files in csv_headers(spark, path).items():
        missing = [c for c in entity.columns if c not in header]
        if missing:
            raise ValueError(f"{entity.name}: columns missing in {files[0]}: {missing}")
        # a name may repeat among columns that nobody reads
        names = [n if n in entity.columns else f"__{i}" for i, n in enumerate(header)]
        if len(set(names)) < len(names):
            raise ValueError(f"{entity.name}: a column repeats in {files[0]}: {list(header)}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BAD]])
        raw = (
            spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", entity.multi_line)
            .option("quote", '"')
            .option("escape", '"')
            .option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _BAD)
            # a record's length is judged whatever columns a query reads
            .option("columnPruning", False)
            .csv(files)
        )
        parts.append(raw.select(*entity.columns, _BAD, F.col("_metadata.file_path").alias(_FILE)))
    if not parts:
        raise ValueError(f"{entity.name}: no file with a header in {path}")
    return reduce(DataFrame.unionByName, parts)


def read_csv_entity(spark: SparkSession, entity: Entity, path: str | list[str]) -> DataFrame:
    """One raw entity from CSV files with a header each, as text columns in declared order.

    Columns are matched by the header of their own file, after a byte-order mark is dropped; files may differ in the order and
    number of columns. Records with fewer or more values than their header are left out here and
    listed by ``csv_quarantine``. Only entities with line breaks inside values give up split reading.
    """
    # Spark refuses a scan of the bad-record column alone; the second test is always true and keeps a column beside it
    fits = F.col(_BAD).isNull() & (F.length(F.concat_ws("", F.col(entity.columns[0]))) >= 0)
    return _csv_rows(spark, entity, path).filter(fits).select(*entity.columns)


def csv_quarantine(spark: SparkSession, entity: Entity, path: str | list[str]) -> DataFrame:
    """Records that do not fit their file's header: entity, file, record as it stands in the file."""
    some = F.length(F.concat_ws("", F.col(entity.columns[0]))) >= 0
    bad = _csv_rows(spark, entity, path).filter(F.col(_BAD).isNotNull() & some)
    return bad.select(F.lit(entity.name).alias("entity"), F.col(_FILE).alias("file"), F.col(_BAD).alias("record"))


def read_csv_folder(spark: SparkSession, root: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All raw entities below ``root``; ``files`` overrides the default ``<entity>.csv``."""
    files = files or {}
    return {
        name: read_csv_entity(spark, entity, f"{root}/{files.get(name, name + '.csv')}")
        for name, entity in ENTITIES.items()
    }


def read_json_records(spark: SparkSession, path: str, schema: T.StructType = HOLIDAY_RECORD) -> DataFrame:
    """Files that each hold one JSON array of records."""
    return json_records(_documents(spark, path), F.col("value"), schema)


def json_drift_of_files(spark: SparkSession, path: str, schema: T.StructType = HOLIDAY_RECORD) -> DataFrame:
    """``json_drift`` of files, with the file's name."""
    named = _documents(spark, path).withColumn("file", F.col("_metadata.file_path"))
    return json_drift(named, F.col("value"), schema, keep=["file"])


def _documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", True).text(path)


def _records(df: DataFrame, document: Column, keep: list[str]) -> DataFrame:
    """A row per array element, (position, record); one without them for a document that is no JSON array, or an empty one."""
    elements = F.try_variant_get(F.try_parse_json(document), "$", "array<variant>")
    return df.select(
        *keep,
        document.alias("document"),
        elements.isNull().alias("unreadable"),
        F.posexplode_outer(elements).alias("position", "record"),
    )


def json_records(df: DataFrame, document: Column, schema: T.StructType = HOLIDAY_RECORD) -> DataFrame:
    """The records of a column of JSON arrays, one row each, with the fields of ``schema``.

    Fields are taken one by one: a record with further fields, without some, or with a value of another kind keeps
    what fits, and every other field. Elements that are no objects have no fields.
    """
    found = _records(df, document, []).filter(F.col("record").isNotNull())
    return found.select(*[
        F.try_variant_get("record", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields
    ])


def json_drift(
    df: DataFrame, document: Column, schema: T.StructType = HOLIDAY_RECORD, keep: list[str] | None = None
) -> DataFrame:
    """Records that differ from ``schema``: position, extra and missing fields, fields of another kind, the record as JSON.

    Documents that are no JSON array are one row without a position. ``keep`` names columns to carry along.
    """
    keep = keep or []
    names = F.array(*[F.lit(n) for n in schema.fieldNames()])
    fields = F.try_variant_get("record", "$", "map<string,variant>")
    present = F.coalesce(F.map_keys(fields), F.array().cast("array<string>"))
    unlike = F.array_compact(F.array(*[
        F.when(
            F.try_variant_get("record", f"$.{f.name}", "variant").isNotNull()
            & F.try_variant_get("record", f"$.{f.name}", f.dataType.simpleString()).isNull()
            & ~F.is_variant_null(F.try_variant_get("record", f"$.{f.name}", "variant")),
            f.name,
        )
        for f in schema.fields
    ]))
    told = _records(df, document, keep).select(
        *keep,
        "unreadable",
        "position",
        F.array_sort(F.array_except(present, names)).alias("extra"),
        F.when(F.col("position").isNotNull(), F.array_except(names, present)).alias("missing"),
        unlike.alias("unlike"),
        F.coalesce(F.to_json("record"), "document").alias("record"),
    )
    differs = (F.size("extra") > 0) | (F.size("missing") > 0) | (F.size("unlike") > 0)
    return told.filter(F.col("unreadable") | (F.col("position").isNotNull() & differs)).drop("unreadable")


def resolve_dataset(layer: str, env: str = "dev") -> str:
    """Folder (or database) name of a layer; production carries no suffix."""
    if layer not in ("raw", "staging", "mart"):
        raise ValueError(f"unknown layer {layer!r}")
    return layer if env == "prod" else f"{layer}_{env}"


def table_path(root: str, layer: str, name: str, env: str = "dev") -> str:
    return f"{root.rstrip('/')}/{resolve_dataset(layer, env)}/{name}"


def read_table(spark: SparkSession, root: str, layer: str, name: str, env: str = "dev") -> DataFrame:
    return spark.read.parquet(table_path(root, layer, name, env))
