"""Writers: raw load, marts, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.sources.versions import (
    Draft, Publication, bucketed_name, current, layer_folder, read_version, write_bucketed,
)

# fact -> the YYYYMMDD key its folders are split by
PARTITION_KEYS = {
    "fact_orders": "order_date_key",
    "fact_order_items": "order_date_key",
    "fact_payments": "order_date_key",
    "fact_reviews": "review_date_key",
}


def load_raw(entities: dict[str, DataFrame], root: str, env: str = "dev") -> Publication:
    """One raw table per entity, published together: a load that fails leaves the earlier one in force."""
    draft = Draft(next(iter(entities.values())).sparkSession, layer_folder(root, "raw", env))
    for name, df in entities.items():
        df.write.parquet(draft.folder(name))
        draft.add(name)
    return draft.commit()


def read_raw(spark: SparkSession, root: str, env: str = "dev") -> dict[str, DataFrame]:
    """The raw tables of the load in force."""
    publication = current(spark, layer_folder(root, "raw", env))
    return {name: spark.read.parquet(path) for name, path in publication.tables.items()} if publication else {}


BUCKET_KEY, MONTH = "order_key", "month_key"
ROWS_PER_BUCKET = 400_000  # orders; a bucket is sorted by one task, with their items in its memory
# buckets moved and written at a time, so that shuffle files of more do not lie on disk at once; each time the inputs are
# read again. Items move most, and when the other facts are there already
BUCKETS_TOGETHER, ITEM_BUCKETS_TOGETHER = 128, 32


def in_turn(buckets: int, together: int) -> Column:
    """The turn in which a row's bucket is written; one value, since its hash is taken of every row read."""
    return F.call_function("div", F.pmod(F.hash(BUCKET_KEY), F.lit(buckets)), F.lit(together))


def mart_folder(root: str, env: str = "dev") -> str:
    return layer_folder(root, "mart", env)


def write_mart(
    draft: Draft, name: str, df: DataFrame, buckets: int, laid_out: bool = False, together: int | None = None
) -> None:
    """One mart table of a publication; ``laid_out`` tells that a fact's rows lie by bucket already.

    Facts lie in month folders, so that a report window prunes its scan, and in them in buckets of the order key, the same for
    all facts, so that facts meet by order without a shuffle. All rows of one order are in one bucket: where an
    order may hold very many rows, read with ``spark.sql.sources.bucketing.enabled=false`` and let run-time
    skew handling split the join. ``together`` buckets are computed and written at a time: what is moved for them is read by
    the filter of their keys and can go before the next ones are.
    """
    key = PARTITION_KEYS.get(name)
    path = draft.folder(name)
    if key is None:
        df.hint("rebalance").write.parquet(path)
        draft.add(name)
    else:
        monthly = df.withColumn(MONTH, F.floor(F.col(key) / 100).cast("int"))
        if not laid_out:
            monthly = monthly.repartition(buckets, BUCKET_KEY)
        together = together or (ITEM_BUCKETS_TOGETHER if name == "fact_order_items" else BUCKETS_TOGETHER)
        for turn in range(-(-buckets // together)):
            some = monthly.filter(in_turn(buckets, together) == turn) if together < buckets else monthly
            write_bucketed(some, bucketed_name(name, path), path, buckets, BUCKET_KEY, MONTH)
        draft.add(name, buckets)


def read_published(spark: SparkSession, publication: Publication, name: str, with_month: bool = False) -> DataFrame:
    """A mart table; ``with_month`` keeps the folder column that reports prune by."""
    df = read_version(spark, publication, name, BUCKET_KEY, MONTH)
    return df if with_month else df.drop(MONTH)


def read_mart(
    spark: SparkSession, name: str, root: str, env: str = "dev", with_month: bool = False
) -> DataFrame:
    """A mart table of the publication in force."""
    publication = current(spark, mart_folder(root, env))
    if publication is None or name not in publication.tables:
        raise ValueError(f"{name} has not been published below {mart_folder(root, env)}")
    return read_published(spark, publication, name, with_month)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled and blanks kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report(name: str, df: DataFrame, root: str) -> str:
    """One report as CSV with a header."""
    path = f"{root.rstrip('/')}/{name}"
    write_csv(df, path)
    return path


def read_report(spark: SparkSession, name: str, root: str) -> DataFrame:
    """A written report, read with the writer's quoting."""
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .csv(f"{root.rstrip('/')}/{name}")
    )


def published_columns(df: DataFrame, read_back: DataFrame) -> bool:
    """Whether the written report kept the columns and their order."""
    return df.columns == read_back.columns


def as_text(df: DataFrame) -> DataFrame:
    """Every column as the text that CSV holds of it; an empty text is no value there."""
    return df.select(*[F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
