"""Column profiles that grow by the month: mergeable sketches kept as a table.

``profile_columns`` counts distinct values exactly and rescans a table for it. Here every month folder of a
fact leaves one row per column with its rows, NULLs and a sketch of its distinct values. A new month adds its own rows, and
merging the sketches gives the profile of all months without reading the older ones again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from feira.plans.workspace import shuffles_released

PERIOD = "month_key"
SKETCH = f"table string, column string, rows bigint, null_count bigint, sketch binary, {PERIOD} int"
LG_K = 16  # 2 ** 16 registers: a standard error of 0.4 %, 64 KB at most
CELLS_TOGETHER = 200_000_000  # sketched at a time; each moves about five bytes, as long as sketches are small


def column_sketches(df: DataFrame, table: str, period: str = PERIOD) -> DataFrame:
    """Per period and column of ``df``: rows, NULLs and a sketch of the distinct values."""
    columns = [c for c in df.columns if c != period]
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    return (
        df.select(F.col(period).cast("int").alias(PERIOD), cells.alias("cell"))
        .groupBy(PERIOD, "cell.column")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("cell.value").isNull()).alias("null_count"),
            F.hll_sketch_agg("cell.value", LG_K).alias("sketch"),
        )
        .select(F.lit(table).alias("table"), "column", "rows", "null_count", "sketch", PERIOD)
    )


def kept_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketches below ``path``, none before the first update."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], SKETCH)
    return spark.read.schema(SKETCH).parquet(path)


def new_periods(df: DataFrame, table: str, path: str, period: str = PERIOD) -> DataFrame:
    """Rows of ``df`` in periods that have no sketches yet; a folder column keeps the other folders unopened.

    Periods without a number (rows without a date) are sketched with the first update that meets them.
    """
    known = kept_sketches(df.sparkSession, path).filter(F.col("table") == table).select(PERIOD).distinct()
    have = [r[0] for r in known.collect()]  # one number per month
    if not have:
        return df
    numbered = [p for p in have if p is not None]
    fresh = ~F.col(period).isin(numbered)
    return df.filter(fresh if None in have else fresh | F.col(period).isNull())


def update_sketches(
    df: DataFrame, table: str, path: str, period: str = PERIOD, together: int = CELLS_TOGETHER
) -> None:
    """Add the sketches of the periods of ``df`` that have none; the others are not read.

    Every task makes a sketch per period and column, so a few periods are sketched at a time: what was moved for them goes
    before the next ones are.
    """
    fresh = new_periods(df, table, path, period)
    met = {r[0]: r[1] for r in fresh.groupBy(period).count().collect()}  # one number per month
    groups: list[list[int | None]] = [[]]
    for p in sorted(met, key=lambda p: (p is None, p)):
        if groups[-1] and sum(met[x] for x in [*groups[-1], p]) * len(df.columns) > together:
            groups.append([])
        groups[-1].append(p)
    for group in groups:
        some = fresh
        if len(groups) > 1:
            given = F.col(period).isin([p for p in group if p is not None])
            some = fresh.filter(given | F.col(period).isNull() if None in group else given)
        with shuffles_released(df.sparkSession):
            column_sketches(some, table, period).repartition(1).write.mode("append").parquet(path)


def merged_profile(sketches: DataFrame) -> DataFrame:
    """Per table and column over all periods: rows, NULLs, estimated distinct values."""
    return sketches.groupBy("table", "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_estimate"),
    )
