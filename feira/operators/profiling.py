"""Profiles of tables: sizes, missing values, duplicates, keys, distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.operators.model_tests import stacked
from feira.plans.duplicates import Key, compact, repeated_in
from feira.plans.ranking import order_statistics
from feira.plans.workspace import shuffles_released

# of (column, value) rows moved at a time, as far as their sizes can be told before. In shuffle files a number or moment takes
# about 12 bytes, a text 5 more than it has, and a hash in hexadecimal digits 21
CELL_BYTES_TOGETHER = 1_600_000_000
PLAIN_BYTES, DIGEST_BYTES = 12, 21
# a task that combines equal cells reads this many rows at least
ROWS_PER_TASK = 25_000


def profile_tables(frames: dict[str, DataFrame]) -> DataFrame:
    return stacked([
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in frames.items()
    ])


def profile_columns(
    frames: dict[str, DataFrame],
    expected: dict[tuple[str, str], tuple[int, int]] | None = None,
    together: int = CELL_BYTES_TOGETHER,
) -> DataFrame:
    """Type, missing share and exact number of distinct values per column.

    Each cell becomes a (column, value) row and equal cells are counted on the
    map side, so one grouping serves all columns and no value is a hot task.

    That moves every column at once. Where the rows of a (table, column) and about how many distinct values it has are
    ``expected``, a table of more than ``together`` bytes to move is counted in turns, and what was moved for one turn goes
    before the next. The counts are exact in either case, the sizes need not be.
    """
    return stacked([_in_turns(name, df, expected or {}, together) for name, df in frames.items()])


def _in_turns(name: str, df: DataFrame, expected: dict[tuple[str, str], tuple[int, int]], together: int) -> DataFrame:
    cells = {}
    for c in df.columns:
        rows, values = expected.get((name, c), (0, 0))
        # equal cells of a task are one
        cells[c] = min(rows, values * -(-rows // ROWS_PER_TASK))
    if sum(cells.values()) * DIGEST_BYTES <= together:
        return _profile(name, df)
    lengths = {c: F.octet_length(F.col(c)) for c, t in df.dtypes if t == "string"}
    nulls = df.agg(
        F.count("*").alias("__n"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
        *[F.struct(F.min(n), F.max(n), F.avg(n)).alias(f"__length {c}") for c, n in lengths.items()],
    ).first()
    for c in df.columns:
        least, most, mean = nulls[f"__length {c}"] if c in lengths else (None, None, None)
        each = DIGEST_BYTES if least == most == 32 else PLAIN_BYTES if mean is None else 5 + mean
        cells[c] = int(cells[c] * each)
    unique: dict[str, int] = {}
    some: list[str] = []
    for c in sorted(df.columns, key=cells.get):
        if some and sum(cells[x] for x in [*some, c]) > together:
            unique |= _distinct(df, some)
            some = []
        if cells[c] > together:
            parts = -(-cells[c] // together)
            unique[c] = sum(_distinct(df, [c], parts, part)[c] for part in range(parts))
        else:
            some.append(c)
    if some:
        unique |= _distinct(df, some)
    total = nulls["__n"]
    rows = [(name, c, t, nulls[c], nulls[c] * 100 / total, unique[c]) for c, t in df.dtypes] if total else []
    return df.sparkSession.createDataFrame(
        rows, "table string, column string, dtype string, null_count bigint, null_pct double, unique_count bigint"
    )


def _distinct(df: DataFrame, columns: list[str], parts: int = 1, part: int = 0) -> dict[str, int]:
    """Distinct values per column; with ``parts``, those whose hash falls into ``part``, which holds all equal ones."""
    with shuffles_released(df.sparkSession):
        texts = [F.col(c).cast("string") for c in columns]
        if len(columns) == 1:
            cells = df.select(F.lit(0).alias("at"), texts[0].alias("value"))
        else:
            each = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), t.alias("value")) for i, t in enumerate(texts)]))
            cells = df.select(each.alias("cell")).select("cell.*")
        if parts > 1:
            cells = cells.filter(F.pmod(F.xxhash64("value"), F.lit(parts)) == part)
        values = cells.filter(F.col("value").isNotNull()).select("at", compact(F.col("value")).alias("value")).distinct()
        found = {r["at"]: r["n"] for r in values.groupBy("at").agg(F.count("*").alias("n")).collect()}
    return {c: found.get(i, 0) for i, c in enumerate(columns)}


def _profile(name: str, df: DataFrame) -> DataFrame:
    """A column travels as its number; its name and type are added to the one row it has in the end."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(df.columns)])
    )
    values = df.select(cells.alias("cell")).select("cell.*").groupBy("at", "value").count()
    nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0))
    labels = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype")) for c, t in df.dtypes])
    return values.groupBy("at").agg(
        nulls.alias("null_count"),
        (nulls.cast("double") * 100 / F.sum("count").cast("double")).alias("null_pct"),
        F.count("value").alias("unique_count"),
    ).withColumn("label", F.get(labels, F.col("at"))).select(
        F.lit(name).alias("table"), "label.column", "label.dtype", "null_count", "null_pct", "unique_count"
    )


def profile_missing(frames: dict[str, DataFrame]) -> DataFrame:
    """Only columns with missing values, the worst first."""
    parts = []
    for name, df in frames.items():
        nulls = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        rows = F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in df.columns])
        )
        parts.append(
            nulls.select("__n", rows.alias("r")).select(
                F.lit(name).alias("table"),
                "r.column",
                "r.null_count",
                F.round(F.try_divide(F.col("r.null_count").cast("decimal(22,0)") * 100, F.col("__n")), 2)
                .cast("decimal(22,2)")
                .alias("null_pct"),
            )
        )
    return stacked(parts).filter(F.col("null_count") > 0).orderBy(F.desc("null_pct"), "table", "column")


def profile_duplicates(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows that repeat an earlier row in every column; whole rows are met again only where their hashes repeat."""
    found = repeated_in({name: (df, [Key(tuple(df.columns))]) for name, df in frames.items()})
    rows = [(name, r[0].rows, r[0].members - r[0].values) for name, r in found.items()]
    spark = next(iter(frames.values())).sparkSession
    counted = spark.createDataFrame(rows, "table string, rows bigint, duplicate_rows bigint")
    share = F.try_divide(F.col("duplicate_rows").cast("decimal(22,0)") * 100, F.col("rows"))
    return counted.select("table", "duplicate_rows", F.round(share, 2).cast("decimal(22,2)").alias("duplicate_pct"))


def profile_keys(frames: dict[str, DataFrame], keys: dict[str, tuple[str, ...]]) -> DataFrame:
    """Rows beyond the first per candidate key, and whether the key is unique; NULL is a value like others."""
    found = repeated_in({name: (frames[name], [Key(columns)]) for name, columns in keys.items()})
    rows = []
    for name, columns in keys.items():
        extra = found[name][0].members - found[name][0].values
        rows.append((name, ", ".join(columns), extra == 0, extra))
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(rows, "table string, key string, is_unique boolean, duplicate_count bigint")


PERCENTILES = (50, 75, 90, 95)


def profile_distribution(rfm: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and linearly interpolated percentiles of R, F and M."""
    metrics = {m: F.col(m) for m in ("recency", "frequency", "monetary")}

    def positions(total: int) -> list[int]:
        below = [(total - 1) * p // 100 for p in PERCENTILES]
        return [k for b in below for k in (b, min(b + 1, total - 1))]

    # missing values are no part of a metric's distribution
    ranked = order_statistics(rfm, metrics, positions, known_only=True)

    def percentile(metric: str, p: int):
        total, found = ranked[0][metric], ranked[1][metric]
        if total == 0:
            return F.lit(None).cast("double")
        below, part = divmod((total - 1) * p, 100)
        low, high = float(found[below]), float(found[min(below + 1, total - 1)])
        return F.lit(low + (high - low) * (part / 100))

    rows = []
    for metric in metrics:
        value = F.col(metric).cast("double")
        rows.append(
            rfm.agg(
                F.count(metric).alias("count"),
                F.try_divide(F.sum(metric).cast("double"), F.count(metric)).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                *[percentile(metric, p).alias(f"p{p}") for p in PERCENTILES],
                F.max(value).alias("max"),
            ).select(F.lit(metric).alias("metric"), "*")
        )
    return stacked(rows)
