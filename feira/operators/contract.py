"""Column contract of the published reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from feira.operators.model_tests import stacked
from feira.sources.files import csv_headers
from feira.sources.sinks import read_report

# --- fixed values: report -> its columns in order ---------------------------
REPORT_COLUMNS = {
    "monthly_sales_trend": [
        "year_month", "region", "order_count", "orders_missing_items", "gmv", "avg_order_value",
    ],
    "rfm_analysis": [
        "customer_key", "customer_unique_id", "customer_segment", "recency_days", "frequency", "monetary_value",
        "recency_score", "frequency_score", "monetary_score", "rfm_code", "rfm_score", "customer_state",
        "customer_city",
    ],
    "rfm_segment_summary": [
        "customer_segment", "customer_count", "avg_recency_days", "avg_frequency", "avg_monetary_value",
        "total_revenue", "pct_customers", "pct_revenue",
    ],
    "holiday_impact": ["day_type", "order_count", "gmv", "avg_order_value"],
    "holiday_impact_by_quarter": ["year_quarter", "day_type", "order_count", "gmv", "avg_order_value"],
    "holiday_daily_metrics_by_quarter": [
        "year_quarter", "day_type", "day_count", "total_orders", "total_gmv", "avg_orders_per_day",
        "avg_gmv_per_day",
    ],
    "holiday_product_category_mix": [
        "day_type", "product_category", "units_sold", "order_count", "gmv", "gmv_share_pct",
    ],
}


def column_faults(actual: list[str], expected: list[str]) -> dict[str, object]:
    """Repeated, missing and unexpected columns; wrong order only when nothing else is wrong."""
    missing = [c for c in expected if c not in actual]
    unexpected = [c for c in actual if c not in expected]
    repeated = sorted({c for c in actual if actual.count(c) > 1})
    return {
        "duplicate_columns": repeated,
        "missing_columns": missing,
        "unexpected_columns": unexpected,
        "wrong_order": actual != expected and not missing and not unexpected,
    }


def _verdict(report: str, rows: DataFrame, actual: list[str], expected: list[str]) -> DataFrame:
    """One verdict row; ``rows`` is a frame of one row count."""
    faults = column_faults(actual, expected)
    sound = not any(faults.values())
    lists = [
        F.lit(", ".join(faults[k])).alias(k) for k in ("duplicate_columns", "missing_columns", "unexpected_columns")
    ]
    return rows.select(
        F.lit(report).alias("report"),
        "rows",
        F.lit(len(actual)).alias("columns"),
        *lists,
        F.lit(faults["wrong_order"]).alias("wrong_order"),
        ((F.col("rows") > 0) & F.lit(sound)).alias("success"),
    )


def report_contract(
    reports: dict[str, DataFrame], expected: dict[str, list[str]] = REPORT_COLUMNS
) -> DataFrame:
    """One verdict row per report: not empty, no repeated column, exactly the expected columns."""
    return stacked([
        _verdict(name, df.agg(F.count("*").alias("rows")), df.columns, expected[name]) for name, df in reports.items()
    ])


def published_contract(
    spark: SparkSession, root: str, expected: dict[str, list[str]] = REPORT_COLUMNS
) -> DataFrame:
    """The contract of the files as published: the header every file has, and the records below it.

    A report that is absent or cannot be read lacks all its columns; of files with different headers, the first
    that breaks the contract is reported.
    """
    parts = []
    for name, columns in expected.items():
        path = f"{root.rstrip('/')}/{name}"
        try:
            headers = [list(h) for h in csv_headers(spark, path)]
        except AnalysisException:  # no such report
            headers = []
        if headers:
            rows = read_report(spark, name, root).agg(F.count("*").alias("rows"))
        else:
            rows, headers = spark.range(1).select(F.lit(0).cast("bigint").alias("rows")), [[]]
        broken = [h for h in headers if any(column_faults(h, columns).values())]
        parts.append(_verdict(name, rows, (broken or headers)[0], columns))
    return stacked(parts)
