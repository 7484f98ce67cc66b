"""Customer scoring by recency, frequency and monetary value."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.domain import NON_QUALIFYING
from feira.functions.columns import TOTAL
from feira.plans.ranking import order_statistics, rank_cuts
from feira.plans.workspace import pinned
from feira.settings import Settings


def _purchases(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.filter(~F.col("order_status").isin(NON_QUALIFYING))


def scored_customers(fact_orders: DataFrame) -> DataFrame:
    """The keys that ``fct_customer_rfm`` has a row for; scores add columns only."""
    return _purchases(fact_orders).select("customer_key").distinct()


def rfm_metrics(fact_orders: DataFrame, analysis_date: date = Settings().analysis_date) -> DataFrame:
    """Days since the last purchase, purchases and spend per customer key (NULL key included)."""
    today = F.lit(analysis_date)
    return (
        _purchases(fact_orders)
        .groupBy("customer_key")
        .agg(
            F.max("order_purchase_timestamp").alias("last"),
            F.count_distinct("order_id").alias("frequency"),
            F.sum("gross_merchandise_value").alias("monetary"),
        )
        .select(
            "customer_key",
            today.alias("analysis_date"),
            F.datediff(today, F.to_date("last")).cast("bigint").alias("recency"),
            "frequency",
            "monetary",
        )
    )


def _score(value: Column, cuts: list, best_first: bool) -> Column:
    """1..5 by the four cut values; NULL ranks before every value."""
    labels = [5, 4, 3, 2, 1] if best_first else [1, 2, 3, 4, 5]
    expr = None
    for cut, label in zip(cuts, labels):
        test = value.isNull() if cut is None else value.isNull() | (value <= F.lit(cut))
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return F.lit(labels[-1]) if expr is None else expr.otherwise(labels[-1])


def rfm_percentile_scores(metrics: DataFrame) -> DataFrame:
    """Percent-rank fifths of recency and monetary, from exactly selected cut values.

    The metrics are computed once into the shared folder: the selection scans
    them a few times and the scoring once more.
    """
    metrics = pinned(metrics)
    value = F.col("monetary").cast(TOTAL)
    total, found = order_statistics(metrics, {"recency": F.col("recency"), "monetary": value}, rank_cuts)
    positions = rank_cuts(total) if total else []
    return metrics.withColumns({
        "recency_score": _score(F.col("recency"), [found["recency"][k] for k in positions], best_first=True),
        "monetary_score": _score(value, [found["monetary"][k] for k in positions], best_first=False),
    })


def rfm_frequency_band(metrics: DataFrame) -> DataFrame:
    n = F.col("frequency")
    band = F.when(n == 1, 1).when(n == 2, 2).when(n == 3, 3).when(n >= 4, 4)
    return metrics.withColumn("frequency_score", band)


def rfm_segment(scored: DataFrame) -> DataFrame:
    """Code, total and segment; the first matching rule names the segment."""
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    rules = [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 4) & (f >= 3), "Loyal Customers"),
        ((r >= 3) & (m == 5), "Big Spenders"),
        ((r >= 4) & (f == 1), "Recent One-Time Customers"),
        ((r >= 4) & (f == 2), "Potential Loyalists"),
        (r.between(2, 3) & (f >= 3), "At Risk"),
        (r.between(2, 3) & (f <= 2), "Needs Attention"),
        (r == 1, "Lost Customers"),
    ]
    segment = F.when(*rules[0])
    for test, name in rules[1:]:
        segment = segment.when(test, name)
    return scored.withColumns({
        "rfm_code": F.concat(r.cast("string"), f.cast("string"), m.cast("string")),
        "rfm_total_score": r + f + m,
        "customer_segment": segment.otherwise("Other"),
    })


RFM_COLUMNS = [
    "customer_key",
    "analysis_date",
    "recency",
    "frequency",
    "monetary",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "rfm_code",
    "rfm_total_score",
    "customer_segment",
]


def fct_customer_rfm(fact_orders: DataFrame, analysis_date: date = Settings().analysis_date) -> DataFrame:
    """One scored row per customer."""
    scored = rfm_frequency_band(rfm_percentile_scores(rfm_metrics(fact_orders, analysis_date)))
    return rfm_segment(scored).select(*RFM_COLUMNS)
