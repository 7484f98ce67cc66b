"""Exact rank selection and customer scores against brute force."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from feira.operators import rfm
from feira.plans import ranking
from feira.plans.ranking import order_statistics, rank_cuts
from frames import make, rows

METRICS = "customer_key string, recency bigint, frequency bigint, monetary decimal(28,2)"


@pytest.mark.parametrize("slices", [2, 7, 16384])
def test_order_statistics_match_a_sort(spark, monkeypatch, slices):
    monkeypatch.setattr(ranking, "SLICES", slices)
    rnd = random.Random(slices)
    for n in (1, 2, 13, 200):
        values = [rnd.choice([None, rnd.randrange(-50, 50), rnd.randrange(10**12)]) for _ in range(n)]
        df = make(spark, [(v,) for v in values], "x bigint")
        total, found = order_statistics(df, {"x": F.col("x")}, lambda t: range(0, t, max(1, t // 9)))
        ordered = sorted(values, key=lambda v: (v is not None, v if v is not None else 0))
        assert total == n
        assert found["x"] == {k: ordered[k] for k in found["x"]}


def by_percent_rank(metrics):
    def score(column, labels):
        rank = F.percent_rank().over(Window.orderBy(column))
        a, b, c, d, e = labels
        return F.when(rank <= 0.2, a).when(rank <= 0.4, b).when(rank <= 0.6, c).when(rank <= 0.8, d).otherwise(e)

    return metrics.withColumns({
        "recency_score": score("recency", (5, 4, 3, 2, 1)), "monetary_score": score("monetary", (1, 2, 3, 4, 5)),
    })


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 13, 99, 403])
@pytest.mark.parametrize("kind", ["random", "tied", "skewed"])
def test_scores_equal_percent_rank(spark, n, kind):
    rnd = random.Random(n)

    def value():
        if kind == "tied":
            return 7
        if kind == "skewed":
            return 1 if rnd.random() < 0.4 else rnd.randrange(10**9)
        return rnd.randrange(50)

    data = [
        (str(i), None if kind == "random" and i % 11 == 3 else value(), 1, Decimal(value()).scaleb(-2))
        for i in range(n)
    ]
    metrics = make(spark, data, METRICS)
    columns = ("customer_key", "recency_score", "monetary_score")
    assert rows(rfm.rfm_percentile_scores(metrics), *columns) == rows(by_percent_rank(metrics), *columns)


def test_cut_positions():
    assert rank_cuts(1) == [0, 0, 0, 0]
    assert rank_cuts(8) == [1, 2, 4, 5]


def test_segments_follow_the_rule_order(spark):
    scored = make(
        spark,
        [("a", 4, 4, 4), ("b", 5, 3, 5), ("c", 3, 1, 5), ("d", 4, 1, 5), ("e", 4, 1, 1), ("f", 5, 2, 4), ("g", 2, 3, 1),
         ("h", 3, 2, 4), ("i", 1, 4, 5), ("j", 4, None, 1)],
        "customer_key string, recency_score int, frequency_score int, monetary_score int",
    )
    got = dict(rows(rfm.rfm_segment(scored), "customer_key", "customer_segment"))
    assert got == {
        "a": "Champions", "b": "Loyal Customers", "c": "Big Spenders", "d": "Big Spenders",
        "e": "Recent One-Time Customers", "f": "Potential Loyalists", "g": "At Risk", "h": "Needs Attention",
        "i": "Lost Customers", "j": "Other",
    }


def test_canceled_orders_and_unknown_customers(spark):
    from datetime import datetime

    orders = make(
        spark,
        [("k", "o1", "DELIVERED", datetime(2018, 10, 10, 23), Decimal("5.00")),
         ("k", "o2", "CANCELED", datetime(2018, 10, 17), Decimal("50.00")),
         ("x", "o3", "UNAVAILABLE", datetime(2018, 10, 17), Decimal("1.00")),
         (None, "o4", "SHIPPED", datetime(2018, 10, 1), Decimal("2.00")),
         ("y", "o5", None, datetime(2018, 10, 1), Decimal("2.00"))],
        "customer_key string, order_id string, order_status string, order_purchase_timestamp timestamp, "
        "gross_merchandise_value decimal(28,2)",
    )
    got = rows(rfm.rfm_metrics(orders, date(2018, 10, 18)), "customer_key", "recency", "frequency", "monetary")
    assert got == [("k", 8, 1, Decimal("5.00")), (None, 17, 1, Decimal("2.00"))]
