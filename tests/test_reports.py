"""Report and drill-down edge cases."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feira.operators import drilldown as dd
from feira.operators import reports
from feira.settings import Settings
from frames import HOLIDAYS, day, make, money, rows

ONE_MONTH = Settings(report_start=(2017, 4), report_end=(2017, 4), spike_year=2017)
FACT_ORDERS = "order_key string, customer_key string, order_date_key int"
FACT_ITEMS = "order_key string, order_date_key int, product_key string, price decimal(18,2), freight_value decimal(18,2)"


def calendar(spark, first=date(2017, 3, 25), last=date(2017, 5, 5)):
    from feira.operators.marts import dim_date

    holidays = make(spark, [(day("2017-04-21"), "TIRADENTES", "NATIONAL", "SEXTA-FEIRA")], HOLIDAYS)
    return dim_date(spark, holidays, Settings(calendar_start=first, calendar_end=last))


def sale(key, date_key, price, freight="0.00", product="p"):
    return (key, date_key, product, money(price), money(freight))


def facts(spark):
    orders = make(spark, [("a", "u", 20170401), ("b", "u", 20170421), ("c", "v", 20170422), ("d", None, 20170501),
                          ("e", "v", 20170422)], FACT_ORDERS)
    items = make(spark, [sale("a", 20170401, "10.00", "1.00"), sale("a", 20170401, "5.00"),
                         sale("b", 20170421, "7.00"), sale("d", 20170501, "99.00"),
                         sale("e", 20170422, "1.00", "0.01"), sale("zz", 20170402, "50.00")], FACT_ITEMS)
    return orders, items


def test_orders_without_items_count_apart(spark):
    orders, items = facts(spark)
    customers = make(spark, [("u", "SP"), ("v", "??")], "customer_key string, customer_state string")
    out = reports.monthly_sales_trend(orders, items, calendar(spark), customers, ONE_MONTH)
    assert rows(out) == [
        ("2017-04", "Southeast", 2, 0, money("23.00"), money("11.50")),
        ("2017-04", "Unknown", 1, 1, money("1.01"), money("1.01")),
    ]


def test_two_averages(spark):
    orders, items = facts(spark)
    dates = calendar(spark)
    mean = {r["day_type"]: r for r in reports.holiday_impact(orders, items, dates, ONE_MONTH).collect()}
    every = {r["day_type"]: r for r in dd.holiday_impact_all_orders(orders, items, dates, ONE_MONTH).collect()}
    assert (mean["Non-Holiday"]["order_count"], mean["Non-Holiday"]["avg_order_value"]) == (2, money("8.51"))
    assert (every["Non-Holiday"]["order_count"], every["Non-Holiday"]["avg_order_value"]) == (3, money("5.67"))


def test_days_without_orders_stay_in_the_average(spark):
    orders, items = facts(spark)
    out = reports.holiday_daily_metrics_by_quarter(orders, items, calendar(spark), ONE_MONTH)
    got = {r["day_type"]: r for r in out.collect()}
    assert (got["Non-Holiday"]["day_count"], got["Non-Holiday"]["total_orders"]) == (29, 2)
    assert got["Non-Holiday"]["avg_orders_per_day"] == money("0.07")
    assert got["Holiday"]["day_count"] == 1


def test_repeated_order_rows_count_once(spark):
    orders, items = facts(spark)
    out = reports.holiday_impact(orders.unionAll(orders), items, calendar(spark), ONE_MONTH)
    got = {r["day_type"]: r for r in out.collect()}
    assert got["Non-Holiday"]["order_count"] == 2 and got["Non-Holiday"]["gmv"] == money("34.02")


def test_growth_needs_both_months(spark):
    schema = "year_month string, orders bigint, gmv decimal(20,2), avg_order_value decimal(20,2)"
    both = [("2017-10", 10, money("100.00"), money("10.00")), ("2017-11", 15, money("120.00"), money("8.00"))]
    row = dd.month_over_month_growth(make(spark, both, schema)).collect()[0]
    assert [round(row[c], 6) for c in row.__fields__[2:]] == [50.0, 20.0, -20.0]
    assert dd.month_over_month_growth(make(spark, both[:1], schema)).count() == 0


def test_category_in_one_year_only_and_short_lists(spark):
    schema = "product_category_name_english string, total_revenue decimal(28,2)"
    early = make(spark, [("a", money("5.00")), ("b", money("1.00"))], schema)
    late = make(spark, [("a", money("2.00")), ("c", money("9.00"))], schema)
    comparison = dd.compare_category_revenue(early, late, (2017, 2018))
    assert rows(comparison) == [("a", money("5.00"), money("2.00")), ("b", money("1.00"), money("0.00")),
                                ("c", money("0.00"), money("9.00"))]
    changes = dd.category_revenue_changes(comparison, (2017, 2018))
    assert [r["product_category_name_english"] for r in changes.collect()] == ["c", "b", "a", "a", "b", "c"]


def test_unmapped_states_are_dropped_from_the_rollup(spark):
    sales = make(spark, [("2017-01", "SP", money("1.00")), ("2017-01", "MG", money("2.00")), ("2017-01", "XX", money("4.00")),
                         ("2017-01", None, money("8.00"))], "month string, customer_state string, gmv decimal(28,2)")
    assert rows(dd.region_rollup(sales)) == [("2017-01", "Southeast", money("3.00"))]


def demand_frames(spark, missing=None):
    holidays = make(spark, [(day("2017-04-14"), "X", "NATIONAL", "-"), (day("2017-04-15"), "X", "NATIONAL", "-"),
                            (day("2017-04-30"), "LAST", "NATIONAL", "-")], HOLIDAYS)
    days = [d for d in range(20170407, 20170423) if d != missing]
    items = [sale("k", d, "7.00") for d in days]
    items += [sale("k", 20170414, "3.00", product="q"), sale("k", 20170401, "1.00")]
    products = make(spark, [("p", "toys"), ("q", "books")], "product_key string, product_category_name_english string")
    return holidays, make(spark, items, FACT_ITEMS), products


def test_holiday_demand(spark):
    out = dd.holiday_window_demand(*demand_frames(spark))
    got = {(r["holiday"], r["product_category_name_english"]): r for r in out.collect()}
    assert set(got) == {("X", "toys"), ("X", "books")}  # the second event has days without sales
    toys, books = got[("X", "toys")], got[("X", "books")]
    assert (toys["before_daily"], toys["holiday_daily"], toys["after_daily"]) == (7.0, 7.0, 7.0)
    assert toys["holiday_change_pct"] == 0.0
    assert books["before_daily"] == 0.0 and books["holiday_daily"] == 1.5
    assert books["holiday_change_pct"] is None and books["after_change_value"] == -1.5


def test_incomplete_window_is_skipped(spark):
    assert dd.holiday_window_demand(*demand_frames(spark, missing=20170410)).count() == 0


def test_top_lists_break_ties_by_name(spark):
    sales = make(spark, [(1, c, money("5.00")) for c in "dbca"],
                 "month int, product_category_name_english string, total_sales_value decimal(28,2)")
    top = dd.top10_each_month(sales, 2)
    assert [r[0] for r in rows(top, "product_category_name_english")] == ["a", "b"]


def test_recency_lists_the_smallest_first(spark):
    detail = make(
        spark, [("a", "S", 5, 1, money("1.00"), 3), ("b", "S", 1, 9, money("2.00"), 3), ("c", "S", None, 2, money("3.00"), 3)],
        "customer_unique_id string, customer_segment string, recency_days bigint, frequency bigint, "
        "monetary_value decimal(28,2), rfm_score int",
    )
    first = {m: dd.top_customers(detail, 1, m).collect()[0][0] for m in ("recency_days", "frequency", "monetary_value")}
    assert first == {"recency_days": "b", "frequency": "b", "monetary_value": "c"}


def test_pivot_keeps_missing_columns(spark):
    quarterly = make(spark, [("2017-Q1", "Non-Holiday", 2.0)], "year_quarter string, day_type string, m double")
    assert rows(dd.pivot_quarter_daytype(quarterly, "m")) == [("2017-Q1", None, 2.0)]
    assert dd.pivot_quarter_daytype(quarterly, "m").columns == ["year_quarter", "Holiday", "Non-Holiday"]


def test_unknown_product_key_is_a_category_of_the_report_only(spark):
    orders, items = facts(spark)
    products = make(spark, [], "product_key string, product_category_name_english string")
    mix = reports.holiday_product_category_mix(orders, items, calendar(spark), products, 10, ONE_MONTH)
    assert {r["product_category"] for r in mix.collect()} == {"Unknown"}
    known = dd.holiday_category_mix_known(items, calendar(spark), products, 10, ONE_MONTH)
    assert known.filter(F.lit(True)).count() == 0


@pytest.mark.parametrize("metric", ["monetary_value", "frequency", "recency_days"])
@pytest.mark.parametrize("n", [1, 3, 5, 50])
def test_top_customers_with_ties_and_missing_values(spark, metric, n):
    data = [(f"k{i}", None if i % 7 == 0 else i % 4, i % 3 + 1, None if i % 5 == 0 else Decimal(i % 6)) for i in range(20)]
    scores = make(spark, data, "customer_key string, recency bigint, frequency bigint, monetary decimal(38,9)")
    for c in ("customer_segment", "recency_score", "frequency_score", "monetary_score", "rfm_code", "rfm_total_score"):
        scores = scores.withColumn(c, F.lit(1))
    # one customer has no name
    people = make(spark, [(k, f"u{19 - i:02d}") for i, (k, *_) in enumerate(data) if i != 13], "customer_key string, customer_unique_id string")
    got = dd.best_customers(scores, people, n, metric).select("customer_unique_id", metric).collect()
    everyone = dd.rfm_detail(scores, people).select("customer_unique_id", metric).collect()
    sign = 1 if metric == "recency_days" else -1
    everyone.sort(key=lambda r: (r[1] is None, sign * (r[1] or 0), r[0] is not None, r[0] or ""))
    assert got == everyone[:n]
