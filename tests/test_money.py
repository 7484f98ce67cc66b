"""Money keeps its decimals and its size from the raw tables to the reports."""

from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from feira.functions.columns import MONEY, TOTAL, minus, ratio
from feira.operators import expectations, intermediate, marts, rfm, staging
from frames import CUSTOMERS, ORDERS, PAYMENTS, make, money, order, rows

RAW_ITEMS = "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, " \
    "price string, freight_value string"
ITEMS = [
    ("a", "1", "p", "s", "2018-01-01", "12.345", "0.004"),
    ("a", "2", "p", "s", "2018-01-01", "0.004", "0.000000001"),
    ("b", "1", "p", "s", "2018-01-01", "1e20", "0.01"),
]


@pytest.fixture
def items(spark):
    return intermediate.int_order_items(staging.stg_order_items(make(spark, ITEMS, RAW_ITEMS)))


def test_small_and_large_amounts_reach_facts_and_scores(spark, items):
    orders = make(spark, [order("a", "c1"), order("b", "c2"), order("e", "c2")], ORDERS)
    fact = marts.fact_orders(
        orders,
        customers=lambda: make(spark, [("c1", "u1", "1", "X", "SP"), ("c2", "u2", "1", "X", "SP")], CUSTOMERS),
        order_items=lambda: items,
        order_payments=lambda: intermediate.int_order_payments(make(spark, [("a", 1, "x", 1, money("0.005"))], PAYMENTS)),
        order_reviews=lambda: make(
            spark, [], "order_id string, average_review_score double, review_count bigint, latest_review_date timestamp"
        ),
    )
    got = rows(fact, "order_id", "gross_merchandise_value", "total_freight_value", "order_total_value", "total_payment_value")
    assert got == [
        ("a", money("12.349"), money("0.004000001"), money("12.353000001"), money("0.005")),
        ("b", money("1e20"), money("0.01"), money("100000000000000000000.01"), None),
        ("e", 0, None, None, None),
    ]
    scored = dict(rows(rfm.fct_customer_rfm(fact), "monetary", "monetary_score"))
    assert scored == {money("12.349"): 1, money("1e20"): 5}


def test_only_what_is_no_number_is_lost(spark):
    frames = {"order_items": make(spark, [*ITEMS, ("c", "1", "p", "s", "2018-01-01", "free", "1")], RAW_ITEMS)}
    assert rows(expectations.dq_coerce(frames)) == [("order_items", "price", 1)]


def test_a_lost_fraction_of_a_cent_shows(spark, items):
    def matches(amount):
        paid = make(spark, [("a", 1, "x", 1, money(amount))], PAYMENTS)
        return rows(expectations.dq_order_reconciliation(items, paid), "payment_matches_items")

    assert matches("12.363000001") == [(True,)] and matches("12.363000002") == [(False,)]


def half_up(num, den, digits, factor):
    value = Fraction(num) * factor / Fraction(den) * 10**digits
    whole = (2 * abs(value.numerator) + value.denominator) // (2 * value.denominator)
    return Decimal(whole if value >= 0 else -whole).scaleb(-digits)


def test_ratio_is_rounded_once(spark):
    cases = [
        ("1", "3"), ("2", "3"), ("-2", "3"), ("0.005", "1"), ("0.004999999", "1"), ("-0.005", "1"), ("0", "7"), ("1", "0"),
        ("100000000000000000000.01", "2"), ("12345678901234567890.123456789", "7"), ("0.124999999", "25000000"),
        ("174999999.999999999", "100000000"), ("5", None), (None, "5"), ("33.333333333", "0.000000001"),
    ]
    df = make(spark, [tuple(None if x is None else Decimal(x) for x in c) for c in cases], f"n {TOTAL}, d {TOTAL}")
    for digits, factor in ((2, 1), (1, 1), (2, 100)):
        got = df.select("n", "d", ratio(F.col("n"), F.col("d"), digits, factor).alias("r")).collect()
        for n, d, r in got:
            assert r == (None if n is None or not d else half_up(n, d, digits, factor)), (n, d)


def test_differences_keep_all_decimals(spark):
    df = make(spark, [(Decimal("1e20"), Decimal("0.000000001"))], f"a {TOTAL}, b {TOTAL}")
    assert df.select(minus(F.col("a"), F.col("b"))).first()[0] == Decimal("99999999999999999999.999999999")
    assert df.select(F.col("a").cast(MONEY) + F.col("b").cast(MONEY)).dtypes[0][1] == TOTAL
