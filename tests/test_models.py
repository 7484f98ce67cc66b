"""Staging, intermediate and mart models on small fixtures."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from feira.operators import intermediate, marts, staging
from feira.settings import Settings
from frames import (
    CUSTOMERS, HISTORY, HOLIDAYS, ITEMS, ORDERS, PAYMENTS, REVIEWS, day, make, money, order, rows, ts,
)


def int_orders(spark, orders, history, items=()):
    return intermediate.int_orders(
        make(spark, orders, ORDERS),
        intermediate.int_order_items(make(spark, list(items), ITEMS)),
        intermediate.int_order_payments(make(spark, [], PAYMENTS)),
        make(spark, history, HISTORY),
        intermediate.int_order_reviews(make(spark, [], REVIEWS)),
    )


def seen(order_id, person="u", number=1, qualifying=True):
    return (order_id, "c", person, ts("2018-01-01 10:00:00"), "DELIVERED", qualifying, None, number)


def test_is_late(spark):
    orders = [
        order("order_late", delivered="2018-01-10 10:00:00", estimated="2018-01-05 00:00:00"),
        order("order_ontime", delivered="2018-01-04 10:00:00", estimated="2018-01-10 00:00:00"),
        order("order_pending", status="SHIPPED", estimated="2018-01-10 00:00:00"),
        order("no_estimate", delivered="2018-01-04 10:00:00"),
    ]
    out = int_orders(spark, orders, [seen(o[0]) for o in orders])
    assert dict(rows(out, "order_id", "is_late")) == {
        "order_late": True, "order_ontime": False, "order_pending": None, "no_estimate": False,
    }


def test_customer_type(spark):
    orders = [order("o1"), order("o2", bought="2018-02-01 10:00:00"), order("o3", status="CANCELED")]
    history = [seen("o1", "u1", 1), seen("o2", "u1", 2), seen("o3", "u2", None, False)]
    out = int_orders(spark, orders, history)
    assert dict(rows(out, "order_id", "customer_type")) == {"o1": "new", "o2": "returning", "o3": "unknown"}


def test_category_fallback(spark):
    products = make(
        spark,
        [("p_matched", "beleza_saude"), ("p_unmatched", "categoria_inexistente"), ("p_no_category", None)],
        "product_id string, product_category_name string",
    )
    for column in ("name_length", "description_length", "photos_qty", "weight_g", "height_cm", "length_cm", "width_cm"):
        products = products.withColumn(f"product_{column}", F.lit(1))
    translation = make(
        spark, [("beleza_saude", "health_beauty")],
        "product_category_name string, product_category_name_english string",
    )
    out = marts.dim_product(products, translation)
    assert dict(rows(out, "product_id", "product_category_name_english")) == {
        "p_matched": "health_beauty", "p_unmatched": "categoria_inexistente", "p_no_category": "unknown",
    }


def test_order_without_items_has_zero_gmv_but_no_other_measures(spark):
    out = int_orders(spark, [order("o1")], [seen("o1")])
    assert rows(out, "order_gmv", "order_item_count", "total_freight_value", "order_total_value") == [
        (money("0.00"), None, None, None)
    ]


def test_items_never_multiply_order_measures(spark):
    items = [("o1", i, "p", "s", None, money("10.00"), money("1.50")) for i in (1, 2, 3)]
    out = int_orders(spark, [order("o1")], [seen("o1")], items)
    assert rows(out, "order_item_count", "order_gmv", "order_total_value") == [(3, money("30.00"), money("34.50"))]


def test_staging_cleans_and_casts(spark):
    raw = make(
        spark,
        [("o", "c", "\t delivered \r\n", "2017-10-02 10:56:33", "n/a", None, None, "2017-13-01")],
        ", ".join(f"{c.split()[0]} string" for c in ORDERS.split(", ")),
    )
    out = staging.stg_orders(raw)
    assert rows(out, "order_status", "order_purchase_timestamp", "order_approved_at",
                "order_estimated_delivery_date") == [("DELIVERED", ts("2017-10-02 10:56:33"), None, None)]


def test_strict_casts_fail_on_bad_input(spark):
    raw = make(
        spark, [("o", "x1", "p", "s", "2017-10-02 10:56:33", "1.00", "2.00")],
        ", ".join(f"{c.split()[0]} string" for c in
                  "order_id order_item_id product_id seller_id shipping_limit_date price freight_value".split()),
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_order_items(raw).collect()


def test_holiday_years_are_stacked(spark):
    schema = "date string, name string, type string, weekday string"
    one = make(spark, [("2017-01-01", " a ", "national", "domingo")], schema)
    two = make(spark, [("2018-01-01", "b", "national", "segunda-feira"), ("bad", "c", "national", "x")], schema)
    three = make(spark, [("2019-01-01", "d", "national", "terça-feira")], schema)
    out = staging.stg_holiday_calendar(one, two, three)
    assert rows(out, "hol_date", "hol_name") == sorted(
        [(date(2017, 1, 1), "A"), (date(2018, 1, 1), "B"), (None, "C"), (date(2019, 1, 1), "D")], key=str
    )


def test_first_geolocation_row_per_zip(spark):
    out = intermediate.int_geolocation(make(
        spark,
        [("1", 2.0, 2.0, "B", "SP"), ("1", 1.0, 5.0, "A", "SP"), ("1", 1.0, 4.0, "A", "SP"), ("2", 0.0, 0.0, None, "RJ"),
         ("2", 0.0, 0.0, "A", "RJ")],
        "geolocation_zip_code_prefix string, latitude double, longitude double, city string, state string",
    ))
    assert rows(out) == [("1", 1.0, 4.0, "A", "SP"), ("2", 0.0, 0.0, None, "RJ")]


def test_null_status_does_not_qualify(spark):
    orders = make(spark, [order("o1", "a", None), order("o2", "a", "SHIPPED", "2018-02-01 00:00:00")], ORDERS)
    customers = make(spark, [("a", "u", "1", "X", "SP")], CUSTOMERS)
    history = intermediate.int_customer_orders(orders, customers)
    assert rows(history, "order_id", "is_qualifying_order", "customer_order_number") == [
        ("o1", None, None), ("o2", True, 1)
    ]
    typed = intermediate.order_customers(orders, customers)
    assert rows(typed, "order_id", "customer_type") == [("o1", "unknown"), ("o2", "new")]


def test_customer_type_agrees_with_the_numbering(spark, folder):
    from feira.registry import World

    cat = World(spark, folder).cat
    typed = intermediate.order_customers(cat.stg_orders, cat.stg_customers)
    numbered = cat.int_orders
    columns = ("order_id", "customer_unique_id", "first_order_timestamp", "customer_type")
    assert rows(typed, *columns) == rows(numbered, *columns)


def test_calendar(spark):
    holidays = make(
        spark,
        [(day("2017-12-25"), "NATAL", "NATIONAL", "SEGUNDA-FEIRA"), (day("2018-04-21"), "A", "NATIONAL", "SÁBADO"),
         (day("2018-04-21"), "B", "NATIONAL", "SÁBADO"), (day("2016-01-01"), "C", "NATIONAL", "SEXTA-FEIRA")],
        HOLIDAYS,
    )
    dates = marts.dim_date(spark, holidays, Settings())
    assert dates.count() == 366 + 365 + 365 + 1  # two holidays share a day
    got = {r["date"]: r for r in dates.collect()}
    assert got[date(2017, 12, 25)]["is_holiday"] is True and got[date(2017, 12, 24)]["is_holiday"] is False
    assert got[date(2016, 1, 1)]["is_holiday"] is None  # no coverage that year
    assert all(r["week"] == int(d.strftime("%U")) for d, r in got.items())
    assert all(r["day_of_week"] == d.strftime("%A") and r["month_name"] == d.strftime("%B") for d, r in got.items())
    assert sum(r["is_quarter_end"] for r in got.values()) == 12
    assert sum(r["is_year_end"] for r in got.values()) == 3
    assert sum(r["is_month_end"] for r in got.values()) == 36
    assert all(r["is_weekend"] == (d.weekday() >= 5) for d, r in got.items())


def test_customer_dimension(spark):
    orders = make(spark, [
        order("o1", "a1", bought="2018-01-01 00:00:00"),
        order("o2", "a2", "CANCELED", bought="2018-03-01 00:00:00"),
        order("o3", "a2", bought="2018-03-01 00:00:00"),
    ], ORDERS)
    customers = make(spark, [
        ("a1", "u", "1", "X", "SP"), ("a2", "u", "2", "Y", "RJ"), ("a3", "v", "9", "Z", "SP"), ("a4", None, "1", "Q", "SP"),
    ], CUSTOMERS)
    zips = make(spark, [("2", 1.0, 1.0, "Y", "RJ")],
                "geolocation_zip_code_prefix string, latitude double, longitude double, city string, state string")
    dim = marts.dim_customer(customers, orders, marts.dim_geolocation(zips))
    got = {r["customer_unique_id"]: r for r in dim.collect()}
    assert set(got) == {"u", "v", None}
    assert (got["u"]["customer_id"], got["u"]["customer_state"]) == ("a2", "RJ")
    assert got["u"]["customer_first_order_date"] == date(2018, 1, 1)
    assert got["u"]["geolocation_key"] is not None
    assert got["v"]["customer_id"] is None and got["v"]["geolocation_key"] is None
    assert got[None]["customer_key"] is None


def test_keys_are_null_when_a_part_is(spark):
    payments = make(spark, [("o1", 1, "boleto", 1, money("1.00")), (None, 1, "boleto", 1, money("1.00"))], PAYMENTS)
    out = marts.fact_payments(payments, make(spark, [order("o1")], ORDERS), make(spark, [], CUSTOMERS))
    assert [r["payment_key"] is None for r in out.orderBy("payment_key").collect()] == [True, False]
