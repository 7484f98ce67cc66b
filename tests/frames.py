"""Small frames for the fixtures."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)
CUSTOMERS = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
    "customer_state string"
)
ITEMS = (
    "order_id string, order_item_id bigint, product_id string, seller_id string, shipping_limit_date timestamp, "
    "price decimal(37,9), freight_value decimal(37,9)"
)
PAYMENTS = (
    "order_id string, payment_sequential bigint, payment_type string, payment_installments bigint, "
    "payment_value decimal(37,9)"
)
REVIEWS = (
    "review_id string, order_id string, review_score bigint, review_comment_title string, "
    "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
)
HISTORY = (
    "order_id string, customer_id string, customer_unique_id string, order_purchase_timestamp timestamp, "
    "order_status string, is_qualifying_order boolean, first_order_timestamp timestamp, customer_order_number bigint"
)
HOLIDAYS = "hol_date date, hol_name string, hol_type string, hol_day string"


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


def money(text: str) -> Decimal:
    return Decimal(text)


def order(order_id, customer_id="c", status="DELIVERED", bought="2018-01-01 10:00:00", delivered=None, estimated=None):
    return (order_id, customer_id, status, ts(bought), None, None, ts(delivered), ts(estimated))


def make(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)
