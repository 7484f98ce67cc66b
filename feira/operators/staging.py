"""Staging: pick the declared columns, clean the text, give every column its type.

``cast`` is strict (the job fails on a malformed value), ``try_cast`` turns a
malformed value into NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.functions.columns import MEASURE, MONEY, clean, clean_upper


def stg_orders(raw: DataFrame) -> DataFrame:
    moments = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    return raw.select(
        "order_id",
        "customer_id",
        clean_upper("order_status").alias("order_status"),
        *[F.col(c).try_cast("timestamp").alias(c) for c in moments],
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("order_item_id").cast("bigint").alias("order_item_id"),
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").cast("timestamp").alias("shipping_limit_date"),
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        F.col("payment_sequential").cast("bigint").alias("payment_sequential"),
        F.col("payment_type").cast("string").alias("payment_type"),
        F.col("payment_installments").cast("bigint").alias("payment_installments"),
        F.col("payment_value").cast(MONEY).alias("payment_value"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("bigint").alias("review_score"),
        clean("review_comment_title").alias("review_comment_title"),
        clean("review_comment_message").alias("review_comment_message"),
        F.col("review_creation_date").cast("timestamp").alias("review_creation_date"),
        F.col("review_answer_timestamp").cast("timestamp").alias("review_answer_timestamp"),
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").cast("string").alias("customer_zip_code_prefix"),
        clean_upper("customer_city").alias("customer_city"),
        clean_upper("customer_state").alias("customer_state"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        F.col("seller_zip_code_prefix").cast("string").alias("seller_zip_code_prefix"),
        clean_upper("seller_city").alias("seller_city"),
        clean_upper("seller_state").alias("seller_state"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        "product_category_name",
        F.col("product_name_lenght").try_cast("bigint").alias("product_name_length"),
        F.col("product_description_lenght").try_cast("bigint").alias("product_description_length"),
        F.col("product_photos_qty").try_cast("bigint").alias("product_photos_qty"),
        *[
            F.col(c).try_cast(MEASURE).alias(c)
            for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
        ],
    )


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean("product_category_name").alias("product_category_name"),
        clean("product_category_name_english").alias("product_category_name_english"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("geolocation_zip_code_prefix").cast("string").alias("geolocation_zip_code_prefix"),
        F.col("geolocation_lat").cast(MEASURE).alias("latitude"),
        F.col("geolocation_lng").cast(MEASURE).alias("longitude"),
        clean_upper("geolocation_city").alias("city"),
        clean_upper("geolocation_state").alias("state"),
    )


def stg_holiday_calendar(*yearly: DataFrame) -> DataFrame:
    """One feed per year, stacked without de-duplication."""
    staged = [
        raw.select(
            F.col("date").try_cast("date").alias("hol_date"),
            clean_upper("name").alias("hol_name"),
            clean_upper("type").alias("hol_type"),
            clean_upper("weekday").alias("hol_day"),
        )
        for raw in yearly
    ]
    return reduce(DataFrame.unionByName, staged)
