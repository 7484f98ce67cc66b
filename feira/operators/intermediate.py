"""Intermediate models: one row per order, item or ZIP prefix."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.domain import NON_QUALIFYING
from feira.functions.columns import TOTAL
from feira.plans.numbering import range_layout
from feira.plans.skew import lookup


def int_order_items(items: DataFrame) -> DataFrame:
    return items.withColumn("item_total_value", F.col("price") + F.col("freight_value"))


def order_item_rollup(items: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Items per order; ``items`` carries item_total_value. ``by`` adds the key that the items lie by, if any."""
    return items.groupBy(*(by or ["order_id"])).agg(
        F.count("*").alias("order_item_count"),
        F.sum("price").alias("order_gmv"),
        F.sum("freight_value").alias("total_freight_value"),
        F.sum("item_total_value").alias("order_total_value"),
    )


def int_order_payments(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_payment_value"),
        F.count("*").alias("payment_count"),
        F.max("payment_installments").alias("max_payment_installments"),
    )


def int_order_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("average_review_score"),
        F.count("*").alias("review_count"),
        F.max("review_creation_date").alias("latest_review_date"),
    )


def int_geolocation(geolocation: DataFrame) -> DataFrame:
    """First row per ZIP prefix by city, state, latitude, longitude (NULLs first).

    The smallest struct is that row, and unlike a row number it aggregates on
    the map side, so a ZIP with very many rows costs nothing extra.
    """
    first = F.min(F.struct("city", "state", "latitude", "longitude")).alias("first")
    return (
        geolocation.groupBy("geolocation_zip_code_prefix")
        .agg(first)
        .select("geolocation_zip_code_prefix", "first.latitude", "first.longitude", "first.city", "first.state")
    )


def order_accounts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Every order with its account's person and address, and whether it counts as a purchase."""
    return orders.join(customers, "customer_id", "left").withColumn(
        "is_qualifying_order", ~F.col("order_status").isin(NON_QUALIFYING)
    )


_HISTORY = [
    "order_id",
    "customer_id",
    "customer_unique_id",
    "order_purchase_timestamp",
    "order_status",
    "is_qualifying_order",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "first_order_timestamp",
    "customer_order_number",
]


def int_customer_orders(
    orders: DataFrame, customers: DataFrame, columns: Iterable[str] | None = None
) -> DataFrame:
    """Order history per person: first qualifying purchase and running number of it.

    Orders meet their accounts once, in ranges of (person, qualifying, time, order): also a person of very many
    orders, of one minute or without times, is numbered by several tasks. Orders without a person are one group.
    Of ``columns`` that tell neither, orders only meet their accounts.
    """
    wanted = list(columns) if columns is not None else _HISTORY
    if not {"first_order_timestamp", "customer_order_number"} & set(wanted):
        return order_accounts(orders, customers).select(*wanted)
    person = ["customer_unique_id"]
    group = [*person, "is_qualifying_order"]
    order = ["order_purchase_timestamp", "order_id"]
    qualifying_time = F.when(F.col("is_qualifying_order"), F.col("order_purchase_timestamp"))

    history = order_accounts(orders, customers)
    needed = [c for c in _HISTORY if c in history.columns]
    layout = range_layout(history.select(*needed), [*group, *order], group)
    out = layout.with_minimum(layout.frame, person, qualifying_time, "first_order_timestamp")
    out = layout.with_row_number(out, group, order, "__number")
    number = F.when(F.col("is_qualifying_order"), F.col("__number").cast("bigint"))
    return out.withColumn("customer_order_number", number).select(*wanted)


def order_customers(
    orders: DataFrame, customers: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """All order columns plus person, first purchase and customer type.

    The type only asks whether an order is the person's first purchase, so one
    aggregate per person replaces the numbering of every order. It reads the orders a second time,
    with their persons as kept by ``keep``, if given.
    """
    history = order_accounts(orders, customers)
    history = keep(history, "order-accounts") if keep else history
    qualifies = F.col("is_qualifying_order")
    firsts = history.groupBy("customer_unique_id").agg(
        F.min(F.when(qualifies, F.col("order_purchase_timestamp"))).alias("first_order_timestamp"),
        F.min(F.when(qualifies, F.struct("order_purchase_timestamp", "order_id")))["order_id"].alias("__first"),
    )
    number = F.when(qualifies, F.when(F.col("order_id") == F.col("__first"), 1).otherwise(2))
    return lookup(history, firsts, ["customer_unique_id"]).withColumn(
        "customer_type", customer_type(number)
    ).drop("__first")


def customer_type(number: Column) -> Column:
    """Label of an order by its running number among the person's purchases."""
    return F.when(number == 1, "new").when(number > 1, "returning").otherwise("unknown")


def delivery_metrics(orders: DataFrame) -> DataFrame:
    """Add calendar-day delivery times and the late flag (NULL until delivered)."""
    purchased = F.to_date("order_purchase_timestamp")
    delivered = F.to_date("order_delivered_customer_date")
    estimated = F.to_date("order_estimated_delivery_date")
    return orders.withColumns({
        "delivery_days": F.datediff(delivered, purchased).cast("bigint"),
        "estimated_delivery_days": F.datediff(estimated, purchased).cast("bigint"),
        "is_late": F.when(delivered > estimated, True)
        .when(delivered.isNull(), F.lit(None).cast("boolean"))
        .otherwise(False),
    })


_ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "customer_unique_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "order_item_count",
    "order_gmv",
    "total_freight_value",
    "order_total_value",
    "total_payment_value",
    "payment_count",
    "max_payment_installments",
    "average_review_score",
    "review_count",
    "latest_review_date",
    "first_order_timestamp",
    "customer_order_number",
    "customer_type",
    "delivery_days",
    "estimated_delivery_days",
    "is_late",
]


def int_orders(
    orders: DataFrame,
    order_items: DataFrame,
    order_payments: DataFrame,
    customer_orders: DataFrame,
    order_reviews: DataFrame,
) -> DataFrame:
    """Orders with item, payment, history and review measures.

    Items are summed per order first, so no join multiplies an order's measures.
    """
    history = customer_orders.select(
        "order_id", "customer_unique_id", "first_order_timestamp", "customer_order_number"
    )
    joined = (
        orders.join(order_item_rollup(order_items), "order_id", "left")
        .join(order_payments, "order_id", "left")
        .join(history, "order_id", "left")
        .join(order_reviews, "order_id", "left")
    )
    out = joined.withColumns({
        "order_gmv": F.coalesce("order_gmv", F.lit(0).cast(TOTAL)),
        "customer_type": customer_type(F.col("customer_order_number")),
    })
    return delivery_metrics(out).select(*_ORDER_COLUMNS)
