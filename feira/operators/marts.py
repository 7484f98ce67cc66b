"""Star schema: dimensions and facts.

The two large fact builders take ``columns``: only the joins those columns need
are planned, which the optimizer could not drop by itself because it does not
know that the looked-up keys are unique. Their inputs are callables, so that
an input nobody needs is not even built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.functions.columns import TOTAL, date_key, region_of, surrogate_key
from feira.operators.intermediate import delivery_metrics, order_accounts, order_customers, order_item_rollup
from feira.plans.skew import lookup, with_hashed_key
from feira.plans.workspace import Keep
from feira.settings import Settings


Frame = Callable[[], DataFrame]
# rows of a fact laid out before its keys are hashed, which are several times wider than the ids
Spread = Callable[[DataFrame], DataFrame]

# --- dimensions -----------------------------------------------------------


def dim_date(spark: SparkSession, holidays: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per calendar day (per holiday, should two share a day)."""
    day = F.col("date")
    calendar = spark.range(1).select(
        F.explode(F.sequence(F.lit(settings.calendar_start), F.lit(settings.calendar_end))).alias("date")
    )
    quarter_end = F.last_day(F.make_date(F.year(day), F.quarter(day) * 3, F.lit(1)))
    return calendar.join(holidays, day == F.col("hol_date"), "left").select(
        date_key(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        # weeks start on Sunday; days before the first Sunday are week 0
        F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int").alias("week"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        (F.last_day(day) == day).alias("is_month_end"),
        (quarter_end == day).alias("is_quarter_end"),
        ((F.month(day) == 12) & (F.dayofmonth(day) == 31)).alias("is_year_end"),
        F.when(F.year(day).isin(*settings.holiday_years), F.col("hol_date").isNotNull()).alias("is_holiday"),
        F.col("hol_name").alias("holiday_name"),
        F.col("hol_type").alias("holiday_type"),
        F.col("hol_day").alias("holiday_weekday"),
    )


def dim_geolocation(zips: DataFrame) -> DataFrame:
    return zips.select(
        surrogate_key("geolocation_zip_code_prefix").alias("geolocation_key"),
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        "latitude",
        "longitude",
        "city",
        "state",
        region_of(F.col("state")).alias("region"),
    )


def _given(frame: DataFrame | Frame) -> DataFrame:
    return frame if isinstance(frame, DataFrame) else frame()


def _geolocation_key(df: DataFrame, zip_column: str, geolocation: DataFrame) -> DataFrame:
    """Key of a ZIP's location; one ZIP may hold any share of the rows."""
    known = geolocation.filter(F.col("zip_code_prefix").isNotNull())
    return lookup(df, known.select(F.col("zip_code_prefix").alias(zip_column), "geolocation_key"), [zip_column])


DIM_CUSTOMER = [
    "customer_key",
    "customer_id",
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "customer_first_order_date",
    "geolocation_key",
]


def dim_customer(
    customers: DataFrame,
    orders: DataFrame | Frame,
    geolocation: DataFrame | Frame,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """One row per person: first order date and the address of the latest order.

    Orders are reduced to their first and latest per account before they meet the
    accounts, and accounts to persons by the largest struct. Both steps aggregate
    on the map side, so neither a busy account nor a busy person is a hot task.
    Keys and names alone need no orders, and only ``geolocation_key`` needs the locations.
    """
    wanted = list(columns) if columns is not None else DIM_CUSTOMER
    if set(wanted) <= {"customer_key", "customer_unique_id"}:
        persons = customers.select("customer_unique_id").distinct()
        return persons.withColumn("customer_key", surrogate_key("customer_unique_id")).select(*wanted)
    per_account = _given(orders).groupBy("customer_id").agg(
        F.min("order_purchase_timestamp").alias("first"),
        F.max(F.struct("order_purchase_timestamp", "order_id")).alias("last"),
    )
    latest = F.when(
        F.col("last").isNotNull(),
        F.struct(
            "last.order_purchase_timestamp",
            "last.order_id",
            "customer_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ),
    )
    persons = (
        customers.join(per_account, "customer_id", "left")
        .groupBy("customer_unique_id")
        .agg(F.min("first").alias("first"), F.max(latest).alias("latest"))
    )
    known = F.col("customer_unique_id").isNotNull()
    dim = persons.select(
        surrogate_key("customer_unique_id").alias("customer_key"),
        F.when(known, F.col("latest.customer_id")).alias("customer_id"),
        "customer_unique_id",
        F.when(known, F.col("latest.customer_zip_code_prefix")).alias("customer_zip_code_prefix"),
        F.when(known, F.col("latest.customer_city")).alias("customer_city"),
        F.when(known, F.col("latest.customer_state")).alias("customer_state"),
        F.when(known, F.to_date("first")).alias("customer_first_order_date"),
    )
    if "geolocation_key" in wanted:
        dim = _geolocation_key(dim, "customer_zip_code_prefix", _given(geolocation))
    return dim.select(*wanted)


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    english = F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown"))
    return products.join(translation, "product_category_name", "left").select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "product_category_name",
        english.alias("product_category_name_english"),
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_height_cm",
        "product_length_cm",
        "product_width_cm",
    )


def dim_seller(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    keyed = sellers.select(surrogate_key("seller_id").alias("seller_key"), "*")
    return _geolocation_key(keyed, "seller_zip_code_prefix", geolocation).select(*keyed.columns, "geolocation_key")


# --- facts ----------------------------------------------------------------

FACT_ORDERS = [
    "order_key",
    "order_id",
    "customer_key",
    "order_date_key",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "number_of_items",
    "gross_merchandise_value",
    "total_freight_value",
    "order_total_value",
    "total_payment_value",
    "delivery_days",
    "estimated_delivery_days",
    "is_late",
    "average_review_score",
    "review_count",
    "latest_review_date",
    "customer_type",
    "first_order_timestamp",
]
_ITEM_MEASURES = {"number_of_items", "gross_merchandise_value", "total_freight_value", "order_total_value"}
_REVIEW_MEASURES = {"average_review_score", "review_count", "latest_review_date"}
_DELIVERY = {"delivery_days", "estimated_delivery_days", "is_late"}
_HISTORY = {"customer_type", "first_order_timestamp"}


def fact_orders(
    orders: DataFrame,
    columns: Iterable[str] | None = None,
    *,
    customers: Frame,
    order_items: Frame,
    order_payments: Frame,
    order_reviews: Frame,
    spread: Spread | None = None,
    keep: Keep | None = None,
) -> DataFrame:
    """One row per order.

    ``customer_key`` is the hash of the person the account belongs to. Every
    such person is a row of the customer dimension, so the dimension itself
    need not be joined. What goes by person, not by order, and the payments, which may be sums of other tables, are computed
    once by ``keep``, if given.
    """
    wanted = list(columns) if columns is not None else FACT_ORDERS
    need = set(wanted)
    out = orders
    if need & _HISTORY:
        out = order_customers(out, customers(), keep)
    elif "customer_key" in need:
        out = order_accounts(out, customers())
    if keep and need & (_HISTORY | {"customer_key"}):
        out = keep(out, "order-customers")
    key = {"order_key": surrogate_key("order_id")}

    def keyed(df: DataFrame) -> DataFrame:
        return spread(df).withColumns(key) if spread else df

    def met(df: DataFrame, measures: DataFrame) -> DataFrame:
        """Rows in the fact's layout meet by its key and stay in it."""
        return df.join(measures.drop("order_id"), "order_key", "left") if spread else df.join(measures, "order_id", "left")

    out = keyed(out)
    if need & _ITEM_MEASURES:
        rollup = order_item_rollup(keyed(order_items()), ["order_key", "order_id"] if spread else ["order_id"])
        out = met(out, rollup.withColumnRenamed("order_item_count", "number_of_items")).withColumn(
            "gross_merchandise_value", F.coalesce("order_gmv", F.lit(0).cast(TOTAL))
        )
    if "total_payment_value" in need:
        paid = order_payments().select("order_id", "total_payment_value")
        out = met(out, keyed(keep(paid, "order-payments") if keep else paid))
    if need & _REVIEW_MEASURES:
        out = met(out, keyed(order_reviews()))
    if need & _DELIVERY:
        out = delivery_metrics(out)
    if "customer_key" in need:
        out = out.withColumn("customer_key", surrogate_key("customer_unique_id"))
    if not spread:
        out = out.withColumns(key)
    return out.withColumn("order_date_key", date_key(F.col("order_purchase_timestamp"))).select(*wanted)


FACT_ORDER_ITEMS = [
    "order_item_key",
    "order_key",
    "product_key",
    "seller_key",
    "order_date_key",
    "order_item_id",
    "product_id",
    "seller_id",
    "price",
    "freight_value",
    "shipping_limit_date",
]


def fact_order_items(
    items: DataFrame,
    columns: Iterable[str] | None = None,
    *,
    orders: Frame,
    products: Frame,
    sellers: Frame,
    spread: Spread | None = None,
) -> DataFrame:
    """One row per order item; ``products`` and ``sellers`` are the dimensions.

    A dimension's key is the hash of its id, so an item needs to know no more of it than that the id is there.
    """
    wanted = list(columns) if columns is not None else FACT_ORDER_ITEMS
    key = {"order_key": surrogate_key("order_id")}
    out = spread(items).withColumns(key) if spread else items
    if "order_date_key" in wanted:
        dates = orders().select("order_id", date_key(F.col("order_purchase_timestamp")).alias("order_date_key"))
        # rows in the fact's layout meet by its key and stay in it
        out = out.join(spread(dates).withColumns(key).drop("order_id"), "order_key", "left") if spread else (
            out.join(dates, "order_id", "left")
        )
    if "product_key" in wanted:
        out = with_hashed_key(out, items, products(), "product_id", "product_key")
    if "seller_key" in wanted:
        out = with_hashed_key(out, items, sellers(), "seller_id", "seller_key")
    if not spread:
        out = out.withColumns(key)
    return out.withColumns({"order_item_key": surrogate_key("order_id", "order_item_id")}).select(*wanted)


PAYMENT_KEY = ("order_id", "payment_sequential")
REVIEW_ORDER_KEY = ("review_id", "order_id")


def _order_persons(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Person and date of each order; the person's key is hashed by the fact, where its rows lie."""
    return order_accounts(orders, customers).select(
        "order_id",
        "customer_unique_id",
        date_key(F.col("order_purchase_timestamp")).alias("order_date_key"),
    )


def fact_payments(
    payments: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    spread: Spread | None = None,
    keep: Keep | None = None,
) -> DataFrame:
    """One row per payment of an order."""
    persons = _order_persons(orders, customers)
    if keep:
        payments, persons = keep(payments, "order-payments"), keep(persons, "order-persons")
    met = payments.join(persons, "order_id", "left")
    return (spread(met) if spread else met).select(
        surrogate_key(*PAYMENT_KEY).alias("payment_key"),
        surrogate_key("order_id").alias("order_key"),
        surrogate_key("customer_unique_id").alias("customer_key"),
        "order_date_key",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def fact_reviews(
    reviews: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    spread: Spread | None = None,
    keep: Keep | None = None,
) -> DataFrame:
    """One row per review and order."""
    persons = _order_persons(orders, customers).select("order_id", "customer_unique_id")
    met = reviews.join(keep(persons, "order-persons") if keep else persons, "order_id", "left")
    return (spread(met) if spread else met).select(
        surrogate_key(*REVIEW_ORDER_KEY).alias("review_order_key"),
        surrogate_key("review_id").alias("review_key"),
        surrogate_key("order_id").alias("order_key"),
        surrogate_key("customer_unique_id").alias("customer_key"),
        date_key(F.col("review_creation_date")).alias("review_date_key"),
        "review_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )
