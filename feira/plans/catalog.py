"""Wires raw entities through staging and intermediate models to the marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from feira.functions.columns import surrogate_key
from feira.operators import intermediate, marts, rfm, staging
from feira.plans.workspace import Keep
from feira.settings import Settings


class Catalog:
    """Frames by model name, built when asked for. Building some of them runs jobs: counted
    broadcasts, hot groups, selected ranks and stored results.

    ``entity`` and ``holidays`` supply raw frames, from files or tables alike.
    """

    def __init__(
        self,
        spark: SparkSession,
        entity: Callable[[str], DataFrame],
        holidays: Callable[[int], DataFrame],
        settings: Settings = Settings(),
    ):
        self.spark = spark
        self.entity = entity
        self.holidays = holidays
        self.settings = settings

    # staging
    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.entity("orders"))

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.entity("order_items"))

    @cached_property
    def stg_order_payments(self) -> DataFrame:
        return staging.stg_order_payments(self.entity("payments"))

    @cached_property
    def stg_order_reviews(self) -> DataFrame:
        return staging.stg_order_reviews(self.entity("reviews"))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.entity("customers"))

    @cached_property
    def stg_sellers(self) -> DataFrame:
        return staging.stg_sellers(self.entity("sellers"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.entity("products"))

    @cached_property
    def stg_category_translation(self) -> DataFrame:
        return staging.stg_category_translation(self.entity("category_translation"))

    @cached_property
    def stg_geolocation(self) -> DataFrame:
        return staging.stg_geolocation(self.entity("geolocation"))

    @cached_property
    def stg_holiday_calendar(self) -> DataFrame:
        return staging.stg_holiday_calendar(*[self.holidays(y) for y in self.settings.holiday_years])

    # intermediate
    @cached_property
    def int_order_items(self) -> DataFrame:
        return intermediate.int_order_items(self.stg_order_items)

    @cached_property
    def int_order_payments(self) -> DataFrame:
        return intermediate.int_order_payments(self.stg_order_payments)

    @cached_property
    def int_order_reviews(self) -> DataFrame:
        return intermediate.int_order_reviews(self.stg_order_reviews)

    @cached_property
    def int_geolocation(self) -> DataFrame:
        return intermediate.int_geolocation(self.stg_geolocation)

    @cached_property
    def int_customer_orders(self) -> DataFrame:
        return intermediate.int_customer_orders(self.stg_orders, self.stg_customers)

    @cached_property
    def int_orders(self) -> DataFrame:
        return intermediate.int_orders(
            self.stg_orders,
            self.int_order_items,
            self.int_order_payments,
            self.int_customer_orders,
            self.int_order_reviews,
        )

    # dimensions
    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark, self.stg_holiday_calendar, self.settings)

    @cached_property
    def dim_geolocation(self) -> DataFrame:
        return marts.dim_geolocation(self.int_geolocation)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.customers()

    def customers(self, columns: Iterable[str] | None = None) -> DataFrame:
        """The customer dimension, built only as far as ``columns`` need it."""
        return marts.dim_customer(
            self.stg_customers, lambda: self.stg_orders, lambda: self.dim_geolocation, columns
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        return marts.dim_product(self.stg_products, self.stg_category_translation)

    @cached_property
    def dim_seller(self) -> DataFrame:
        return marts.dim_seller(self.stg_sellers, self.dim_geolocation)

    @cached_property
    def seller_keys(self) -> DataFrame:
        """Sellers and their keys; a location is one row per ZIP, so it neither adds nor drops any."""
        return self.stg_sellers.select("seller_id", surrogate_key("seller_id").alias("seller_key"))

    # facts
    def fact_orders(
        self, columns: Iterable[str] | None = None, spread: marts.Spread | None = None, keep: Keep | None = None
    ) -> DataFrame:
        return marts.fact_orders(
            self.stg_orders,
            columns,
            spread=spread,
            keep=keep,
            customers=lambda: self.stg_customers,
            order_items=lambda: self.int_order_items,
            order_payments=lambda: self.int_order_payments,
            order_reviews=lambda: self.int_order_reviews,
        )

    def fact_order_items(self, columns: Iterable[str] | None = None, spread: marts.Spread | None = None) -> DataFrame:
        return marts.fact_order_items(
            self.int_order_items,
            columns,
            spread=spread,
            orders=lambda: self.stg_orders,
            products=lambda: self.dim_product,
            sellers=lambda: self.seller_keys,
        )

    @cached_property
    def fact_payments(self) -> DataFrame:
        return marts.fact_payments(self.stg_order_payments, self.stg_orders, self.stg_customers)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return marts.fact_reviews(self.stg_order_reviews, self.stg_orders, self.stg_customers)

    @cached_property
    def fct_customer_rfm(self) -> DataFrame:
        orders = self.fact_orders(
            ["customer_key", "order_id", "order_status", "order_purchase_timestamp", "gross_merchandise_value"]
        )
        return rfm.fct_customer_rfm(orders, self.settings.analysis_date)

    def bucketed_fact(self, name: str, buckets: int, keep: Keep | None = None) -> DataFrame:
        """A fact in the layout of its buckets. Its rows are moved once, before their keys are hashed.

        With ``keep``, what does not go by order is stored, so that buckets can be taken a few at a time: a filter of
        the order's key then reaches all that is moved.
        """

        def spread(df: DataFrame) -> DataFrame:
            return df.repartition(buckets, surrogate_key("order_id"))

        if name == "fact_payments":
            return marts.fact_payments(self.stg_order_payments, self.stg_orders, self.stg_customers, spread, keep)
        if name == "fact_reviews":
            return marts.fact_reviews(self.stg_order_reviews, self.stg_orders, self.stg_customers, spread, keep)
        if name == "fact_orders":
            return self.fact_orders(spread=spread, keep=keep)
        return getattr(self, name)(spread=spread)

    def model(self, name: str) -> DataFrame:
        value = getattr(self, name)
        return value() if callable(value) and not isinstance(value, DataFrame) else value


class MartTables:
    """The marts read back from their tables, with the same names as ``Catalog``."""

    def __init__(self, read: Callable[[str], DataFrame], settings: Settings = Settings()):
        self.read = read
        self.settings = settings

    def fact_orders(self, columns: Iterable[str] | None = None) -> DataFrame:
        df = self.read("fact_orders")
        return df if columns is None else df.select(*columns)

    def fact_order_items(self, columns: Iterable[str] | None = None) -> DataFrame:
        df = self.read("fact_order_items")
        return df if columns is None else df.select(*columns)

    def model(self, name: str) -> DataFrame:
        return self.read(name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith(("dim_", "fact_", "fct_", "stg_")):
            return self.read(name)
        raise AttributeError(name)
