"""The published reports over the marts.

Order values are summed per order before they meet the orders, and every
distinct order count is taken after one row per order remains, so no report
needs the row-multiplying plan of several distinct aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.functions.columns import (
    TOTAL,
    day_type,
    in_months,
    keep_months,
    ratio,
    region_of,
    year_month,
    year_quarter,
)
from feira.plans.sizing import checked_broadcast
from feira.plans.workspace import pinned
from feira.settings import Settings


def item_value() -> Column:
    return F.col("price") + F.col("freight_value")


def positive(name: str, value: int) -> int:
    if int(value) <= 0:
        raise ValueError(f"{name} must be greater than 0")
    return int(value)


def calendar(dim_date: DataFrame, *columns: str, where: Column | None = None) -> DataFrame:
    """Calendar rows to join to facts, broadcast when their count allows it.

    The calendar spans the days of ``Settings``; a shuffle of a fact by day
    would meet hot days.
    """
    days = dim_date if where is None else dim_date.filter(where)
    return checked_broadcast(days.select("date_key", *columns))


def report_window(settings: Settings) -> Column:
    return in_months(F.col("year"), F.col("month"), settings.report_start, settings.report_end)


def in_report_window(fact: DataFrame, settings: Settings) -> DataFrame:
    """The calendar filter again, on the fact's own date key, where the scan can use it."""
    return keep_months(fact, settings.report_start, settings.report_end)


def order_totals(fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Price plus freight per order inside the report window."""
    days = calendar(dim_date, where=report_window(settings)).withColumnRenamed("date_key", "order_date_key")
    return (
        in_report_window(fact_order_items, settings)
        .join(days, "order_date_key")
        .groupBy("order_key")
        .agg(F.sum(item_value()).alias("total_order_value"))
    )


def all_order_totals(fact_order_items: DataFrame) -> DataFrame:
    """Price plus freight per order, whatever its date."""
    return fact_order_items.groupBy("order_key").agg(F.sum(item_value()).alias("total_order_value"))


def per_order(orders: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    """One row per order and ``by``: value, rows with a value, rows.

    Grouping starts with the join key, so it needs no exchange after the join.
    """
    return (
        orders.join(totals, "order_key", "left")
        .groupBy("order_key", *by)
        .agg(
            F.sum("total_order_value").alias("value"),
            F.count("total_order_value").alias("valued"),
            F.count("*").alias("rows"),
        )
    )


def _keyed() -> Column:
    return F.col("order_key").isNotNull()


def orders_with_items() -> Column:
    return F.count_if(_keyed() & (F.col("valued") > 0))


def orders_without_items() -> Column:
    return F.count_if(_keyed() & (F.col("rows") > F.col("valued")))


def all_orders() -> Column:
    return F.count_if(_keyed())


def gmv() -> Column:
    return F.sum("value")


def avg_valued() -> Column:
    """Average over the orders that have items."""
    return ratio(F.sum("value"), F.sum("valued"))


def avg_all() -> Column:
    """Value per order, orders without items included."""
    return ratio(F.sum("value"), all_orders())


def monthly_sales_trend(
    fact_orders: DataFrame,
    fact_order_items: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Orders, value and average order value per month and customer region."""
    days = calendar(dim_date, "year", "month", where=report_window(settings))
    states = dim_customer.select("customer_key", "customer_state")
    orders = (
        in_report_window(fact_orders, settings)
        .join(days, F.col("order_date_key") == F.col("date_key"))
        .join(states, "customer_key", "left")
        .withColumn("region", region_of(F.col("customer_state")))
        .select("order_key", "year", "month", "region")
    )
    return (
        per_order(orders, order_totals(fact_order_items, dim_date, settings), ["year", "month", "region"])
        .groupBy(year_month(F.col("year"), F.col("month")).alias("year_month"), "region")
        .agg(
            orders_with_items().alias("order_count"),
            orders_without_items().alias("orders_missing_items"),
            gmv().alias("gmv"),
            avg_valued().alias("avg_order_value"),
        )
        .orderBy("year_month", "region")
    )


def rfm_analysis(
    rfm: DataFrame, dim_customer: DataFrame, limit: int = Settings().top_customers
) -> DataFrame:
    """The customers with the highest spend and where they live."""
    limit = positive("limit", limit)
    top = rfm.orderBy(F.desc("monetary"), "customer_key").limit(limit)
    places = dim_customer.select("customer_key", "customer_unique_id", "customer_state", "customer_city")
    # at most ``limit`` keys reduce the dimension before the outer join
    places = places.join(checked_broadcast(top.select("customer_key")), "customer_key", "left_semi")
    return (
        top.join(places, "customer_key", "left")
        .select(
            "customer_key",
            "customer_unique_id",
            "customer_segment",
            F.col("recency").alias("recency_days"),
            "frequency",
            F.col("monetary").alias("monetary_value"),
            "recency_score",
            "frequency_score",
            "monetary_score",
            "rfm_code",
            F.col("rfm_total_score").alias("rfm_score"),
            "customer_state",
            "customer_city",
        )
        .orderBy(F.desc("monetary_value"), "customer_key")
    )


def rfm_segment_summary(rfm: DataFrame) -> DataFrame:
    """Size, averages and shares per segment."""
    # the whole-table window runs over the nine segment rows only
    everything = Window.partitionBy()
    segments = (
        rfm.filter(F.col("customer_segment").isNotNull())
        .groupBy("customer_segment")
        .agg(
            F.count("*").alias("customer_count"),
            F.sum("recency").alias("recency"),
            F.count("recency").alias("dated"),
            F.sum("frequency").alias("frequency"),
            F.sum("monetary").alias("total_revenue"),
        )
    )
    n = F.col("customer_count")
    return segments.select(
        "customer_segment",
        "customer_count",
        ratio(F.col("recency"), F.col("dated"), 1).alias("avg_recency_days"),
        ratio(F.col("frequency"), n).alias("avg_frequency"),
        ratio(F.col("total_revenue"), n).alias("avg_monetary_value"),
        "total_revenue",
        ratio(n, F.sum(n).over(everything), factor=100).alias("pct_customers"),
        ratio(F.col("total_revenue"), F.sum("total_revenue").over(everything), factor=100).alias("pct_revenue"),
    ).orderBy(F.desc("total_revenue"), "customer_segment")


def orders_by_day_type(fact_orders: DataFrame, dim_date: DataFrame, settings: Settings) -> DataFrame:
    known = report_window(settings) & F.col("is_holiday").isNotNull()
    days = calendar(dim_date, "year", "quarter", "is_holiday", where=known)
    return (
        in_report_window(fact_orders, settings)
        .join(days, F.col("order_date_key") == F.col("date_key"))
        .select(
            "order_key",
            day_type().alias("day_type"),
            year_quarter(F.col("year"), F.col("quarter")).alias("year_quarter"),
        )
    )


def holiday_impact(
    fact_orders: DataFrame, fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Orders with items, value and average order value of holidays and other days."""
    orders = orders_by_day_type(fact_orders, dim_date, settings)
    return (
        per_order(orders, order_totals(fact_order_items, dim_date, settings), ["day_type"])
        .groupBy("day_type")
        .agg(orders_with_items().alias("order_count"), gmv().alias("gmv"), avg_valued().alias("avg_order_value"))
        .orderBy(F.desc("gmv"))
    )


def holiday_impact_by_quarter(
    fact_orders: DataFrame, fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """``holiday_impact`` per quarter."""
    orders = orders_by_day_type(fact_orders, dim_date, settings)
    by = ["year_quarter", "day_type"]
    return (
        per_order(orders, order_totals(fact_order_items, dim_date, settings), by)
        .groupBy(*by)
        .agg(orders_with_items().alias("order_count"), gmv().alias("gmv"), avg_valued().alias("avg_order_value"))
        .orderBy(*by)
    )


def daily_metrics(
    fact_orders: DataFrame, totals: DataFrame, dim_date: DataFrame, orders: Column, settings: Settings
) -> DataFrame:
    """Per quarter and day type; calendar days without orders stay in the averages."""
    by_day = (
        per_order(in_report_window(fact_orders, settings), totals, ["order_date_key"])
        .groupBy("order_date_key")
        .agg(orders.alias("orders"), gmv().alias("gmv"))
    )
    known = report_window(settings) & F.col("is_holiday").isNotNull()
    days = dim_date.filter(known).select(
        "date_key",
        year_quarter(F.col("year"), F.col("quarter")).alias("year_quarter"),
        day_type().alias("day_type"),
    )
    no_money = F.lit(0).cast(TOTAL)
    return (
        days.join(by_day, F.col("date_key") == F.col("order_date_key"), "left")
        .groupBy("year_quarter", "day_type")
        .agg(
            F.count("*").alias("day_count"),
            F.sum(F.coalesce("orders", F.lit(0))).alias("total_orders"),
            F.sum(F.coalesce("gmv", no_money)).alias("total_gmv"),
        )
        .select(
            "*",
            ratio(F.col("total_orders"), F.col("day_count")).alias("avg_orders_per_day"),
            ratio(F.col("total_gmv"), F.col("day_count")).alias("avg_gmv_per_day"),
        )
        .orderBy("year_quarter", "day_type")
    )


def holiday_daily_metrics_by_quarter(
    fact_orders: DataFrame, fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Orders with items and value per calendar day."""
    totals = order_totals(fact_order_items, dim_date, settings)
    return daily_metrics(fact_orders, totals, dim_date, orders_with_items(), settings)


def category_mix(sales: DataFrame, top_n: int, candidates: Column | None = None) -> DataFrame:
    """Share of each category within its day type, for the ``top_n`` categories by value.

    ``sales`` holds day_type, product_category, order_key and the item's money.
    The per-category sums are computed once and pinned, because both totals and
    the ranking read them.
    """
    stats = pinned(
        sales.groupBy("day_type", "product_category").agg(
            F.count("*").alias("units_sold"),
            F.count_distinct("order_key").alias("order_count"),
            F.sum(item_value()).alias("gmv"),
        )
    )
    # two day types, top_n categories: both sides have a fixed size
    day_totals = F.broadcast(stats.groupBy("day_type").agg(F.sum("gmv").alias("day_gmv")))
    ranked = (stats if candidates is None else stats.filter(candidates)).groupBy("product_category")
    top = F.broadcast(
        ranked.agg(F.sum("gmv").alias("combined_gmv"))
        .orderBy(F.desc("combined_gmv"), "product_category")
        .limit(positive("top_n", top_n))
    )
    return (
        stats.join(day_totals, "day_type")
        .join(top, "product_category")
        .select(
            "day_type",
            "product_category",
            "units_sold",
            "order_count",
            "gmv",
            ratio(F.col("gmv"), F.col("day_gmv"), factor=100).alias("gmv_share_pct"),
            "combined_gmv",
        )
    )


MIX_COLUMNS = ["day_type", "product_category", "units_sold", "order_count", "gmv", "gmv_share_pct"]


def holiday_product_category_mix(
    fact_orders: DataFrame,
    fact_order_items: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    top_n: int = Settings().top_categories,
    settings: Settings = Settings(),
) -> DataFrame:
    """Category mix of holidays and other days, dated by the order."""
    positive("top_n", top_n)
    orders = orders_by_day_type(fact_orders, dim_date, settings).select("order_key", "day_type")
    categories = dim_product.select("product_key", "product_category_name_english")
    # an item carries its order's date; a view cut to fewer columns may lack it
    dated = "order_date_key" in fact_order_items.columns
    items = in_report_window(fact_order_items, settings) if dated else fact_order_items
    sales = (
        items.join(orders, "order_key")
        .join(categories, "product_key", "left")
        .withColumn("product_category", F.coalesce("product_category_name_english", F.lit("Unknown")))
    )
    return category_mix(sales, top_n).orderBy(F.desc("combined_gmv"), "product_category", "day_type").select(MIX_COLUMNS)
