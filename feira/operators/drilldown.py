"""Drill-downs and dashboard views over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.domain import DAY_TYPES, REGIONS, UNKNOWN_REGION
from feira.functions.columns import TOTAL, date_key, day_type, keep_months, minus, ratio, region_of, year_month
from feira.operators import reports
from feira.operators.reports import (
    MIX_COLUMNS,
    all_order_totals,
    all_orders,
    avg_all,
    calendar,
    category_mix,
    daily_metrics,
    gmv,
    item_value,
    per_order,
    positive,
)
from feira.plans.sizing import checked_broadcast
from feira.plans.workspace import pinned
from feira.settings import Settings

CATEGORY = "product_category_name_english"
H1, H2 = "H1 (Jan-Jun)", "H2 (Jul-Dec)"


def _dated(fact: DataFrame, dim_date: DataFrame, year: int, months: tuple[int, ...]) -> DataFrame:
    """Fact rows of some months of one year, with their calendar month."""
    where = (F.col("year") == year) & F.col("month").isin(*months)
    days = calendar(dim_date, "year", "month", where=where)
    pruned = keep_months(fact, (year, min(months)), (year, max(months)))
    return pruned.join(days, F.col("order_date_key") == F.col("date_key"))


def _items_of(fact: DataFrame, start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """Items of orders bought in these months.

    An item carries its order's date, so the orders' window prunes the items as well. A view cut
    to fewer columns may lack the date; the join with the orders then does it alone.
    """
    return keep_months(fact, start, end) if "order_date_key" in fact.columns else fact


# --- spike ----------------------------------------------------------------


def order_vs_aov(
    fact_orders: DataFrame, fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Orders, value and value per order of the spike months; orders without items count."""
    orders = _dated(fact_orders, dim_date, settings.spike_year, settings.spike_months)
    by = ["year", "month"]
    year, months = settings.spike_year, settings.spike_months
    items = _items_of(fact_order_items, (year, min(months)), (year, max(months)))
    return (
        per_order(orders.select("order_key", *by), all_order_totals(items), by)
        .groupBy(year_month(F.col("year"), F.col("month")).alias("year_month"))
        .agg(all_orders().alias("orders"), gmv().alias("gmv"), avg_all().alias("avg_order_value"))
        .orderBy("year_month")
    )


def month_over_month_growth(monthly: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Percent change between two months of ``order_vs_aov``; no row when one is absent."""
    base = f"{settings.spike_year:04d}-{settings.spike_base_month:02d}"
    peak = f"{settings.spike_year:04d}-{settings.spike_month:02d}"
    names = ["orders", "gmv", "avg_order_value"]
    pair = monthly.agg(
        F.count_if(F.col("year_month") == base).alias("bases"),
        F.count_if(F.col("year_month") == peak).alias("peaks"),
        *[F.max(F.when(F.col("year_month") == base, F.col(c))).cast("double").alias(f"{c}_0") for c in names],
        *[F.max(F.when(F.col("year_month") == peak, F.col(c))).cast("double").alias(f"{c}_1") for c in names],
    ).filter((F.col("bases") > 0) & (F.col("peaks") > 0))
    return pair.select(
        F.lit(base).alias("from_month"),
        F.lit(peak).alias("to_month"),
        *[((F.try_divide(F.col(f"{c}_1"), F.col(f"{c}_0")) - 1) * 100).alias(f"{c}_growth_pct") for c in names],
    )


def daily_activity(
    fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Orders and value per day of the spike month."""
    items = _dated(fact_order_items, dim_date, settings.spike_year, (settings.spike_month,))
    return (
        items.groupBy("date_key")
        .agg(F.count_distinct("order_key").alias("order_count"), F.sum(item_value()).alias("gmv"))
        .orderBy("date_key")
    )


def peak_day(daily: DataFrame) -> DataFrame:
    """The day with the highest value, the earliest on a tie."""
    return daily.orderBy(F.desc("gmv"), "date_key").limit(1)


def category_spike(
    fact_order_items: DataFrame, dim_date: DataFrame, dim_product: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Categories that grew between two months, and their share of all growth."""
    base, peak = settings.spike_base_month, settings.spike_month
    categories = dim_product.select("product_key", CATEGORY)
    monthly = (
        _dated(fact_order_items, dim_date, settings.spike_year, (base, peak))
        .join(categories, "product_key", "left")
        .groupBy("month", F.coalesce(CATEGORY, F.lit("Unknown")).alias("product_category"))
        .agg(F.count_distinct("order_key").alias("orders"), F.sum(item_value()).alias("gmv"))
    )

    def of(month: int, value: str):
        return F.sum(F.when(F.col("month") == month, F.col(value)).otherwise(0))

    growth = pinned(
        monthly.groupBy("product_category")
        .agg(
            of(base, "gmv").alias("base_gmv"),
            of(peak, "gmv").alias("spike_gmv"),
            of(base, "orders").alias("base_orders"),
            of(peak, "orders").alias("spike_orders"),
        )
        .withColumn("gmv_increase", minus(F.col("spike_gmv"), F.col("base_gmv")))
        .filter(F.col("gmv_increase") > 0)
    )
    all_growth = growth.agg(F.sum("gmv_increase")).scalar()
    return growth.select(
        "product_category",
        "base_gmv",
        "spike_gmv",
        "gmv_increase",
        ratio(F.col("gmv_increase"), F.col("base_gmv"), factor=100).alias("growth_pct"),
        "base_orders",
        "spike_orders",
        ratio(F.col("gmv_increase"), all_growth, factor=100).alias("contribution_to_spike_pct"),
    ).orderBy(F.desc("gmv_increase"), "product_category")


def category_spike_top10(spike: DataFrame, n: int = 10) -> DataFrame:
    top = spike.orderBy(F.desc("gmv_increase"), "product_category").limit(n)
    return top.orderBy("gmv_increase", F.desc("product_category"))


# --- categories and regions -----------------------------------------------


def category_sales(
    fact_order_items: DataFrame, fact_orders: DataFrame, dim_product: DataFrame, year: int
) -> DataFrame:
    """Delivered value per month and category of one year."""
    bought = F.col("order_purchase_timestamp")
    window = (year, 1), (year, 12)
    delivered = (F.col("order_status") == "DELIVERED") & (F.year(bought) == year)
    orders = _items_of(fact_orders, *window).filter(delivered).select("order_key", F.month(bought).alias("month"))
    return (
        _items_of(fact_order_items, *window)
        .join(orders, "order_key")
        .join(dim_product.select("product_key", CATEGORY), "product_key")
        .groupBy("month", CATEGORY)
        .agg(F.sum(item_value()).alias("total_sales_value"))
    )


def monthly_state_sales(
    fact_order_items: DataFrame, fact_orders: DataFrame, dim_customer: DataFrame, years: tuple[int, ...]
) -> DataFrame:
    """Delivered value per month and customer state.

    Items are summed per order before they meet the customers.
    """
    bought = F.col("order_purchase_timestamp")
    window = (min(years), 1), (max(years), 12)
    delivered = (F.col("order_status") == "DELIVERED") & F.year(bought).isin(*years)
    orders = _items_of(fact_orders, *window).filter(delivered).select(
        "order_key", "customer_key", F.date_format(bought, "yyyy-MM").alias("month")
    )
    return (
        orders.join(all_order_totals(_items_of(fact_order_items, *window)), "order_key")
        .join(dim_customer.select("customer_key", "customer_state"), "customer_key")
        .groupBy("month", "customer_state")
        .agg(F.sum("total_order_value").alias("gmv"))
    )


def region_rollup(state_sales: DataFrame) -> DataFrame:
    """Month and region; states outside the five regions are left out."""
    return (
        state_sales.withColumn("region", region_of(F.col("customer_state"), default=None))
        .filter(F.col("region").isNotNull())
        .groupBy("month", "region")
        .agg(F.sum("gmv").alias("gmv"))
    )


def half_year_label(sales: DataFrame) -> DataFrame:
    return sales.withColumn("half_year", F.when(F.col("month") <= 6, H1).otherwise(H2))


def half_year_revenue(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("half_year", CATEGORY).agg(F.sum("total_sales_value").alias("total_revenue"))


def top10_each_month(sales: DataFrame, n: int = 10) -> DataFrame:
    """The best categories of each month; equal values rank by category name."""
    best = Window.partitionBy("month").orderBy(F.desc("total_sales_value"), CATEGORY)
    return sales.withColumn("__place", F.row_number().over(best)).filter(F.col("__place") <= n).drop("__place")


def category_frequency(top: DataFrame, by_half: bool = True) -> DataFrame:
    """Months a category was among the best, by half year or over all months."""
    keys = ["half_year", CATEGORY] if by_half else [CATEGORY]
    return top.groupBy(*keys).agg(F.count("*").alias("top_10_months"))


def category_summary(revenue: DataFrame, frequency: DataFrame) -> DataFrame:
    """Revenue with the number of months among the best, 0 when never."""
    keys = [c for c in ("half_year", CATEGORY) if c in revenue.columns]
    return revenue.join(frequency, keys, "left").withColumn(
        "top_10_months", F.coalesce("top_10_months", F.lit(0))
    )


def category_revenue(sales: DataFrame, last_month: int | None = None) -> DataFrame:
    """Revenue per category, of months up to ``last_month``."""
    kept = sales if last_month is None else sales.filter(F.col("month") <= last_month)
    return kept.groupBy(CATEGORY).agg(F.sum("total_sales_value").alias("total_revenue"))


def compare_category_revenue(
    earlier: DataFrame, later: DataFrame, years: tuple[int, int] = Settings().compare_years
) -> DataFrame:
    """Both years side by side; a category sold in one year only has 0 in the other."""
    names = [f"total_revenue_{y}" for y in years]
    joined = earlier.withColumnRenamed("total_revenue", names[0]).join(
        later.withColumnRenamed("total_revenue", names[1]), CATEGORY, "full"
    )
    zero = F.lit(0).cast(TOTAL)
    return joined.select(CATEGORY, *[F.coalesce(n, zero).alias(n) for n in names])


def category_revenue_changes(
    comparison: DataFrame, years: tuple[int, int] = Settings().compare_years, n: int = 5
) -> DataFrame:
    """The largest increases followed by the largest decreases; they overlap in a short list."""
    change = minus(F.col(f"total_revenue_{years[1]}"), F.col(f"total_revenue_{years[0]}"))
    changes = comparison.withColumn("revenue_change", change)
    up = changes.orderBy(F.desc("revenue_change"), CATEGORY).limit(n)
    down = changes.orderBy("revenue_change", CATEGORY).limit(n)
    return up.unionByName(down)


# --- holidays: dashboard variants -----------------------------------------


def holiday_impact_all_orders(
    fact_orders: DataFrame, fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Like ``holiday_impact``, with every order in the count and the average."""
    orders = reports.orders_by_day_type(fact_orders, dim_date, settings)
    items = _items_of(fact_order_items, settings.report_start, settings.report_end)
    return (
        per_order(orders, all_order_totals(items), ["day_type"])
        .groupBy("day_type")
        .agg(all_orders().alias("order_count"), gmv().alias("gmv"), avg_all().alias("avg_order_value"))
        .orderBy(F.desc("gmv"))
    )


def holiday_impact_by_quarter_all_orders(
    fact_orders: DataFrame, fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    orders = reports.orders_by_day_type(fact_orders, dim_date, settings)
    items = _items_of(fact_order_items, settings.report_start, settings.report_end)
    by = ["year_quarter", "day_type"]
    return (
        per_order(orders, all_order_totals(items), by)
        .groupBy(*by)
        .agg(all_orders().alias("order_count"), gmv().alias("gmv"), avg_all().alias("avg_order_value"))
        .orderBy(*by)
    )


def holiday_daily_metrics_all_orders(
    fact_orders: DataFrame, fact_order_items: DataFrame, dim_date: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    items = _items_of(fact_order_items, settings.report_start, settings.report_end)
    return daily_metrics(fact_orders, all_order_totals(items), dim_date, all_orders(), settings)


def holiday_category_mix_known(
    fact_order_items: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    top_n: int = Settings().top_categories,
    settings: Settings = Settings(),
) -> DataFrame:
    """Category mix of known products, dated by the item; 'Unknown' is never a top category."""
    positive("top_n", top_n)
    known = reports.report_window(settings) & F.col("is_holiday").isNotNull()
    days = calendar(dim_date, "is_holiday", where=known)
    sales = (
        reports.in_report_window(fact_order_items, settings)
        .join(days, F.col("order_date_key") == F.col("date_key"))
        .join(dim_product.select("product_key", CATEGORY), "product_key")
        .withColumns({
            "day_type": day_type(),
            "product_category": F.coalesce(CATEGORY, F.lit("Unknown")),
        })
    )
    mix = category_mix(sales, top_n, candidates=F.col("product_category") != "Unknown")
    return mix.select(MIX_COLUMNS).orderBy("product_category", "day_type")


# --- holidays: demand around an event -------------------------------------


def holiday_events(holidays: DataFrame) -> DataFrame:
    """First and last day of each holiday of a year."""
    return (
        holidays.filter(F.col("hol_date").isNotNull() & F.col("hol_name").isNotNull())
        .groupBy(F.year("hol_date").alias("year"), "hol_name")
        .agg(F.min("hol_date").alias("holiday_start"), F.max("hol_date").alias("holiday_end"))
        .withColumn("holiday_days", F.datediff("holiday_end", "holiday_start") + 1)
    )


def category_daily_sales(fact_order_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    return (
        fact_order_items.join(dim_product.select("product_key", CATEGORY), "product_key")
        .groupBy("order_date_key", CATEGORY)
        .agg(F.sum(item_value()).alias("gmv"))
    )


def holiday_window_demand(
    holidays: DataFrame, fact_order_items: DataFrame, dim_product: DataFrame, pad: int = Settings().pad_days
) -> DataFrame:
    """Daily sales per category before, during and after each holiday.

    Every event becomes one row per day of its window, which turns the range
    condition into an equality on the day. Events whose window has a day
    without any sale are left out.
    """
    event = ["year", "hol_name"]
    start, end, day = F.col("holiday_start"), F.col("holiday_end"), F.col("day")
    windows = (
        holiday_events(holidays)
        .withColumn("day", F.explode(F.sequence(F.date_sub(start, pad), F.date_add(end, pad))))
        .select(
            *event,
            "holiday_days",
            date_key(day).alias("order_date_key"),
            F.when(day < start, "before").when(day > end, "after").otherwise("holiday").alias("period"),
        )
    )
    # only days inside a window are summed, so the rest of the history is left out before the sum
    days = windows.select("order_date_key").distinct()
    on = ["order_date_key"]
    if "month_key" in fact_order_items.columns:  # the days name the folders that are opened
        days, on = days.withColumn("month_key", F.floor(F.col("order_date_key") / 100).cast("int")), [*on, "month_key"]
    sold = fact_order_items.join(checked_broadcast(days), on, "left_semi")
    # days x categories: both the completeness test and the sums read it
    sales = pinned(category_daily_sales(sold, dim_product))
    sold_days = sales.select("order_date_key").distinct()
    complete = (
        windows.join(sold_days, "order_date_key")
        .groupBy(*event, "holiday_days")
        .agg(F.count_distinct("order_date_key").alias("days"))
        .filter(F.col("days") >= F.col("holiday_days") + 2 * pad)
        .select(*event)
    )

    def during(period: str):
        return F.sum(F.when(F.col("period") == period, F.col("gmv")).otherwise(0)).alias(f"{period}_gmv")

    sums = (
        sales.join(windows.join(complete, event, "left_semi"), "order_date_key")
        .groupBy(CATEGORY, *event, "holiday_days")
        .agg(during("before"), during("holiday"), during("after"))
    )
    money = {p: F.col(f"{p}_gmv").cast("double") for p in ("before", "holiday", "after")}
    daily = sums.withColumns({
        "before_daily": money["before"] / pad,
        "holiday_daily": money["holiday"] / F.col("holiday_days"),
        "after_daily": money["after"] / pad,
    })
    change = F.col("holiday_daily") - F.col("before_daily")
    return daily.withColumns({
        "holiday_change_pct": F.try_divide(change, F.col("before_daily")) * 100,
        "holiday_change_value": change,
        "after_change_value": F.col("after_daily") - F.col("holiday_daily"),
    }).withColumnRenamed("hol_name", "holiday")


def biggest_holiday_changes(demand: DataFrame, year: int, n: int = 10) -> DataFrame:
    return (
        demand.filter(F.col("year") == year)
        .withColumn("absolute_change", F.abs("holiday_change_value"))
        .orderBy(F.desc("absolute_change"), "holiday", CATEGORY)
        .limit(n)
    )


def holiday_category_label(changes: DataFrame) -> DataFrame:
    """Chart rows: one label per holiday and category, smallest change first."""
    label = F.concat(F.col("holiday"), F.lit(" — "), F.col(CATEGORY))
    return changes.withColumn("holiday_category", label).orderBy("holiday_change_value", "holiday_category")


# --- customers ------------------------------------------------------------


def rfm_columns(rfm: DataFrame) -> DataFrame:
    """The scores under the names of the drill-downs."""
    return rfm.select(
        "customer_key",
        "customer_segment",
        F.col("recency").alias("recency_days"),
        "frequency",
        F.col("monetary").alias("monetary_value"),
        "recency_score",
        "frequency_score",
        "monetary_score",
        "rfm_code",
        F.col("rfm_total_score").alias("rfm_score"),
    )


def _named(scored: DataFrame, dim_customer: DataFrame) -> DataFrame:
    persons = dim_customer.select("customer_key", "customer_unique_id")
    rest = [c for c in scored.columns if c != "customer_key"]
    return scored.join(persons, "customer_key", "left").select("customer_key", "customer_unique_id", *rest)


def rfm_detail(rfm: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Scored customers with their person id, highest spend first."""
    # the key splits customers of equal spend over the sorted parts
    return _named(rfm_columns(rfm), dim_customer).orderBy(F.desc("monetary_value"), "customer_key")


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """What the segment figures read of the scores; no customer dimension is needed for them."""
    return rfm.select("customer_key", "customer_segment", F.col("monetary").alias("monetary_value"))


def rfm_segment_filtered(detail: DataFrame, segments: list[str]) -> DataFrame:
    """Revenue, customers and average of the chosen segments, smallest revenue first."""
    return (
        detail.filter(F.col("customer_segment").isin(segments))
        .groupBy("customer_segment")
        .agg(
            F.sum("monetary_value").alias("total_revenue"),
            F.count_distinct("customer_key").alias("customer_count"),
            ratio(F.sum("monetary_value"), F.count("monetary_value")).alias("average_customer_value"),
        )
        .orderBy("total_revenue", "customer_segment")
    )


def rfm_kpis(detail: DataFrame) -> DataFrame:
    return detail.agg(
        F.count_distinct("customer_key").alias("total_customers"),
        F.sum("monetary_value").alias("total_revenue"),
        ratio(F.sum("monetary_value"), F.count("monetary_value")).alias("average_customer_value"),
    )


def rfm_segment_list(detail: DataFrame) -> DataFrame:
    named = detail.filter(F.col("customer_segment").isNotNull())
    return named.select("customer_segment").distinct().orderBy("customer_segment")


def _best_first(metric: str):
    """Order of a list of best customers: the smallest recency, the largest of anything else."""
    return F.asc_nulls_last(metric) if metric == "recency_days" else F.desc(metric)


def top_customers(detail: DataFrame, n: int = 10, metric: str = "monetary_value") -> DataFrame:
    """Best customers by a metric; equal ones by their person id."""
    return (
        detail.orderBy(_best_first(metric), "customer_unique_id")
        .limit(n)
        .select(
            "customer_unique_id", "customer_segment", "recency_days", "frequency", "monetary_value", "rfm_score"
        )
    )


def best_customers(
    rfm: DataFrame, dim_customer: DataFrame, n: int = 10, metric: str = "monetary_value"
) -> DataFrame:
    """``top_customers`` from the scores: the n-th best value is found first, and only customers at least as good
    look up their names."""
    scored, value = rfm_columns(rfm), F.col(metric)
    smallest = metric == "recency_days"
    best = scored.select(metric).orderBy(_best_first(metric)).limit(n)
    # no bound when the list holds a customer without a value, or fewer than n
    edge = best.agg(F.when(F.count(metric) == n, F.max(metric) if smallest else F.min(metric))).scalar()
    good = scored.filter(F.coalesce(value <= edge if smallest else value >= edge, edge.isNull()))
    return top_customers(_named(good, dim_customer), n, metric)


def report_top10_view(report: DataFrame, n: int = 10) -> DataFrame:
    """Chart rows of the best customers: shortened id, smallest value first."""
    return (
        report.orderBy(F.desc("monetary_value"), "customer_key")
        .limit(n)
        .select(F.substring("customer_unique_id", 1, 12).alias("customer"), "monetary_value")
        .orderBy("monetary_value", "customer")
    )


# --- pivots ---------------------------------------------------------------


def pivot_month_region(monthly: DataFrame, month: str = "year_month") -> DataFrame:
    """Month by region matrix of value; the region list is fixed, so no pass looks for it."""
    regions = [*REGIONS, UNKNOWN_REGION]
    return monthly.groupBy(month).pivot("region", regions).agg(F.sum("gmv")).orderBy(month)


def pivot_quarter_daytype(quarterly: DataFrame, metric: str) -> DataFrame:
    """Quarter by day type matrix of one metric."""
    return quarterly.groupBy("year_quarter").pivot("day_type", DAY_TYPES).agg(F.sum(metric)).orderBy("year_quarter")


def pivot_category_daytype(mix: DataFrame) -> DataFrame:
    """Category by day type matrix of value shares, smallest combined value first."""
    shares = {d: F.sum(F.when(F.col("day_type") == d, F.col("gmv_share_pct"))) for d in DAY_TYPES}
    zero = F.lit(0).cast("decimal(38,2)")
    return (
        mix.groupBy("product_category")
        .agg(*[F.coalesce(v, zero).alias(d) for d, v in shares.items()], F.sum("gmv").alias("combined_gmv"))
        .orderBy("combined_gmv", "product_category")
    )
