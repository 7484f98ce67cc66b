"""One DuckDB query per registered query."""

from __future__ import annotations

from feira.domain import REGIONS
from feira.operators import expectations, model_tests
from feira.operators.contract import REPORT_COLUMNS
from feira.operators.expectations import CRITICAL, MART, OBSERVATION, Check
from feira.registry import BEST, CHECK_KINDS, MART_CHECKS, PROFILE_KEYS, PROFILED, RAW_CHECKS, SEGMENTS, STAGING_CHECKS, STAGING_OF
from feira.schemas import ENTITIES
from feira.sources.driver_tables import SETTINGS
from oracle.ctes import half_up, quoted, region_case, with_ctes

S = SETTINGS
Y0, Y1 = S.compare_years
ORACLE: dict[str, str] = {}
# report-sized sub-queries that several selects build on
VIEWS: dict[str, str] = {}


def show(body: str, double: str = "", text: str = "", bigint: str = "", integer: str = "") -> str:
    """Same exchange types as the Spark side: double, text, bigint and int columns."""
    casts = [f"CAST({c} AS {t}) AS {c}" for names, t in
             ((double, "DOUBLE"), (text, "VARCHAR"), (bigint, "BIGINT"), (integer, "INTEGER"))
             for c in names.split()]
    replaced = f" REPLACE ({', '.join(casts)})" if casts else ""
    return with_ctes(f"SELECT *{replaced} FROM ({body.strip()}) q", VIEWS)


def add(name: str, body: str, **casts: str) -> None:
    ORACLE[name] = show(body, **casts)


MOMENTS = ("order_purchase_timestamp order_approved_at order_delivered_carrier_date "
           "order_delivered_customer_date order_estimated_delivery_date")
ORDER_MONEY = "order_total_value total_freight_value total_payment_value"

# --- sources and sinks ------------------------------------------------------

add("src_csv", """
SELECT 'R' || (o_orderkey // 2) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
  CAST(1 + o_orderkey % 5 AS VARCHAR) AS review_score,
  CASE WHEN o_orderkey % 8 = 0 THEN ' title ' || o_orderkey END AS review_comment_title,
  CASE WHEN o_orderkey % 2 <> 0 THEN 'message, "' || o_orderkey || '"' || chr(10) || 'second line ' END
    AS review_comment_message,
  CAST(o_orderdate + INTERVAL 20 DAY AS VARCHAR) AS review_creation_date,
  CAST(o_orderdate + INTERVAL 22 DAY AS VARCHAR) AS review_answer_timestamp
FROM orders WHERE o_orderkey % 10 <> 0""")
add("src_json_records", "SELECT date, name, type, weekday FROM raw_holidays")
add("src_table", "SELECT * FROM stg_orders", text=MOMENTS)
def fingerprint(table: str, source: str, numbers: str, others: str) -> str:
    """Rows, columns, sum and exclusive or of row hashes over canonical text, columns by name."""
    names = sorted([(c, True) for c in numbers.split()] + [(c, False) for c in others.split()])
    texts = [f"CAST(CAST({c} AS DECIMAL(38,9)) AS VARCHAR)" if n else f"CAST({c} AS VARCHAR)" for c, n in names]
    row = "concat_ws('|', " + ", ".join(f"COALESCE({t}, '~')" for t in texts) + ")"
    return (
        f"SELECT '{table}' AS \"table\", COUNT(*) AS rows, {len(names)} AS columns, "
        f"CAST(COALESCE(SUM(h), 0) AS VARCHAR) AS hash_sum, COALESCE(bit_xor(h), 0) AS hash_xor "
        f"FROM (SELECT CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT) AS h FROM {source})"
    )


def fingerprints(tables: dict[str, tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(fingerprint(t, *spec) for t, spec in tables.items())


_SIZES = "product_weight_g product_height_cm product_length_cm product_width_cm"
_RAW_VALUES = {
    "orders": ("raw_orders", "", "order_id customer_id order_status " + MOMENTS),
    "order_items": ("stg_order_items", "order_item_id price freight_value", "order_id product_id seller_id shipping_limit_date"),
    "customers": ("raw_customers", "", "customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state"),
    "sellers": ("raw_sellers", "", "seller_id seller_zip_code_prefix seller_city seller_state"),
    "products": ("raw_products", "product_name_lenght product_description_lenght product_photos_qty " + _SIZES,
                 "product_id product_category_name"),
    "category_translation": ("raw_translation", "", "product_category_name product_category_name_english"),
    "geolocation": ("raw_geolocation", "geolocation_lat geolocation_lng",
                    "geolocation_zip_code_prefix geolocation_city geolocation_state"),
    "payments": ("stg_order_payments", "payment_sequential payment_installments payment_value", "order_id payment_type"),
    "reviews": ("raw_reviews", "review_score", "review_id order_id review_comment_title review_comment_message "
                "review_creation_date review_answer_timestamp"),
}
add("sink_raw_load", fingerprints(_RAW_VALUES))


def _as_text(table: str) -> tuple[str, str, str]:
    """From CSV every column is text: money with its nine decimals, other numbers as they are."""
    source, numbers, others = _RAW_VALUES[table]
    money = [c for c in numbers.split() if c in ("price", "freight_value", "payment_value")]
    plain = [c for c in numbers.split() if c not in money]
    if table == "geolocation":
        points = ", ".join(f"CAST({c} AS DECIMAL(9,1)) AS {c}" for c in plain)
        source = f"(SELECT * REPLACE ({points}) FROM {source})"
    return source, " ".join(money), " ".join([*plain, others])


add("src_csv_entities", fingerprints({t: _as_text(t) for t in _RAW_VALUES}))
# the staging layer under raw names: what differs from the raw layer's own values
_STAGED_VALUES = {
    **{t: spec for t, spec in _RAW_VALUES.items() if t != "category_translation"},
    "orders": ("(SELECT * REPLACE (lower(order_status) AS order_status) FROM stg_orders)", *_RAW_VALUES["orders"][1:]),
    "customers": ("stg_customers", *_RAW_VALUES["customers"][1:]),
    "sellers": ("stg_sellers", *_RAW_VALUES["sellers"][1:]),
    "products": ("(SELECT * RENAME (product_name_length AS product_name_lenght, "
                 "product_description_length AS product_description_lenght) FROM stg_products)", *_RAW_VALUES["products"][1:]),
    "geolocation": ("(SELECT * RENAME (latitude AS geolocation_lat, longitude AS geolocation_lng, city AS geolocation_city, "
                    "state AS geolocation_state) FROM stg_geolocation)", *_RAW_VALUES["geolocation"][1:]),
    "reviews": ("stg_order_reviews", *_RAW_VALUES["reviews"][1:]),
    "holidays": ("stg_holiday_calendar", "", "hol_date hol_name hol_type hol_day"),
}
add("src_layer_frames", " UNION ALL ".join(
    f"SELECT *, '{layer}' AS layer FROM ({fingerprints(spec)})"
    for layer, spec in (
        ("raw", {t: v for t, v in _RAW_VALUES.items() if t != "category_translation"}), ("staging", _STAGED_VALUES),
    )))
add("sink_mart", fingerprints({
    "dim_date": ("dim_date", "date_key day week month quarter year", "date day_of_week month_name is_weekend is_month_end "
                 "is_quarter_end is_year_end is_holiday holiday_name holiday_type holiday_weekday"),
    "dim_geolocation": ("dim_geolocation", "latitude longitude", "geolocation_key zip_code_prefix city state region"),
    "dim_customer": ("dim_customer", "", "customer_key customer_id customer_unique_id customer_zip_code_prefix customer_city "
                     "customer_state customer_first_order_date geolocation_key"),
    "dim_product": ("dim_product", "product_name_length product_description_length product_photos_qty " + _SIZES,
                    "product_key product_id product_category_name product_category_name_english"),
    "dim_seller": ("dim_seller", "", "seller_key seller_id seller_zip_code_prefix seller_city seller_state geolocation_key"),
    "fact_orders": ("fact_orders", "order_date_key number_of_items gross_merchandise_value delivery_days estimated_delivery_days "
                    "average_review_score review_count " + ORDER_MONEY,
                    "order_key order_id customer_key order_status is_late latest_review_date customer_type "
                    "first_order_timestamp " + MOMENTS),
    "fact_order_items": ("fact_order_items", "order_date_key order_item_id price freight_value",
                         "order_item_key order_key product_key seller_key product_id seller_id shipping_limit_date"),
    "fact_payments": ("fact_payments", "order_date_key payment_sequential payment_installments payment_value",
                      "payment_key order_key customer_key payment_type"),
    "fact_reviews": ("fact_reviews", "review_date_key review_score", "review_order_key review_key order_key customer_key "
                     "review_id review_comment_title review_comment_message review_creation_date review_answer_timestamp"),
    "fct_customer_rfm": ("fct_customer_rfm", "recency frequency monetary recency_score frequency_score monetary_score "
                         "rfm_total_score", "customer_key analysis_date rfm_code customer_segment"),
}))

# --- staging, intermediate, marts -------------------------------------------

add("stg_orders", "SELECT * FROM stg_orders", text=MOMENTS)
add("stg_order_items", "SELECT * FROM stg_order_items", double="price freight_value", text="shipping_limit_date")
add("stg_order_payments", "SELECT * FROM stg_order_payments", double="payment_value")
add("stg_order_reviews", "SELECT * FROM stg_order_reviews", text="review_creation_date review_answer_timestamp")
add("stg_customers", "SELECT * FROM stg_customers")
add("stg_sellers", "SELECT * FROM stg_sellers")
add("stg_products", "SELECT * FROM stg_products",
    double="product_weight_g product_length_cm product_height_cm product_width_cm")
add("stg_category_translation", "SELECT * FROM stg_category_translation")
add("stg_geolocation", "SELECT * FROM stg_geolocation", double="latitude longitude")
add("stg_holiday_calendar", "SELECT * FROM stg_holiday_calendar", text="hol_date")
add("int_order_items", "SELECT * FROM int_order_items",
    double="price freight_value item_total_value", text="shipping_limit_date")
add("int_order_payments", "SELECT * FROM int_order_payments", double="total_payment_value")
add("int_order_reviews", "SELECT * FROM int_order_reviews", text="latest_review_date")
add("int_geolocation", "SELECT * FROM int_geolocation", double="latitude longitude")
add("int_customer_orders", "SELECT * FROM int_customer_orders", text="order_purchase_timestamp first_order_timestamp")
add("int_orders", "SELECT * FROM int_orders",
    double="order_gmv " + ORDER_MONEY, text=MOMENTS + " latest_review_date first_order_timestamp")
add("order_item_rollup", "SELECT * FROM order_item_rollup", double="order_gmv total_freight_value order_total_value")
add("customer_type", "SELECT order_id, customer_unique_id, first_order_timestamp, customer_type FROM int_orders",
    text="first_order_timestamp")
add("delivery_metrics", "SELECT order_id, delivery_days, estimated_delivery_days, is_late FROM int_orders")
add("dim_date", "SELECT * FROM dim_date", text="date", integer="day week month quarter year")
add("dim_geolocation", "SELECT * FROM dim_geolocation", double="latitude longitude")
add("dim_customer", "SELECT * FROM dim_customer", text="customer_first_order_date")
add("dim_product", "SELECT * FROM dim_product",
    double="product_weight_g product_length_cm product_height_cm product_width_cm")
add("dim_seller", "SELECT * FROM dim_seller")
add("fact_orders", "SELECT * FROM fact_orders",
    double="gross_merchandise_value " + ORDER_MONEY, text=MOMENTS + " latest_review_date first_order_timestamp")
add("fact_order_items", "SELECT * FROM fact_order_items", double="price freight_value", text="shipping_limit_date")
add("fact_payments", "SELECT * FROM fact_payments", double="payment_value")
add("fact_reviews", "SELECT * FROM fact_reviews", text="review_creation_date review_answer_timestamp")
add("fct_customer_rfm", "SELECT * FROM fct_customer_rfm", double="monetary", text="analysis_date")
add("rfm_metrics", "SELECT * FROM rfm_metrics", double="monetary", text="analysis_date")
add("rfm_percentile_scores", "SELECT customer_key, recency_score, monetary_score FROM rfm_scored")
add("rfm_frequency_band", "SELECT customer_key, frequency, frequency_score FROM rfm_scored")
add("rfm_segment", "SELECT customer_key, rfm_code, rfm_total_score, customer_segment FROM fct_customer_rfm")

# --- published reports ------------------------------------------------------

_WITH_ITEMS = "COUNT(DISTINCT CASE WHEN t.total_order_value IS NOT NULL THEN f.order_id END)"
_MISSING = "COUNT(DISTINCT CASE WHEN t.total_order_value IS NULL THEN f.order_id END)"
_AVG_VALUED = half_up("SUM(t.total_order_value)", "COUNT(t.total_order_value)")
_AVG_ALL = half_up("SUM(t.total_order_value)", "COUNT(DISTINCT f.order_id)")

add("order_totals", "SELECT * FROM order_totals", double="total_order_value")
VIEWS["monthly_trend"] = f"""
SELECT printf('%04d-%02d', d.year, d.month) AS year_month, {region_case('c.customer_state')} AS region,
  {_WITH_ITEMS} AS order_count, {_MISSING} AS orders_missing_items, SUM(t.total_order_value) AS gmv,
  {_AVG_VALUED} AS avg_order_value
FROM fact_orders f
JOIN dim_date d ON f.order_date_key = d.date_key
LEFT JOIN dim_customer c ON f.customer_key = c.customer_key
LEFT JOIN order_totals t ON f.order_key = t.order_key
WHERE (d.year = {S.report_start[0]} AND d.month >= {S.report_start[1]})
   OR (d.year = {S.report_end[0]} AND d.month <= {S.report_end[1]})
GROUP BY ALL"""
add("monthly_sales_trend", "SELECT * FROM monthly_trend", double="gmv avg_order_value")
add("marts_monthly_sales_trend", "SELECT * FROM monthly_trend", double="gmv avg_order_value")
VIEWS["rfm_named"] = """
SELECT r.customer_key, c.customer_unique_id, r.customer_segment, r.recency AS recency_days, r.frequency,
  r.monetary AS monetary_value, r.recency_score, r.frequency_score, r.monetary_score, r.rfm_code,
  r.rfm_total_score AS rfm_score, c.customer_state, c.customer_city
FROM fct_customer_rfm r LEFT JOIN dim_customer c ON r.customer_key = c.customer_key"""
VIEWS["rfm_top"] = f"SELECT * FROM rfm_named ORDER BY monetary_value DESC, customer_key LIMIT {S.top_customers}"
add("rfm_analysis", "SELECT * FROM rfm_top", double="monetary_value")
VIEWS["segment_summary"] = f"""
SELECT customer_segment, COUNT(*) AS customer_count,
  {half_up('SUM(recency)', 'COUNT(recency)', 1)} AS avg_recency_days,
  {half_up('SUM(frequency)', 'COUNT(*)')} AS avg_frequency,
  {half_up('SUM(monetary)', 'COUNT(*)')} AS avg_monetary_value, SUM(monetary) AS total_revenue,
  {half_up('COUNT(*)', '(SELECT COUNT(*) FROM fct_customer_rfm)', factor=100)} AS pct_customers,
  {half_up('SUM(monetary)', '(SELECT SUM(monetary) FROM fct_customer_rfm)', factor=100)} AS pct_revenue
FROM fct_customer_rfm GROUP BY customer_segment"""
add("rfm_segment_summary", "SELECT * FROM segment_summary", double="total_revenue")

_DAYS = "FROM fact_orders f JOIN known_days d ON f.order_date_key = d.date_key"
for _suffix, _totals, _orders, _average in (
    ("", "order_totals", _WITH_ITEMS, _AVG_VALUED),
    ("_all_orders", "all_order_totals", "COUNT(DISTINCT f.order_id)", _AVG_ALL),
):
    for _name, _by in (("holiday_impact", "d.day_type"), ("holiday_impact_by_quarter", "d.year_quarter, d.day_type")):
        VIEWS[f"v_{_name}{_suffix}"] = f"""
SELECT {_by}, {_orders} AS order_count, SUM(t.total_order_value) AS gmv, {_average} AS avg_order_value
{_DAYS} LEFT JOIN {_totals} t ON f.order_key = t.order_key GROUP BY {_by}"""
        add(f"{_name}{_suffix}", f"SELECT * FROM v_{_name}{_suffix}", double="gmv avg_order_value")
    VIEWS[f"daily{_suffix}"] = f"""
SELECT f.order_date_key, {_orders} AS order_count, SUM(t.total_order_value) AS gmv
FROM fact_orders f LEFT JOIN {_totals} t ON f.order_key = t.order_key GROUP BY f.order_date_key"""
    VIEWS[f"v_holiday_daily{_suffix}"] = f"""
SELECT d.year_quarter, d.day_type, COUNT(*) AS day_count, SUM(COALESCE(o.order_count, 0)) AS total_orders,
  SUM(COALESCE(o.gmv, 0)) AS total_gmv,
  {half_up('SUM(COALESCE(o.order_count, 0))', 'COUNT(*)')} AS avg_orders_per_day,
  {half_up('SUM(COALESCE(o.gmv, 0))', 'COUNT(*)')} AS avg_gmv_per_day
FROM known_days d LEFT JOIN daily{_suffix} o ON d.date_key = o.order_date_key GROUP BY d.year_quarter, d.day_type"""
    add("holiday_daily_metrics_by_quarter" if not _suffix else "holiday_daily_metrics_all_orders",
        f"SELECT * FROM v_holiday_daily{_suffix}", double="total_gmv", bigint="total_orders")

VIEWS["mix_sales"] = """
SELECT d.day_type, COALESCE(p.product_category_name_english, 'Unknown') AS product_category, i.order_key,
  i.price + i.freight_value AS value
FROM fact_order_items i
JOIN fact_orders f ON i.order_key = f.order_key
JOIN known_days d ON f.order_date_key = d.date_key
LEFT JOIN dim_product p ON i.product_key = p.product_key"""
VIEWS["mix_known"] = """
SELECT d.day_type, COALESCE(p.product_category_name_english, 'Unknown') AS product_category, i.order_key,
  i.price + i.freight_value AS value
FROM fact_order_items i
JOIN dim_product p ON i.product_key = p.product_key
JOIN known_days d ON i.order_date_key = d.date_key"""
for _name, _sales, _where in (
    ("holiday_product_category_mix", "mix_sales", ""),
    ("holiday_category_mix_known", "mix_known", "WHERE product_category <> 'Unknown'"),
):
    VIEWS[f"{_sales}_stats"] = f"""
SELECT day_type, product_category, COUNT(*) AS units_sold, COUNT(DISTINCT order_key) AS order_count,
  SUM(value) AS gmv FROM {_sales} GROUP BY day_type, product_category"""
    VIEWS[f"{_sales}_shares"] = f"""
SELECT *, SUM(gmv) OVER (PARTITION BY day_type) AS day_gmv FROM {_sales}_stats"""
    VIEWS[f"{_sales}_top"] = f"""
SELECT product_category FROM {_sales}_stats {_where} GROUP BY product_category
ORDER BY SUM(gmv) DESC, product_category LIMIT {S.top_categories}"""
    VIEWS[f"v_{_name}"] = f"""
SELECT day_type, product_category, units_sold, order_count, gmv, {half_up('gmv', 'day_gmv', factor=100)} AS gmv_share_pct
FROM {_sales}_shares WHERE product_category IN (SELECT product_category FROM {_sales}_top)"""
    add(_name, f"SELECT * FROM v_{_name}", double="gmv")

# --- spike ------------------------------------------------------------------

VIEWS["v_order_vs_aov"] = f"""
SELECT printf('%04d-%02d', d.year, d.month) AS year_month, COUNT(DISTINCT f.order_id) AS orders,
  SUM(t.total_order_value) AS gmv, {_AVG_ALL} AS avg_order_value
FROM fact_orders f JOIN dim_date d ON f.order_date_key = d.date_key
LEFT JOIN all_order_totals t ON f.order_key = t.order_key
WHERE d.year = {S.spike_year} AND d.month IN ({", ".join(map(str, S.spike_months))}) GROUP BY d.year, d.month"""
add("order_vs_aov", "SELECT * FROM v_order_vs_aov", double="gmv")
_BASE, _PEAK = (f"{S.spike_year:04d}-{m:02d}" for m in (S.spike_base_month, S.spike_month))
add("month_over_month_growth", f"""
SELECT a.year_month AS from_month, b.year_month AS to_month,
  (CAST(b.orders AS DOUBLE) / CAST(a.orders AS DOUBLE) - 1) * 100 AS orders_growth_pct,
  (CAST(b.gmv AS DOUBLE) / CAST(a.gmv AS DOUBLE) - 1) * 100 AS gmv_growth_pct,
  (b.avg_order_value / a.avg_order_value - 1) * 100 AS avg_order_value_growth_pct
FROM v_order_vs_aov a JOIN v_order_vs_aov b ON a.year_month = '{_BASE}' AND b.year_month = '{_PEAK}'""")
VIEWS["v_daily_activity"] = f"""
SELECT d.date_key, COUNT(DISTINCT i.order_key) AS order_count, SUM(i.price + i.freight_value) AS gmv
FROM fact_order_items i JOIN dim_date d ON i.order_date_key = d.date_key
WHERE d.year = {S.spike_year} AND d.month = {S.spike_month} GROUP BY d.date_key"""
add("daily_activity", "SELECT * FROM v_daily_activity", double="gmv")
add("peak_day", "SELECT * FROM v_daily_activity ORDER BY gmv DESC, date_key LIMIT 1", double="gmv")
VIEWS["spike_months"] = f"""
SELECT d.month, COALESCE(p.product_category_name_english, 'Unknown') AS product_category,
  COUNT(DISTINCT i.order_key) AS orders, SUM(i.price + i.freight_value) AS gmv
FROM fact_order_items i JOIN dim_date d ON i.order_date_key = d.date_key
LEFT JOIN dim_product p ON i.product_key = p.product_key
WHERE d.year = {S.spike_year} AND d.month IN ({S.spike_base_month}, {S.spike_month}) GROUP BY ALL"""
VIEWS["spike_pairs"] = f"""
SELECT product_category,
  COALESCE(SUM(gmv) FILTER (month = {S.spike_base_month}), 0) AS base_gmv,
  COALESCE(SUM(gmv) FILTER (month = {S.spike_month}), 0) AS spike_gmv,
  COALESCE(SUM(orders) FILTER (month = {S.spike_base_month}), 0) AS base_orders,
  COALESCE(SUM(orders) FILTER (month = {S.spike_month}), 0) AS spike_orders
FROM spike_months GROUP BY product_category"""
VIEWS["v_category_spike"] = f"""
SELECT *, spike_gmv - base_gmv AS gmv_increase,
  {half_up('spike_gmv - base_gmv', 'base_gmv', factor=100)} AS growth_pct,
  {half_up('spike_gmv - base_gmv', '(SELECT SUM(spike_gmv - base_gmv) FROM spike_pairs WHERE spike_gmv > base_gmv)',
           factor=100)} AS contribution_to_spike_pct
FROM spike_pairs WHERE spike_gmv > base_gmv"""
_SPIKE = {"double": "base_gmv spike_gmv gmv_increase", "bigint": "base_orders spike_orders"}
add("category_spike", "SELECT * FROM v_category_spike", **_SPIKE)
add("category_spike_top10", "SELECT * FROM v_category_spike ORDER BY gmv_increase DESC, product_category LIMIT 10",
    **_SPIKE)

# --- categories and regions -------------------------------------------------

VIEWS["all_category_sales"] = """
SELECT year(o.order_purchase_timestamp) AS year, CAST(month(o.order_purchase_timestamp) AS INTEGER) AS month,
  p.product_category_name_english, SUM(i.price + i.freight_value) AS total_sales_value
FROM fact_order_items i JOIN fact_orders o ON i.order_key = o.order_key
JOIN dim_product p ON i.product_key = p.product_key
WHERE o.order_status = 'DELIVERED' GROUP BY ALL"""
VIEWS["labelled"] = f"""
SELECT month, product_category_name_english, total_sales_value,
  CASE WHEN month <= 6 THEN 'H1 (Jan-Jun)' ELSE 'H2 (Jul-Dec)' END AS half_year
FROM all_category_sales WHERE year = {Y0}"""
VIEWS["late_sales"] = f"""
SELECT month, product_category_name_english, total_sales_value FROM all_category_sales
WHERE year = {Y1} AND month <= {S.last_compared_month}"""
_BEST = "QUALIFY ROW_NUMBER() OVER (PARTITION BY month ORDER BY total_sales_value DESC, product_category_name_english)"
VIEWS["best_labelled"] = f"SELECT * FROM labelled {_BEST} <= {BEST}"
VIEWS["best_late"] = f"SELECT * FROM late_sales {_BEST} <= {BEST}"
VIEWS["frequency_labelled"] = """
SELECT half_year, product_category_name_english, COUNT(*) AS top_10_months FROM best_labelled GROUP BY ALL"""
VIEWS["frequency_late"] = """
SELECT product_category_name_english, COUNT(*) AS top_10_months FROM best_late GROUP BY ALL"""
VIEWS["revenue_labelled"] = """
SELECT half_year, product_category_name_english, SUM(total_sales_value) AS total_revenue FROM labelled GROUP BY ALL"""
VIEWS["revenue_late"] = """
SELECT product_category_name_english, SUM(total_sales_value) AS total_revenue FROM late_sales GROUP BY ALL"""
VIEWS["revenue_early"] = f"""
SELECT product_category_name_english, SUM(total_sales_value) AS total_revenue FROM labelled
WHERE month <= {S.last_compared_month} GROUP BY ALL"""
add("category_sales", "SELECT * EXCLUDE (half_year) FROM labelled", double="total_sales_value")
add("half_year_label", "SELECT * FROM labelled", double="total_sales_value")
add("half_year_revenue", "SELECT * FROM revenue_labelled", double="total_revenue")
add("top10_each_month", f"SELECT * FROM labelled {_BEST} <= 10", double="total_sales_value")
add("top3_each_month", "SELECT * FROM best_labelled", double="total_sales_value")
add("category_frequency", "SELECT * FROM frequency_labelled")
add("category_frequency_overall", "SELECT * FROM frequency_late")
add("category_summary", """
SELECT r.*, COALESCE(f.top_10_months, 0) AS top_10_months FROM revenue_labelled r
LEFT JOIN frequency_labelled f USING (half_year, product_category_name_english)""", double="total_revenue")
add("category_summary_overall", """
SELECT r.*, COALESCE(f.top_10_months, 0) AS top_10_months FROM revenue_late r
LEFT JOIN frequency_late f USING (product_category_name_english)""", double="total_revenue")
add("category_revenue_jan_jun", "SELECT * FROM revenue_late", double="total_revenue")
VIEWS["v_comparison"] = f"""
SELECT product_category_name_english, COALESCE(a.total_revenue, 0) AS total_revenue_{Y0},
  COALESCE(b.total_revenue, 0) AS total_revenue_{Y1}
FROM revenue_early a FULL JOIN revenue_late b USING (product_category_name_english)"""
_PAIR = f"total_revenue_{Y0} total_revenue_{Y1}"
add("compare_category_revenue", "SELECT * FROM v_comparison", double=_PAIR)
VIEWS["v_changes"] = f"SELECT *, total_revenue_{Y1} - total_revenue_{Y0} AS revenue_change FROM v_comparison"
add("category_revenue_changes", """
(SELECT * FROM v_changes ORDER BY revenue_change DESC, product_category_name_english LIMIT 5)
UNION ALL (SELECT * FROM v_changes ORDER BY revenue_change, product_category_name_english LIMIT 5)""",
    double=_PAIR + " revenue_change")
VIEWS["state_sales"] = f"""
SELECT strftime(o.order_purchase_timestamp, '%Y-%m') AS month, c.customer_state,
  SUM(i.price + i.freight_value) AS gmv
FROM fact_order_items i JOIN fact_orders o ON i.order_key = o.order_key
JOIN dim_customer c ON o.customer_key = c.customer_key
WHERE o.order_status = 'DELIVERED' AND year(o.order_purchase_timestamp) IN ({Y0}, {Y1}) GROUP BY ALL"""
add("monthly_state_sales", "SELECT * FROM state_sales", double="gmv")
VIEWS["region_sales"] = f"""
SELECT month, region, SUM(gmv) AS gmv FROM (SELECT *, {region_case('customer_state', 'NULL')} AS region FROM state_sales)
WHERE region IS NOT NULL GROUP BY month, region"""
add("region_rollup", "SELECT * FROM region_sales", double="gmv")

# --- holidays ---------------------------------------------------------------

VIEWS["events_of_year"] = """
SELECT year(hol_date) AS year, hol_name, MIN(hol_date) AS holiday_start, MAX(hol_date) AS holiday_end,
  CAST(date_diff('day', MIN(hol_date), MAX(hol_date)) + 1 AS INTEGER) AS holiday_days
FROM stg_holiday_calendar GROUP BY ALL"""
add("holiday_events", "SELECT * FROM events_of_year", text="holiday_start holiday_end", integer="year")
VIEWS["item_days"] = """
SELECT strptime(CAST(i.order_date_key AS VARCHAR), '%Y%m%d')::DATE AS day, p.product_category_name_english,
  i.price + i.freight_value AS value
FROM fact_order_items i JOIN dim_product p ON i.product_key = p.product_key WHERE i.order_date_key IS NOT NULL"""
VIEWS["around"] = f"""
SELECT e.*, s.*, CASE WHEN s.day < e.holiday_start THEN 'before' WHEN s.day > e.holiday_end THEN 'after'
  ELSE 'holiday' END AS period
FROM events_of_year e JOIN item_days s
  ON s.day BETWEEN e.holiday_start - {S.pad_days} AND e.holiday_end + {S.pad_days}"""
VIEWS["complete_events"] = f"""
SELECT year, hol_name FROM around GROUP BY year, hol_name, holiday_days
HAVING COUNT(DISTINCT day) >= holiday_days + {2 * S.pad_days}"""
VIEWS["event_sums"] = """
SELECT product_category_name_english, year, hol_name AS holiday, holiday_days,
  CAST(COALESCE(SUM(value) FILTER (period = 'before'), 0) AS DOUBLE) AS before_gmv,
  CAST(COALESCE(SUM(value) FILTER (period = 'holiday'), 0) AS DOUBLE) AS holiday_gmv,
  CAST(COALESCE(SUM(value) FILTER (period = 'after'), 0) AS DOUBLE) AS after_gmv
FROM around SEMI JOIN complete_events USING (year, hol_name) GROUP BY ALL"""
VIEWS["event_rates"] = f"""
SELECT *, before_gmv / {S.pad_days} AS before_daily, holiday_gmv / holiday_days AS holiday_daily,
  after_gmv / {S.pad_days} AS after_daily FROM event_sums"""
VIEWS["demand"] = """
SELECT *, (holiday_daily - before_daily) / NULLIF(before_daily, 0) * 100 AS holiday_change_pct,
  holiday_daily - before_daily AS holiday_change_value, after_daily - holiday_daily AS after_change_value
FROM event_rates"""
add("holiday_window_demand", "SELECT * FROM demand", integer="year")
VIEWS["biggest"] = f"""
SELECT *, abs(holiday_change_value) AS absolute_change FROM demand WHERE year = {S.holiday_years[-1]}
ORDER BY absolute_change DESC, holiday, product_category_name_english LIMIT 10"""
add("biggest_holiday_changes", "SELECT * FROM biggest", integer="year")
add("holiday_category_label", """
SELECT holiday || ' — ' || product_category_name_english AS holiday_category, holiday_change_value FROM biggest""")

# --- customers --------------------------------------------------------------

add("rfm_detail", "SELECT * EXCLUDE (customer_state, customer_city) FROM rfm_named", double="monetary_value")
_AVERAGE = half_up("SUM(monetary_value)", "COUNT(monetary_value)")
add("rfm_segment_filtered", f"""
SELECT customer_segment, SUM(monetary_value) AS total_revenue, COUNT(DISTINCT customer_key) AS customer_count,
  {_AVERAGE} AS average_customer_value
FROM rfm_named WHERE customer_segment IN ({quoted(SEGMENTS)}) GROUP BY customer_segment""", double="total_revenue")
add("rfm_kpis", f"""
SELECT COUNT(DISTINCT customer_key) AS total_customers, SUM(monetary_value) AS total_revenue,
  {_AVERAGE} AS average_customer_value FROM rfm_named""", double="total_revenue")
add("rfm_segment_list", "SELECT DISTINCT customer_segment FROM rfm_named WHERE customer_segment IS NOT NULL")
for _name, _order in (
    ("top_customers", "monetary_value DESC"),
    ("top_customers_by_frequency", "frequency DESC"),
    ("top_customers_by_recency", "recency_days ASC NULLS LAST"),
):
    add(_name, f"""
SELECT customer_unique_id, customer_segment, recency_days, frequency, monetary_value, rfm_score FROM rfm_named
ORDER BY {_order}, customer_unique_id LIMIT 10""", double="monetary_value")
add("report_top10_view", """
SELECT substr(customer_unique_id, 1, 12) AS customer, monetary_value FROM rfm_top
ORDER BY monetary_value DESC, customer_key LIMIT 10""", double="monetary_value")

# --- pivots -----------------------------------------------------------------

_REGION_COLUMNS = ", ".join(
    f"CAST(SUM(gmv) FILTER (region = '{r}') AS DOUBLE) AS \"{r}\"" for r in [*REGIONS, "Unknown"]
)
add("pivot_month_region", f"SELECT year_month, {_REGION_COLUMNS} FROM monthly_trend GROUP BY year_month")
add("pivot_state_month_region", f"SELECT month, {_REGION_COLUMNS} FROM region_sales GROUP BY month")
for _name, _metric in (("pivot_quarter_daytype", "avg_gmv_per_day"),
                       ("pivot_quarter_daytype_orders", "avg_orders_per_day")):
    add(_name, f"""
SELECT year_quarter, SUM({_metric}) FILTER (day_type = 'Holiday') AS "Holiday",
  SUM({_metric}) FILTER (day_type = 'Non-Holiday') AS "Non-Holiday" FROM v_holiday_daily GROUP BY year_quarter""")
add("pivot_category_daytype", """
SELECT product_category, COALESCE(SUM(gmv_share_pct) FILTER (day_type = 'Holiday'), 0) AS "Holiday",
  COALESCE(SUM(gmv_share_pct) FILTER (day_type = 'Non-Holiday'), 0) AS "Non-Holiday", SUM(gmv) AS combined_gmv
FROM v_holiday_product_category_mix GROUP BY product_category""", double="combined_gmv")

# --- structural tests -------------------------------------------------------

def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


add("dq_not_null", union([
    f"SELECT '{m}' AS model, '{c}' AS \"column\", COUNT(*) AS failures FROM {m} WHERE {c} IS NULL"
    for m, columns in model_tests.NOT_NULL.items() for c in columns]))
add("dq_unique", union([
    f"SELECT '{m}' AS model, '{c}' AS \"column\", COUNT(*) AS failures FROM "
    f"(SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"
    for m, columns in model_tests.UNIQUE.items() for c in columns]))
add("dq_relationships", union([
    f"SELECT '{child}' AS model, '{c}' AS \"column\", '{parent}' AS parent, '{severity}' AS severity, "
    f"COUNT(*) AS failures FROM {child} x WHERE x.{c} IS NOT NULL "
    f"AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{pc} = x.{c})"
    for child, c, parent, pc, severity in model_tests.RELATIONSHIPS]))
add("dq_accepted_values", union([
    f"SELECT '{m}' AS model, '{c}' AS \"column\", COUNT(*) AS failures FROM {m} WHERE {c} NOT IN ({quoted(values)})"
    for m, c, values in model_tests.ACCEPTED_VALUES]))
add("dq_unique_combination", union([
    f"SELECT '{m}' AS model, '{', '.join(cs)}' AS \"column\", COUNT(*) AS failures FROM "
    f"(SELECT {', '.join(cs)} FROM {m} GROUP BY {', '.join(cs)} HAVING COUNT(*) > 1)"
    for m, cs in model_tests.UNIQUE_COMBINATION]))
add("dq_equal_rowcount", union([
    f"SELECT '{m}' AS model, '{other}' AS compared_model, a.n AS model_rows, b.n AS compared_rows, a.n = b.n AS success "
    f"FROM (SELECT COUNT(*) AS n FROM {m}) a, (SELECT COUNT(*) AS n FROM {other}) b"
    for m, other in model_tests.EQUAL_ROWCOUNT]))
add("dq_person_count", """
SELECT a.n AS dim_customer_count, b.n AS distinct_customer_unique_id_count, a.n = b.n AS success
FROM (SELECT COUNT(*) AS n FROM dim_customer) a,
  (SELECT COUNT(DISTINCT customer_unique_id) AS n FROM stg_customers) b""")

# --- plausibility checks ----------------------------------------------------

VIEWS["c_customers"] = "SELECT * FROM stg_customers"
VIEWS["c_sellers"] = "SELECT * FROM stg_sellers"
VIEWS["c_payments"] = "SELECT * FROM stg_order_payments"
VIEWS["c_reviews"] = "SELECT * FROM stg_order_reviews"
VIEWS["c_holidays"] = "SELECT * FROM stg_holiday_calendar"
VIEWS["c_products"] = """
SELECT * EXCLUDE (product_name_length, product_description_length), product_name_length AS product_name_lenght,
  product_description_length AS product_description_lenght FROM stg_products"""
VIEWS["c_geolocation"] = """
SELECT geolocation_zip_code_prefix, latitude AS geolocation_lat, longitude AS geolocation_lng,
  city AS geolocation_city, state AS geolocation_state FROM stg_geolocation"""
VIEWS["c_orders"] = """
SELECT * EXCLUDE (order_status), lower(order_status) AS order_status,
  NOT ((order_status IS NOT DISTINCT FROM 'DELIVERED' AND order_delivered_customer_date IS NULL)
    OR (order_status IS DISTINCT FROM 'DELIVERED' AND order_delivered_customer_date IS NOT NULL))
    AS delivery_date_matches_status
FROM stg_orders"""
VIEWS["c_order_items"] = """
SELECT i.*, NOT COALESCE(i.shipping_limit_date < o.order_purchase_timestamp, FALSE) AS shipping_after_purchase
FROM stg_order_items i LEFT JOIN stg_orders o ON i.order_id = o.order_id"""
VIEWS["c_order_reconciliation"] = """
SELECT a.order_id, a.due AS order_item_freight_total, b.paid AS order_payment_total,
  abs(b.paid - a.due) <= 0.01 AS payment_matches_items
FROM (SELECT order_id, SUM(price + freight_value) AS due FROM stg_order_items GROUP BY order_id) a
JOIN (SELECT order_id, SUM(payment_value) AS paid FROM stg_order_payments GROUP BY order_id) b USING (order_id)"""


def _wrong(c: Check) -> str:
    if c.kind == "not_null":
        return f"{c.column} IS NULL"
    if c.kind == "in_set":
        return f"NOT {c.column}" if c.values == (True,) else f"{c.column} NOT IN ({quoted(c.values)})"
    if c.kind == "regex":
        return f"NOT regexp_matches({c.column}, '^[0-9]{{5}}$')"
    if c.kind == "pair_greater":
        return f"{c.column} < {c.other}"
    tests = [] if c.low is None else [f"{c.column} {'<=' if c.strict_low else '<'} {c.low}"]
    return " OR ".join(tests + ([] if c.high is None else [f"{c.column} > {c.high}"]))


def check_row(c: Check, layer: str = "c") -> str:
    source = c.table if c.group == MART else f"{layer}_{c.table}"
    head = (f"SELECT '{c.group}' AS \"group\", '{c.table}' AS \"table\", '{c.kind}' AS expectation, "
            f"'{c.label}' AS \"column\", '{c.detail}' AS detail, ")
    if c.kind in ("mean_between", "sum_between", "row_count_between"):
        seen = {
            "mean_between": f"CAST(SUM({c.column}) AS DOUBLE) / COUNT({c.column})",
            "sum_between": f"CAST(SUM({c.column}) AS DOUBLE)",
            "row_count_between": "CAST(COUNT(*) AS DOUBLE)",
        }[c.kind]
        return (f"{head} COALESCE(v BETWEEN {float(c.low)!r}::DOUBLE AND {float(c.high)!r}::DOUBLE, FALSE) AS success, "
                f"v AS observed_value, NULL::BIGINT AS unexpected_count, NULL::DOUBLE AS unexpected_percent "
                f"FROM (SELECT {seen} AS v FROM {source})")
    if c.kind == "compound_unique":
        keys = ", ".join(c.columns)
        counted = (f"SELECT SUM(k) AS n, COALESCE(SUM(k) FILTER (k > 1), 0) AS u "
                   f"FROM (SELECT COUNT(*) AS k FROM {source} GROUP BY {keys})")
    else:
        present = "TRUE" if c.kind == "not_null" else f"{c.column} IS NOT NULL"
        if c.other:
            present += f" AND {c.other} IS NOT NULL"
        counted = f"SELECT COUNT(*) FILTER ({present}) AS n, COUNT(*) FILTER ({_wrong(c)}) AS u FROM {source}"
    return (f"{head} CASE WHEN n = 0 THEN TRUE ELSE (n - u)::DOUBLE / n::DOUBLE >= {c.mostly!r}::DOUBLE END AS success, "
            f"NULL::DOUBLE AS observed_value, u::BIGINT AS unexpected_count, "
            f"CASE WHEN n > 0 THEN u::DOUBLE * 100 / n::DOUBLE END AS unexpected_percent FROM ({counted})")


VIEWS["details"] = union([check_row(c) for c in STAGING_CHECKS])
_R_MOMENTS = ", ".join(f"TRY_CAST({m} AS TIMESTAMP) AS {m}" for m in MOMENTS.split())
VIEWS["r_customers"] = "SELECT * FROM raw_customers"
VIEWS["r_sellers"] = "SELECT * FROM raw_sellers"
VIEWS["r_payments"] = "SELECT * FROM stg_order_payments"
VIEWS["r_reviews"] = "SELECT * FROM raw_reviews"
VIEWS["r_products"] = "SELECT * FROM raw_products"
VIEWS["r_geolocation"] = "SELECT * FROM raw_geolocation"
VIEWS["r_orders"] = f"""
SELECT *, (order_status = 'delivered') = (order_delivered_customer_date IS NOT NULL) AS delivery_date_matches_status
FROM (SELECT * REPLACE ({_R_MOMENTS}) FROM raw_orders)"""
VIEWS["r_order_items"] = """
SELECT i.*, NOT COALESCE(i.shipping_limit_date < o.order_purchase_timestamp, FALSE) AS shipping_after_purchase
FROM stg_order_items i LEFT JOIN r_orders o ON i.order_id = o.order_id"""
VIEWS["r_order_reconciliation"] = "SELECT * FROM c_order_reconciliation"
VIEWS["raw_details"] = union([check_row(c, "r") for c in RAW_CHECKS])
VIEWS["mart_rows"] = union([check_row(c) for c in MART_CHECKS])
for _name, _kind in CHECK_KINDS.items():
    add(_name, union([check_row(c) for c in STAGING_CHECKS if c.kind == _kind]))
add("ex_sum_between", "SELECT * FROM mart_rows WHERE expectation = 'sum_between'")
add("dq_mart_sanity", "SELECT * FROM mart_rows")
add("dq_failure_detail", "SELECT * FROM details WHERE NOT success")
add("dq_observation_unexpected", f"SELECT * FROM details WHERE \"group\" = '{OBSERVATION}' AND unexpected_count > 0")
_TABLES = [*expectations.STAGING_MODELS, "order_reconciliation"]
add("dq_suite_run", f"""
SELECT p.*, p."table" || '_' || p."group" || '_validation' AS validation, COALESCE(v.success, TRUE) AS success
FROM ({union([f"SELECT '{g}' AS " + '"group"' + f", '{t}' AS " + '"table"' for g in (CRITICAL, OBSERVATION) for t in _TABLES])}) p
LEFT JOIN (SELECT "group", "table", bool_and(success) AS success FROM details GROUP BY ALL) v
  ON p."group" = v."group" AND p."table" = v."table" """)
_RAW_TABLES = [*expectations.LAYER_TABLES["raw"], "order_reconciliation"]
add("dq_suite_run_raw", f"""
SELECT p.*, p."table" || '_' || p."group" || '_validation' AS validation, COALESCE(v.success, TRUE) AS success
FROM ({union([f"SELECT '{g}' AS " + '"group"' + f", '{t}' AS " + '"table"' for g in (CRITICAL, OBSERVATION) for t in _RAW_TABLES])}) p
LEFT JOIN (SELECT "group", "table", bool_and(success) AS success FROM raw_details GROUP BY ALL) v
  ON p."group" = v."group" AND p."table" = v."table" """)
add("dq_failure_detail_raw", "SELECT * FROM raw_details WHERE NOT success")
add("dq_gate", f"""
SELECT "group", COUNT(*) AS checks, COUNT(*) FILTER (NOT success) AS failed,
  "group" = '{CRITICAL}' AND COUNT(*) FILTER (NOT success) > 0 AS blocking
FROM (SELECT * FROM details UNION ALL SELECT * FROM mart_rows) GROUP BY "group" """)
add("dq_coerce", """
SELECT 'orders' AS "table", 'order_approved_at' AS "column", COUNT(*) AS new_nulls FROM raw_orders
WHERE order_approved_at IS NOT NULL AND TRY_CAST(order_approved_at AS TIMESTAMP) IS NULL HAVING COUNT(*) > 0""")
add("dq_status_date_consistency", "SELECT order_id, order_status, delivery_date_matches_status FROM c_orders")
add("dq_shipping_after_purchase",
    "SELECT order_id, order_item_id, product_id, shipping_after_purchase FROM c_order_items")
add("dq_order_reconciliation", "SELECT * FROM c_order_reconciliation",
    double="order_item_freight_total order_payment_total")

# --- profiles ---------------------------------------------------------------

_STAGED_TYPES = {
    "customers": "customer_id:s customer_unique_id:s customer_zip_code_prefix:s customer_city:s customer_state:s",
    "orders": "order_id:s customer_id:s order_status:s " + " ".join(f"{m}:t" for m in MOMENTS.split()),
    "order_items": "order_id:s order_item_id:i product_id:s seller_id:s shipping_limit_date:t price:m freight_value:m",
    "payments": "order_id:s payment_sequential:i payment_type:s payment_installments:i payment_value:m",
    "reviews": "review_id:s order_id:s review_score:i review_comment_title:s review_comment_message:s "
               "review_creation_date:t review_answer_timestamp:t",
    "products": "product_id:s product_category_name:s product_name_length:i product_description_length:i "
                "product_photos_qty:i product_weight_g:d product_length_cm:d product_height_cm:d product_width_cm:d",
    "sellers": "seller_id:s seller_zip_code_prefix:s seller_city:s seller_state:s",
    "geolocation": "geolocation_zip_code_prefix:s latitude:d longitude:d city:s state:s",
    "category_translation": "product_category_name:s product_category_name_english:s",
}
_TYPE_NAMES = {"s": "string", "i": "bigint", "t": "timestamp", "m": "decimal(37,9)", "d": "decimal(18,9)"}
COLUMNS = {t: [tuple(c.split(":")) for c in spec.split()] for t, spec in _STAGED_TYPES.items()}

add("profile_tables", union([
    f"SELECT '{t}' AS \"table\", COUNT(*) AS rows, {len(COLUMNS[t])} AS columns FROM {STAGING_OF[t]}" for t in PROFILED]))
add("profile_columns", union([
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{_TYPE_NAMES[k]}' AS dtype, COUNT(*) - COUNT({c}) AS null_count, "
    f"CAST(COUNT(*) - COUNT({c}) AS DOUBLE) * 100 / CAST(COUNT(*) AS DOUBLE) AS null_pct, "
    f"COUNT(DISTINCT {c}) AS unique_count FROM {STAGING_OF[t]}"
    for t in PROFILED for c, k in COLUMNS[t]]))
_FACTS = {
    "fact_orders": "order_key order_id customer_key order_date_key order_status number_of_items gross_merchandise_value "
                   "delivery_days estimated_delivery_days is_late average_review_score review_count latest_review_date "
                   "customer_type first_order_timestamp " + ORDER_MONEY + " " + MOMENTS,
    "fact_order_items": "order_item_key order_key product_key seller_key order_date_key order_item_id product_id seller_id "
                        "price freight_value shipping_limit_date",
}
add("profile_columns_merged", union([
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS null_count, "
    f"TRUE AS within_2_percent FROM {t}"
    for t, columns in _FACTS.items() for c in columns.split()]))
add("profile_missing", "SELECT * FROM (" + union([
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS null_count, "
    f"{half_up(f'(COUNT(*) - COUNT({c}))', 'COUNT(*)', factor=100)} AS null_pct FROM {STAGING_OF[t]}"
    for t in PROFILED for c, _ in COLUMNS[t]]) + ") WHERE null_count > 0")
add("profile_duplicates", union([
    f"SELECT '{t}' AS \"table\", CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_rows, "
    f"{half_up('SUM(n) - COUNT(*)', 'SUM(n)', factor=100)} AS duplicate_pct "
    f"FROM (SELECT COUNT(*) AS n FROM {STAGING_OF[t]} GROUP BY {', '.join(c for c, _ in COLUMNS[t])})"
    for t in PROFILED]))
add("profile_keys", union([
    f"SELECT '{t}' AS \"table\", '{', '.join(keys)}' AS key, SUM(n) = COUNT(*) AS is_unique, "
    f"CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicate_count "
    f"FROM (SELECT COUNT(*) AS n FROM {STAGING_OF[t]} GROUP BY {', '.join(keys)})"
    for t, keys in PROFILE_KEYS.items()]))
add("profile_distribution", union([
    f"SELECT '{m}' AS metric, COUNT({m}) AS count, "
    f"round(CAST(SUM({m}) AS DOUBLE) / COUNT({m}), 4) AS mean, "
    f"round(stddev_samp(CAST({m} AS DOUBLE)), 4) AS std, CAST(MIN({m}) AS DOUBLE) AS min, "
    + ", ".join(f"round(quantile_cont(CAST({m} AS DOUBLE), {p / 100}), 4) AS p{p}" for p in (50, 75, 90, 95))
    + f", CAST(MAX({m}) AS DOUBLE) AS max FROM fct_customer_rfm"
    for m in ("recency", "frequency", "monetary")]))

# --- reports as files -------------------------------------------------------

REPORT_VIEWS = {
    "monthly_sales_trend": "monthly_trend",
    "rfm_analysis": "rfm_top",
    "rfm_segment_summary": "segment_summary",
    "holiday_impact": "v_holiday_impact",
    "holiday_impact_by_quarter": "v_holiday_impact_by_quarter",
    "holiday_daily_metrics_by_quarter": "v_holiday_daily",
    "holiday_product_category_mix": "v_holiday_product_category_mix",
}
add("report_contract", union([
    f"SELECT '{r}' AS report, COUNT(*) AS rows, {len(REPORT_COLUMNS[r])} AS columns, '' AS duplicate_columns, "
    f"'' AS missing_columns, '' AS unexpected_columns, FALSE AS wrong_order, COUNT(*) > 0 AS success FROM {view}"
    for r, view in REPORT_VIEWS.items()]))
_WRITTEN = REPORT_VIEWS | {
    f"profile_{p}": f"({ORACLE[f'profile_{p}']})" for p in ("tables", "columns", "missing", "duplicates", "distribution")
}
add("sink_report", union([
    f"SELECT '{r}' AS report, COUNT(*) AS rows, COUNT(*) AS written_rows, TRUE AS same_columns, TRUE AS same_values FROM {view}"
    for r, view in _WRITTEN.items()]))

# over published tables the answers are the same
for _name in ("order_vs_aov", "holiday_impact_all_orders", "category_sales", "holiday_window_demand"):
    ORACLE[f"marts_{_name}"] = ORACLE[_name]
