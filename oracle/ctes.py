"""Named sub-queries: the data binding, staging, intermediate models and marts.

Written the plain SQL way (row numbers, window functions, QUALIFY), on purpose
unlike the Spark jobs they are compared with.
"""

from __future__ import annotations

import re

from feira.domain import REGIONS, STATES
from feira.sources.driver_tables import HOLIDAYS, PAYMENT_TYPES, SETTINGS, UNTRANSLATED, WEEKDAYS


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def array(values) -> str:
    return f"[{quoted(values)}]"


def region_case(column: str, default: str = "'Unknown'") -> str:
    whens = " ".join(f"WHEN {column} IN ({quoted(states)}) THEN '{r}'" for r, states in REGIONS.items())
    return f"CASE {whens} ELSE {default} END"


def half_up(num: str, den: str, digits: int = 2, factor: int = 1) -> str:
    """num/den rounded half up in integer arithmetic; both have at most two decimals."""
    n = f"(CAST(({num}) * 100 AS HUGEINT) * {factor * 10 ** digits})"
    d = f"CAST(({den}) * 100 AS HUGEINT)"
    return f"CASE WHEN {d} <> 0 THEN CAST((2 * {n} + {d}) // (2 * {d}) AS DOUBLE) / {10 ** digits} END"


def key(moment: str) -> str:
    return f"CAST(strftime({moment}, '%Y%m%d') AS INTEGER)"


def in_window(year: str = "d.year", month: str = "d.month") -> str:
    (y0, m0), (y1, m1) = SETTINGS.report_start, SETTINGS.report_end
    return f"({year} * 12 + {month} BETWEEN {y0 * 12 + m0} AND {y1 * 12 + m1})"


_BOUGHT = "o_orderdate + to_minutes(o_orderkey % 1440)"
_STATUS = (
    "CASE WHEN o_orderkey % 50 = 7 THEN 'canceled' WHEN o_orderkey % 70 = 9 THEN 'unavailable' "
    "WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END"
)
_HOLIDAY_NAME = (
    "CASE "
    + " ".join(
        f"WHEN strftime(day, '{'%m%d' if len(k) == 4 else '%Y%m%d'}') = '{k}' THEN '{v}'" for k, v in HOLIDAYS.items()
    )
    + " END"
)
_PAYMENT_TYPE = "CASE " + " ".join(f"WHEN o_orderpriority = '{k}' THEN '{v}'" for k, v in PAYMENT_TYPES.items()) + " END"

CTES: dict[str, str] = {}

# --- binding ----------------------------------------------------------------

CTES["raw_orders"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'A' || o_orderkey AS customer_id,
  ' ' || ({_STATUS}) || ' ' AS order_status,
  CAST({_BOUGHT} AS VARCHAR) AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 400 = 3 THEN 'n/a' ELSE CAST({_BOUGHT} + INTERVAL 1 HOUR AS VARCHAR) END AS order_approved_at,
  CAST({_BOUGHT} + to_days(CASE WHEN o_orderkey % 50 = 11 THEN -1 ELSE 2 END) AS VARCHAR)
    AS order_delivered_carrier_date,
  CASE WHEN ({_STATUS}) = 'delivered' THEN CAST({_BOUGHT} + to_days(CAST(3 + o_orderkey % 25 AS INTEGER)) AS VARCHAR)
    END AS order_delivered_customer_date,
  CAST(o_orderdate + INTERVAL 15 DAY AS VARCHAR) AS order_estimated_delivery_date
FROM orders"""

CTES["accounts"] = f"""
SELECT o_orderkey, o_custkey, a.z, n_name AS city, lpad(CAST(a.z AS VARCHAR), 5, '0') AS zip,
  {array(STATES)}[a.z + 1] AS state
FROM (SELECT o_orderkey, o_custkey, CAST((c_nationkey + o_orderkey) % 25 AS INTEGER) AS z
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey) a
LEFT JOIN nation ON n_nationkey = a.z"""

CTES["raw_customers"] = """
SELECT 'A' || o_orderkey AS customer_id, 'P' || (o_custkey * 8 + o_orderkey % 8) AS customer_unique_id,
  zip AS customer_zip_code_prefix, city AS customer_city, state AS customer_state
FROM accounts"""

CTES["raw_geolocation"] = """
SELECT zip AS geolocation_zip_code_prefix, (o_orderkey % 7) / 10.0 - z AS geolocation_lat,
  (o_orderkey % 7) / 10.0 - z - 40 AS geolocation_lng, city AS geolocation_city, state AS geolocation_state
FROM accounts WHERE z < 23"""

CTES["lines"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS freight_value
FROM lineitem"""

CTES["due"] = "SELECT l_orderkey, SUM(price + freight_value) AS due FROM lines GROUP BY l_orderkey"

CTES["paid"] = """
SELECT o_orderkey, o_orderpriority,
  CAST(due + CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS total
FROM orders JOIN due ON o_orderkey = l_orderkey"""

# 60 % of the total, half up in whole cents
_FIRST_PART = "CAST((2 * CAST(total * 600 AS HUGEINT) + 10) // 20 AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2))"

CTES["payment_parts"] = f"""
SELECT o_orderkey, o_orderpriority, 1 AS seq, total AS value FROM paid WHERE o_orderkey % 5 <> 0
UNION ALL
SELECT o_orderkey, o_orderpriority, 1, {_FIRST_PART} FROM paid WHERE o_orderkey % 5 = 0
UNION ALL
SELECT o_orderkey, o_orderpriority, 2, total - {_FIRST_PART} FROM paid WHERE o_orderkey % 5 = 0"""

CTES["holiday_days"] = f"""
SELECT day, {_HOLIDAY_NAME} AS name
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
      WHERE year(o_orderdate) IN ({", ".join(map(str, SETTINGS.holiday_years))}))"""

CTES["raw_holidays"] = f"""
SELECT strftime(day, '%Y-%m-%d') AS date, name, 'national' AS type, {array(WEEKDAYS)}[dayofweek(day) + 1] AS weekday
FROM holiday_days WHERE name IS NOT NULL"""

CTES["raw_sellers"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
  n_name AS seller_city, {array(STATES)}[s_nationkey + 1] AS seller_state
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

CTES["raw_products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS product_category_name, length(p_name) AS product_name_lenght,
  length(p_name) * 10 AS product_description_lenght, 1 + p_size % 5 AS product_photos_qty, p_size * 100 AS product_weight_g,
  p_size + 10 AS product_length_cm, p_size + 5 AS product_height_cm, p_size + 8 AS product_width_cm
FROM part"""

CTES["raw_translation"] = f"""
SELECT DISTINCT lower(p_type) AS product_category_name, ' ' || lower(p_type) || '_goods' AS product_category_name_english
FROM part WHERE p_type <> '{UNTRANSLATED}'"""

CTES["raw_reviews"] = """
SELECT 'R' || (o_orderkey // 2) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id, 1 + o_orderkey % 5 AS review_score,
  CASE WHEN o_orderkey % 8 = 0 THEN ' title ' || o_orderkey END AS review_comment_title,
  CASE WHEN o_orderkey % 2 <> 0 THEN 'message, "' || o_orderkey || '"' || chr(10) || 'second line ' END
    AS review_comment_message,
  o_orderdate + INTERVAL 20 DAY AS review_creation_date, o_orderdate + INTERVAL 22 DAY AS review_answer_timestamp
FROM orders WHERE o_orderkey % 10 <> 0"""

# --- staging ----------------------------------------------------------------

CTES["stg_orders"] = """
SELECT order_id, customer_id, upper(trim(order_status)) AS order_status,
  TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
  TRY_CAST(order_approved_at AS TIMESTAMP) AS order_approved_at,
  TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
  TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
  TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date
FROM raw_orders"""

CTES["stg_order_items"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
  CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
  l_shipdate AS shipping_limit_date, price, freight_value
FROM lines"""

CTES["stg_order_payments"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(seq AS BIGINT) AS payment_sequential,
  {_PAYMENT_TYPE} AS payment_type, CAST(1 + o_orderkey % 10 AS BIGINT) AS payment_installments,
  CAST(value AS DECIMAL(18,2)) AS payment_value
FROM payment_parts"""

CTES["stg_order_reviews"] = """
SELECT 'R' || (o_orderkey // 2) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
  CAST(1 + o_orderkey % 5 AS BIGINT) AS review_score,
  CASE WHEN o_orderkey % 8 = 0 THEN 'title ' || o_orderkey END AS review_comment_title,
  CASE WHEN o_orderkey % 2 <> 0 THEN 'message, "' || o_orderkey || '"' || chr(10) || 'second line' END
    AS review_comment_message,
  o_orderdate + INTERVAL 20 DAY AS review_creation_date, o_orderdate + INTERVAL 22 DAY AS review_answer_timestamp
FROM orders WHERE o_orderkey % 10 <> 0"""

CTES["stg_customers"] = """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, upper(trim(customer_city)) AS customer_city,
  upper(trim(customer_state)) AS customer_state
FROM raw_customers"""

CTES["stg_sellers"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
  upper(trim(n_name)) AS seller_city, {array(STATES)}[s_nationkey + 1] AS seller_state
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

CTES["stg_products"] = """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS product_category_name,
  CAST(length(p_name) AS BIGINT) AS product_name_length, CAST(length(p_name) * 10 AS BIGINT) AS product_description_length,
  CAST(1 + p_size % 5 AS BIGINT) AS product_photos_qty, CAST(p_size * 100 AS DECIMAL(18,9)) AS product_weight_g,
  CAST(p_size + 10 AS DECIMAL(18,9)) AS product_length_cm, CAST(p_size + 5 AS DECIMAL(18,9)) AS product_height_cm,
  CAST(p_size + 8 AS DECIMAL(18,9)) AS product_width_cm
FROM part"""

CTES["stg_category_translation"] = f"""
SELECT DISTINCT lower(p_type) AS product_category_name, lower(p_type) || '_goods' AS product_category_name_english
FROM part WHERE p_type <> '{UNTRANSLATED}'"""

CTES["stg_geolocation"] = """
SELECT geolocation_zip_code_prefix, CAST(CAST(geolocation_lat AS DECIMAL(9,1)) AS DECIMAL(18,9)) AS latitude,
  CAST(CAST(geolocation_lng AS DECIMAL(9,1)) AS DECIMAL(18,9)) AS longitude,
  upper(trim(geolocation_city)) AS city, upper(trim(geolocation_state)) AS state
FROM raw_geolocation"""

CTES["stg_holiday_calendar"] = """
SELECT TRY_CAST(date AS DATE) AS hol_date, upper(trim(name)) AS hol_name, upper(trim(type)) AS hol_type,
  upper(trim(weekday)) AS hol_day
FROM raw_holidays"""

# --- intermediate -----------------------------------------------------------

CTES["int_order_items"] = "SELECT *, price + freight_value AS item_total_value FROM stg_order_items"

CTES["order_item_rollup"] = """
SELECT order_id, COUNT(*) AS order_item_count, SUM(price) AS order_gmv, SUM(freight_value) AS total_freight_value,
  SUM(item_total_value) AS order_total_value
FROM int_order_items GROUP BY order_id"""

CTES["int_order_payments"] = """
SELECT order_id, SUM(payment_value) AS total_payment_value, COUNT(*) AS payment_count,
  MAX(payment_installments) AS max_payment_installments
FROM stg_order_payments GROUP BY order_id"""

CTES["int_order_reviews"] = """
SELECT order_id, AVG(review_score) AS average_review_score, COUNT(*) AS review_count,
  MAX(review_creation_date) AS latest_review_date
FROM stg_order_reviews GROUP BY order_id"""

CTES["int_geolocation"] = """
SELECT geolocation_zip_code_prefix, latitude, longitude, city, state FROM stg_geolocation
QUALIFY ROW_NUMBER() OVER (PARTITION BY geolocation_zip_code_prefix
  ORDER BY city NULLS FIRST, state NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST) = 1"""

CTES["account_orders"] = """
SELECT o.order_id, o.customer_id, c.customer_unique_id, o.order_purchase_timestamp, o.order_status,
  o.order_status NOT IN ('CANCELED', 'UNAVAILABLE') AS is_qualifying_order,
  c.customer_zip_code_prefix, c.customer_city, c.customer_state
FROM stg_orders o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id"""

CTES["int_customer_orders"] = """
SELECT *,
  MIN(CASE WHEN is_qualifying_order THEN order_purchase_timestamp END) OVER (PARTITION BY customer_unique_id)
    AS first_order_timestamp,
  CASE WHEN is_qualifying_order THEN ROW_NUMBER() OVER (PARTITION BY customer_unique_id, is_qualifying_order
    ORDER BY order_purchase_timestamp NULLS FIRST, order_id) END AS customer_order_number
FROM account_orders"""

CTES["int_orders"] = """
SELECT o.*, h.customer_unique_id, i.order_item_count, COALESCE(i.order_gmv, 0) AS order_gmv, i.total_freight_value,
  i.order_total_value, p.total_payment_value, p.payment_count, p.max_payment_installments,
  r.average_review_score, r.review_count, r.latest_review_date, h.first_order_timestamp, h.customer_order_number,
  CASE WHEN h.customer_order_number = 1 THEN 'new' WHEN h.customer_order_number > 1 THEN 'returning'
    ELSE 'unknown' END AS customer_type,
  date_diff('day', CAST(o.order_purchase_timestamp AS DATE), CAST(o.order_delivered_customer_date AS DATE))
    AS delivery_days,
  date_diff('day', CAST(o.order_purchase_timestamp AS DATE), CAST(o.order_estimated_delivery_date AS DATE))
    AS estimated_delivery_days,
  CASE WHEN o.order_delivered_customer_date IS NULL THEN NULL
    ELSE COALESCE(CAST(o.order_delivered_customer_date AS DATE) > CAST(o.order_estimated_delivery_date AS DATE), FALSE)
    END AS is_late
FROM stg_orders o
LEFT JOIN order_item_rollup i ON o.order_id = i.order_id
LEFT JOIN int_order_payments p ON o.order_id = p.order_id
LEFT JOIN int_customer_orders h ON o.order_id = h.order_id
LEFT JOIN int_order_reviews r ON o.order_id = r.order_id"""

# --- marts ------------------------------------------------------------------

CTES["dim_date"] = f"""
SELECT {key('c.day')} AS date_key, c.day AS date, day(c.day) AS day, dayname(c.day) AS day_of_week,
  CAST(strftime(c.day, '%U') AS INTEGER) AS week, month(c.day) AS month, monthname(c.day) AS month_name,
  quarter(c.day) AS quarter, year(c.day) AS year, dayofweek(c.day) IN (0, 6) AS is_weekend,
  day(c.day + INTERVAL 1 DAY) = 1 AS is_month_end,
  day(c.day + INTERVAL 1 DAY) = 1 AND month(c.day) IN (3, 6, 9, 12) AS is_quarter_end,
  strftime(c.day, '%m%d') = '1231' AS is_year_end,
  CASE WHEN year(c.day) NOT IN ({", ".join(map(str, SETTINGS.holiday_years))}) THEN NULL
    ELSE h.hol_date IS NOT NULL END AS is_holiday,
  h.hol_name AS holiday_name, h.hol_type AS holiday_type, h.hol_day AS holiday_weekday
FROM (SELECT CAST(unnest(generate_series(DATE '{SETTINGS.calendar_start}', DATE '{SETTINGS.calendar_end}',
        INTERVAL 1 DAY)) AS DATE) AS day) c
LEFT JOIN stg_holiday_calendar h ON c.day = h.hol_date"""

CTES["dim_geolocation"] = f"""
SELECT md5(geolocation_zip_code_prefix) AS geolocation_key, geolocation_zip_code_prefix AS zip_code_prefix,
  latitude, longitude, city, state, {region_case('state')} AS region
FROM int_geolocation"""

CTES["last_orders"] = """
SELECT customer_unique_id, customer_id, customer_zip_code_prefix, customer_city, customer_state
FROM int_customer_orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_unique_id
  ORDER BY order_purchase_timestamp DESC NULLS LAST, order_id DESC) = 1"""

CTES["dim_customer"] = """
SELECT md5(p.customer_unique_id) AS customer_key, l.customer_id, p.customer_unique_id, l.customer_zip_code_prefix,
  l.customer_city, l.customer_state, CAST(f.first_order AS DATE) AS customer_first_order_date, g.geolocation_key
FROM (SELECT DISTINCT customer_unique_id FROM stg_customers) p
LEFT JOIN (SELECT customer_unique_id, MIN(order_purchase_timestamp) AS first_order FROM int_customer_orders
           GROUP BY customer_unique_id) f ON p.customer_unique_id = f.customer_unique_id
LEFT JOIN last_orders l ON p.customer_unique_id = l.customer_unique_id
LEFT JOIN dim_geolocation g ON l.customer_zip_code_prefix = g.zip_code_prefix"""

CTES["dim_product"] = """
SELECT md5(p.product_id) AS product_key, p.product_id, p.product_category_name,
  COALESCE(t.product_category_name_english, p.product_category_name, 'unknown') AS product_category_name_english,
  p.product_name_length, p.product_description_length, p.product_photos_qty, p.product_weight_g,
  p.product_height_cm, p.product_length_cm, p.product_width_cm
FROM stg_products p LEFT JOIN stg_category_translation t ON p.product_category_name = t.product_category_name"""

CTES["dim_seller"] = """
SELECT md5(s.seller_id) AS seller_key, s.*, g.geolocation_key
FROM stg_sellers s LEFT JOIN dim_geolocation g ON s.seller_zip_code_prefix = g.zip_code_prefix"""

CTES["fact_orders"] = f"""
SELECT md5(o.order_id) AS order_key, o.order_id, c.customer_key, {key('o.order_purchase_timestamp')} AS order_date_key,
  o.order_status, o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
  o.order_delivered_customer_date, o.order_estimated_delivery_date, o.order_item_count AS number_of_items,
  o.order_gmv AS gross_merchandise_value, o.total_freight_value, o.order_total_value, o.total_payment_value,
  o.delivery_days, o.estimated_delivery_days, o.is_late, o.average_review_score, o.review_count,
  o.latest_review_date, o.customer_type, o.first_order_timestamp
FROM int_orders o LEFT JOIN dim_customer c ON o.customer_unique_id = c.customer_unique_id"""

CTES["fact_order_items"] = f"""
SELECT md5(i.order_id || '-' || i.order_item_id) AS order_item_key, md5(i.order_id) AS order_key, p.product_key,
  s.seller_key, {key('o.order_purchase_timestamp')} AS order_date_key, i.order_item_id, i.product_id, i.seller_id,
  i.price, i.freight_value, i.shipping_limit_date
FROM int_order_items i
LEFT JOIN stg_orders o ON i.order_id = o.order_id
LEFT JOIN dim_product p ON i.product_id = p.product_id
LEFT JOIN dim_seller s ON i.seller_id = s.seller_id"""

CTES["fact_payments"] = f"""
SELECT md5(p.order_id || '-' || p.payment_sequential) AS payment_key, md5(p.order_id) AS order_key, c.customer_key,
  {key('o.order_purchase_timestamp')} AS order_date_key, p.payment_sequential, p.payment_type,
  p.payment_installments, p.payment_value
FROM stg_order_payments p
LEFT JOIN int_orders o ON p.order_id = o.order_id
LEFT JOIN dim_customer c ON o.customer_unique_id = c.customer_unique_id"""

CTES["fact_reviews"] = f"""
SELECT md5(r.review_id || '-' || r.order_id) AS review_order_key, md5(r.review_id) AS review_key,
  md5(r.order_id) AS order_key, c.customer_key, {key('r.review_creation_date')} AS review_date_key, r.review_id,
  r.review_score, r.review_comment_title, r.review_comment_message, r.review_creation_date, r.review_answer_timestamp
FROM stg_order_reviews r
LEFT JOIN int_orders o ON r.order_id = o.order_id
LEFT JOIN dim_customer c ON o.customer_unique_id = c.customer_unique_id"""

# --- customer scores --------------------------------------------------------

CTES["rfm_metrics"] = f"""
SELECT customer_key, DATE '{SETTINGS.analysis_date}' AS analysis_date,
  date_diff('day', CAST(MAX(order_purchase_timestamp) AS DATE), DATE '{SETTINGS.analysis_date}') AS recency,
  COUNT(DISTINCT order_id) AS frequency, SUM(gross_merchandise_value) AS monetary
FROM fact_orders WHERE order_status NOT IN ('CANCELED', 'UNAVAILABLE') GROUP BY customer_key"""

CTES["rfm_ranked"] = """
SELECT *, PERCENT_RANK() OVER (ORDER BY recency NULLS FIRST) AS r_rank,
  PERCENT_RANK() OVER (ORDER BY monetary NULLS FIRST) AS m_rank
FROM rfm_metrics"""

CTES["rfm_scored"] = """
SELECT customer_key, analysis_date, recency, frequency, monetary,
  CASE WHEN r_rank <= 0.2::DOUBLE THEN 5 WHEN r_rank <= 0.4::DOUBLE THEN 4 WHEN r_rank <= 0.6::DOUBLE THEN 3
    WHEN r_rank <= 0.8::DOUBLE THEN 2 ELSE 1 END AS recency_score,
  CASE WHEN frequency >= 4 THEN 4 WHEN frequency >= 1 THEN CAST(frequency AS INTEGER) END AS frequency_score,
  CASE WHEN m_rank <= 0.2::DOUBLE THEN 1 WHEN m_rank <= 0.4::DOUBLE THEN 2 WHEN m_rank <= 0.6::DOUBLE THEN 3
    WHEN m_rank <= 0.8::DOUBLE THEN 4 ELSE 5 END AS monetary_score
FROM rfm_ranked"""

CTES["fct_customer_rfm"] = """
SELECT *, CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) || CAST(monetary_score AS VARCHAR)
    AS rfm_code,
  recency_score + frequency_score + monetary_score AS rfm_total_score,
  CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
    WHEN recency_score >= 4 AND frequency_score >= 3 THEN 'Loyal Customers'
    WHEN monetary_score = 5 AND recency_score >= 3 THEN 'Big Spenders'
    WHEN recency_score >= 4 AND frequency_score = 1 THEN 'Recent One-Time Customers'
    WHEN recency_score >= 4 AND frequency_score = 2 THEN 'Potential Loyalists'
    WHEN recency_score IN (2, 3) AND frequency_score >= 3 THEN 'At Risk'
    WHEN recency_score IN (2, 3) AND frequency_score <= 2 THEN 'Needs Attention'
    WHEN recency_score = 1 THEN 'Lost Customers' ELSE 'Other' END AS customer_segment
FROM rfm_scored"""

# --- shared by the reports --------------------------------------------------

CTES["order_totals"] = f"""
SELECT i.order_key, SUM(i.price + i.freight_value) AS total_order_value
FROM fact_order_items i JOIN dim_date d ON i.order_date_key = d.date_key
WHERE {in_window()} GROUP BY i.order_key"""

CTES["all_order_totals"] = """
SELECT order_key, SUM(price + freight_value) AS total_order_value FROM fact_order_items GROUP BY order_key"""

CTES["known_days"] = f"""
SELECT *, CASE WHEN is_holiday THEN 'Holiday' ELSE 'Non-Holiday' END AS day_type,
  CAST(year AS VARCHAR) || '-Q' || CAST(quarter AS VARCHAR) AS year_quarter
FROM dim_date d WHERE is_holiday IS NOT NULL AND {in_window()}"""


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the sub-queries it uses, directly or not, in order."""
    known = {**CTES, **(extra or {})}
    words = {name: set(re.findall(r"[a-z_0-9]+", sql)) for name, sql in known.items()}
    need: set[str] = set()
    todo = [w for w in re.findall(r"[a-z_0-9]+", body) if w in known]
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo += [w for w in words[name] if w in known and w != name]
    parts = [f"{name} AS ({known[name].strip()})" for name in known if name in need]
    return (f"WITH {', '.join(parts)} " if parts else "") + body.strip()
