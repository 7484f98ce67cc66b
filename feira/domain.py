"""Word lists, lookup tables and thresholds of the data set."""

from __future__ import annotations

# --- fixed values: the 27 states, in the order of the domain list ---------
STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG",
    "PA", "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

# --- fixed values: region of each state -----------------------------------
REGIONS = {
    "North": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Northeast": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Central-West": ["DF", "GO", "MT", "MS"],
    "Southeast": ["ES", "MG", "RJ", "SP"],
    "South": ["PR", "RS", "SC"],
}
UNKNOWN_REGION = "Unknown"

# --- fixed values: order life cycle ---------------------------------------
ORDER_STATUSES = [
    "created", "approved", "invoiced", "processing", "shipped", "delivered", "unavailable", "canceled",
]
# orders that never count as a purchase
NON_QUALIFYING = ["CANCELED", "UNAVAILABLE"]

# --- fixed values: payments and holidays ----------------------------------
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]
HOLIDAY_TYPES = ["NATIONAL"]
HOLIDAY_WEEKDAYS = [
    "DOMINGO", "SEGUNDA-FEIRA", "TERÇA-FEIRA", "QUARTA-FEIRA",
    "QUINTA-FEIRA", "SEXTA-FEIRA", "SÁBADO",
]

HOLIDAY = "Holiday"
NON_HOLIDAY = "Non-Holiday"
DAY_TYPES = [HOLIDAY, NON_HOLIDAY]

# --- fixed values: row counts the loads are compared with -----------------
RAW_ROWS = {
    "customers": 99_441,
    "orders": 99_441,
    "order_items": 112_650,
    "payments": 103_886,
    "reviews": 99_224,
    "products": 32_951,
    "sellers": 3_095,
    "geolocation": 1_000_163,
}
STAGING_ROWS = {**RAW_ROWS, "holidays": 26}

# --- fixed values: mart size and value baselines --------------------------
MART_BASELINES = {
    "fact_orders": {"rows": 99_441, "column": "order_total_value", "value": 15_843_553.24},
    "fact_payments": {"rows": 103_886, "column": "payment_value", "value": 16_008_872.12},
}
