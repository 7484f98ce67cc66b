"""Plausibility checks of the loaded tables.

A table's checks are evaluated together in one aggregation, whatever their
number and severity; only compound uniqueness needs its own grouping.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.domain import (
    HOLIDAY_TYPES,
    HOLIDAY_WEEKDAYS,
    MART_BASELINES,
    ORDER_STATUSES,
    PAYMENT_TYPES,
    RAW_ROWS,
    STAGING_ROWS,
    STATES,
)
from feira.functions.columns import MONEY, TOTAL, minus
from feira.operators.model_tests import as_rows, stacked
from feira.plans.duplicates import Key, repeated_keys

CRITICAL, OBSERVATION, MART = "critical", "observation", "mart"
NO_COLUMN = "<table or column pair>"


@dataclass(frozen=True)
class Check:
    """One expectation. ``column >= other`` for pairs, ``columns`` for compound keys."""

    group: str
    table: str
    kind: str
    column: str | None = None
    other: str | None = None
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    strict_low: bool = False
    values: tuple = ()
    pattern: str | None = None
    mostly: float = 1.0

    @property
    def label(self) -> str:
        """Column name as reported; pairs, compound keys and table checks have none."""
        return self.column if self.column and not self.other else NO_COLUMN

    @property
    def detail(self) -> str:
        if self.other:
            return f"{self.column} >= {self.other}"
        if self.columns:
            return ", ".join(self.columns)
        if self.kind in ("between", "mean_between", "sum_between", "row_count_between"):
            sign = ">" if self.strict_low else ">="
            bounds = [f"{sign} {self.low:.15g}"] if self.low is not None else []
            return " and ".join(bounds + ([f"<= {self.high:.15g}"] if self.high is not None else []))
        return ""


def _group(group: str, table: str):
    def add(kind: str, column: str | None = None, **options) -> Check:
        return Check(group, table, kind, column, **options)

    return add


def row_count_check(table: str, baseline: int, group: str = OBSERVATION) -> Check:
    """Five percent around a baseline, both bounds cut to whole rows."""
    return Check(group, table, "row_count_between", low=int(baseline * 0.95), high=int(baseline * 1.05))


# --- fixed values: the declared expectations -------------------------------

ZIP = r"^\d{5}$"


def staging_checks(row_baselines: dict[str, int] | None = None) -> list[Check]:
    """All checks of the staged tables; ``row_baselines`` are the expected row counts."""
    baselines = STAGING_ROWS if row_baselines is None else row_baselines
    critical: list[Check] = []
    c = _group(CRITICAL, "customers")
    critical += [
        c("in_set", "customer_state", values=tuple(STATES)),
        c("regex", "customer_zip_code_prefix", pattern=ZIP),
    ]
    c = _group(CRITICAL, "orders")
    critical += [
        c("in_set", "order_status", values=tuple(ORDER_STATUSES)),
        c("not_null", "order_purchase_timestamp"),
        c("pair_greater", "order_approved_at", other="order_purchase_timestamp"),
        c("pair_greater", "order_delivered_customer_date", other="order_purchase_timestamp"),
    ]
    c = _group(CRITICAL, "order_items")
    critical += [
        c("between", "order_item_id", low=1),
        c("between", "price", low=0, strict_low=True),
        c("between", "freight_value", low=0),
    ]
    c = _group(CRITICAL, "payments")
    critical += [
        c("between", "payment_sequential", low=1),
        c("between", "payment_value", low=0),
        c("in_set", "payment_type", values=tuple(PAYMENT_TYPES), mostly=0.9999),
    ]
    c = _group(CRITICAL, "reviews")
    critical += [
        c("between", "review_score", low=1, high=5),
        c("pair_greater", "review_answer_timestamp", other="review_creation_date"),
    ]
    c = _group(CRITICAL, "products")
    critical += [
        c("between", column, low=0)
        for column in (
            "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
            "product_length_cm", "product_height_cm", "product_width_cm",
        )
    ]
    c = _group(CRITICAL, "sellers")
    critical += [
        c("in_set", "seller_state", values=tuple(STATES)),
        c("regex", "seller_zip_code_prefix", pattern=ZIP),
    ]
    c = _group(CRITICAL, "geolocation")
    critical += [
        c("between", "geolocation_lat", low=-90, high=90),
        c("between", "geolocation_lng", low=-180, high=180),
        c("in_set", "geolocation_state", values=tuple(STATES)),
        c("regex", "geolocation_zip_code_prefix", pattern=ZIP),
    ]
    c = _group(CRITICAL, "holidays")
    critical += [
        c("not_null", "hol_date"),
        c("not_null", "hol_name"),
        c("in_set", "hol_day", values=tuple(HOLIDAY_WEEKDAYS)),
    ]

    watched = [row_count_check(table, rows) for table, rows in baselines.items()]
    o = _group(OBSERVATION, "customers")
    watched += [o("not_null", "customer_city", mostly=0.99)]
    o = _group(OBSERVATION, "orders")
    watched += [
        o("not_null", "order_approved_at", mostly=0.98),
        o("pair_greater", "order_delivered_carrier_date", other="order_purchase_timestamp", mostly=0.995),
        o("pair_greater", "order_delivered_customer_date", other="order_delivered_carrier_date", mostly=0.999),
        o("pair_greater", "order_estimated_delivery_date", other="order_delivered_customer_date", mostly=0.90),
        o("in_set", "delivery_date_matches_status", values=(True,), mostly=0.999),
    ]
    o = _group(OBSERVATION, "order_items")
    watched += [
        o("mean_between", "price", low=95, high=145),
        o("mean_between", "freight_value", low=16, high=24),
        o("in_set", "shipping_after_purchase", values=(True,), mostly=0.999),
    ]
    o = _group(OBSERVATION, "payments")
    watched += [
        o("between", "payment_installments", low=1, mostly=0.9999),
        o("between", "payment_value", low=0, strict_low=True, mostly=0.9999),
        o("mean_between", "payment_value", low=120, high=190),
    ]
    o = _group(OBSERVATION, "reviews")
    watched += [
        o("not_null", "review_comment_title", mostly=0.10),
        o("not_null", "review_comment_message", mostly=0.35),
        o("mean_between", "review_score", low=3.8, high=4.3),
    ]
    o = _group(OBSERVATION, "products")
    watched += [
        o("not_null", "product_category_name", mostly=0.97),
        o("between", "product_weight_g", low=0, high=50_000, mostly=0.999),
    ]
    o = _group(OBSERVATION, "sellers")
    watched += [o("not_null", "seller_city", mostly=0.99)]
    o = _group(OBSERVATION, "geolocation")
    watched += [
        o("between", "geolocation_lat", low=-34, high=6, mostly=0.9999),
        o("between", "geolocation_lng", low=-74, high=-34, mostly=0.9999),
        o(
            "compound_unique",
            columns=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                     "geolocation_city", "geolocation_state"),
            mostly=0.60,
        ),
    ]
    o = _group(OBSERVATION, "holidays")
    watched += [o("in_set", "hol_type", values=tuple(HOLIDAY_TYPES))]
    o = _group(OBSERVATION, "order_reconciliation")
    watched += [o("in_set", "payment_matches_items", values=(True,), mostly=0.99)]
    return critical + watched


def mart_checks(baselines: dict[str, dict] | None = None) -> list[Check]:
    """Row count and value total of a mart, five percent around its baseline."""
    out = []
    for table, base in (MART_BASELINES if baselines is None else baselines).items():
        out.append(row_count_check(table, base["rows"], MART))
        out.append(
            Check(MART, table, "sum_between", base["column"], low=base["value"] * 0.95, high=base["value"] * 1.05)
        )
    return out


# --- frames the checks run on ----------------------------------------------

# --- fixed values: logical table -> staging model and its renamed columns ---
STAGING_MODELS = {
    "customers": "stg_customers",
    "orders": "stg_orders",
    "order_items": "stg_order_items",
    "payments": "stg_order_payments",
    "reviews": "stg_order_reviews",
    "products": "stg_products",
    "sellers": "stg_sellers",
    "geolocation": "stg_geolocation",
    "holidays": "stg_holiday_calendar",
}
STAGING_RENAMES = {
    "products": {
        "product_name_length": "product_name_lenght",
        "product_description_length": "product_description_lenght",
    },
    "geolocation": {
        "latitude": "geolocation_lat",
        "longitude": "geolocation_lng",
        "city": "geolocation_city",
        "state": "geolocation_state",
    },
}
LAYER_TABLES = {
    # holidays come as one feed per year and are one table from staging on
    "raw": {name: name for name in STAGING_MODELS if name != "holidays"},
    "staging": STAGING_MODELS,
}
LAYER_ROWS = {"raw": RAW_ROWS, "staging": STAGING_ROWS}
NUMERIC = {
    "order_items": ["order_item_id", "price", "freight_value"],
    "payments": ["payment_sequential", "payment_installments", "payment_value"],
    "reviews": ["review_score"],
    "products": [
        "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "geolocation": ["geolocation_lat", "geolocation_lng"],
}
MOMENTS = {
    "orders": [
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "order_items": ["shipping_limit_date"],
    "reviews": ["review_creation_date", "review_answer_timestamp"],
}
ZIPS = {
    "customers": "customer_zip_code_prefix",
    "sellers": "seller_zip_code_prefix",
    "geolocation": "geolocation_zip_code_prefix",
}
_EXACT = {"price": MONEY, "freight_value": MONEY, "payment_value": MONEY}


def layer_frames(tables: dict[str, DataFrame], layer: str = "staging") -> dict[str, DataFrame]:
    """A layer's tables under the raw layer's column names and status spelling, so that checks run on either."""
    if layer == "raw":
        return dict(tables)
    frames = {name: df.withColumnsRenamed(STAGING_RENAMES.get(name, {})) for name, df in tables.items()}
    if "orders" in frames:
        frames["orders"] = frames["orders"].withColumn("order_status", F.lower("order_status"))
    return frames


def read_layer(read: Callable[[str], DataFrame], layer: str) -> dict[str, DataFrame]:
    """All logical tables of a layer; ``read`` opens a physical table by its name there."""
    if layer not in LAYER_TABLES:
        raise ValueError(f"unknown layer {layer!r}")
    return layer_frames({logical: read(physical) for logical, physical in LAYER_TABLES[layer].items()}, layer)


def layer_checks(layer: str, row_baselines: dict[str, int] | None = None) -> list[Check]:
    """The checks that apply to a layer, with its own row baselines."""
    baselines = LAYER_ROWS[layer] if row_baselines is None else row_baselines
    tables = {*LAYER_TABLES[layer], "order_reconciliation"}
    return [c for c in staging_checks({t: n for t, n in baselines.items() if t in tables}) if c.table in tables]


def _coercions(table: str) -> dict[str, Column]:
    """Column -> its value as a number, moment or five-digit ZIP; NULL where it is none."""
    out = {c: F.col(c).try_cast(_EXACT.get(c, "double")) for c in NUMERIC.get(table, [])}
    out |= {c: F.col(c).try_cast("timestamp") for c in MOMENTS.get(table, [])}
    if table in ZIPS:
        digits = F.col(ZIPS[table]).try_cast("bigint").cast("string")
        out[ZIPS[table]] = F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)
    return out


def coerce(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: df.withColumns(_coercions(name)) if _coercions(name) else df for name, df in frames.items()}


def dq_coerce(frames: dict[str, DataFrame]) -> DataFrame:
    """Values per column that were given but could not be converted."""
    parts = []
    for name, df in frames.items():
        casts = _coercions(name)
        if casts:
            lost = df.agg(*[F.count_if(F.col(c).isNotNull() & v.isNull()).alias(c) for c, v in casts.items()])
            parts.append(
                as_rows(lost, [
                    {"table": F.lit(name), "column": F.lit(c), "new_nulls": F.col(c)} for c in casts
                ])
            )
    return stacked(parts).filter(F.col("new_nulls") > 0)


def dq_status_date_consistency(orders: DataFrame) -> DataFrame:
    """Flag whether exactly the delivered orders have a delivery date; no status is not delivered."""
    delivered = F.col("order_status").eqNullSafe("delivered")
    dated = F.col("order_delivered_customer_date").isNotNull()
    return orders.withColumn("delivery_date_matches_status", delivered == dated)


def dq_shipping_after_purchase(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Flag items whose shipping limit is not before the purchase; true when either is missing."""
    bought = orders.select("order_id", F.col("order_purchase_timestamp").alias("__bought"))
    early = F.coalesce(F.col("shipping_limit_date") < F.col("__bought"), F.lit(False))
    return (
        items.join(bought, "order_id", "left").withColumn("shipping_after_purchase", ~early).drop("__bought")
    )


def dq_order_reconciliation(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Items against payments of the orders that have both; one cent of difference is allowed."""
    none = F.lit(0).cast(TOTAL)
    due = items.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.coalesce(F.sum(F.col("price") + F.col("freight_value")), none).alias("order_item_freight_total")
    )
    paid = payments.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.coalesce(F.sum("payment_value"), none).alias("order_payment_total")
    )
    gap = F.abs(minus(F.col("order_payment_total"), F.col("order_item_freight_total")))
    cent = F.lit("0.01").cast("decimal(4,2)")
    return due.join(paid, "order_id").withColumn("payment_matches_items", gap <= cent)


def row_wise(name: str, df: DataFrame) -> DataFrame:
    """A logical table with its columns coerced and the flags that need no other table."""
    out = coerce({name: df})[name]
    return dq_status_date_consistency(out) if name == "orders" else out


def checked(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Everything the checks read, by logical table."""
    frames = coerce(tables)
    frames["order_reconciliation"] = dq_order_reconciliation(frames["order_items"], frames["payments"])
    frames["order_items"] = dq_shipping_after_purchase(frames["order_items"], frames["orders"])
    frames["orders"] = dq_status_date_consistency(frames["orders"])
    return frames


def check_frames(tables: dict[str, DataFrame], layer: str = "staging") -> dict[str, DataFrame]:
    """What the checks read of a layer's tables."""
    return checked(layer_frames(tables, layer))


# --- evaluation -------------------------------------------------------------


def _number(value: float) -> Column:
    return F.lit(float(value))


def _fails(check: Check) -> Column:
    """Whether a present value breaks a row-wise check."""
    value = F.col(check.column)
    if check.kind == "in_set":
        return ~value.isin(list(check.values))
    if check.kind == "regex":
        return ~value.rlike(check.pattern)
    if check.kind == "pair_greater":
        return ~(value >= F.col(check.other))
    tests = []
    if check.low is not None:
        tests.append(value <= check.low if check.strict_low else value < check.low)
    if check.high is not None:
        tests.append(value > check.high)
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def measures(check: Check, i: int) -> list[Column]:
    """Aggregates of one check: values looked at, unexpected values, observed value."""
    nothing = F.lit(None).cast("double")
    total = F.count("*")
    if check.kind == "not_null":
        looked, wrong, seen = total, F.count_if(F.col(check.column).isNull()), nothing
    elif check.kind == "mean_between":
        sums = F.sum(check.column).cast("double")
        looked, wrong, seen = total, F.lit(None).cast("bigint"), F.try_divide(sums, F.count(check.column))
    elif check.kind == "sum_between":
        looked, wrong, seen = total, F.lit(None).cast("bigint"), F.sum(check.column).cast("double")
    elif check.kind == "row_count_between":
        looked, wrong, seen = total, F.lit(None).cast("bigint"), total.cast("double")
    else:
        present = F.col(check.column).isNotNull()
        if check.other:
            present &= F.col(check.other).isNotNull()
        looked, wrong, seen = F.count_if(present), F.count_if(_fails(check)), nothing
    return [looked.alias(f"n{i}"), wrong.alias(f"u{i}"), seen.alias(f"v{i}")]


def result(check: Check, n: Column, wrong: Column, seen: Column) -> dict[str, Column]:
    if check.kind.endswith("_between"):
        passed = seen.between(_number(check.low), _number(check.high))
    else:
        share = (n - wrong).cast("double") / n.cast("double")
        passed = F.when(n == 0, True).otherwise(share >= _number(check.mostly))
    percent = F.when(n > 0, wrong.cast("double") * 100 / n.cast("double"))
    return {
        "group": F.lit(check.group),
        "table": F.lit(check.table),
        "expectation": F.lit(check.kind),
        "column": F.lit(check.label),
        "detail": F.lit(check.detail),
        "success": F.coalesce(passed, F.lit(False)),
        "observed_value": seen,
        "unexpected_count": wrong,
        "unexpected_percent": percent,
    }


def _evaluate_compound(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Every member of a repeated key is unexpected; rows without any value are ignored."""
    found = repeated_keys(df, [Key(c.columns, "some") for c in checks])
    counted = df.sparkSession.createDataFrame(
        [tuple(v for r in found for v in (r.rows, r.members))],
        ", ".join(f"n{i} bigint, u{i} bigint" for i in range(len(checks))),
    )
    nothing = F.lit(None).cast("double")
    return as_rows(counted, [result(c, F.col(f"n{i}"), F.col(f"u{i}"), nothing) for i, c in enumerate(checks)])


def evaluate(df: DataFrame, checks: list[Check]) -> list[DataFrame]:
    """Result rows of one table's checks: one aggregation, plus one search for all compound keys."""
    single = [c for c in checks if c.kind != "compound_unique"]
    compound = [c for c in checks if c.kind == "compound_unique"]
    parts = [_evaluate_compound(df, compound)] if compound else []
    if single:
        measured = df.agg(*[m for i, c in enumerate(single) for m in measures(c, i)])
        rows = [result(c, F.col(f"n{i}"), F.col(f"u{i}"), F.col(f"v{i}")) for i, c in enumerate(single)]
        parts.insert(0, as_rows(measured, rows))
    return parts


def run_checks(frames: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Long result table: one row per check."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    return stacked([part for table, own in by_table.items() for part in evaluate(frames[table], own)])


def of_kind(checks: Iterable[Check], *kinds: str) -> list[Check]:
    return [c for c in checks if c.kind in kinds]


def dq_suite_run(spark: SparkSession, details: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Verdict per group and table; a table without checks in a group passes."""
    places = [
        F.struct(F.lit(g).alias("group"), F.lit(t).alias("table")) for g in (CRITICAL, OBSERVATION) for t in tables
    ]
    every = spark.range(1).select(F.explode(F.array(*places)).alias("p")).select("p.*")
    verdicts = details.groupBy("group", "table").agg(F.bool_and("success").alias("success"))
    return (
        every.join(verdicts, ["group", "table"], "left")
        .select(
            "group",
            "table",
            F.concat_ws("_", "table", "group", F.lit("validation")).alias("validation"),
            F.coalesce("success", F.lit(True)).alias("success"),
        )
        .orderBy("group", "table")
    )


def dq_failure_detail(details: DataFrame) -> DataFrame:
    return details.filter(~F.col("success"))


def dq_observation_unexpected(details: DataFrame) -> DataFrame:
    """Observations with unexpected values, also those within tolerance."""
    return details.filter((F.col("group") == OBSERVATION) & (F.col("unexpected_count") > 0))


def dq_gate(details: DataFrame, raise_on_critical: bool = True, raise_on_mart: bool = False) -> DataFrame:
    """Failed checks per group and whether they stop the run; observations never do."""
    stops = F.when(F.col("group") == CRITICAL, F.lit(raise_on_critical)).when(
        F.col("group") == MART, F.lit(raise_on_mart)
    ).otherwise(False)
    return (
        details.groupBy("group")
        .agg(F.count("*").alias("checks"), F.count_if(~F.col("success")).alias("failed"))
        .withColumn("blocking", stops & (F.col("failed") > 0))
        .orderBy("group")
    )
