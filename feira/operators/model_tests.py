"""Structural tests of the models: each returns the number of failing rows or values.

All NULL tests of a model share one aggregation, parents are reduced to their
distinct keys once, and children to counted keys before they meet the parents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.domain import REGIONS, UNKNOWN_REGION
from feira.plans.duplicates import Key, compact, repeated_in, repeated_keys

# (model, columns) -> frame that holds at least these columns of the model
Models = Callable[[str, list[str]], DataFrame]

# --- fixed values: the declared tests --------------------------------------
NOT_NULL = {
    "stg_customers": ["customer_id", "customer_unique_id"],
    "stg_orders": ["order_id", "customer_id", "order_purchase_timestamp", "order_status"],
    "stg_order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
    "stg_order_payments": ["order_id", "payment_type", "payment_value"],
    "stg_order_reviews": ["review_id", "order_id", "review_score"],
    "stg_products": ["product_id"],
    "stg_sellers": ["seller_id"],
    "stg_geolocation": ["geolocation_zip_code_prefix", "latitude", "longitude"],
    "stg_category_translation": ["product_category_name"],
    "stg_holiday_calendar": ["hol_date"],
    "int_geolocation": ["geolocation_zip_code_prefix"],
    "int_order_items": ["order_id", "order_item_id", "item_total_value"],
    "int_order_payments": ["order_id", "total_payment_value"],
    "int_order_reviews": ["order_id", "average_review_score"],
    "int_customer_orders": ["order_id", "customer_unique_id", "is_qualifying_order"],
    "int_orders": ["order_id", "customer_id"],
    "dim_geolocation": ["geolocation_key", "zip_code_prefix", "region"],
    "dim_date": ["date_key", "date"],
    "dim_customer": ["customer_key", "customer_id", "customer_unique_id"],
    "dim_product": ["product_key"],
    "dim_seller": ["seller_key"],
    "fact_reviews": ["review_order_key"],
    "fct_customer_rfm": ["customer_key"],
    "fact_order_items": ["order_item_key"],
    "fact_orders": ["order_key"],
    "fact_payments": ["payment_key"],
}
UNIQUE = {
    "stg_customers": ["customer_id"],
    "stg_orders": ["order_id"],
    "stg_products": ["product_id"],
    "stg_sellers": ["seller_id"],
    "stg_category_translation": ["product_category_name"],
    "stg_holiday_calendar": ["hol_date"],
    "int_geolocation": ["geolocation_zip_code_prefix"],
    "int_order_payments": ["order_id"],
    "int_order_reviews": ["order_id"],
    "int_customer_orders": ["order_id"],
    "int_orders": ["order_id"],
    "dim_geolocation": ["geolocation_key", "zip_code_prefix"],
    "dim_date": ["date_key", "date"],
    "dim_customer": ["customer_key", "customer_unique_id"],
    "dim_product": ["product_key"],
    "dim_seller": ["seller_key"],
    "fact_reviews": ["review_order_key"],
    "fct_customer_rfm": ["customer_key"],
    "fact_order_items": ["order_item_key"],
    "fact_orders": ["order_key"],
    "fact_payments": ["payment_key"],
}
# models that look rows up by keys: those keys, and the columns that the lookups bring, for models cut to their columns
_ORDER, _ACCOUNT = ("stg_orders", "order_id"), ("stg_customers", "customer_id")
LOOKED_UP = {
    "int_customer_orders": ([_ACCOUNT], ["customer_unique_id"]),
    "int_orders": ([_ORDER, _ACCOUNT], []),
    "fact_reviews": ([_ORDER, _ACCOUNT], []),
    "fact_order_items": (
        [
            _ORDER,
            ("stg_products", "product_id"),
            ("stg_category_translation", "product_category_name"),
            ("stg_sellers", "seller_id"),
        ],
        ["order_date_key", "product_key", "seller_key"],
    ),
    "fact_orders": ([_ACCOUNT], ["customer_key"]),
    "fact_payments": ([_ORDER, _ACCOUNT], []),
}
# child model, child column, parent model, parent column, severity
RELATIONSHIPS = [
    ("stg_customers", "customer_id", "stg_orders", "customer_id", "error"),
    ("stg_orders", "customer_id", "stg_customers", "customer_id", "error"),
    ("stg_order_items", "order_id", "stg_orders", "order_id", "error"),
    ("stg_order_items", "product_id", "stg_products", "product_id", "error"),
    ("stg_order_items", "seller_id", "stg_sellers", "seller_id", "error"),
    ("stg_order_payments", "order_id", "stg_orders", "order_id", "error"),
    ("stg_order_reviews", "order_id", "stg_orders", "order_id", "error"),
    ("stg_products", "product_category_name", "stg_category_translation", "product_category_name", "warn"),
    ("dim_customer", "geolocation_key", "dim_geolocation", "geolocation_key", "error"),
    ("dim_seller", "geolocation_key", "dim_geolocation", "geolocation_key", "error"),
    ("fact_reviews", "order_key", "fact_orders", "order_key", "error"),
    ("fact_reviews", "customer_key", "dim_customer", "customer_key", "error"),
    ("fact_reviews", "review_date_key", "dim_date", "date_key", "error"),
    ("fct_customer_rfm", "customer_key", "dim_customer", "customer_key", "error"),
    ("fact_order_items", "order_key", "fact_orders", "order_key", "error"),
    ("fact_order_items", "product_key", "dim_product", "product_key", "error"),
    ("fact_order_items", "seller_key", "dim_seller", "seller_key", "error"),
    ("fact_order_items", "order_date_key", "dim_date", "date_key", "error"),
    ("fact_orders", "customer_key", "dim_customer", "customer_key", "error"),
    ("fact_orders", "order_date_key", "dim_date", "date_key", "error"),
    ("fact_payments", "order_key", "fact_orders", "order_key", "error"),
    ("fact_payments", "customer_key", "dim_customer", "customer_key", "error"),
    ("fact_payments", "order_date_key", "dim_date", "date_key", "error"),
]
ACCEPTED_VALUES = [
    (
        "stg_orders",
        "order_status",
        ["DELIVERED", "SHIPPED", "CANCELED", "UNAVAILABLE", "INVOICED", "PROCESSING", "CREATED", "APPROVED"],
    ),
    ("dim_geolocation", "region", [*REGIONS, UNKNOWN_REGION]),
]
UNIQUE_COMBINATION = [
    ("stg_order_items", ["order_id", "order_item_id"]),
    ("stg_order_payments", ["order_id", "payment_sequential"]),
    ("stg_order_reviews", ["review_id", "order_id"]),
]
EQUAL_ROWCOUNT = [
    ("fact_reviews", "stg_order_reviews"),
    ("dim_product", "stg_products"),
    ("dim_seller", "stg_sellers"),
    ("fact_order_items", "stg_order_items"),
    ("fact_orders", "stg_orders"),
    ("fact_payments", "stg_order_payments"),
]


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def as_rows(one_row: DataFrame, fields: list[dict[str, Column]]) -> DataFrame:
    """One output row per entry, from a frame with a single row."""
    structs = [F.struct(*[v.alias(k) for k, v in f.items()]) for f in fields]
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _label(**values: str) -> dict[str, Column]:
    return {k: F.lit(v) for k, v in values.items()}


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return as_rows(counted, [{**_label(model=model, column=c), "failures": F.col(c)} for c in columns])


def _failures(spark: SparkSession, rows: list[tuple[str, str, int]]) -> DataFrame:
    return spark.createDataFrame(rows, "model string, column string, failures bigint")


def unique(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Values per column that occur more than once; NULLs do not count."""
    found = repeated_keys(df, [Key((c,), "none") for c in columns])
    return _failures(df.sparkSession, [(model, c, r.values) for c, r in zip(columns, found)])


def key_set(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).select(F.col(column).alias("key")).distinct()


def relationships(child: DataFrame, column: str, parent_keys: DataFrame) -> DataFrame:
    """Rows whose value is not among ``parent_keys``; children meet them as counted keys."""
    counted = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).count()
    orphans = counted.join(parent_keys, "key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("failures"))


def accepted_values(df: DataFrame, model: str, column: str, values: list[str]) -> DataFrame:
    """Rows with a value outside the list; NULL is not a value."""
    return df.agg(F.count_if(~F.col(column).isin(values)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column"), "failures"
    )


def unique_combination(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Compound keys that occur more than once; NULL is a value like others."""
    found = repeated_keys(df, [Key(tuple(columns))])
    return _failures(df.sparkSession, [(model, ", ".join(columns), found[0].values)])


def equal_rowcount(df: DataFrame, other: DataFrame, model: str, compared: str) -> DataFrame:
    """Row counts of a model and its source side by side, from one aggregate over both."""
    both = stacked([df.select(F.lit(1).alias("mine")), other.select(F.lit(0).alias("mine"))])
    return both.agg(
        F.count_if(F.col("mine") == 1).alias("model_rows"), F.count_if(F.col("mine") == 0).alias("compared_rows")
    ).select(
        F.lit(model).alias("model"),
        F.lit(compared).alias("compared_model"),
        "model_rows",
        "compared_rows",
        (F.col("model_rows") == F.col("compared_rows")).alias("success"),
    )


# --- the declared sets ------------------------------------------------------


def dq_not_null(models: Models) -> DataFrame:
    return stacked([not_null(models(m, columns), m, columns) for m, columns in NOT_NULL.items()])


def dq_unique(models: Models, unjoined: Models | None = None) -> DataFrame:
    """Every declared unique column; a model is read once for all of its columns.

    The keys of the staging layer are tested first. A left join to keys that occur once neither adds nor drops rows, so a model
    whose ``LOOKED_UP`` keys were all found unique is taken ``unjoined``, if that is given, and else with the joins.
    """

    def tested(frames: dict[str, DataFrame]) -> dict[str, list[int]]:
        found = repeated_in({m: (df, [Key((c,), "none") for c in UNIQUE[m]]) for m, df in frames.items()})
        return {m: [r.values for r in found[m]] for m in frames}

    first = [m for m in UNIQUE if m.startswith("stg_")]
    values = tested({m: models(m, UNIQUE[m]) for m in first})
    repeated = {(m, c) for m in first for c, n in zip(UNIQUE[m], values[m]) if n}
    frames = {}
    for m in UNIQUE:
        if m in first:
            continue
        keys, brought = LOOKED_UP.get(m, ([], []))
        if repeated.intersection(keys):
            frames[m] = models(m, [*UNIQUE[m], *brought])
        else:
            frames[m] = (unjoined if unjoined and keys else models)(m, UNIQUE[m])
    values |= tested(frames)
    rows = [(m, c, n) for m, columns in UNIQUE.items() for c, n in zip(columns, values[m])]
    return _failures(next(iter(frames.values())).sparkSession, rows)


def dq_relationships(models: Models) -> DataFrame:
    """Every declared relationship. Each model is read once, and the keys of parents and children meet in one grouping,
    counted on the map side: a key crosses the network once per model that holds it."""
    places = list(dict.fromkeys((parent, column) for _, _, parent, column, _ in RELATIONSHIPS))
    members: dict[int, list[tuple[str, str, str]]] = {i: [] for i in range(len(places))}
    cells: dict[str, dict[tuple[int, int], str]] = {}
    for i, (parent, column) in enumerate(places):
        cells.setdefault(parent, {})[i, -1] = column
    for child, column, parent, parent_column, severity in RELATIONSHIPS:
        i = places.index((parent, parent_column))
        cells.setdefault(child, {})[i, len(members[i])] = column
        members[i].append((child, column, severity))

    parts = []
    for model, own in cells.items():
        each = [
            F.when(
                F.col(c).isNotNull(),
                F.struct(F.lit(i).alias("place"), F.lit(slot).alias("slot"), compact(F.col(c)).alias("key")),
            )
            for (i, slot), c in own.items()
        ]
        df = models(model, list(dict.fromkeys(own.values())))
        parts.append(df.select(F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x")).select("x.*"))
    slots = range(max(len(m) for m in members.values()))
    counts = [F.count_if(F.col("slot") == j).alias(f"n{j}") for j in slots]
    met = stacked(parts).groupBy("place", "key").agg(F.count_if(F.col("slot") == -1).alias("held"), *counts)
    sums = [F.sum(f"n{j}").alias(f"n{j}") for j in slots]
    orphans = met.filter("held = 0").groupBy("place").agg(F.array(*sums).alias("orphans"))
    declared = [
        (i, j, child, column, places[i][0], severity)
        for i, own in members.items()
        for j, (child, column, severity) in enumerate(own)
    ]
    rows = parts[0].sparkSession.createDataFrame(
        declared, "place int, slot int, model string, column string, parent string, severity string"
    )
    failures = F.coalesce(F.get("orphans", F.col("slot")), F.lit(0)).alias("failures")
    return rows.join(orphans, "place", "left").select("model", "column", "parent", "severity", failures)


def dq_accepted_values(models: Models) -> DataFrame:
    return stacked([accepted_values(models(m, [c]), m, c, values) for m, c, values in ACCEPTED_VALUES])


def dq_unique_combination(models: Models) -> DataFrame:
    tables = {m: (models(m, columns), [Key(tuple(columns))]) for m, columns in UNIQUE_COMBINATION}
    found = repeated_in(tables)
    rows = [(m, ", ".join(columns), found[m][0].values) for m, columns in UNIQUE_COMBINATION]
    return _failures(next(iter(tables.values()))[0].sparkSession, rows)


def dq_equal_rowcount(models: Models) -> DataFrame:
    return stacked([equal_rowcount(models(m, []), models(other, []), m, other) for m, other in EQUAL_ROWCOUNT])


def dq_person_count(dim_customer: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Rows of the customer dimension against distinct persons in staging."""
    both = stacked([
        dim_customer.select(F.lit(1).alias("dim"), F.lit(None).cast("string").alias("person")),
        stg_customers.select(F.lit(0).alias("dim"), F.col("customer_unique_id").alias("person")).distinct(),
    ])
    return both.agg(
        F.count_if(F.col("dim") == 1).alias("dim_customer_count"),
        F.count("person").alias("distinct_customer_unique_id_count"),
    ).withColumn("success", F.col("dim_customer_count") == F.col("distinct_customer_unique_id_count"))
