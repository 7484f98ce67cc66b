"""Every operator as a query over one folder of the generated tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.functions.columns import surrogate_key
from feira.operators import contract, drilldown, expectations, fingerprint, intermediate, marts, model_tests, profiling, reports, rfm, sketches
from feira.operators.checked_load import load_checked
from feira.plans.build import MARTS, publish_marts
from feira.plans.catalog import Catalog
from feira.plans.workspace import new_folder, pinned, stored
from feira.schemas import ENTITIES
from feira.session import prepare
from feira.sources import files, sinks
from feira.sources.driver_tables import SETTINGS, DriverTables
from feira.sources.versions import Draft, Publication

Query = Callable[[SparkSession, str], DataFrame]

# expected row counts of the generated tables at scale factor 0.01
ROW_BASELINES = {
    "customers": 15_000,
    "orders": 15_000,
    "order_items": 60_000,
    "payments": 17_700,
    "reviews": 13_500,
    "products": 2_000,
    "sellers": 100,
    "geolocation": 13_800,
    "holidays": 20,
}
MART_BASELINES = {
    "fact_orders": {"rows": 15_000, "column": "order_total_value", "value": 3_300_000_000.0},
    "fact_payments": {"rows": 17_700, "column": "payment_value", "value": 2_000_000_000.0},
}
STAGING_CHECKS = expectations.layer_checks("staging", ROW_BASELINES)
RAW_CHECKS = expectations.layer_checks("raw", ROW_BASELINES)
MART_CHECKS = expectations.mart_checks(MART_BASELINES)

RFM_INPUT = ["customer_key", "order_id", "order_status", "order_purchase_timestamp", "gross_merchandise_value"]
ORDER_SPINE = ["order_key", "order_date_key"]
ITEM_VALUES = ["order_key", "price", "freight_value"]
ITEM_MONEY = ["order_key", "order_date_key", "price", "freight_value"]
ITEM_SALES = [*ITEM_MONEY, "product_key"]
SALE_ORDERS = ["order_key", "customer_key", "order_status", "order_purchase_timestamp"]
CUSTOMER_NAME = ["customer_key", "customer_unique_id"]
CUSTOMER_STATE = ["customer_key", "customer_state"]
# the generated tables have seven categories, so lists of ten would never cut
BEST = 3
SEGMENTS = ["Big Spenders", "Champions", "Lost Customers"]

PROFILED = ["customers", "orders", "order_items", "payments", "reviews", "products", "sellers", "geolocation",
            "category_translation"]
STAGING_OF = {**expectations.STAGING_MODELS, "category_translation": "stg_category_translation"}
# entities that are joined or summed from the generated tables, not read from one
JOINED = ("customers", "payments", "geolocation")
PROFILE_KEYS = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "order_items": ("order_id", "order_item_id"),
    "payments": ("order_id", "payment_sequential"),
    "reviews": ("order_id", "review_id"),
}


def mart_details(cat: Catalog) -> DataFrame:
    frames = {"fact_orders": cat.fact_orders(["order_total_value"]), "fact_payments": cat.fact_payments}
    return expectations.run_checks(frames, MART_CHECKS)


class World:
    """The frames of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark, runtime_filters=True)
        self.raw = DriverTables(spark, folder)
        self.cat = Catalog(spark, self.raw.entity, self.raw.holidays, SETTINGS)

    @cached_property
    def dates(self) -> DataFrame:
        """The calendar as the table it is in production: computed once, joined several times."""
        return pinned(self.cat.dim_date)

    @cached_property
    def spine(self) -> DataFrame:
        return self.cat.fact_orders(ORDER_SPINE)

    @cached_property
    def money(self) -> DataFrame:
        return self.cat.fact_order_items(ITEM_MONEY)

    @cached_property
    def values(self) -> DataFrame:
        return self.cat.fact_order_items(ITEM_VALUES)

    @cached_property
    def sales(self) -> DataFrame:
        return self.cat.fact_order_items(ITEM_SALES)

    @cached_property
    def rfm_input(self) -> DataFrame:
        return self.cat.fact_orders(RFM_INPUT)

    @cached_property
    def order_vs_aov(self) -> DataFrame:
        return drilldown.order_vs_aov(self.spine, self.values, self.dates, SETTINGS)

    @cached_property
    def daily_activity(self) -> DataFrame:
        return drilldown.daily_activity(self.money, self.dates, SETTINGS)

    @cached_property
    def category_spike(self) -> DataFrame:
        return drilldown.category_spike(self.sales, self.dates, self.cat.dim_product, SETTINGS)

    def category_sales(self, year: int) -> DataFrame:
        items = self.cat.fact_order_items([*ITEM_VALUES, "product_key"])
        orders = self.cat.fact_orders(["order_key", "order_status", "order_purchase_timestamp"])
        return drilldown.category_sales(items, orders, self.cat.dim_product, year)

    def year_start_sales(self, year: int) -> DataFrame:
        return self.category_sales(year).filter(F.col("month") <= SETTINGS.last_compared_month)

    @cached_property
    def labelled_sales(self) -> DataFrame:
        return drilldown.half_year_label(self.category_sales(SETTINGS.compare_years[0]))

    @cached_property
    def monthly_state_sales(self) -> DataFrame:
        orders = self.cat.fact_orders(SALE_ORDERS)
        return drilldown.monthly_state_sales(self.values, orders, self.cat.customers(CUSTOMER_STATE), SETTINGS.compare_years)

    @cached_property
    def comparison(self) -> DataFrame:
        early, late = (
            drilldown.category_revenue(self.category_sales(y), SETTINGS.last_compared_month)
            for y in SETTINGS.compare_years
        )
        return drilldown.compare_category_revenue(early, late, SETTINGS.compare_years)

    @cached_property
    def monthly_trend(self) -> DataFrame:
        orders = self.cat.fact_orders([*ORDER_SPINE, "customer_key"])
        return reports.monthly_sales_trend(
            orders, self.money, self.dates, self.cat.customers(CUSTOMER_STATE), SETTINGS
        )

    @cached_property
    def category_mix(self) -> DataFrame:
        return reports.holiday_product_category_mix(
            self.spine,
            self.cat.fact_order_items([*ITEM_VALUES, "product_key"]),
            self.dates,
            self.cat.dim_product,
            SETTINGS.top_categories,
            SETTINGS,
        )

    @cached_property
    def window_demand(self) -> DataFrame:
        return drilldown.holiday_window_demand(
            self.cat.stg_holiday_calendar, self.sales, self.cat.dim_product, SETTINGS.pad_days
        )

    @cached_property
    def rfm_detail(self) -> DataFrame:
        return drilldown.rfm_detail(self.cat.fct_customer_rfm, self.names)

    @cached_property
    def rfm_scores(self) -> DataFrame:
        return drilldown.rfm_scores(self.cat.fct_customer_rfm)

    @cached_property
    def rfm_report(self) -> DataFrame:
        places = self.cat.customers([*CUSTOMER_NAME, "customer_state", "customer_city"])
        return reports.rfm_analysis(self.cat.fct_customer_rfm, places, SETTINGS.top_customers)

    @cached_property
    def names(self) -> DataFrame:
        return self.cat.customers(CUSTOMER_NAME)

    def top(self, metric: str) -> DataFrame:
        return drilldown.best_customers(self.cat.fct_customer_rfm, self.names, 10, metric)

    @cached_property
    def staged(self) -> dict[str, DataFrame]:
        return {name: self.cat.model(model) for name, model in expectations.STAGING_MODELS.items()}

    @cached_property
    def profiled(self) -> dict[str, DataFrame]:
        return {name: self.cat.model(STAGING_OF[name]) for name in PROFILED}

    @cached_property
    def raw_entities(self) -> dict[str, DataFrame]:
        return {name: self.raw.entity(name) for name in PROFILED if name != "category_translation"}

    @cached_property
    def loaded(self) -> tuple[Publication, DataFrame]:
        """The staging layer, loaded, and its checks, measured meanwhile."""
        draft = Draft(self.spark, new_folder(self.spark, "checked-staging"))
        return load_checked(expectations.layer_frames(self.staged), STAGING_CHECKS, draft)

    @cached_property
    def check_details(self) -> DataFrame:
        return self.loaded[1]

    @cached_property
    def raw_check_details(self) -> DataFrame:
        """Checks of the raw layer, measured while it is loaded."""
        draft = Draft(self.spark, new_folder(self.spark, "checked-raw"))
        frames = expectations.read_layer(self.raw.entity, "raw")
        return load_checked(frames, RAW_CHECKS, draft)[1]

    @cached_property
    def mart_details(self) -> DataFrame:
        return mart_details(self.cat)

    @cached_property
    def loaded_mart_details(self) -> DataFrame:
        """The marts' checks over the staging layer as loaded, which is not built again for them."""
        cat = Catalog(self.spark, self.raw.entity, self.raw.holidays, SETTINGS)
        for name in ("customers", "orders", "order_items", "payments"):
            df = self.spark.read.parquet(self.loaded[0].tables[name])
            # the layer's checks spell the status in small letters
            df = df.withColumn("order_status", F.upper("order_status")) if name == "orders" else df
            setattr(cat, expectations.STAGING_MODELS[name], df)
        return mart_details(cat)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return reports.holiday_daily_metrics_by_quarter(self.spine, self.money, self.dates, SETTINGS)

    @cached_property
    def profiles(self) -> dict[str, DataFrame]:
        """The profile tables that are published beside the reports; all read the same tables."""
        tables = {name: stored(df, "profiled") if name in JOINED else df for name, df in self.profiled.items()}
        return {
            "profile_tables": profiling.profile_tables(tables),
            "profile_columns": profiling.profile_columns(tables),
            "profile_missing": profiling.profile_missing(tables),
            "profile_duplicates": profiling.profile_duplicates(tables),
            "profile_distribution": profiling.profile_distribution(self.cat.fct_customer_rfm),
        }

    def models(self, name: str, columns: list[str]) -> DataFrame:
        """A model for the structural tests; facts and customers are cut to ``columns`` when given."""
        if columns and name in ("fact_orders", "fact_order_items"):
            return getattr(self.cat, name)(columns)
        if columns and name == "dim_customer":
            return self.cat.customers(columns)
        if columns and name == "int_customer_orders":
            return intermediate.int_customer_orders(self.cat.stg_orders, self.cat.stg_customers, columns)
        if columns == ["customer_key"] and name == "fct_customer_rfm":
            return rfm.scored_customers(self.cat.fact_orders(["customer_key", "order_status"]))
        if columns == ["order_id"] and name == "int_order_payments":
            return self.payment_keys.select("order_id").distinct()
        return self.cat.model(name)

    @cached_property
    def payment_keys(self) -> DataFrame:
        """Payments are summed from all items, so the keys of both models over them are computed once."""
        return stored(self.cat.stg_order_payments.select(*marts.PAYMENT_KEY), "payment-keys")

    def unjoined(self, name: str, columns: list[str]) -> DataFrame:
        """A model's ``columns`` where every key that its rows are joined by was found to occur once."""
        if name in ("int_customer_orders", "int_orders"):
            return self.cat.stg_orders
        if name == "fact_payments":
            return self.payment_keys.select(surrogate_key(*marts.PAYMENT_KEY).alias("payment_key"))
        if name == "fact_reviews":
            return self.cat.stg_order_reviews.select(surrogate_key(*marts.REVIEW_ORDER_KEY).alias("review_order_key"))
        return self.models(name, columns)

    @cached_property
    def reports(self) -> dict[str, DataFrame]:
        """All reports over the same rows: the facts of the report window and the customers are computed once."""
        dates, rfm_table = self.dates, self.cat.fct_customer_rfm
        facts = (self.cat.fact_orders([*ORDER_SPINE, "customer_key"]), self.sales)
        orders, items = (stored(reports.in_report_window(f, SETTINGS), "report-window") for f in facts)
        people = stored(self.cat.customers([*CUSTOMER_NAME, "customer_state", "customer_city"]), "customers")
        return {
            "monthly_sales_trend": reports.monthly_sales_trend(orders, items, dates, people, SETTINGS),
            "rfm_analysis": reports.rfm_analysis(rfm_table, people, SETTINGS.top_customers),
            "rfm_segment_summary": reports.rfm_segment_summary(rfm_table),
            "holiday_impact": reports.holiday_impact(orders, items, dates, SETTINGS),
            "holiday_impact_by_quarter": reports.holiday_impact_by_quarter(orders, items, dates, SETTINGS),
            "holiday_daily_metrics_by_quarter": reports.holiday_daily_metrics_by_quarter(orders, items, dates, SETTINGS),
            "holiday_product_category_mix": reports.holiday_product_category_mix(
                orders, items, dates, self.cat.dim_product, SETTINGS.top_categories, SETTINGS
            ),
        }


# --- sources and sinks ------------------------------------------------------


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def src_csv(w: World) -> DataFrame:
    """Reviews, the entity with line breaks and quotes, written as CSV in two orders of columns and read back."""
    root = new_folder(w.spark, "csv")
    reviews = as_text(w.raw.entity("reviews"))
    early = F.col("review_creation_date") < "1995-01-01"
    sinks.write_csv(reviews.filter(early), f"{root}/reviews/early")
    late = reviews.filter(~early | early.isNull())
    sinks.write_csv(late.select("order_id", *reversed([c for c in late.columns if c != "order_id"])), f"{root}/reviews/late")
    return files.read_csv_entity(w.spark, ENTITIES["reviews"], [f"{root}/reviews/early", f"{root}/reviews/late"])


def src_csv_entities(w: World) -> DataFrame:
    """All nine entities through CSV files, with a byte-order mark in every header."""
    root = new_folder(w.spark, "csv")
    for name in ENTITIES:
        df = as_text(w.raw.entity(name))
        marked = df.withColumnRenamed(df.columns[0], files.BYTE_ORDER_MARK + df.columns[0])
        sinks.write_csv(marked, f"{root}/{name}.csv")
    return fingerprint.fingerprints(files.read_csv_folder(w.spark, root))


def src_json_records(w: World) -> DataFrame:
    """One JSON array per year, written as text files and read as records."""
    root = new_folder(w.spark, "json")
    years = []
    for year in SETTINGS.holiday_years:
        w.raw.holiday_documents(year).write.text(f"{root}/{year}")
        years.append(files.read_json_records(w.spark, f"{root}/{year}"))
    return model_tests.stacked(years)


def src_table(w: World) -> DataFrame:
    root = new_folder(w.spark, "tables")
    w.cat.stg_orders.write.parquet(files.table_path(root, "staging", "stg_orders"))
    return files.read_table(w.spark, root, "staging", "stg_orders")


def src_layer_frames(w: World) -> DataFrame:
    """Every logical table of both layers, read back by its name there, as value fingerprints."""
    root = new_folder(w.spark, "layers")
    sinks.load_raw(w.raw.entities(), root)
    raw = sinks.read_raw(w.spark, root)
    # staging reads what was loaded, as in production
    loaded = Catalog(w.spark, raw.__getitem__, w.raw.holidays, SETTINGS)
    for name in expectations.STAGING_MODELS.values():
        loaded.model(name).write.parquet(files.table_path(root, "staging", name))
    readers = {
        "raw": raw.__getitem__,
        "staging": lambda name: files.read_table(w.spark, root, "staging", name),
    }
    return model_tests.stacked([
        fingerprint.fingerprints(expectations.read_layer(read, layer)).withColumn("layer", F.lit(layer))
        for layer, read in readers.items()
    ])


def sink_mart(w: World) -> DataFrame:
    """Publish all marts and take the fingerprints of the tables read back."""
    root = new_folder(w.spark, "marts")
    publish_marts(w.cat, root)
    return fingerprint.fingerprints({name: sinks.read_mart(w.spark, name, root) for name in MARTS})


def marts_monthly_sales_trend(w: World) -> DataFrame:
    """The monthly report over published mart tables, as in production."""
    tables = publish_marts(
        w.cat, new_folder(w.spark, "marts"), names=["dim_date", "dim_customer", "fact_orders", "fact_order_items"]
    )
    return reports.monthly_sales_trend(
        tables.fact_orders(), tables.fact_order_items(), tables.dim_date, tables.dim_customer, SETTINGS
    )


def _published(w: World, *names: str):
    return publish_marts(w.cat, new_folder(w.spark, "marts"), names=names)


def marts_order_vs_aov(w: World) -> DataFrame:
    """The spike months over published tables: both facts open the folders of those months only."""
    tables = _published(w, "dim_date", "fact_orders", "fact_order_items")
    return drilldown.order_vs_aov(tables.fact_orders(), tables.fact_order_items(), tables.dim_date, SETTINGS)


def marts_holiday_impact_all_orders(w: World) -> DataFrame:
    tables = _published(w, "dim_date", "fact_orders", "fact_order_items")
    return drilldown.holiday_impact_all_orders(
        tables.fact_orders(), tables.fact_order_items(), tables.dim_date, SETTINGS
    )


def marts_category_sales(w: World) -> DataFrame:
    tables = _published(w, "dim_product", "fact_orders", "fact_order_items")
    return drilldown.category_sales(
        tables.fact_order_items(), tables.fact_orders(), tables.dim_product, SETTINGS.compare_years[0]
    )


def marts_holiday_window_demand(w: World) -> DataFrame:
    tables = _published(w, "dim_product", "fact_order_items")
    return drilldown.holiday_window_demand(
        w.cat.stg_holiday_calendar, tables.fact_order_items(), tables.dim_product, SETTINGS.pad_days
    )


def sink_raw_load(w: World) -> DataFrame:
    """Load the raw entities and take the fingerprints of the tables read back."""
    root = new_folder(w.spark, "raw")
    sinks.load_raw(w.raw.entities(), root)
    return fingerprint.fingerprints(sinks.read_raw(w.spark, root))


def _write_reports(w: World, frames: dict[str, DataFrame]) -> tuple[str, dict[str, DataFrame]]:
    """Folder and frames of the reports, computed once and written."""
    root = new_folder(w.spark, "reports")
    kept = {name: pinned(df) for name, df in frames.items()}
    for name, df in kept.items():
        sinks.write_report(name, df, root)
    return root, kept


def sink_report(w: World) -> DataFrame:
    """Write the seven reports and the profiles, read them back, and compare columns, rows and values."""
    root, frames = _write_reports(w, {**w.reports, **w.profiles})
    parts = []
    for name, df in frames.items():
        back = sinks.read_report(w.spark, name, root)
        written = fingerprint.table_fingerprint(sinks.as_text(df), name)
        found = fingerprint.table_fingerprint(sinks.as_text(back), name).withColumnsRenamed(
            {c: f"found_{c}" for c in ("rows", "columns", "hash_sum", "hash_xor")}
        )
        equal = (F.col("hash_sum") == F.col("found_hash_sum")) & (F.col("hash_xor") == F.col("found_hash_xor"))
        parts.append(
            written.join(found, "table").select(
                F.col("table").alias("report"),
                "rows",
                F.col("found_rows").alias("written_rows"),
                F.lit(sinks.published_columns(df, back)).alias("same_columns"),
                equal.alias("same_values"),
            )
        )
    return model_tests.stacked(parts)


def report_contract(w: World) -> DataFrame:
    """The column contract of the reports as files."""
    root, _ = _write_reports(w, w.reports)
    return contract.published_contract(w.spark, root)


def profile_columns_merged(w: World) -> DataFrame:
    """Profiles of the facts merged from monthly sketches, added in two steps, beside exact distinct counts."""
    tables = _published(w, "fact_orders", "fact_order_items")
    path = new_folder(w.spark, "sketches")
    middle = SETTINGS.report_start[0] * 100
    facts = {"fact_orders": tables.fact_orders(), "fact_order_items": tables.fact_order_items()}
    for name, df in facts.items():
        sketches.update_sketches(df.filter(F.col("month_key") < middle), name, path)
        sketches.update_sketches(df, name, path)
    merged = sketches.merged_profile(sketches.kept_sketches(w.spark, path))
    known = {(r["table"], r["column"]): (r["rows"], r["unique_estimate"]) for r in merged.collect()}
    exact = profiling.profile_columns({n: df.drop("month_key") for n, df in facts.items()}, known)
    near = F.abs(F.col("unique_estimate") - F.col("unique_count")) <= F.greatest(F.col("unique_count") * 0.02, F.lit(0))
    return merged.join(exact.select("table", "column", "unique_count"), ["table", "column"]).select(
        "table", "column", "rows", "null_count", near.alias("within_2_percent")
    )


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Floating statistics to a precision two engines agree on."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- one entry per operator -------------------------------------------------

QUERIES: dict[str, Callable[[World], DataFrame]] = {
    "src_csv": src_csv,
    "src_csv_entities": src_csv_entities,
    "src_json_records": src_json_records,
    "src_table": src_table,
    "src_layer_frames": src_layer_frames,
    "sink_mart": sink_mart,
    "marts_monthly_sales_trend": marts_monthly_sales_trend,
    "marts_order_vs_aov": marts_order_vs_aov,
    "marts_holiday_impact_all_orders": marts_holiday_impact_all_orders,
    "marts_category_sales": marts_category_sales,
    "marts_holiday_window_demand": marts_holiday_window_demand,
    "sink_raw_load": sink_raw_load,
    "sink_report": sink_report,
}

for _name in [
    "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_customers", "stg_sellers",
    "stg_products", "stg_category_translation", "stg_geolocation", "stg_holiday_calendar",
    "int_order_items", "int_order_payments", "int_order_reviews", "int_geolocation", "int_customer_orders",
    "int_orders", "dim_date", "dim_geolocation", "dim_customer", "dim_product", "dim_seller", "fact_orders",
    "fact_order_items", "fact_payments", "fact_reviews", "fct_customer_rfm",
]:
    QUERIES[_name] = lambda w, _n=_name: w.cat.model(_n)

QUERIES |= {
    "order_item_rollup": lambda w: intermediate.order_item_rollup(w.cat.int_order_items),
    "customer_type": lambda w: intermediate.order_customers(w.cat.stg_orders, w.cat.stg_customers).select(
        "order_id", "customer_unique_id", "first_order_timestamp", "customer_type"
    ),
    "delivery_metrics": lambda w: intermediate.delivery_metrics(w.cat.stg_orders).select(
        "order_id", "delivery_days", "estimated_delivery_days", "is_late"
    ),
    "rfm_metrics": lambda w: rfm.rfm_metrics(w.rfm_input, SETTINGS.analysis_date),
    "rfm_percentile_scores": lambda w: rfm.rfm_percentile_scores(
        rfm.rfm_metrics(w.rfm_input, SETTINGS.analysis_date)
    ).select("customer_key", "recency_score", "monetary_score"),
    "rfm_frequency_band": lambda w: rfm.rfm_frequency_band(
        rfm.rfm_metrics(w.rfm_input, SETTINGS.analysis_date)
    ).select("customer_key", "frequency", "frequency_score"),
    "rfm_segment": lambda w: w.cat.fct_customer_rfm.select(
        "customer_key", "rfm_code", "rfm_total_score", "customer_segment"
    ),
    # published reports
    "order_totals": lambda w: reports.order_totals(w.money, w.dates, SETTINGS),
    "monthly_sales_trend": lambda w: w.monthly_trend,
    "rfm_analysis": lambda w: w.rfm_report,
    "rfm_segment_summary": lambda w: reports.rfm_segment_summary(w.cat.fct_customer_rfm),
    "holiday_impact": lambda w: reports.holiday_impact(w.spine, w.money, w.dates, SETTINGS),
    "holiday_impact_by_quarter": lambda w: reports.holiday_impact_by_quarter(
        w.spine, w.money, w.dates, SETTINGS
    ),
    "holiday_daily_metrics_by_quarter": lambda w: w.daily_metrics,
    "holiday_product_category_mix": lambda w: w.category_mix,
    # drill-downs
    "order_vs_aov": lambda w: w.order_vs_aov,
    "month_over_month_growth": lambda w: drilldown.month_over_month_growth(w.order_vs_aov, SETTINGS),
    "daily_activity": lambda w: w.daily_activity,
    "peak_day": lambda w: drilldown.peak_day(w.daily_activity),
    "category_spike": lambda w: w.category_spike,
    "category_spike_top10": lambda w: drilldown.category_spike_top10(w.category_spike),
    "category_sales": lambda w: w.category_sales(SETTINGS.compare_years[0]),
    "monthly_state_sales": lambda w: w.monthly_state_sales,
    "region_rollup": lambda w: drilldown.region_rollup(w.monthly_state_sales),
    "half_year_label": lambda w: w.labelled_sales,
    "half_year_revenue": lambda w: drilldown.half_year_revenue(w.labelled_sales),
    "top10_each_month": lambda w: drilldown.top10_each_month(w.labelled_sales),
    "top3_each_month": lambda w: drilldown.top10_each_month(w.labelled_sales, BEST),
    "category_frequency": lambda w: drilldown.category_frequency(drilldown.top10_each_month(w.labelled_sales, BEST)),
    "category_frequency_overall": lambda w: drilldown.category_frequency(
        drilldown.top10_each_month(w.year_start_sales(SETTINGS.compare_years[1]), BEST), by_half=False
    ),
    "category_summary": lambda w: drilldown.category_summary(
        drilldown.half_year_revenue(w.labelled_sales),
        drilldown.category_frequency(drilldown.top10_each_month(w.labelled_sales, BEST)),
    ),
    "category_summary_overall": lambda w: drilldown.category_summary(
        drilldown.category_revenue(w.year_start_sales(SETTINGS.compare_years[1])),
        drilldown.category_frequency(
            drilldown.top10_each_month(w.year_start_sales(SETTINGS.compare_years[1]), BEST), by_half=False
        ),
    ),
    "category_revenue_jan_jun": lambda w: drilldown.category_revenue(
        w.category_sales(SETTINGS.compare_years[1]), SETTINGS.last_compared_month
    ),
    "compare_category_revenue": lambda w: w.comparison,
    "category_revenue_changes": lambda w: drilldown.category_revenue_changes(w.comparison, SETTINGS.compare_years),
    "holiday_impact_all_orders": lambda w: drilldown.holiday_impact_all_orders(
        w.spine, w.values, w.dates, SETTINGS
    ),
    "holiday_impact_by_quarter_all_orders": lambda w: drilldown.holiday_impact_by_quarter_all_orders(
        w.spine, w.values, w.dates, SETTINGS
    ),
    "holiday_daily_metrics_all_orders": lambda w: drilldown.holiday_daily_metrics_all_orders(
        w.spine, w.values, w.dates, SETTINGS
    ),
    "holiday_category_mix_known": lambda w: drilldown.holiday_category_mix_known(
        w.sales, w.dates, w.cat.dim_product, SETTINGS.top_categories, SETTINGS
    ),
    "holiday_events": lambda w: drilldown.holiday_events(w.cat.stg_holiday_calendar),
    "holiday_window_demand": lambda w: w.window_demand,
    "biggest_holiday_changes": lambda w: drilldown.biggest_holiday_changes(
        w.window_demand, SETTINGS.holiday_years[-1]
    ),
    "holiday_category_label": lambda w: drilldown.holiday_category_label(
        drilldown.biggest_holiday_changes(w.window_demand, SETTINGS.holiday_years[-1])
    ).select("holiday_category", "holiday_change_value"),
    "rfm_detail": lambda w: w.rfm_detail,
    "rfm_segment_filtered": lambda w: drilldown.rfm_segment_filtered(w.rfm_scores, SEGMENTS),
    "rfm_kpis": lambda w: drilldown.rfm_kpis(w.rfm_scores),
    "rfm_segment_list": lambda w: drilldown.rfm_segment_list(w.rfm_scores),
    "top_customers": lambda w: w.top("monetary_value"),
    "top_customers_by_frequency": lambda w: w.top("frequency"),
    "top_customers_by_recency": lambda w: w.top("recency_days"),
    "report_top10_view": lambda w: drilldown.report_top10_view(w.rfm_report),
    "pivot_month_region": lambda w: drilldown.pivot_month_region(w.monthly_trend),
    "pivot_state_month_region": lambda w: drilldown.pivot_month_region(
        drilldown.region_rollup(w.monthly_state_sales), "month"
    ),
    "pivot_quarter_daytype": lambda w: drilldown.pivot_quarter_daytype(w.daily_metrics, "avg_gmv_per_day"),
    "pivot_quarter_daytype_orders": lambda w: drilldown.pivot_quarter_daytype(w.daily_metrics, "avg_orders_per_day"),
    "pivot_category_daytype": lambda w: drilldown.pivot_category_daytype(w.category_mix),
    # structural tests
    "dq_not_null": lambda w: model_tests.dq_not_null(w.models),
    "dq_unique": lambda w: model_tests.dq_unique(w.models, w.unjoined),
    "dq_relationships": lambda w: model_tests.dq_relationships(w.models),
    "dq_accepted_values": lambda w: model_tests.dq_accepted_values(w.models),
    "dq_unique_combination": lambda w: model_tests.dq_unique_combination(w.models),
    "dq_equal_rowcount": lambda w: model_tests.dq_equal_rowcount(w.models),
    "dq_person_count": lambda w: model_tests.dq_person_count(w.cat.dim_customer, w.cat.stg_customers),
    # plausibility checks
    "dq_coerce": lambda w: expectations.dq_coerce(w.raw_entities),
    "dq_status_date_consistency": lambda w: expectations.dq_status_date_consistency(
        expectations.layer_frames({"orders": w.cat.stg_orders})["orders"]
    ).select("order_id", "order_status", "delivery_date_matches_status"),
    "dq_shipping_after_purchase": lambda w: expectations.dq_shipping_after_purchase(
        w.cat.stg_order_items, w.cat.stg_orders
    ).select("order_id", "order_item_id", "product_id", "shipping_after_purchase"),
    "dq_order_reconciliation": lambda w: expectations.dq_order_reconciliation(
        w.cat.stg_order_items, w.cat.stg_order_payments
    ),
    "dq_mart_sanity": lambda w: w.mart_details,
    "dq_suite_run": lambda w: expectations.dq_suite_run(
        w.spark, w.check_details, [*expectations.STAGING_MODELS, "order_reconciliation"]
    ),
    "dq_suite_run_raw": lambda w: expectations.dq_suite_run(
        w.spark, w.raw_check_details, [*expectations.LAYER_TABLES["raw"], "order_reconciliation"]
    ),
    "dq_failure_detail_raw": lambda w: expectations.dq_failure_detail(w.raw_check_details),
    "dq_failure_detail": lambda w: expectations.dq_failure_detail(w.check_details),
    "dq_observation_unexpected": lambda w: expectations.dq_observation_unexpected(w.check_details),
    "dq_gate": lambda w: expectations.dq_gate(w.check_details.unionByName(w.loaded_mart_details)),
    # profiles
    "profile_tables": lambda w: profiling.profile_tables(w.profiled),
    "profile_columns": lambda w: profiling.profile_columns(w.profiled),
    "profile_columns_merged": profile_columns_merged,
    "profile_missing": lambda w: profiling.profile_missing(w.profiled),
    "profile_duplicates": lambda w: profiling.profile_duplicates(w.profiled),
    "profile_keys": lambda w: profiling.profile_keys(w.profiled, PROFILE_KEYS),
    "profile_distribution": lambda w: rounded(profiling.profile_distribution(w.cat.fct_customer_rfm), 4),
    "report_contract": report_contract,
}


CHECK_KINDS = {
    "ex_not_null": "not_null",
    "ex_in_set": "in_set",
    "ex_between": "between",
    "ex_regex": "regex",
    "ex_pair_greater": "pair_greater",
    "ex_mean_between": "mean_between",
    "ex_row_count_between": "row_count_between",
    "ex_compound_unique": "compound_unique",
}


def _of_kind(kind: str) -> Callable[[World], DataFrame]:
    checks = expectations.of_kind(STAGING_CHECKS, kind)
    return lambda w: expectations.run_checks(expectations.check_frames(w.staged), checks)


QUERIES |= {name: _of_kind(kind) for name, kind in CHECK_KINDS.items()}
QUERIES["ex_sum_between"] = lambda w: w.mart_details.filter(F.col("expectation") == "sum_between")


def plain(df: DataFrame) -> DataFrame:
    """Exchange types any client reads alike: decimals as double, dates and moments as text."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")
        out.append(column.alias(name))
    return df.select(*out)


def _entry(name: str) -> Query:
    return lambda spark, folder: plain(QUERIES[name](World(spark, folder)))


def queries() -> dict[str, Query]:
    return {name: _entry(name) for name in QUERIES}
