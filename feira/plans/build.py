"""Publishes the star schema: views become tables, in dependency order."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from feira.operators import marts, rfm
from feira.plans.catalog import Catalog, MartTables
from feira.plans.workspace import scratch, shuffles_released
from feira.sources.sinks import PARTITION_KEYS, ROWS_PER_BUCKET, mart_folder, read_mart, read_published, write_mart
from feira.sources.versions import Draft, Publication

MARTS = [
    "dim_date",
    "dim_geolocation",
    "dim_product",
    "dim_customer",
    "dim_seller",
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "fact_reviews",
    "fct_customer_rfm",
]


def mart_tables(catalog: Catalog, root: str, env: str = "dev") -> MartTables:
    """The published tables, facts with their month folder."""
    return MartTables(
        lambda name: read_mart(catalog.spark, name, root, env, with_month=True), catalog.settings
    )


def buckets_for_orders(orders: DataFrame, rows: int = ROWS_PER_BUCKET) -> int:
    """Buckets of the facts, a power of two so that layouts of different sizes still divide one another."""
    return 1 << max(0, (orders.count() - 1) // rows).bit_length()


def publish_marts(
    catalog: Catalog,
    root: str,
    env: str = "dev",
    names: Iterable[str] = MARTS,
    writers: int = 4,
    buckets: int | None = None,
    together: int | None = None,
) -> MartTables:
    """Full refresh of the marts, a few dimensions at a time; readers see all new tables at once, at the end.

    Dimensions that look up a ZIP read the new location table, and the customer scores read the new orders, so
    neither is computed twice. ``buckets`` of the facts follow the number of orders unless given. Facts are written one after
    the other, ``together`` buckets at a time: on disk lie what is written so far and the shuffle files of these buckets.
    """
    wanted = [n for n in MARTS if n in set(names)]
    draft = Draft(catalog.spark, mart_folder(root, env))
    facts = set(PARTITION_KEYS) & set(wanted)
    parts = buckets or (buckets_for_orders(catalog.stg_orders) if facts else 1)

    def written(name: str) -> DataFrame:
        return read_published(catalog.spark, Publication(0, draft.version, draft.tables, draft.buckets), name)

    def location() -> DataFrame:
        return written("dim_geolocation") if "dim_geolocation" in wanted else catalog.dim_geolocation

    def frame(name: str) -> DataFrame:
        if name == "dim_customer":
            return marts.dim_customer(catalog.stg_customers, catalog.stg_orders, location())
        if name == "dim_seller":
            return marts.dim_seller(catalog.stg_sellers, location())
        if name == "fct_customer_rfm" and "fact_orders" in wanted:
            return rfm.fct_customer_rfm(written("fact_orders"), catalog.settings.analysis_date)
        return catalog.model(name)

    def write(name: str) -> None:
        # another supplier of models may hand out finished facts only
        laid_out = name in facts and hasattr(catalog, "bucketed_fact")
        with scratch(catalog.spark) as keep:
            df = catalog.bucketed_fact(name, parts, keep) if laid_out else frame(name)
            write_mart(draft, name, df, parts, laid_out, together)

    last = {"dim_customer", "dim_seller", "fct_customer_rfm"}
    with shuffles_released(catalog.spark), ThreadPoolExecutor(max_workers=writers) as pool:
        list(pool.map(write, [n for n in wanted if n not in last and n not in facts]))
        for name in wanted:
            if name in facts:
                write(name)
        list(pool.map(write, [n for n in wanted if n in last]))
    publication = draft.commit()
    return MartTables(lambda name: read_published(catalog.spark, publication, name, with_month=True), catalog.settings)
