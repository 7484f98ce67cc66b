"""Binds the generated order/line tables to the raw entities of ``feira.schemas``.

Columns keep their stored type where one exists. Staging still has real work to
do: blanks around the status, approval times as text with an unparsable one now
and then, repeated keys, unmatched ZIP prefixes and untranslated categories.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.domain import STATES
from feira.functions.columns import MONEY, minus
from feira.schemas import ENTITIES, HOLIDAY_RECORD
from feira.settings import Settings
from feira.sources.files import json_records

SETTINGS = Settings(
    calendar_start=date(1995, 1, 1),
    calendar_end=date(2001, 12, 31),
    holiday_years=(1999, 2000),
    analysis_date=date(2001, 8, 2),
    report_start=(1999, 1),
    report_end=(2000, 6),
    spike_year=2000,
    spike_months=(10, 11, 12),
    spike_base_month=10,
    spike_month=11,
    compare_years=(1999, 2000),
)

# holiday names by MMdd, or by yyyyMMdd where the day moves
HOLIDAYS = {
    "0101": "Confraternização mundial",
    "19990215": "Carnaval",
    "19990216": "Carnaval",
    "20000306": "Carnaval",
    "20000307": "Carnaval",
    "0421": "Tiradentes",
    "0501": "Dia do trabalho",
    "0907": "Independência do Brasil",
    "1012": "Nossa Senhora Aparecida",
    "1102": "Finados",
    "1115": "Proclamação da República",
    "1225": "Natal",
}
WEEKDAYS = [
    "domingo", "segunda-feira", "terça-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sábado",
]
PAYMENT_TYPES = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "voucher",
    "4-NOT SPECIFIED": "debit_card",
    "5-LOW": "credit_card",
}
UNTRANSLATED = "SMALL"

# Stored schemas, so that planning a query opens no file footers.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(17,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def _days(moment: Column, n: Column | int) -> Column:
    return moment + F.make_dt_interval(F.lit(n) if isinstance(n, int) else n)


def _choose(value: Column, options: dict[str, str]) -> Column:
    expr = None
    for key, out in options.items():
        expr = F.when(value == key, out) if expr is None else expr.when(value == key, out)
    return expr


class DriverTables:
    """The raw entities of one data folder, built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def entity(self, name: str) -> DataFrame:
        build: Callable[[], DataFrame] = getattr(self, f"_{name}")
        return build().select(*ENTITIES[name].columns)

    def entities(self) -> dict[str, DataFrame]:
        return {name: self.entity(name) for name in ENTITIES}

    def _orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        bought = F.col("o_orderdate") + F.make_dt_interval(mins=(k % 1440).cast("int"))
        status = (
            F.when(k % 50 == 7, "canceled")
            .when(k % 70 == 9, "unavailable")
            .when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .otherwise("processing")
        )
        carrier_days = F.when(k % 50 == 11, -1).otherwise(2)
        return self.table("orders").select(
            k.cast("string").alias("order_id"),
            F.concat(F.lit("A"), k.cast("string")).alias("customer_id"),
            F.concat(F.lit(" "), status, F.lit(" ")).alias("order_status"),
            bought.alias("order_purchase_timestamp"),
            F.when(k % 400 == 3, "n/a")
            .otherwise((bought + F.make_dt_interval(hours=F.lit(1))).cast("string"))
            .alias("order_approved_at"),
            _days(bought, carrier_days).alias("order_delivered_carrier_date"),
            F.when(status == "delivered", _days(bought, (3 + k % 25).cast("int"))).alias(
                "order_delivered_customer_date"
            ),
            _days(F.col("o_orderdate"), 15).alias("order_estimated_delivery_date"),
        )

    def _accounts(self) -> DataFrame:
        """One account per order with the index of its ZIP area."""
        people = self.table("customer").select("c_custkey", "c_nationkey")
        areas = self.table("nation").select(F.col("n_nationkey").alias("z"), F.col("n_name").alias("city"))
        states = F.array(*[F.lit(s) for s in STATES])
        return (
            self.table("orders")
            .join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
            .withColumn("z", ((F.col("c_nationkey") + F.col("o_orderkey")) % 25).cast("int"))
            .join(areas, "z", "left")
            .select(
                "o_orderkey",
                "o_custkey",
                "z",
                "city",
                F.lpad(F.col("z").cast("string"), 5, "0").alias("zip"),
                F.get(states, F.col("z")).alias("state"),
            )
        )

    def _customers(self) -> DataFrame:
        k = F.col("o_orderkey")
        person = (F.col("o_custkey") * 8 + k % 8).cast("string")
        return self._accounts().select(
            F.concat(F.lit("A"), k.cast("string")).alias("customer_id"),
            F.concat(F.lit("P"), person).alias("customer_unique_id"),
            F.col("zip").alias("customer_zip_code_prefix"),
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    def _geolocation(self) -> DataFrame:
        """A point per account; areas 23 and 24 stay without one."""
        shift = (F.col("o_orderkey") % 7).cast("decimal(3,1)") / F.lit(10).cast("decimal(3,0)")
        z = F.col("z").cast("decimal(9,1)")
        return self._accounts().filter(F.col("z") < 23).select(
            F.col("zip").alias("geolocation_zip_code_prefix"),
            (shift - z).cast("decimal(9,1)").alias("geolocation_lat"),
            (shift - z - 40).cast("decimal(9,1)").alias("geolocation_lng"),
            F.col("city").alias("geolocation_city"),
            F.col("state").alias("geolocation_state"),
        )

    def _lines(self) -> DataFrame:
        """Line items with exact money: whole cents first, as a double turns into a decimal slowly."""
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        percent = F.round(F.col("l_tax") * 100).cast("bigint")
        return (
            self.table("lineitem")
            .withColumns({"__cents": cents, "__percent": percent})
            .withColumns({
                "price": _money(F.col("__cents")),
                # tax on the price, half up to a cent
                "freight": _money(F.expr("(__cents * __percent + 50L) div 100L")),
            })
        )

    def _order_items(self) -> DataFrame:
        return self._lines().select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            "price",
            F.col("freight").alias("freight_value"),
        )

    def _payments(self) -> DataFrame:
        """One payment per order with items, every fifth order paid in two parts."""
        k = F.col("o_orderkey")
        due = self._lines().groupBy("l_orderkey").agg(F.sum(F.col("price") + F.col("freight")).alias("due"))
        total = (F.col("due") + F.when(k % 97 == 0, F.lit(1)).otherwise(F.lit(0))).cast(MONEY)
        first = F.round(total.cast("decimal(18,2)") * F.lit(6) / F.lit(10), 2).cast(MONEY)
        parts = F.when(
            k % 5 == 0,
            F.array(
                F.struct(F.lit(1).alias("seq"), first.alias("value")),
                F.struct(F.lit(2).alias("seq"), minus(total, first).cast(MONEY).alias("value")),
            ),
        ).otherwise(F.array(F.struct(F.lit(1).alias("seq"), total.alias("value"))))
        return (
            self.table("orders")
            .join(due, k == F.col("l_orderkey"))
            .select(k, "o_orderpriority", F.explode(parts).alias("part"))
            .select(
                k.cast("string").alias("order_id"),
                F.col("part.seq").alias("payment_sequential"),
                _choose(F.col("o_orderpriority"), PAYMENT_TYPES).alias("payment_type"),
                (1 + k % 10).alias("payment_installments"),
                F.col("part.value").alias("payment_value"),
            )
        )

    def _reviews(self) -> DataFrame:
        k = F.col("o_orderkey")
        created = _days(F.col("o_orderdate"), 20)
        return self.table("orders").filter(k % 10 != 0).select(
            F.concat(F.lit("R"), F.floor(k / 2).cast("string")).alias("review_id"),
            k.cast("string").alias("order_id"),
            (1 + k % 5).alias("review_score"),
            F.when(k % 8 == 0, F.concat(F.lit(" title "), k.cast("string"))).alias("review_comment_title"),
            F.when(k % 2 != 0, F.concat(F.lit("message, \""), k.cast("string"), F.lit("\"\nsecond line "))).alias(
                "review_comment_message"
            ),
            created.alias("review_creation_date"),
            _days(created, 2).alias("review_answer_timestamp"),
        )

    def _products(self) -> DataFrame:
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.when(F.col("p_partkey") % 50 != 0, F.lower("p_type")).alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            (F.length("p_name") * 10).alias("product_description_lenght"),
            (1 + size % 5).alias("product_photos_qty"),
            (size * 100).alias("product_weight_g"),
            (size + 10).alias("product_length_cm"),
            (size + 5).alias("product_height_cm"),
            (size + 8).alias("product_width_cm"),
        )

    def _sellers(self) -> DataFrame:
        z = F.col("s_nationkey")
        areas = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("city"))
        return self.table("supplier").join(areas, "s_nationkey", "left").select(
            F.col("s_suppkey").cast("string").alias("seller_id"),
            F.lpad(z.cast("string"), 5, "0").alias("seller_zip_code_prefix"),
            F.col("city").alias("seller_city"),
            F.get(F.array(*[F.lit(s) for s in STATES]), z).alias("seller_state"),
        )

    def _category_translation(self) -> DataFrame:
        """All part types but one, so that one category stays untranslated."""
        kind = F.lower("p_type")
        return self.table("part").filter(F.col("p_type") != UNTRANSLATED).select("p_type").distinct().select(
            kind.alias("product_category_name"),
            F.concat(F.lit(" "), kind, F.lit("_goods")).alias("product_category_name_english"),
        )

    def holiday_documents(self, year: int) -> DataFrame:
        """The JSON array a holiday service would answer for ``year``: the holidays with orders."""
        day = F.col("day")
        fixed = _choose(F.date_format(day, "MMdd"), {k: v for k, v in HOLIDAYS.items() if len(k) == 4})
        moving = _choose(F.date_format(day, "yyyyMMdd"), {k: v for k, v in HOLIDAYS.items() if len(k) == 8})
        weekday = F.get(F.array(*[F.lit(w) for w in WEEKDAYS]), F.dayofweek(day) - 1)
        bought = F.col("o_orderdate")
        days = (
            self.table("orders")
            .filter((bought >= F.lit(datetime(year, 1, 1))) & (bought < F.lit(datetime(year + 1, 1, 1))))
            .select(F.to_date(bought).alias("day"))
            .distinct()
            .select(
                F.date_format(day, "yyyy-MM-dd").alias("date"),
                F.coalesce(moving, fixed).alias("name"),
                F.lit("national").alias("type"),
                weekday.alias("weekday"),
            )
            .filter(F.col("name").isNotNull())
        )
        record = F.struct(*HOLIDAY_RECORD.fieldNames())
        # one year holds at most 366 records
        return days.agg(F.to_json(F.sort_array(F.collect_list(record))).alias("document"))

    def holidays(self, year: int) -> DataFrame:
        return json_records(self.holiday_documents(year), F.col("document"))
